"""Fitted operators: held-out accuracy, gradients and defined results on odd input."""

import zlib
from itertools import product

import numpy as np
import pytest
from fixtures import documents, frame, words

from fieldstar.llm import line_crf
from fieldstar.llm.secret_forest import scan_secrets


def labelled(spark, count=240):
    """Documents of prose, shouting, symbols and repeats, most of several lines, and their labels."""
    import random

    rng = random.Random(5)
    rows, labels = [], []
    for i in range(count):
        lines = [words(rng, rng.randrange(6, 20)).capitalize() + "." for _ in range(rng.randrange(1, 6))]
        bad = i % 4 == 0
        if bad:
            kind = rng.randrange(3)
            spoil = [
                lambda x: " ".join(w.upper() + "!!" for w in x.split()),
                lambda x: " | ".join(x.split()) + " |",
                lambda x: " ".join([x.split()[0]] * 20),
            ][kind]
            lines = [spoil(x) for x in lines]
        rows.append((i, "\n".join(lines), "s"))
        labels.append((i, int(not bad), 0))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_is_right_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    found = line_crf.score_quality(docs, labels).collect()
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


def test_held_out_labels_do_not_change_scores(spark):
    docs, labels = labelled(spark, 80)
    from fieldstar.llm.common import held_out

    turned = labels.withColumn("quality", (1 - labels["quality"]) * held_out("doc_id", 5).cast("int") + labels["quality"]
                               * (~held_out("doc_id", 5)).cast("int"))
    score = lambda known: sorted(tuple(r) for r in line_crf.score_quality(docs, known).collect())
    assert score(labels) == score(turned)


def test_classifier_on_odd_tables(spark):
    docs, labels = labelled(spark, 40)
    assert line_crf.score_quality(frame(spark, []), labels).count() == 0
    plain = line_crf.score_quality(frame(spark), labels.limit(0)).collect()
    assert len(plain) == len(documents())
    assert {r["score"] for r in plain} == {0.5}
    every = line_crf.score_quality(frame(spark), spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int"))
    assert {r["score"] for r in every.collect()} == {0.5}
    assert every.count() == len(documents())


def test_classifier_learns_from_long_documents_and_once_per_id(spark, monkeypatch):
    docs, labels = labelled(spark, 60)
    monkeypatch.setattr(line_crf, "MAX_TRAINING_LINES", 3)
    again = docs.unionByName(docs.filter("doc_id < 20")).unionByName(docs.filter("doc_id < 20"))
    sample = line_crf.training_sample(again, labels, "doc_id", "text", "quality", 4000)
    expected = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(60))
    assert len(sample[0]) == len(sample[1]) == expected
    assert max(len(d) for d in sample[0]) == 3 and len(set(sample[1])) == 2


def test_marginals_are_sums_over_all_labellings():
    rng = np.random.default_rng(2)
    ratios, go = np.exp(rng.normal(size=6)), np.exp(rng.normal(size=(2, 2)))
    weight = np.zeros((6, 2))
    for path in product((0, 1), repeat=6):
        total = np.prod([ratios[t] if y else 1.0 for t, y in enumerate(path)])
        total *= np.prod([go[a, b] for a, b in zip(path, path[1:], strict=False)])
        for t, y in enumerate(path):
            weight[t, y] += total
    assert np.allclose(line_crf.marginals(ratios.tolist(), go), weight[:, 1] / weight.sum(1))


SECRETS = [
    ("AKIA" + "Q7ZP2M4K8W1RT6XB", 0),
    ('token = "9f8c7b6a5d4e3f2a1b0c9d8e7f6a5b4c3d2e1f0a"', 9),
    ("password=3d4bc476f7469ffa8a", 9),
]


def secret_rows():
    rows = [(i, f"some words before {SECRETS[i % 3][0]} and words after", "src/app") for i in range(60)]
    rows += [(100 + i, f"see mail{i}.example-host-number{i}.com and the build-of-version-{i}x today", "src/app") for i in range(60)]
    return rows


def test_secrets_are_found_and_look_alikes_are_not(spark):
    rows = [*secret_rows(), (300, None, None), (301, "", "x"), (302, "password=changeme-please1", "docs/x")]
    texts = {i: t for i, t, _ in rows}
    found = scan_secrets(frame(spark, rows)).collect()
    sure = {(r["doc_id"], texts[r["doc_id"]][r["start"] : r["end"]]) for r in found if r["is_secret"]}
    values = [s[skip:].strip('"').removeprefix('"') for s, skip in SECRETS]
    assert sure == {(i, values[i % 3]) for i in range(60)}
    assert any(r["doc_id"] >= 100 for r in found)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "s"), (1, "", "s")]])
def test_secret_scan_without_findings(spark, rows):
    assert scan_secrets(frame(spark, rows)).count() == 0


def test_secret_scan_without_both_labels(spark):
    found = scan_secrets(frame(spark, [r for r in secret_rows() if r[0] < 3])).collect()
    assert [r["is_secret"] for r in found] == [True] * 3


def test_lines_are_labelled_anew_as_far_as_their_document_allows():
    own = np.zeros((5, line_crf.FEATURES))
    own[:, line_crf.SIZE] = np.log1p([10, 10, 10, 10, 55]) / 8
    chance = np.array([0.9, 0.8, 0.7, 0.1, 0.95])
    # Of a bad document less than 30 % may be good, so not 55 of 95; of a good one at most 70 % may be bad: 65 of 95.
    assert line_crf.relabelled(own, chance, 0).tolist() == [0, 0, 0, 0, 0]
    assert line_crf.relabelled(own[:4], chance[:4], 0).tolist() == [1, 0, 0, 0]
    assert line_crf.relabelled(own, 1 - chance, 1).tolist() == [0, 1, 1, 1, 0]


def test_lines_of_a_mixed_document_are_told_apart(spark):
    """Bad documents of the sample hold a good line in five: a text whose first half is junk is good after it."""
    import random

    rng = random.Random(7)
    good = lambda: (words(rng, rng.randrange(8, 16)).capitalize() + ".").encode()
    junk = lambda: b" ".join([b"$$", b"BUY", b"NOW!!"] * rng.randrange(4, 8))
    texts = [([junk() for _ in range(4)] + [good()], 0) for _ in range(80)]
    texts += [([good() for _ in range(5)], 1) for _ in range(80)]
    for lines, _ in texts:
        rng.shuffle(lines)
    sample = []
    for lines, _ in texts:
        rows = np.array(line_crf.document_features(b"\n".join(lines))[0])
        sample.append(line_crf.with_neighbours(rows, [len(rows)]))
    weights, go = line_crf.fit(sample, [label for _, label in texts])
    rows = np.array(line_crf.document_features(b"\n".join([*(junk() for _ in range(5)), *(good() for _ in range(5))]))[0])
    found = line_crf.marginals(line_crf._ratios(line_crf.with_neighbours(rows, [10]), weights).tolist(), go)
    # The first good line still has a junk line beside it.
    assert max(found[:5]) < 0.2 and found[5] >= line_crf.ACCEPT and min(found[6:]) > 0.8
