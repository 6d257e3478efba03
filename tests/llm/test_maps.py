"""Operators with one result per document, against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from fixtures import documents, frame

from pyspark.sql import functions as F

from fieldstar.llm.block_dedup import exact_dedup
from fieldstar.llm.line_rules import quality_rules, remove_common_lines
from fieldstar.llm.maxent_lm import score_language
from fieldstar.llm.ngram_join import ngram_join
from fieldstar.llm import packing
from fieldstar.llm.packing import CAPACITY, pack_best_fit
from fieldstar.llm.personal_data import KINDS, find_personal_data
from fieldstar.llm.secret_forest import scan_secrets
from fieldstar.llm.source_mixing import copies_to_mix, mix_sources
from fieldstar.llm.trie_counts import BYTE_SCORE, MARK, VOCABULARY, piece_scores, token_counts
from fieldstar.llm.tokens import vocabulary_path

TEXT_OPERATORS = [
    exact_dedup, token_counts, ngram_join, find_personal_data, pack_best_fit, scan_secrets, score_language, quality_rules, mix_sources,
]
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


# --- token counts -------------------------------------------------------------------------------------------------


def brute_tokens(token, scores):
    best = [(0.0, 0)]
    for end in range(1, len(token) + 1):
        options = [(best[end - 1][0] + BYTE_SCORE, best[end - 1][1] - 1)]
        options += [
            (best[s][0] + scores[token[s:end]], best[s][1] - 1) for s in range(end) if token[s:end] in scores
        ]
        best.append(max(options))
    return -best[-1][1]


def test_token_counts_are_the_best_segmentations(spark):
    rows = [r for r in documents() if not r[1] or len(r[1]) < 5000]
    scores = piece_scores(vocabulary_path(VOCABULARY))
    mark = MARK.encode()
    expected = Counter()
    for i, text, _ in rows:
        words = (text or "").encode().split()
        expected[i, len(words), sum(brute_tokens(mark + w, scores) for w in words)] += 1
    assert Counter(tuple(r) for r in token_counts(frame(spark, rows)).collect()) == expected
    assert token_counts(frame(spark, [])).count() == 0


# --- packing ------------------------------------------------------------------------------------------------------


def brackets(gaps, pieces):
    """{piece: gap} of a sweep: pieces by falling size, each takes the smallest free gap that holds it."""
    import bisect

    free, taken = sorted((size, -key) for key, size in gaps.items()), {}
    for key, size in sorted(pieces.items(), key=lambda x: (-x[1], x[0])):
        place = bisect.bisect_left(free, (size, -(1 << 60)))
        if place < len(free):
            taken[key] = -free.pop(place)[1]
    return taken


@pytest.mark.parametrize("block", [1 << 16, 7])
def test_a_sweep_gives_each_piece_its_best_free_gap(spark, monkeypatch, block):
    import random

    monkeypatch.setattr(packing, "BLOCK_ROWS", block)
    for seed, span in ((1, 200), (2, 8), (3, 40)):
        rng = random.Random(seed)
        gaps = {k: rng.randint(1, span) for k in range(rng.choice([60, 150]))}
        pieces = {k: rng.randint(1, span) for k in range(130)}
        rows = [(0, k, v) for k, v in gaps.items()] + [(1, k, v) for k, v in pieces.items()]
        found = packing.match_best_fit(spark.createDataFrame(rows, "_kind int, _key long, _size long")).collect()
        assert len(found) == len(rows)
        taken = {r["_key"]: r["_partner"]["_key"] for r in found if r["_kind"] == 1 and r["_partner"]}
        expected = brackets(gaps, pieces)
        assert set(taken) == set(expected)
        assert {k: gaps[g] for k, g in taken.items()} == {k: gaps[g] for k, g in expected.items()}
        assert {r["_partner"]["_key"]: r["_key"] for r in found if r["_kind"] == 0 and r["_partner"]} == taken


def best_fit_decreasing(sizes, capacity):
    import bisect

    gaps = []
    for size in sorted(sizes, reverse=True):
        place = bisect.bisect_left(gaps, size)
        bisect.insort(gaps, (gaps.pop(place) if place < len(gaps) else capacity) - size)
    return len(gaps)


def test_sweeps_pack_nearly_as_tightly_as_one_piece_after_the_other(spark):
    import random

    rng = random.Random(1)
    sizes = [rng.choice([rng.randint(1, 2047), rng.randint(1, 600), 100]) for _ in range(3000)]
    sizes += [rng.randint(1, 12) for _ in range(9000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "_key long, _size long")
    placed = packing.place_items(items.filter("_size > 12 or _key % 40 = 0"), 2048).collect()
    used = {r["_item"]: r["_seq"] for r in placed}
    kept = [(k, n) for k, n in enumerate(sizes) if n > 12 or k % 40 == 0]
    assert len(placed) == len(used) == len(kept)
    filled = Counter()
    for k, n in kept:
        filled[used[k]] += n
    assert max(filled.values()) <= 2048
    assert len(filled) <= best_fit_decreasing([n for _, n in kept], 2048) * 1.005 + 1


def test_sweeps_on_runs_place_what_sweeps_on_rows_place(spark, monkeypatch):
    import random

    for seed, capacity, most in ((1, 64, 63), (2, 300, 90)):
        rng = random.Random(seed)
        sizes = sorted((rng.randint(1, rng.choice([most, most, 9])) for _ in range(400)), reverse=True)
        items = spark.createDataFrame([(3 * k + 5, n) for k, n in enumerate(sizes)], "_key long, _size long")
        by_runs = {tuple(r) for r in packing.place_items(items, capacity).collect()}
        with monkeypatch.context() as m:
            m.setattr(packing, "MOST_SIZES", 0)
            by_rows = {tuple(r) for r in packing.place_items(items, capacity).collect()}
        assert by_runs == by_rows and len(by_runs) == len(sizes)


def test_the_driver_starts_few_jobs_however_many_sweeps_there_are(spark):
    import random

    rng = random.Random(5)
    sizes = [rng.choice([rng.randint(1, 2047), rng.randint(1, 300)]) for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "_key long, _size long")
    context = spark.sparkContext
    context.setJobGroup("few-jobs", "packing")
    try:
        placed = packing.place_items(items, 2048).collect()
        assert len(placed) == len(sizes)
        assert len(context.statusTracker().getJobIdsForGroup("few-jobs")) < 30
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_what_runs_cost_does_not_grow_with_the_number_of_pieces():
    import random

    rng = random.Random(7)
    counts = {n: rng.randint(1, 50) for n in range(1, 2048)}
    for times in (1, 10_000_000):
        runs = packing.place_runs({n: k * times for n, k in counts.items()}, 2048)
        assert runs[:, 1].sum() == sum(counts.values()) * times
        assert len(runs) < 60 * len(counts)


def test_short_pieces_come_in_bundles(spark):
    sizes = sorted([5] * 1000 + [7] * 10 + [300, 128, 129], reverse=True)
    rows = spark.createDataFrame(list(enumerate(sizes)), "_rank long, length long")
    found = packing._bundled(rows, dict(Counter(sizes)), 2048).collect()
    assert all(r["_item"] <= r["_rank"] for r in found)
    bundles = Counter()
    for r in found:
        assert sizes[r["_item"]] == r["length"]
        bundles[r["_item"]] += r["length"]
    assert all(n <= 128 or n in sizes for n in bundles.values())
    assert len(bundles) < 60 and sum(bundles.values()) == sum(sizes)
    assert {r["_item"] for r in found if r["_rank"] >= len(sizes) - 6} == set(range(len(sizes) - 6, len(sizes)))


def test_packed_pieces_are_the_documents_ids(spark):
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    expected = Counter()
    for i, text, _ in documents():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), CAPACITY)):
            part = ids[start : start + CAPACITY]
            expected[i, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    found = pack_best_fit(frame(spark)).collect()
    assert Counter(tuple(r)[:5] for r in found) == expected
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= CAPACITY
    assert len(by_sequence) <= sum(r["length"] for r in found) / CAPACITY + 2
    assert pack_best_fit(frame(spark, [])).count() == 0


# --- language model -----------------------------------------------------------------------------------------------


def test_base_scores_and_a_distribution(spark):
    rows = documents()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    tokens = [[*(t or "").encode().lower().split(), b""] for _, t, _ in rows]
    counts = Counter(w for (i, _, _), own in zip(rows, tokens, strict=True) if not held(i) for w in own)
    total, distinct = sum(counts.values()), len(counts)
    log = {w: math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for own in tokens for w in own}
    expected = Counter()
    for (i, _, _), own in zip(rows, tokens, strict=True):
        known = sum(counts[w] > 0 for w in own)
        expected[i, held(i), len(own), known, total, round(sum(log[w] for w in own), 6)] += 1
    found = score_language(frame(spark)).collect()
    assert Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in found) == expected
    assert all(r["score"] < 0 for r in found)
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)
    assert score_language(frame(spark, [])).count() == 0


def test_model_probabilities_add_up_to_one():
    import numpy as np

    from fieldstar.llm import maxent_lm as lm

    rng = np.random.default_rng(3)
    weights = rng.normal(size=(lm.ROWS, lm.CLASSES)).astype("f4")
    rows = lm.features(np.array([5, 9, 9, 2], "u8"), np.array([0]))
    logs = lm.log_softmax(rows, np.zeros(lm.CLASSES, "f4"), weights)
    assert np.allclose(np.exp(logs).sum(1), 1, atol=1e-4)
    before = np.take_along_axis(logs, np.array([[1], [2], [3], [4]]), 1).sum()
    lm.update(rows, np.array([1, 2, 3, 4]), np.zeros(lm.CLASSES, "f4"), weights, np.ones_like(weights))
    after = lm.log_softmax(rows, np.zeros(lm.CLASSES, "f4"), weights)
    assert np.take_along_axis(after, np.array([[1], [2], [3], [4]]), 1).sum() > before


def test_language_model_without_training_rows(spark):
    rows = [(i, "a b", "s") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert {r["base_score"] for r in score_language(frame(spark, rows)).collect()} == {0.0}


# --- quality rules ------------------------------------------------------------------------------------------------


def brute_figures(text):
    words = SPLIT.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    twice = {p + k for p, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPLIT.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(twice)


def test_figures_of_the_quality_rules(spark):
    rows = [*documents(), (200, "a b c a b c # x", "s0"), (201, "x y\nx y\n \nz\nx y", "s0"), (202, "to " * 80, "s1")]
    expected = Counter()
    for i, text, _ in rows:
        figures = brute_figures(text or "")
        failed = figures[0] < 50 or 100 * figures[4] > 50 * figures[0]
        expected[i, *figures, failed] += 1
    found = quality_rules(frame(spark, rows)).collect()
    assert Counter((*tuple(r)[:6], r["base_failed"]) for r in found) == expected
    assert not any(r["kept"] and r["base_failed"] for r in found)
    assert quality_rules(frame(spark, [])).count() == 0


def test_documents_of_common_lines_are_rejected(spark):
    own = lambda i: "\n".join(" ".join(f"d{i}w{k}x{j}" for k in range(30)) for j in range(3))
    common = "\n".join(" ".join(f"c{j}k{k}" for k in range(30)) for j in range(9))
    rows = [(i, own(i), "h") for i in range(20)] + [(100 + i, common.upper() + "\n" + own(i + 50), "h") for i in range(8)]
    rows += [(200 + i, common + "\n" + own(i + 90), f"host{i}") for i in range(8)]
    found = {r["doc_id"]: r for r in quality_rules(frame(spark, rows)).collect()}
    assert all(found[i]["kept"] for i in range(20))
    assert not any(found[100 + i]["kept"] for i in range(8))
    assert {found[100 + i]["removed_words"] for i in range(8)} == {270}
    assert all(found[200 + i]["kept"] for i in range(8))  # one document per host carries the lines


# --- personal data ------------------------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [int(c) * 2 if k % 2 else int(c) for k, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute_spans(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind in KINDS
        for m in re.finditer(PLAIN[kind], text or "")
        if valid(kind, m.group())
    ]


def test_base_spans_are_those_of_the_plain_patterns(spark):
    import random

    rng = random.Random(3)
    marks = "0123456789.@+- ()abéü_%\n1234567890"
    rows = [(i, "".join(rng.choice(marks) for _ in range(rng.randrange(300))), "s") for i in range(300)]
    rows += documents()
    rows += [(1000, "a" * 60000 + " 1.2.3.4", "s"), (1001, "a@b.c_d@e.fg x@y.z@w.v \U0001f600 +12345678 ", "s")]
    rows += [(1002, "4111 1111 1111 1111 0001.02.3.255 1.2.3.256 " + "7 " * 4000, "s")]
    expected = Counter()
    for i, text, _ in rows:
        spans = brute_spans(text)
        kinds = Counter(s.split(":")[0] for s in spans)
        expected[i, *[kinds[k] for k in KINDS], hashlib.sha256(",".join(spans).encode()).hexdigest()] += 1
    found = find_personal_data(frame(spark, rows)).collect()
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256"]
    assert Counter(tuple(r[n] for n in names) for r in found) == expected
    assert find_personal_data(frame(spark, [])).count() == 0


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    rows = [(i, f"dear reader, mail me: user{i}@site{i}.org today", "s") for i in range(12)]
    rows += [(100, "mail me: hidden@localhost today, or room 4 at 12", "s"), (101, "not this: hidden@localhost now", "s")]
    found = {r["doc_id"]: r for r in find_personal_data(frame(spark, rows)).collect()}
    assert found[100]["spans"] == "email:9:25"
    assert (found[100]["n_email"], found[100]["n_added"]) == (0, 1)
    assert found[101]["spans"] == ""


def test_a_list_of_identifiers_takes_time_in_proportion(spark):
    """Addresses and words like them, 100,000 in one text: none drags all others along."""
    many = 50_000
    text = " ".join(f"u{i}@host{i}.org x{i}@y{i}" for i in range(many))
    rows = [(1, text, "s"), (2, "", "s")]
    found = {r["doc_id"]: r for r in find_personal_data(frame(spark, rows)).collect()}
    assert (found[1]["n_email"], found[1]["n_added"]) == (many, 0)  # what stands before the words stands before no seed


def test_what_is_learnt_leads_to_contexts_without_a_seed(spark):
    rows = [(i, f"reach me under mailbox user{i}@site{i}.org please", "s") for i in range(12)]
    rows += [(100 + i, f"reach me under mailbox odd{i}@host{i} or use alias box odd{i}@host{i} then", "s") for i in range(6)]
    rows += [(200, "try alias box lone@place then", "s"), (201, "nothing like other@place then", "s")]
    one, three = (
        {r["doc_id"]: r["spans"] for r in find_personal_data(frame(spark, rows), rounds=k).collect()} for k in (1, 3)
    )
    assert one[200] == one[201] == three[201] == ""
    assert three[200] == "email:14:24"
    assert [s.split(":")[0] for s in three[100].split(",")] == ["email", "email"]


def test_contexts_reach_over_earlier_matches(spark):
    from fieldstar.llm.spans import matches

    text = "alpha beta 11 gamma 22 33 44 55 66 delta 77"
    df = spark.createDataFrame([(text,), ("9",)], "t string")
    found = df.select(F.inline(matches(F.col("t"), "[0-9]+", "[0-9]"))).collect()
    for r in found:
        own = text if r["e"] > 1 else "9"
        assert own[r["s"] : r["e"]] == r["v"]
        assert own[: r["s"]].endswith(r["c"]) and own[r["e"] :].startswith(r["a"])
        assert len(r["c"].split()) >= min(2, len(own[: r["s"]].split()))


def test_overlaps_are_those_of_all_pairs(spark):
    import random

    from fieldstar.llm.spans import overlapped

    rng = random.Random(7)
    rows = [(r, s, s + rng.randint(1, 9), rng.random() < 0.4) for r in range(12) for s in rng.choices(range(120), k=40)]
    df = spark.createDataFrame(rows, "_row int, s int, e int, sure boolean")
    for r in df.withColumn("met", overlapped(F.col("sure"))).filter("not sure").collect():
        expected = any(row == r["_row"] and sure and s < r["e"] and e > r["s"] for row, s, e, sure in rows)
        assert r["met"] == expected


# --- mixing -------------------------------------------------------------------------------------------------------


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else share[s] for s in names}
        capped |= over


def test_mix_meets_its_targets_and_reruns_agree(spark):
    rows = [*documents(), (300, "only one", "tiny"), (301, "", "void")]
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(SPLIT.findall(text or ""))
    targets = brute_targets(sizes)
    found = mix_sources(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    taken, aim, least_left = Counter(), {}, {}
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"]
        key = (r["source_size"], round(r["target"], 6))
        taken[key] += r["taken"]
        aim[key] = r["target"]
        if r["size"] and r["copies"] <= r["target"] // r["source_size"]:  # not in the fractional selection
            least_left[key] = min(least_left.get(key, r["size"]), r["size"])
    assert {round(t, 6) for t in aim.values()} == {round(t, 6) for t in targets.values()}
    for key, target in aim.items():
        assert taken[key] <= target + 1e-6
        assert target - taken[key] < least_left.get(key, 1)  # nothing that is left would fit
    again = mix_sources(frame(spark, rows[::-1]).repartition(7)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
    assert mix_sources(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed", ["a", "b", "c", "d"])
def test_mix_leaves_nothing_out_that_would_fit(spark, seed):
    """Documents in their turn, each taken if it still fits: brute force over the same keys."""
    import random

    rng = random.Random(seed)
    rows = [(i, "w " * rng.choice([0, 1, 1, 2, 7, 30, 400]), f"s{rng.choice('01234555')}") for i in range(250)]
    rows += [(500 + i, "", "capped") for i in range(3)] + [(510, "a b c", "capped"), (511, "", "void"), (512, None, "void")]
    found = mix_sources(frame(spark, rows), seed=seed).collect()
    texts, by_source = {i: (t, s) for i, t, s in rows}, {}
    for r in found:
        assert r["copies"] <= 3
        by_source.setdefault(texts[r["doc_id"]][1], []).append(r)
    assert {r["copies"] for r in by_source["capped"]} == {3}
    assert {r["copies"] for r in by_source["void"]} == {0}
    for members in by_source.values():
        size, target = members[0]["source_size"], members[0]["target"]
        epochs = int(target // max(size, 1))
        rest = math.floor(target - epochs * size)
        spent = sum(r["size"] for r in members if r["copies"] > epochs)
        assert spent <= rest
        assert not any(0 < r["size"] <= rest - spent for r in members if r["copies"] == epochs)


def test_mix_takes_better_documents_first(spark):
    rows = [(i, "word " * 10 + ("|#*$ " * 10 if i % 2 else "text " * 10), "a") for i in range(400)]
    rows += [(1000 + i, "word " * 20, "b") for i in range(400)]
    found = mix_sources(frame(spark, rows)).collect()
    good = sum(r["copies"] for r in found if r["doc_id"] < 1000 and r["doc_id"] % 2 == 0)
    bad = sum(r["copies"] for r in found if r["doc_id"] < 1000 and r["doc_id"] % 2)
    assert good > 2 * bad


def test_mix_as_rows(spark):
    taken = Counter()
    for r in mix_sources(frame(spark)).collect():
        taken[r["doc_id"]] += r["copies"]
    rows = copies_to_mix(frame(spark))
    assert rows.columns == frame(spark).columns
    assert Counter(r["doc_id"] for r in rows.collect()) == +taken


def test_text_without_common_lines(spark):
    line = lambda j, k: " ".join(f"{k}{j}x{w}" for w in range(12))
    common = [f"  Common {j} line\t{line(j, 'c')} " for j in range(4)]
    rows = [(i, "\n".join([line(i, "o"), common[i % 4].upper(), " ", common[0], line(i, "p")]), "h") for i in range(40)]
    rows += [(50, None, "h"), (51, "", "h"), (52, common[0], "other"), (None, common[0] + "\n\nown", "h"), rows[3]]
    spare = re.compile("[\x20\x09-\x0D]+")
    norm = lambda x: spare.sub(" ", x).strip(" ").lower()
    docs, total = {}, {}
    for i, text, host in rows:
        total.setdefault(host, set()).add(i)
        for x in (text or "").split("\n"):
            if SPLIT.search(x):
                docs.setdefault((host, norm(x)), set()).add(i)
    gone = lambda host, x: SPLIT.search(x) and len(docs[host, norm(x)]) > max(5, 0.01 * len(total[host]))
    expected = Counter(
        (i, None if text is None else "\n".join(x for x in text.split("\n") if not gone(host, x))) for i, text, host in rows
    )
    df = frame(spark, rows)
    kept = remove_common_lines(df)
    assert kept.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == expected
    words = lambda t: len(SPLIT.findall(t or ""))
    left = Counter((i, words(text) - words(next(t for j, t in expected if j == i))) for i, text, _ in rows)
    assert Counter((r["doc_id"], r["removed_words"]) for r in quality_rules(df).collect()) == left
    assert remove_common_lines(frame(spark, [])).count() == 0


def named(spark):
    """The fixture with ids as text."""
    df = frame(spark)
    return df.withColumn("doc_id", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))


@pytest.mark.parametrize("operator", TEXT_OPERATORS)
def test_ids_may_be_text(spark, operator):
    found = operator(named(spark)).select("doc_id").collect()
    kept = Counter(r["doc_id"] for r in named(spark).collect())
    if operator in (pack_best_fit, scan_secrets):
        assert {r["doc_id"] for r in found} <= set(kept)
    else:
        assert Counter(r["doc_id"] for r in found) == kept


@pytest.mark.parametrize("operator", [quality_rules, find_personal_data, mix_sources, token_counts, score_language])
def test_rows_with_nulls_only(spark, operator):
    assert operator(frame(spark, [(None, None, None), (None, None, None)])).count() == 2
