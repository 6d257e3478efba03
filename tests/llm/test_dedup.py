"""Exact and near deduplication against brute force."""

import hashlib
from collections import Counter, defaultdict

import pytest
from fixtures import documents, frame

from fieldstar.llm.block_dedup import exact_dedup, keep_one
from fieldstar.llm.ngram_join import choose_bands, keep_one_of_similar, linked, ngram_join


def low(value):
    return (value is not None, value or 0)


@pytest.mark.parametrize(("size", "bits"), [(8192, 64), (7, 64), (16, 3)])
def test_exact_dedup_is_equality_of_bytes(spark, size, bits):
    rows = documents()
    groups = defaultdict(list)
    for i, text, _ in rows:
        groups[text or ""].append(i)
    expected = Counter()
    for text, ids in groups.items():
        keep = max(ids, key=low)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for place, i in enumerate(ids):
            expected[i, keep, len(ids), i == keep and place == ids.index(keep), sha] += 1
    found = exact_dedup(frame(spark), block_bytes=size, address_bits=bits).collect()
    assert Counter(tuple(r) for r in found) == expected


def test_exact_dedup_tells_blocks_of_one_address_apart(spark):
    rows = [(i, f"{i % 40:04d}" * 9, "s") for i in range(80)]
    found = exact_dedup(frame(spark, rows), block_bytes=8, address_bits=1).collect()
    assert sorted(r["doc_id"] for r in found if r["kept"]) == list(range(40, 80))


def test_exact_dedup_keeps_whole_rows(spark):
    kept = keep_one(frame(spark), block_bytes=32)
    assert kept.columns == frame(spark).columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t, _ in documents()})


def grams(text, n=5):
    words = (text or "").encode().split()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute_links(rows):
    sets = [grams(t) for _, t, _ in rows]
    up = list(range(len(rows)))
    links = [0] * len(rows)

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                up[root(a)] = root(b)
    classes = defaultdict(list)
    for k in range(len(rows)):
        classes[root(k)].append(rows[k][0])
    return links, [min(classes[root(k)], key=low) for k in range(len(rows))], len(classes)


@pytest.mark.parametrize("block", [1000, 2])
def test_ngram_join_finds_every_link(spark, block):
    rows = documents()
    links, classes, count = brute_links(rows)
    found = ngram_join(frame(spark), block=block).collect()
    expected = Counter((i, n, c) for (i, _, _), n, c in zip(rows, links, classes, strict=True))
    assert Counter((r["doc_id"], r["n_links"], r["class_id"]) for r in found) == expected
    assert sum(r["kept"] for r in found) == count


def test_ngram_join_keeps_whole_rows(spark):
    kept = keep_one_of_similar(frame(spark))
    assert kept.columns == frame(spark).columns
    assert kept.count() == brute_links(documents())[2]


def test_bands_reach_the_recall():
    bands, rows = choose_bands(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999
    assert bands * rows <= 128


def test_pair_verification_agrees_at_both_sizes():
    import numpy as np

    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 60, 80, "u8")
    sets = []
    for _ in range(70):
        own = base.copy()
        own[rng.integers(0, 80, rng.integers(0, 14))] = rng.integers(0, 1 << 60)
        sets.append(np.unique(own))
    pairs = np.argwhere(np.triu(np.ones((70, 70), bool), 1))
    assert len(pairs) > 2000
    many, few = linked(sets, pairs, 0.8), np.concatenate([linked(sets, p[None], 0.8) for p in pairs])
    assert (many == few).all()
    assert 0 < many.sum() < len(pairs)


def test_empty_tables(spark):
    empty = frame(spark, [])
    for operator in (exact_dedup, keep_one, ngram_join, keep_one_of_similar):
        assert operator(empty).count() == 0
