"""Line dedup, Merkle manifest and whitening against brute force."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import documents, frame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstar.llm import line_dedup, merkle, whitening
from fieldstar.llm.line_dedup import dedup_lines, drop_common_lines
from fieldstar.llm.merkle import every_seventh, merkle_manifest
from fieldstar.llm.whitening import contours, count_above, feast, tridiagonal, whiten

BLANKS = " \t\n\x0b\f\r"


def low(value):
    return (value is not None, value or 0)


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute_lines(rows, min_chars=40, min_docs=5):
    holders = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                holders[key_of(line)].add(i)
    keeper = {k: max(ids, key=low) for k, ids in holders.items() if len(ids) >= min_docs}
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key_of(x) not in keeper or keeper[key_of(x)] == i]
        yield i, len(lines), len(lines) - len(kept), "\n".join(kept)


COMMON = "This Line is common to many documents, É and all.  "
ACCENTS = "ÉÀ stays as it is but ASCII LETTERS fall to lower case"


def line_rows():
    rows = documents()
    for i in range(200, 212):
        rows.append((i, f"{COMMON}\nown line {i} of enough marks to count as a long one\n\t{COMMON.upper()}", "s1"))
    for i in range(212, 220):
        rows.append((i, "\n".join([COMMON.lower(), "short", COMMON, "", ACCENTS, "short"]), None))
    rows += [(219, COMMON, "s0"), (None, COMMON + "\r", "s0"), (None, f"x\n{ACCENTS}", None)]
    rows += [(300, "\n" * 5000 + (COMMON + "\n") * 5000, "s1"), (301, "z" * 1_200_000, "s2"), (302, COMMON, "s1")]
    return rows


def as_rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("heavy", [2000, 2])
def test_dedup_lines(spark, monkeypatch, heavy):
    monkeypatch.setattr(line_dedup, "HEAVY", heavy)
    rows = line_rows()
    found = dedup_lines(frame(spark, rows))
    assert as_rows(found, "doc_id", "n_lines", "n_dropped", "kept_text") == Counter(brute_lines(rows))
    assert sum(n > 0 for _, _, n, _ in brute_lines(rows)) > 20


def test_dedup_lines_counts_documents_not_rows(spark):
    rows = [(1, COMMON, "s")] * 9 + [(i, COMMON, "s") for i in (2, 3, 4)]
    assert as_rows(dedup_lines(frame(spark, rows)), "n_dropped") == {(0,): 12}
    rows.append((None, COMMON, "s"))
    assert as_rows(dedup_lines(frame(spark, rows)), "doc_id", "n_dropped") == {
        (1, 1): 9, (2, 1): 1, (3, 1): 1, (4, 0): 1, (None, 1): 1
    }


def test_dedup_lines_with_text_ids(spark):
    df = spark.createDataFrame([(f"d{i}", COMMON) for i in range(6)], "doc_id string, text string")
    assert as_rows(dedup_lines(df).filter("n_dropped = 0"), "doc_id") == {("d5",): 1}


def test_drop_common_lines_keeps_columns(spark):
    df = frame(spark, line_rows())
    kept = drop_common_lines(df)
    assert kept.columns == df.columns
    expected = Counter(
        (i, None if text is None else left)
        for (i, text, _), (_, _, _, left) in zip(line_rows(), brute_lines(line_rows()), strict=True)
    )
    assert as_rows(kept, "doc_id", "text") == expected


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(nodes, fanout=2):
    """(root, path of each node as (left, right) siblings)."""
    paths = [[] for _ in nodes]
    place, level = list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, at in enumerate(place):
            first = at - at % fanout
            paths[k].append(("".join(level[first:at]), "".join(level[at + 1 : first + fanout])))
        place = [at // fanout for at in place]
        level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
    return level[0], paths


def brute_manifest(rows, fanout=2):
    def leaf(i, text, lang, source, n_chars):
        fields = [i, source, lang, n_chars, text]
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))

    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((low(row[0]), leaf(*row), row))
    trees = []
    for lang in sorted(groups, key=lambda v: (v is not None, (v or "").encode())):
        members = sorted(groups[lang], key=lambda m: m[:2])
        trees.append((members, *brute_tree([m[1] for m in members], fanout)))
    root, tops = brute_tree([t[1] for t in trees], fanout)
    for (members, subroot, paths), top in zip(trees, tops, strict=True):
        for (_, own, (i, text, lang, source, n)), path in zip(members, paths, strict=True):
            hit = i is not None and zlib.crc32(str(i).encode()) % 7 == 0
            node = leaf(i, text, lang, source, n + 1) if hit and n is not None else own
            for left, right in path + top:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in path + top))
            yield i, own, subroot, root, proof, node, node == root


DOCS = "doc_id long, text string, lang string, source string, n_chars long, _id long, _tree long, root string"
OUT = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def manifest_rows():
    langs = ["en", "en", "en", "fr", "é", None, "", "z"]
    rows = [(i, t, langs[k % len(langs)], s, None if k % 9 == 0 else len(t or "")) for k, (i, t, s) in enumerate(documents())]
    return rows + [rows[5], rows[5], (500, "alone", "only", "s", 5)]


@pytest.mark.parametrize(("fanout", "depth"), [(2, 10), (2, 2), (3, 1)])
def test_manifest(spark, monkeypatch, fanout, depth):
    monkeypatch.setattr(merkle, "FANOUT", fanout)
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "BLOCK", fanout**depth)
    rows = manifest_rows()
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], DOCS).repartition(3)
    found = merkle_manifest(df, every_seventh())
    expected = Counter(brute_manifest(rows, fanout))
    assert as_rows(found, *OUT) == expected
    assert {v for *_, v in expected} == {True, False}


@pytest.mark.parametrize("many", [1, 2, 3, 4, 5, 8, 9, 17])
def test_manifest_of_one_group(spark, monkeypatch, many):
    monkeypatch.setattr(merkle, "DEPTH", 2)
    monkeypatch.setattr(merkle, "BLOCK", 4)
    rows = [(i, f"t{i}", "en", "s", 2) for i in range(many)]
    found = merkle_manifest(spark.createDataFrame([(*r, 1, 2, "x") for r in rows], DOCS), every_seventh())
    assert as_rows(found, *OUT) == Counter(brute_manifest(rows))


def test_manifest_proof_is_checkable(spark):
    rows = manifest_rows()
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], DOCS)
    for r in merkle_manifest(df).collect():
        node = r["leaf"]
        for s in r["proof"]:
            node = sha(s["left"] + node + s["right"])
        assert node == r["root"]
        assert r["verified"]
    assert merkle_manifest(df.limit(0), every_seventh()).count() == 0


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(5)
    for d in (1, 2, 3, 9, 40):
        a = rng.standard_normal((d, d))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        diagonal, off = tridiagonal(a)
        for shift in (*rng.uniform(-8, 8, 20), values[0] - 1, values[-1] + 1):
            assert count_above(diagonal, off, shift) == (values > shift).sum()


@pytest.mark.parametrize("kind", ["plain", "clustered", "equal", "spread", "low rank"])
def test_feast_finds_the_leading_pairs(kind):
    rng = np.random.default_rng(7)
    d = 48
    values = {
        "plain": rng.uniform(1, 50, d),
        "clustered": 10 + rng.uniform(0, 1e-6, d),
        "equal": np.repeat([4.0, 3.0, 2.0], d // 3),
        "spread": 10.0 ** -np.arange(d),
        "low rank": np.append([5.0, 4.0, 3.0], np.zeros(d - 3)),
    }[kind]
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    exact = np.linalg.eigvalsh(matrix)[::-1]
    parts = contours(matrix, 16)
    pairs = [feast(matrix, *p) for p in parts]
    found = np.concatenate([v for v, _ in pairs])
    assert len(found) >= {"low rank": 3, "spread": 10}.get(kind, 16)
    assert np.allclose(found, exact[: len(found)], rtol=0, atol=1e-11 * exact[0])
    vectors = np.hstack([v for _, v in pairs])
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-10 * exact[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-5


VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("x", T.LongType()),
        T.StructField("k", T.StringType()),
    ]
)


def vectors(d=20, many=300):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1 + (np.arange(d) % 5), d).astype("f4").tolist()) for i in range(many)]
    rows += [(i + 1000, rows[0][1]) for i in range(many)]  # copies
    rows += [rows[3], (None, rows[4][1]), (2000, None), (2001, []), (2002, [1.0] * (d - 1))]
    rows += [(2003, [math.nan] + [0.0] * (d - 1)), (2004, [math.inf] + [0.0] * (d - 1)), (2005, [None] + [0.0] * (d - 1))]
    return rows


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "y") for i, v in rows], VECTORS).repartition(3)


def test_whitening(spark):
    rows = vectors()
    usable = [(i, v) for i, v in rows if v and len(v) == 20 and all(c is not None and math.isfinite(c) for c in v)]
    x = np.floor(64 * np.array([v for _, v in usable], "f8")).astype("i8") + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    cov = np.cov(fit.T.astype("f8"), bias=True)
    values, turn = np.linalg.eigh(cov)
    values, turn = values[::-1][:16], turn[:, ::-1][:, :16]
    white = (x - total / n) @ turn / np.sqrt(values)
    found = whiten(vector_frame(spark, rows)).collect()
    assert len(found) == 16 * len(usable)
    assert {r["n"] for r in found} == {n}
    assert max(r["identity_error"] for r in found) < 1e-9
    expected, got = Counter(), defaultdict(list)
    for (i, _), own in zip(usable, x, strict=True):
        expected[i, int(((n * own - total) ** 2).sum())] += 16
    assert Counter((r["vec_id"], r["deviation"]) for r in found) == expected
    by_id = {i: w for (i, _), w in zip(usable, white, strict=True)}
    for r in found:
        got[r["component"]].append((r["whitened"], by_id[r["vec_id"]][r["component"] - 1]))
        assert abs(r["explained"] - values[r["component"] - 1] / np.trace(cov)) < 1e-9
    for pairs in got.values():
        ours, theirs = np.array(pairs).T
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs).max()) < 1e-8


def test_whitening_of_little(spark):
    assert whiten(vector_frame(spark, [])).count() == 0
    assert whiten(vector_frame(spark, [(1, None), (2, [])])).count() == 0
    assert whiten(vector_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    found = whiten(vector_frame(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [9.0])])).collect()
    assert sorted((r["vec_id"], r["component"], abs(r["whitened"])) for r in found) == [(1, 1, 1.0), (2, 1, 1.0)]
    far = [(1, [2.0**40, 1.0]), (2, [2.0**39, 1.0]), (3, [-(2.0**39), 1.0])]
    found = whiten(vector_frame(spark, far)).collect()
    assert {(r["vec_id"], r["n"], r["deviation"]) for r in found} == {(2, 2, None), (3, 2, None)}


def test_whitening_writes_no_row_twice(spark):
    df = vector_frame(spark, vectors(6, 40)).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    found = whiten(df, components=3)
    assert found.groupBy("vec_id", "component").count().agg(F.max("count")).first()[0] == 2
    assert found.agg(F.max("component")).first()[0] == 3
