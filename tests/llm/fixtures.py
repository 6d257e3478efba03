"""Small frames with the cases every operator must take."""

import random

from pyspark.sql import types as T

# Extra columns with names that operators use inside, or for their results.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(n, T.LongType()) for n in ("_id", "_row", "_of", "_text", "score", "kept", "size", "chunk", "label")],
    ]
)


def words(rng, n, names=400):
    return " ".join(f"w{rng.randrange(names)}" + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def documents():
    """(doc_id, text, source) rows: nulls, empty and long texts, copies, near copies, ties, repeated rows."""
    rng = random.Random(11)
    rows = []
    for i in range(60):
        rows.append((i, "\n".join(words(rng, rng.randrange(5, 60)) for _ in range(rng.randrange(1, 5))), f"s{i % 4}"))
    for i in range(60, 70):  # exact copies
        rows.append((i, rows[i % 7][1], rows[i % 7][2]))
    for i in range(70, 90):  # near copies
        own = rows[i % 9][1].split(" ")
        own[rng.randrange(len(own))] = "changed"
        rows.append((i, " ".join(own), None if i % 5 == 0 else "s1"))
    rows += [(90, None, "s0"), (91, "", None), (92, " \n\t ", "s2"), (93, "", "s2"), (94, "one two", None)]
    rows += [(95, words(rng, 9000, 2000), "s3"), (96, "é" * 9000 + "\U0001f600", "s3"), (97, "a\x00b   c", "s3")]
    rows += [rows[3], rows[3], (3, "same id, another text", "s1"), (None, "no id " * 20, "s0"), (None, None, None)]
    return rows


def frame(spark, rows=None):
    rows = documents() if rows is None else rows
    full = [(i, t, "en", s, len(t or ""), 1, 2, 3, 4, 5, 6, 7, 8, 9) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3, "doc_id")
