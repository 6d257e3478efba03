"""Quality classifier: a linear-chain conditional random field over lines.

Each line is good or bad. A line's score comes from shape features of the line
and of its two neighbours; transition scores tie neighbours together. The
forward-backward marginals of the lines, weighted by their lengths, average to
the document's score.

Labels are known for documents only; those of lines are hidden. A first fit gives
every line its document's label and has no transitions, so that lines speak for
themselves. Its surest contradictions are then labelled anew, as far as the
lines of a document still agree with its label: by length, less than ACCEPT of a
bad document may be good. The second fit, with transitions, sees good lines
beside bad ones. Documents weigh the same whatever their length, and the two
labels weigh the same whatever their numbers. Training uses a bounded sample of the labelled rows that are not
held out: at most MAX_DOCS documents, the first by a hash of the id. Only their
line features (a few numbers a line) and the fitted weights pass through the
driver. Scoring is one map over all documents and all their lines, without a
shuffle: nothing in it grows with the table.
"""

from __future__ import annotations

import zlib
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstar.llm.common import held_out, query, table
from fieldstar.session import ship_package

MAX_DOCS = 4000
# Longer documents are learnt from by this many lines in a row, from a place that a hash of the text chooses.
# MAX_DOCS times this bounds what reaches the driver.
MAX_TRAINING_LINES = 400
FOLDS = 5
ACCEPT = 0.3
STEPS = 150
RATE = 0.1
PENALTY = 1e-4

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = b"0123456789"
STOPS = tuple(".!?:;,".encode())
OWN = 12
SIZE = 2  # place of a line's length among its features
FEATURES = 3 * OWN + 2


def line_features(line: bytes, before: bytes | None) -> tuple:
    """Shape of one line, every figure about 0 to 1."""
    words = line.split()
    n, size = len(words), len(line)
    if not n:
        return (1.0, 1.0) + (0.0,) * (OWN - 2)
    letters = size - len(line.translate(None, LETTERS))
    share = lambda marks: (size - len(line.translate(None, marks))) / size
    return (
        1.0,
        0.0,
        np.log1p(size) / 8,
        share(SYMBOLS),
        line.count(b"!") / size,
        (size - len(line.translate(None, UPPER))) / letters if letters else 0.0,
        share(DIGITS),
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        min(size / n / 20, 2.0),
        1.0 if words[-1][-1] in STOPS else 0.0,
        1.0 if line == before else 0.0,
    )


def document_features(text: bytes) -> tuple[list[tuple], list[int]]:
    """Features and weights (lengths) of a text's lines; an empty text is one empty line."""
    rows, weights, before = [], [], None
    for line in text.split(b"\n"):
        rows.append(line_features(line, before))
        weights.append(max(len(line), 1))
        before = line
    return rows, weights


def with_neighbours(own: np.ndarray, lengths: list[int]) -> np.ndarray:
    """Own, previous and next features side by side, and whether a line is first or last."""
    ends = np.cumsum(lengths)
    first, last = np.zeros(len(own), bool), np.zeros(len(own), bool)
    first[ends - lengths], last[ends - 1] = True, True
    previous, following = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    previous[first], following[last] = 0, 0
    return np.hstack([own, previous, following, first[:, None], last[:, None]])


def marginals(scores: list[float], stay: np.ndarray) -> list[float]:
    """P(good) of each line of one document; `stay[a][b]` is the factor of going from a to b (1: good)."""
    (bb, bg), (gb, gg) = stay.tolist()
    good, bad, forward = 1.0, 1.0, []
    for place, ratio in enumerate(scores):
        if place:
            good, bad = (good * gg + bad * bg) * ratio, good * gb + bad * bb
        else:
            good, bad = ratio, 1.0
        total = good + bad
        good, bad = good / total, bad / total
        forward.append(good)
    good, bad, found = 1.0, 1.0, []
    for here, ratio in zip(reversed(forward), reversed(scores), strict=True):
        up = here * good
        found.append(up / (up + (1 - here) * bad))
        good, bad = gg * ratio * good + gb * bad, bg * ratio * good + bb * bad
        total = good + bad
        good, bad = good / total, bad / total
    return found[::-1]


def _ratios(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(features @ weights, -30, 30))


def relabelled(own: np.ndarray, chance: np.ndarray, label: int) -> np.ndarray:
    """Labels of one document's lines that its label allows: the surest contradictions are believed.

    A document is good from a share of ACCEPT of good text: so much less of a
    bad document, and so much at least of a good one, is good.
    """
    lines = np.full(len(chance), float(label))
    against = np.abs(chance - label)
    order = np.argsort(-against, kind="stable")
    weight = np.maximum(np.expm1(8 * own[order, SIZE]), 1)
    share = np.cumsum(weight) / weight.sum()
    room = share <= 1 - ACCEPT if label else share < ACCEPT
    lines[order[room & (against[order] > 0.5)]] = 1 - label
    return lines


def fit(documents: list[np.ndarray], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features and transition factors, from labels of documents: two fits with lines labelled anew."""
    alike = [np.full(len(d), float(label)) for d, label in zip(documents, labels, strict=True)]
    weights, _ = fit_lines(documents, labels, alike, False)
    found = [_ratios(d, weights) for d in documents]
    lines = [relabelled(d, r / (1 + r), y) for d, r, y in zip(documents, found, labels, strict=True)]
    return fit_lines(documents, labels, lines, True)


def fit_lines(
    documents: list[np.ndarray], labels: list[int], lines: list[np.ndarray], chained: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transition factors by gradient ascent on the mean log-likelihood of the lines' labels.

    Documents are padded side by side, the longest first, so that one step of
    the recursion is one array operation over all that still have lines. Without
    `chained`, transitions stay neutral.
    """
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    lengths = np.array([len(documents[i]) for i in order])
    truth = np.array([labels[i] for i in order], float)
    flat = np.vstack([documents[i] for i in order])
    told = np.concatenate([lines[i] for i in order])
    n, longest = len(order), int(lengths[0])
    row = np.repeat(np.arange(n), lengths)
    col = np.concatenate([np.arange(k) for k in lengths])
    alive = [int((lengths > t).sum()) for t in range(longest)]
    share = np.where(truth == 1, 0.5 / max((truth == 1).sum(), 1), 0.5 / max((truth == 0).sum(), 1)) / lengths
    pairs = np.flatnonzero(row[1:] == row[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (told[pairs].astype("i8"), told[pairs + 1].astype("i8")), share[row[pairs]])
    weights, steps = np.zeros(FEATURES), np.zeros((2, 2))  # steps[a, b]: from a to b
    moment, second = np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)
    ratio, forward, chance = np.ones((longest, n)), np.zeros((longest, n)), np.zeros((longest, n))
    for step in range(1, STEPS + 1):
        ratio[col, row] = _ratios(flat, weights)
        go = np.exp(steps)
        for t in range(longest):
            k = alive[t]
            if t:
                p = forward[t - 1, :k]
                up, down = (p * go[1, 1] + (1 - p) * go[0, 1]) * ratio[t, :k], p * go[1, 0] + (1 - p) * go[0, 0]
            else:
                up, down = ratio[0], np.ones(n)
            forward[t, :k] = up / (up + down)
        moved = np.zeros((2, 2))
        good = bad = np.ones(n)
        for t in range(longest - 1, -1, -1):
            k = alive[t]
            p = forward[t, :k]
            if t + 1 < longest and (m := alive[t + 1]):
                r = ratio[t + 1, :m]
                g1, b1 = good[:m], bad[:m]
                q = p[:m]
                joint = np.array(
                    [[(1 - q) * go[0, 0] * b1, (1 - q) * go[0, 1] * r * g1], [q * go[1, 0] * b1, q * go[1, 1] * r * g1]]
                )
                joint /= joint.sum((0, 1))
                moved += (joint * share[:m]).sum(2)
                up = go[1, 1] * r * g1 + go[1, 0] * b1
                down = go[0, 1] * r * g1 + go[0, 0] * b1
                good, bad = np.ones(k), np.ones(k)
                good[:m], bad[:m] = up / (up + down), down / (up + down)
            else:
                good, bad = np.ones(k), np.ones(k)
            up = p * good
            chance[t, :k] = up / (up + (1 - p) * bad)
        left = (told - chance[col, row]) * share[row]
        slope = np.concatenate([left @ flat, (seen - moved).ravel()])
        if not chained:
            slope[FEATURES:] = 0
        slope -= PENALTY * np.concatenate([weights, steps.ravel()])
        moment = 0.9 * moment + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        change = RATE * (moment / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights, steps = weights + change[:FEATURES], steps + change[FEATURES:].reshape(2, 2)
    return weights, np.exp(steps)


def training_sample(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_docs: int):
    """(features per document, labels) of at most `max_docs` labelled rows that are not held out."""
    known = labels.filter(F.col(label_col).isNotNull() & ~F.coalesce(held_out(id_col, FOLDS), F.lit(False)))
    known = known.groupBy(F.col(id_col).alias("_of")).agg(F.min(label_col).cast("int").alias("_label"))
    sample = known.orderBy(F.xxhash64("_of"), "_of").limit(max_docs)
    # The sample has `max_docs` rows of two numbers at most, which bounds the broadcast.
    texts = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    met = texts.join(F.broadcast(sample), F.col("_id") == F.col("_of"))
    # Rows that repeat an id are one document: its greatest text.
    met = met.groupBy("_of", "_label").agg(F.max("_text").alias("_text")).select("_label", "_text")

    def featurise(batches):
        for batch in batches:
            found = []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                rows = document_features(text or b"")[0]
                start = zlib.crc32(text) % (len(rows) - MAX_TRAINING_LINES + 1) if len(rows) > MAX_TRAINING_LINES else 0
                found.append(np.array(rows[start : start + MAX_TRAINING_LINES], "f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["label", "own"])

    rows = [r for r in met.mapInArrow(featurise, "label int, own binary").collect() if r["own"]]
    rows.sort(key=lambda r: (r["label"], bytes(r["own"])))
    owns = [np.frombuffer(r["own"], "f4").reshape(-1, OWN).astype("f8") for r in rows]
    return [with_neighbours(own, [len(own)]) for own in owns], [r["label"] for r in rows]


def score_quality(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_docs: int = MAX_DOCS,
) -> DataFrame:
    """One row per input row: id, held_out, score, predicted, n_lines.

    `labels` has the id and a 0/1 label. A NULL text counts as empty; an empty
    text is scored as one empty line. Of labels that repeat an id the least
    counts. Without any label, or with labels of one kind only, the model stays
    neutral: every score is 0.5. Rows that repeat an id
    are scored each; a NULL id is not held out. An empty table gives no row.
    Columns other than id and text are never read.
    """
    ship_package(df.sparkSession)
    documents, known = training_sample(df, labels, id_col, text_col, label_col, max_docs)
    weights, go = fit(documents, known) if len(set(known)) == 2 else (np.zeros(FEATURES), np.ones((2, 2)))

    def score(batches):
        for batch in batches:
            scores, counts = [], []
            texts = batch.column(2).cast(pa.binary())
            for at in range(0, batch.num_rows, 100):
                own, sizes, lengths = [], [], []
                for text in texts.slice(at, 100).to_pylist():
                    rows, weighted = document_features(text or b"")
                    own += rows
                    sizes.append(weighted)
                    lengths.append(len(rows))
                ratio, start = _ratios(with_neighbours(np.array(own), lengths), weights).tolist(), 0
                for weighted, length in zip(sizes, lengths, strict=True):
                    chances = marginals(ratio[start : start + length], go)
                    scores.append(sum(map(float.__mul__, chances, map(float, weighted))) / sum(weighted))
                    start += length
                counts += lengths
            columns = [batch.column(0), batch.column(1), pa.array(scores, "f8"), pa.array(counts, "i8")]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "held_out", "score", "n_lines"])

    kind = dict(df.dtypes)[id_col]
    own = df.select(
        F.col(id_col).alias("_id"),
        F.coalesce(held_out(id_col, FOLDS), F.lit(False)).alias("held_out"),
        F.col(text_col).alias("_text"),
    )
    scored = own.mapInArrow(score, f"_id {kind}, held_out boolean, score double, n_lines long")
    predicted = (F.col("score") >= ACCEPT).cast("int").alias("predicted")
    return scored.select(F.col("_id").alias(id_col), "held_out", "score", predicted, "n_lines")


@query("op1_quality_classifier")
def op1_quality_classifier(spark, sf_dir):
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
