"""Language-model scoring with a hashed maximum-entropy model.

The model predicts a word's class from its history and the word from its class:
log P(w | h) = log softmax_class(b + sum of weights of active features) + log P(w | class).
Features are the word before (n-gram of two), the two words before (n-gram of
three) and the word two back (skip), hashed into weight vectors whose number
follows the square root of the training tokens, so that what is learnt from
context grows with the corpus. The most frequent words are classes of their own;
others share a class by their ending, so that a word never seen has one too.
Words within a class are smoothed counts with one share for all unseen words,
which makes the model a distribution.

Training is parallel stochastic gradient ascent over all documents that are not
held out: in each round every task starts from the shared weights and updates
those that its batches meet, and each weight vector's changes are averaged over
the tasks that met it, by their numbers of tokens with it; one that no task met
keeps its values. Tasks send the changes of the vectors they met, in half
precision; these are added up per range of vectors. Scores are sums over sparse
numpy batches.

Plan at scale: documents are encoded once, in chunks that carry their distinct
words and the places of these; a shuffle then moves a word once per chunk rather
than once per occurrence, and training and scoring need no text, only hashes of
the distinct words. Word counts are exact over all training documents and joined
to the chunks by word; a word that occurs in every chunk is one row per chunk,
and the join can split it. Every task and the driver hold all weight vectors:
TASK_VECTORS tokens a vector and task make both the vectors and the tasks grow
with the square root of the corpus, and so what a round sends in proportion to
the corpus. 10^8 tokens have 2^15 vectors (4 MB), 10^12 have 2^21 (268 MB).
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstar.llm.common import held_out, query, table
from fieldstar.session import ship_package, stage

FOLDS = 10
SMOOTH = 0.1
OWN_CLASSES = 16
ENDING_CLASSES = 16
CLASSES = OWN_CLASSES + ENDING_CLASSES
ENDING = 3
# Weight vectors: at least ROWS, and the power of two from twice the square root of the training tokens.
ROWS = 1 << 14
ROUNDS = 2
RATE = 0.2
BATCH = 20_000
CHUNK_DOCS = 4096
CHUNK_TOKENS = 2_400_000
PART = 512
TASK_VECTORS = 100
TASKS = 32
LONG = 16
# Scores are kept where their exponentials are finite.
STEEPEST = 60
ONES = np.ones(CLASSES, "f4")
END = b""


class Places(dict):
    """Places of words, in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


def planes(codes: np.ndarray) -> bytes:
    """32-bit places byte by byte, low bytes first, as the high ones are mostly zero; compressed for disk and shuffle."""
    return pa.compress(np.ascontiguousarray(codes.astype("<u4").view("u1").reshape(-1, 4).T), "zstd", asbytes=True)


def from_planes(data: bytes, tokens: int) -> np.ndarray:
    low_first = np.frombuffer(pa.decompress(data, 4 * tokens, "zstd"), "u1").reshape(4, -1)
    return np.ascontiguousarray(low_first.T).view("<u4").ravel()


def _encode(batches):
    """Chunks of documents: ids, held-out marks, token counts, distinct words, their hashes and endings' classes, and
    the tokens as places in these."""
    number, first = 0, TaskContext.get().partitionId() << 32
    for batch in batches:
        ids, held, texts = batch.column(0), batch.column(1), batch.column(2).cast(pa.binary())
        at = 0
        while at < batch.num_rows:
            place, codes, tokens, end = Places(), [], 0, at
            while end < batch.num_rows and end - at < CHUNK_DOCS and tokens < CHUNK_TOKENS:
                words = (texts[end].as_py() or b"").lower().split()
                words.append(END)
                codes.append(np.fromiter(map(place.__getitem__, words), "u4", len(words)))
                tokens += len(words)
                end += 1
            size = end - at
            listed = lambda column: pa.ListArray.from_arrays(pa.array([0, size], "i4"), column)  # noqa: E731, B023
            columns = [
                pa.array([first + number], "i8"),
                listed(ids.slice(at, size)),
                listed(held.slice(at, size)),
                pa.array([[len(c) for c in codes]], pa.list_(pa.int64())),
                pa.array([list(place)], pa.list_(pa.binary())),
                pa.array([np.fromiter(map(word_name, place), "<u4", len(place)).tobytes()], pa.binary()),
                pa.array([bytes(map(ending_class, place))], pa.binary()),
                pa.array([planes(np.concatenate(codes))], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, ["chunk", "ids", "held", "sizes", "words", "names", "endings", "codes"]
            )
            number, at = number + 1, end


def _count(batches):
    """Counts of the training documents' words, one row per chunk and word."""
    for batch in batches:
        for row in range(batch.num_rows):
            held, sizes, words, codes = (column[row] for column in batch.columns)
            words, held, sizes = words.values, np.array(held.as_py(), bool), np.array(sizes.as_py(), "i8")
            trained = from_planes(codes.as_py(), sizes.sum())[np.repeat(~held, sizes)]
            counts = np.bincount(trained, minlength=len(words))
            found = counts > 0
            yield pa.RecordBatch.from_arrays([words.filter(pa.array(found)), pa.array(counts[found])], ["word", "c"])


def word_name(word: bytes) -> int:
    """The hash by which features and classes know a word."""
    return zlib.crc32(word)


def ending_class(word: bytes) -> int:
    return OWN_CLASSES + zlib.crc32(word[-ENDING:]) % ENDING_CLASSES


def classes_of(names: np.ndarray, endings: np.ndarray, own: np.ndarray) -> np.ndarray:
    """A frequent word's own class, or the class of its ending; `own` has the frequent words' names."""
    found = endings.astype("i8")
    for place, name in enumerate(own):
        found[names == name] = place
    return found


def histories(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per token the word before and the one before that; 0 stands before a text."""
    one, two = np.zeros_like(names), np.zeros_like(names)
    one[1:], two[2:] = names[:-1], names[:-2]
    one[starts] = 0
    two[starts] = 0
    second = starts + 1
    two[second[second < len(names)]] = 0
    return one, two


def hashed(one: np.ndarray, two: np.ndarray, rows: int) -> np.ndarray:
    """(tokens, 3) weight rows: the word before, the two words before, the word two back."""
    one, two, factor = one.astype("u8"), two.astype("u8"), np.uint64(0x9E3779B97F4A7C15)
    found = np.empty((3, len(one)), "u8")
    found[0] = (one + np.uint64(1)) * factor
    found[1] = ((one + np.uint64(3)) * factor ^ two) * factor
    found[2] = (two + np.uint64(11)) * factor
    found ^= found >> np.uint64(29)
    found *= factor
    found >>= np.uint64(24)
    found &= np.uint64(rows - 1)
    return found.astype("i8").T


def features(names: np.ndarray, starts: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """(tokens, 3) weight rows of a text's tokens; `rows` is a power of two."""
    return hashed(*histories(names, starts), rows)


def _scores(rows: np.ndarray, bias: np.ndarray, weights: np.ndarray) -> np.ndarray:
    scores = weights.take(rows[:, 0], 0)
    scores += weights.take(rows[:, 1], 0)
    scores += weights.take(rows[:, 2], 0)
    scores += bias
    return np.clip(scores, -STEEPEST, STEEPEST, out=scores)


def log_softmax(rows: np.ndarray, bias: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Log-probabilities of all classes for each token."""
    scores = _scores(rows, bias, weights)
    scores -= np.log(np.exp(scores) @ ONES)[:, None]
    return scores


def sums_by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct weight rows of a batch, and the sums of `values` over the tokens that have them.

    The rows with most tokens stand first: the k-th token of all rows that have
    one is then one array operation; rows of over LONG tokens are few.
    """
    keys = (rows.T << 32 | np.arange(len(rows))).ravel()
    keys.sort()
    flat, token = keys >> 32, keys & 0xFFFFFFFF
    first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    size = np.diff(np.r_[first, len(flat)])
    by_size = (-np.minimum(size, LONG + 1)).astype("i2").argsort(kind="stable")
    met, first, size = flat[first[by_size]], first[by_size], size[by_size]
    long = int((size > LONG).sum())
    total = values.take(token[first], 0)
    for k in range(1, LONG):
        some = int((size > k).sum())
        total[long:some] += values.take(token[first[long:some] + k], 0)
    if long:
        tail = np.concatenate([token[a : a + n] for a, n in zip(first[:long], size[:long], strict=True)])
        total[:long] = np.add.reduceat(values.take(tail, 0), np.r_[0, np.cumsum(size[:long])[:-1]], axis=0)
    return met, total


def update(rows: np.ndarray, truth: np.ndarray, bias: np.ndarray, weights: np.ndarray, spread: np.ndarray) -> None:
    """One gradient step over a batch, on the weights it meets, scaled by each weight's own history."""
    error = _scores(rows, bias, weights)
    np.exp(error, out=error)
    error *= (-1 / (error @ ONES))[:, None]
    error[np.arange(len(truth)), truth] += 1
    met, slope = sums_by_row(rows, error)
    history = spread.take(met, 0)
    history += slope * slope
    spread[met] = history
    slope /= np.sqrt(history, out=history)
    slope *= RATE
    slope += weights.take(met, 0)
    weights[met] = slope


def _training(batches, own: np.ndarray):
    """(names per token, starts, classes per token) of the training documents, per chunk."""
    for batch in batches:
        for row in range(batch.num_rows):
            held, sizes, names, endings, codes = (column[row].as_py() for column in batch.columns)
            held, sizes = np.array(held, bool), np.array(sizes, "i8")
            codes = from_planes(codes, sizes.sum())[np.repeat(~held, sizes)]
            if len(codes):
                names, endings = np.frombuffer(names, "<u4"), np.frombuffer(endings, "u1")
                starts = np.r_[0, np.cumsum(sizes[~held])[:-1]]
                yield names[codes], starts, classes_of(names, endings, own)[codes]


def _train(batches, own: np.ndarray, bias: np.ndarray, shared: np.ndarray):
    """Changes of the weight vectors that this task's documents met and their numbers of tokens, in ranges of PART."""
    weights, spread, met = shared.copy(), np.ones_like(shared), np.zeros(len(shared), "i8")
    for names, starts, truth in _training(batches, own):
        one, two = histories(names, starts)
        for at in range(0, len(truth), BATCH):
            rows = hashed(one[at : at + BATCH], two[at : at + BATCH], len(shared))
            update(rows, truth[at : at + BATCH], bias, weights, spread)
            np.add.at(met, rows.ravel(), 1)
    for at in range(0, len(shared), PART):
        some = np.flatnonzero(met[at : at + PART])
        if len(some):
            change = weights[at + some] - shared[at + some]
            columns = [
                pa.array([at // PART], "i4"),
                pa.array([some.astype("<u2").tobytes()]),
                pa.array([met[at + some].astype("<i8").tobytes()]),
                pa.array([change.astype("<f2").tobytes()]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["part", "places", "met", "change"])


def _average(batches):
    """Changes of each range of vectors, averaged over the tasks that met them; one range's sums at a time per key."""
    sums: dict[int, tuple] = {}
    for batch in batches:
        for part, places, met, change in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            places, met = np.frombuffer(places, "<u2"), np.frombuffer(met, "<i8")
            count, total = sums.setdefault(part, (np.zeros(PART, "i8"), np.zeros((PART, CLASSES))))
            count[places] += met
            total[places] += np.frombuffer(change, "<f2").reshape(-1, CLASSES).astype("f8") * met[:, None]
    for part, (count, total) in sums.items():
        mean = (total / np.maximum(count, 1)[:, None]).astype("<f4")
        yield pa.RecordBatch.from_arrays([pa.array([part], "i4"), pa.array([mean.tobytes()])], ["part", "change"])


def _class_totals(batches, own: np.ndarray):
    """Tokens and distinct words per class."""
    tokens, kinds = np.zeros(CLASSES, "i8"), np.zeros(CLASSES, "i8")
    for batch in batches:
        words = batch.column(0).to_pylist()
        names = np.fromiter(map(word_name, words), "u4", len(words))
        of = classes_of(names, np.fromiter(map(ending_class, words), "u1", len(words)), own)
        np.add.at(tokens, of, batch.column(1).to_numpy())
        kinds += np.bincount(of, minlength=CLASSES)
    columns = [pa.array(range(CLASSES), "i4"), pa.array(tokens), pa.array(kinds)]
    yield pa.RecordBatch.from_arrays(columns, ["class", "tokens", "kinds"])


def _gather(batches):
    """Counts of a chunk's words as one value, from rows sorted by (chunk, place)."""
    chunk, held = None, []

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], "i8"), pa.array([np.concatenate(held).astype("<i8").tobytes()])], ["of", "counts"]
        )

    for batch in batches:
        chunks, counts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero(chunks[1:] != chunks[:-1]) + 1
        for some, values in zip(np.split(chunks, cuts), np.split(counts, cuts), strict=True):
            if not len(some):
                continue
            if chunk is not None and some[0] != chunk:
                yield row()
                held = []
            chunk = int(some[0])
            held.append(values)
    if held:
        yield row()


def _score(batches, total: int, distinct: int, own, bias, weights, tokens: np.ndarray, kinds: np.ndarray):
    """Per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    for batch in batches:
        for row in range(batch.num_rows):
            ids = batch.column(0)[row].values
            held, sizes, names, endings, codes, counts = (column[row].as_py() for column in batch.columns[1:])
            sizes, names, counts = np.array(sizes, "i8"), np.frombuffer(names, "<u4"), np.frombuffer(counts, "<i8")
            codes, classes = from_planes(codes, sizes.sum()), classes_of(names, np.frombuffer(endings, "u1"), own)
            base = np.log10((counts + SMOOTH) / (total + SMOOTH * (distinct + 1)))
            inside = np.log10((counts + SMOOTH) / (tokens[classes] + SMOOTH * (kinds[classes] + 1)))
            starts = np.r_[0, np.cumsum(sizes)[:-1]]
            one, two = histories(names[codes], starts)
            chosen = np.empty(len(codes))
            for at in range(0, len(codes), BATCH):
                logs = log_softmax(hashed(one[at : at + BATCH], two[at : at + BATCH], len(weights)), bias, weights)
                chosen[at : at + BATCH] = logs[np.arange(len(logs)), classes[codes[at : at + BATCH]]]
            sums = lambda values: np.add.reduceat(values, starts)  # noqa: E731, B023
            columns = [
                ids,
                pa.array(held, pa.bool_()),
                pa.array(sizes),
                pa.array(sums((counts > 0).astype("i8")[codes])),
                pa.array(np.full(len(sizes), total)),
                pa.array(sums(base[codes])),
                pa.array(sums(chosen / np.log(10) + inside[codes])),
            ]
            found = ["_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
            yield pa.RecordBatch.from_arrays(columns, found)


def vectors(tokens: int) -> int:
    """Number of weight vectors for so many training tokens."""
    return max(ROWS, 1 << math.ceil(math.log2(2 * math.sqrt(max(tokens, 1)))))


def score_language(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Text is lower-cased (A-Z only); tokens are runs of anything but ASCII white
    space, and one end per document. A NULL or empty text is its end alone. Rows
    that repeat an id are documents each; a NULL id is not held out. If every
    row is held out, the model is uniform over classes and every base score is
    0. An empty table gives no row. Other columns are ignored.
    """
    ship_package(df.sparkSession)
    kind = dict(df.dtypes)[id_col]
    held = F.coalesce(held_out(id_col, FOLDS), F.lit(False)).alias("_held")
    source = df.select(F.col(id_col).alias("_id"), held, F.col(text_col).alias("_text"))
    shape = f"chunk long, ids array<{kind}>, held array<boolean>, sizes array<long>, words array<binary>, "
    shape += "names binary, endings binary, codes binary"
    encoded = stage(source.mapInArrow(_encode, shape), "encoded")

    counted = encoded.select("held", "sizes", "words", "codes").mapInArrow(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
    counted = stage(counted, "word-counts")
    sums = counted.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    # OWN_CLASSES rows: the frequent words that are classes of their own.
    top = counted.orderBy(F.col("c").desc(), "word").limit(OWN_CLASSES).collect()
    own = np.array([word_name(bytes(row["word"])) for row in top], "u4")
    per_class = (
        counted.mapInArrow(lambda b: _class_totals(b, own), "class int, tokens long, kinds long")
        .groupBy("class").agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).collect()
    )
    tokens, kinds = np.zeros(CLASSES, "i8"), np.zeros(CLASSES, "i8")
    for row in per_class:
        tokens[row["class"]], kinds[row["class"]] = row["tokens"], row["kinds"]
    bias = np.log((tokens + 1.0) / (tokens.sum() + CLASSES)).astype("f4")

    n, v = int(sums["n"]), int(sums["v"])
    weights = np.zeros((vectors(n), CLASSES), "f4")
    learnt = encoded.select("held", "sizes", "names", "endings", "codes")
    learnt = learnt.coalesce(max(TASKS, math.ceil(n / (TASK_VECTORS * len(weights)))))
    for _ in range(rounds):
        sent = "part int, places binary, met binary, change binary"
        trained = learnt.mapInArrow(lambda b, w=weights: _train(b, own, bias, w), sent)
        averaged = trained.repartition("part").mapInArrow(_average, "part int, change binary")
        weights = weights.copy()
        # One row per range of weight vectors: as large as the model itself.
        for row in averaged.collect():
            at = row["part"] * PART
            weights[at : at + PART] += np.frombuffer(row["change"], "<f4").reshape(-1, CLASSES)

    words = encoded.select("chunk", F.posexplode("words").alias("place", "_w"))
    met = words.join(counted, F.col("_w") == F.col("word"), "left")
    met = met.select("chunk", F.coalesce("c", F.lit(0)).alias("c"), "place").repartition("chunk")
    gathered = met.sortWithinPartitions("chunk", "place").select("chunk", "c").mapInArrow(
        _gather, "of long, counts binary"
    )
    kept = encoded.drop("words")
    ready = kept.join(gathered, F.col("chunk") == F.col("of")).select(*kept.columns[1:], "counts")
    out = (
        f"_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    scored = ready.mapInArrow(lambda b: _score(b, n, v, own, bias, weights, tokens, kinds), out)
    return scored.withColumnRenamed("_id", id_col)


@query("op8_language_scores")
def op8_language_scores(spark, sf_dir):
    return score_language(table(spark, sf_dir, "documents"))
