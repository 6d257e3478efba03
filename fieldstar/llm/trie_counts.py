"""Token counts by dynamic programming over a trie of pre-tokens.

A pre-token (a word with its leading mark) is segmented into vocabulary pieces
so that the sum of the pieces' scores is highest. The best score of a prefix
depends on the prefix only, so it is computed once per node of a trie that holds
the distinct pre-tokens, and words that share a prefix share its work. A node
where a pre-token ends keeps its token count, its terminal count.

Scores are unigram log-probabilities after a rank law over the vocabulary's
order: -ln(rank + 2.7). Bytes that no piece covers count as one token each, at
BYTE_SCORE. Equal scores go to the segmentation with fewer tokens.

Plan at scale: counting is one map over the documents without a shuffle. Every
task builds its own trie from the pre-tokens it meets; natural text repeats
them, so nearly every word is one table look-up. Trie and table are bounded: a
full one is emptied and grows again, which changes no count. Totals per group
are ordinary aggregates over per-document counts.
"""

from __future__ import annotations

import math
import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstar.llm.common import query, table
from fieldstar.llm.tokens import vocabulary_path
from fieldstar.session import ship_package

VOCABULARY = "piece_bpe_32k.model"
MARK = "\N{LOWER ONE EIGHTH BLOCK}"  # stands for the space before a word
BYTE_SCORE = -20.0
MOST_NODES = 1_000_000
MOST_WORDS = 400_000


def piece_scores(path: str) -> dict[bytes, float]:
    """Scores of a vocabulary's ordinary pieces, by their UTF-8 bytes."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ordinary = [
        i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    return {model.id_to_piece(i).encode(): -math.log(rank + 2.7) for rank, i in enumerate(ordinary)}


class Trie:
    """Pre-tokens met so far, with the best segmentation of every prefix.

    A node is a number; it has the score and the token count of the best
    segmentation of the bytes that lead to it, and its children by byte.
    """

    def __init__(self, scores: dict[bytes, float]):
        # Every ending of a piece: its score if it is a piece itself, else None. Looking for the
        # last piece of a prefix can stop at the first string that ends no piece.
        self.endings = {piece[k:]: None for piece in scores for k in range(len(piece))} | scores
        self.clear()

    def clear(self) -> None:
        self.children: dict[int, int] = {}  # 256 * node + byte -> node
        self.score, self.tokens = [0.0], [0]

    def _grow(self, path: list[int], token: bytes, end: int) -> int:
        """A new node for token[:end]; `path` has the nodes of the shorter prefixes."""
        score, tokens, endings = self.score, self.tokens, self.endings
        before = path[end - 1]
        best, fewest = score[before] + BYTE_SCORE, tokens[before] + 1
        for start in range(end - 1, -1, -1):
            piece = token[start:end]
            if (own := endings.get(piece, 1.0)) is None:
                continue
            if own > 0:
                break
            before = path[start]
            total, needed = score[before] + own, tokens[before] + 1
            if total > best or total == best and needed < fewest:
                best, fewest = total, needed
        score.append(best)
        tokens.append(fewest)
        return len(score) - 1

    def count(self, token: bytes) -> int:
        """Tokens of the best segmentation of a pre-token: its terminal count."""
        if len(self.score) + len(token) > MOST_NODES:
            self.clear()
        children, node, path = self.children, 0, [0]
        for end, byte in enumerate(token, 1):
            edge = 256 * node + byte
            if (child := children.get(edge)) is None:
                child = children[edge] = self._grow(path, token, end)
            path.append(node := child)
        return self.tokens[node]


class WordCounts(dict):
    """Token counts by word, bounded; the trie answers for new words."""

    def __init__(self, trie: Trie):
        super().__init__()
        self.trie = trie
        self.mark = MARK.encode()

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        self[word] = found = self.trie.count(self.mark + word)
        return found


_counts: dict[str, WordCounts] = {}


def word_counts(vocabulary: str) -> WordCounts:
    """This worker's table for a vocabulary: a file path, or the name of a public file."""
    if vocabulary not in _counts:
        path = vocabulary if os.path.isabs(vocabulary) else vocabulary_path(vocabulary)
        _counts[vocabulary] = WordCounts(Trie(piece_scores(path)))
    return _counts[vocabulary]


def token_counts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """One row per input row: id, n_words, n_tokens.

    Words are runs of anything but ASCII white space. NULL, empty and blank
    texts have no words and no tokens. Rows that repeat an id are counted each.
    An empty table gives no row. Other columns are ignored.
    """

    def count(batches):
        known = word_counts(vocabulary)
        for batch in batches:
            words = [(text or b"").split() for text in batch.column(1).cast(pa.binary()).to_pylist()]
            tokens = [sum(map(known.__getitem__, own)) for own in words]
            columns = [batch.column(0), pa.array(list(map(len, words)), "i8"), pa.array(tokens, "i8")]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "n_words", "n_tokens"])

    ship_package(df.sparkSession)
    kind = dict(df.dtypes)[id_col]
    own = df.select(F.col(id_col).alias("_id"), text_col)
    return own.mapInArrow(count, f"_id {kind}, n_words long, n_tokens long").withColumnRenamed("_id", id_col)


@query("op3_token_counts")
def op3_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))
