"""Token ids of a public vocabulary, word by word."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words of these letters and marks fall into a letter run and a mark run for the
# vocabulary's own splitter; both come out as they would from the whole word.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*#%&$|]*)").fullmatch
MOST_WORDS = 400_000
MOST_PARTS = 1_000_000
PARTS_AT_ONCE = 2_000


def vocabulary_path(name: str) -> str:
    """Where this machine keeps a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of texts as unsigned 32-bit numbers.

    The vocabulary drops white space and never joins across it, so a text's ids
    are its words' ids in a row. Arrow splits many texts at once and reduces
    their words to the distinct ones; only these are looked up, and numbers are
    gathered for all places at once. Words repeat, so ids are kept by word, and
    new words are put together from letter runs where that gives the same ids.
    All tables are bounded: a full one is emptied and filled anew.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._parts: dict[str, bytes] = {"": b""}
        self._clear()

    def _clear(self) -> None:
        self._places: dict[str, int] = {"": 0}
        self._starts, self._sizes = array("q", [0]), array("q", [0])
        self._ids = bytearray()

    def _encode(self, parts: list[str]) -> None:
        # What the vocabulary returns of a part is far larger than its ids: few are held at once.
        for at in range(0, len(parts), PARTS_AT_ONCE):
            some = parts[at : at + PARTS_AT_ONCE]
            found = self._tokenizer.encode_batch_fast(some, add_special_tokens=False)
            self._parts.update((p, array("I", e.ids).tobytes()) for p, e in zip(some, found, strict=True))

    def _learn(self, words: list[str]) -> None:
        if len(self._parts) > MOST_PARTS:
            self._parts = {"": b""}
        cut = {}
        for word in words:
            plain = PLAIN(word)
            cut[word] = (plain[1].lower(), plain[2]) if plain else (word, "")
        self._encode([p for p in {part for pair in cut.values() for part in pair} if p not in self._parts])
        for word, (head, tail) in cut.items():
            ids = self._parts[head] + self._parts[tail]
            self._places[word] = len(self._starts)
            self._starts.append(len(self._ids) // 4)
            self._sizes.append(len(ids) // 4)
            self._ids += ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids per text) of an array of texts, NULL counting as empty."""
        words = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self._places) + len(distinct) > MOST_WORDS:
            self._clear()
        known = self._places
        self._learn([w for w in distinct if w not in known])
        place = np.fromiter(map(self._places.__getitem__, distinct), "i8", len(distinct))
        starts = np.frombuffer(self._starts, "i8")[place] if len(place) else place
        sizes = np.frombuffer(self._sizes, "i8")[place] if len(place) else place
        of_word = coded.indices.to_numpy(zero_copy_only=False)
        each = sizes[of_word]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        ids = np.frombuffer(self._ids, "u4") if len(self._ids) else np.zeros(0, "u4")
        # Where each word's ids stand, less where they go: one gather then takes all of them.
        index = np.repeat(starts[of_word] - ends + each, each)
        index += np.arange(total)
        found = ids[index]
        edges = np.concatenate([[0], ends])[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return found, np.diff(edges)


_encoders: dict[str, WordEncoder] = {}


def encoder(name: str) -> WordEncoder:
    """This worker's encoder for a vocabulary: a file path, or the name of a public file."""
    if name not in _encoders:
        _encoders[name] = WordEncoder(name if os.path.isabs(name) else vocabulary_path(name))
    return _encoders[name]
