"""BPE encoding and decoding by dynamic programming over prefixes.

A word is a string of symbols: one per byte, the last byte being a symbol of its own kind
(it carries the end-of-word mark). Every prefix of a word has exactly one encoding, so one
last token per prefix describes them all: of the vocabulary tokens that an Aho-Corasick
automaton (a suffix automaton of the vocabulary) finds to end at a position, it is the one
that is compatible with the last token of the prefix before it. Back-pointers from the end
give the ids.

Two tokens are compatible if merging their symbols side by side yields just these two. A
merge across their border happens if its rank comes before the ranks at which the piece on
either side is taken up by its own token; of two equal merges the left one goes first.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Words kept with their tokens by a task; the store is emptied when it is full.
CACHED_WORDS = 400_000

# How the vocabulary splits texts into words, in general and for ASCII.
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
_ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")
_END = "</w>"
_LATE = 1 << 60


class Codec:
    """Encoder and decoder of one vocabulary: BPE over bytes with end-of-word marks, texts in
    NFC and lower case, special tokens cut out first."""

    def __init__(self, vocabulary: str):
        """vocabulary: the text of a tokenizer JSON file of this kind."""
        spec = json.loads(vocabulary)
        model, self.special = spec["model"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        if model.get("end_of_word_suffix") != _END or any(t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("not a vocabulary with end-of-word marks")
        ids: dict[str, int] = model["vocab"]
        self.text = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.symbols = self._alphabet(ids)
        self.ranks: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            a, b, whole = ids[left], ids[right], ids[left + right]
            self.ranks[a, b] = rank
            self.parts[whole] = a, b
            self.symbols[whole] = self.symbols[a] + self.symbols[b]
        self.made = {t: self.ranks[p] for t, p in self.parts.items()}
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.automaton = ahocorasick.Automaton()
        for token in sorted(self.symbols, key=lambda t: self.made.get(t, -1)):
            self.left[token], self.right[token] = self._edge(token, 0), self._edge(token, 1)
            own = self.parts.get(token)
            if own is None or self._crossing(*own, self.made[token]) is None:
                self.automaton.add_word(self.symbols[token], (len(self.symbols[token]), token))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[int, str, str]] = {}

    @staticmethod
    def _alphabet(ids: dict[str, int]) -> dict[int, str]:
        """Symbols of the single-byte tokens: chr(byte), or chr(256 + byte) at a word's end."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        shown = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        return {ids[c]: chr(b) for b, c in shown.items()} | {ids[c + _END]: chr(256 + b) for b, c in shown.items()}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Pieces that stand at one edge of a token while it is merged, the token first, each
        with the rank of the merge that takes it up."""
        found, taken = [(token, _LATE)], _LATE
        while parts := self.parts.get(token):
            taken, token = self.made[token], parts[side]
            found.append((token, taken))
        return found

    def _crossing(self, a: int, b: int, before: int = _LATE) -> int | None:
        """Rank of a merge across the border of two tokens that comes before ``before``."""
        ranks = self.ranks
        for x, taken_x in self.right[a]:
            for y, taken_y in self.left[b]:
                rank = ranks.get((x, y))
                if rank is not None and rank < taken_x and rank <= taken_y and rank < before:
                    return rank
        return None

    def compatible(self, a: int, b: int) -> bool:
        if len(self.pairs) >= CACHED_WORDS:
            self.pairs.clear()
        found = self.pairs[a, b] = self._crossing(a, b) is None
        return found

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode()
        symbols = raw[:-1].decode("latin-1") + chr(256 + raw[-1])
        size, known, done = len(symbols), self.pairs, -1
        last, start = [0] * size, [0] * size
        for end, (length, token) in self.automaton.iter(symbols):
            if end == done:
                continue
            before = end - length
            if before >= 0:
                fits = known.get((last[before], token))
                if not (self.compatible(last[before], token) if fits is None else fits):
                    continue
            last[end], start[end], done = token, before, end
        ids, at = [], size - 1
        while at >= 0:
            ids.append(last[at])
            at = start[at]
        ids.reverse()
        return ids

    def _word(self, word: str) -> tuple[int, str, str]:
        ids = self.encode_word(word)
        if len(self.words) >= CACHED_WORDS:
            self.words.clear()
        found = self.words[word] = len(ids), " ".join(map(str, ids)), self.decode(ids)
        return found

    def encoded(self, text: str) -> Iterator[tuple[int, str, str]]:
        """Of each word or special token: number of ids, the ids and their texts, space-joined."""
        get = self.words.get
        for part in self.cut.split(text) if self.cut and "<" in text else (text,):
            if part in self.special:
                yield 1, str(self.special[part]), part
            elif part.isascii():
                for word in _ASCII_WORD.findall(part.lower()):
                    yield get(word) or self._word(word)
            else:
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                for word in _WORD.findall(part):
                    yield get(word) or self._word(word)

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self.encoded(text) for i in ids.split(" ")]

    def decode(self, ids: list[int]) -> str:
        """Token texts joined by one space; unknown ids are left out."""
        return " ".join(self.text[i] for i in ids if i in self.text)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(documents: DataFrame, vocabulary_file: str) -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    A null text counts as empty; repeated rows and null ids stay; other columns are ignored.
    The vocabulary is read on the driver and sent to the executors once.
    """
    spark = documents.sparkSession
    with open(vocabulary_file, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or Codec(vocabulary.value)
            rows = []
            for text in batch.column(1):
                found = list(zip(*codec.encoded(text.as_py() or ""))) or [(), (), ()]
                rows.append((sum(found[0]), _digest(" ".join(found[1])), _digest(" ".join(found[2]))))
            columns = list(zip(*rows)) or [()] * 3
            arrays = [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = documents.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.dtypes[0][1]}, n_tokens long, ids_sha256 string, decoded_sha256 string")


# Workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
