"""Alignment of two tokenizers on byte offsets, each distinct text once.

Texts are grouped by their full text (map-side counts come first, so a group of copies with
a third of all rows is one row per map task). Each distinct text is encoded by both
tokenizers and aligned. The ends of all tokens cut a text into smallest ranges, and each
such range is the overlap of exactly one token of A and one of B: a link. Pair counts of
the corpus are sums of the links of distinct texts weighted by the texts' multiplicity.
Measures go back to the documents by the SHA-256 of their text.

Both encodings can be cut before a space between two signs that are no white space: A's
word pattern starts a word there, and no piece of B holds a space mark behind another sign
(checked when the vocabulary is loaded). Between cuts the encodings are functions of the
segment alone, so a task keeps those of segments that it has seen.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import store

# Signs of segments kept by a task; the store is emptied when it is full.
CACHED_CHARS = 4_000_000
# New segments encoded as one text.
JOINED = 20_000
# Signs of texts handled at once.
BLOCK_CHARS = 1_000_000
# Pairs that are broadcast at most (of 24 bytes); all rarer ones are joined by a shuffle.
MOST_FREQUENT = 500_000

_CUT = re.compile(r"(?<=\S) (?=\S)")
_MARK = "▁"
_COLUMNS = "key binary, n long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, counts array<long>"


class Aligner:
    """Encodes segments of texts with both tokenizers and aligns them."""

    def __init__(self, a_spec: str, b_model: bytes):
        """a_spec: text of a byte-level tokenizer JSON file; b_model: a piece model."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_spec)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(_MARK in p.lstrip(_MARK) for p in pieces):
            raise ValueError("pieces with a space mark inside cannot be cut at spaces")
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]
        shown = _byte_level()
        spelled = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [_raw(spelled.get(i, ""), shown) for i in range(max(spelled) + 1)]
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.chars = 0
        self.shown: list[str] = []
        self.sizes = np.zeros((0, 3), np.int64)
        self.starts = np.zeros(1, np.int64)
        self.links = np.zeros(0, np.int64)

    def _encoded(self, text: str) -> tuple[list[int], list[int]]:
        return self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)

    def _whole(self, text: str, a: list[int], b: list[int]) -> bool:
        raw = (" " + text).encode()
        return b"".join([self.a_bytes[i] for i in a]) == raw and b"".join([self.b_bytes[i] for i in b]) == raw

    def _aligned(self, flat_a: np.ndarray, flat_b: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Of segments that end at ``stops`` (bytes), where a token of A and one of B end: numbers
        of tokens of A and B and of groups; linked pairs (A in the high half) one segment after
        another; the groups' text."""
        ends_a, ends_b = np.cumsum(self.a_sizes[flat_a]), np.cumsum(self.b_sizes[flat_b])
        ends = np.union1d(ends_a, ends_b)
        links = flat_a[np.searchsorted(ends_a, ends)] << 32 | flat_b[np.searchsorted(ends_b, ends)]
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        stops_a, stops_b = np.searchsorted(ends_a, both, "right"), np.searchsorted(ends_b, both, "right")
        sizes = np.stack([np.diff(np.searchsorted(e, stops, "right"), prepend=0) for e in (ends_a, ends_b, both)], axis=1)
        text_a, text_b = list(map(str, flat_a.tolist())), list(map(str, flat_b.tolist()))
        parts, x, y = [], 0, 0
        for i, j in zip(stops_a.tolist(), stops_b.tolist()):
            parts.append((text_a[x] if i - x == 1 else ",".join(text_a[x:i])) + "|" + (text_b[y] if j - y == 1 else ",".join(text_b[y:j])))
            x, y = i, j
        shown, at = [], 0
        for size in sizes[:, 2].tolist():
            shown.append(parts[at] if size == 1 else ";".join(parts[at : at + size]))
            at += size
        return sizes, links, shown

    def _learn(self, segments: list[str]) -> None:
        """Encode and align new segments. Those without white space at their ends are cut from
        each other like parts of one text, so they are encoded as one; should that not give the
        bytes back, its halves are. A single one that does not gets no place."""
        text = " ".join(segments)
        a, b = self._encoded(text)
        if not self._whole(text, a, b):
            if len(segments) > 1:
                half = len(segments) // 2
                self._learn(segments[:half])
                self._learn(segments[half:])
            else:
                self.place[text] = -1
            return
        stops = np.cumsum([1 + len(s.encode()) for s in segments])
        sizes, links, shown = self._aligned(np.array(a), np.array(b), stops)
        first = len(self.shown)
        self.place.update(zip(segments, range(first, first + len(segments))))
        self.shown += shown
        self.sizes = np.concatenate([self.sizes, sizes])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes[:, 0] + sizes[:, 1] - sizes[:, 2])])
        self.links = np.concatenate([self.links, links])

    def measured(self, texts: list[str]) -> Iterator[tuple]:
        """Of each text: numbers of tokens of A and B, groups and links, digest of the groups,
        and its distinct linked pairs with their numbers of links."""
        if self.chars > CACHED_CHARS:
            self._clear()
        cut = [_CUT.split(t) for t in texts]
        new = set(chain.from_iterable(cut)).difference(self.place)
        self.chars += sum(map(len, new))
        joined = sorted(s for s in new if not s[0].isspace() and not s[-1].isspace())
        for i in range(0, len(joined), JOINED):
            self._learn(joined[i : i + JOINED])
        for single in new.difference(joined):
            self._learn([single])
        for text, segments in zip(texts, cut):
            at = np.fromiter(map(self.place.__getitem__, segments), np.int64, len(segments))
            if at.min() >= 0:
                n_a, n_b, n_groups = self.sizes[at].sum(axis=0).tolist()
                sizes = self.starts[at + 1] - self.starts[at]
                stops = np.cumsum(sizes)
                links = self.links[np.arange(stops[-1]) + np.repeat(self.starts[at] - stops + sizes, sizes)]
                shown = ";".join([self.shown[i] for i in at.tolist()])
            else:
                a, b = self._encoded(text)
                if not self._whole(text, a, b):
                    yield 0, 0, 0, 0, "", _NONE, _NONE
                    continue
                sizes, links, (shown,) = self._aligned(np.array(a), np.array(b), np.array([1 + len(text.encode())]))
                n_a, n_b, n_groups = sizes[0].tolist()
            pairs, counts = np.unique(links, return_counts=True)
            yield n_a, n_b, n_groups, n_a + n_b - n_groups, hashlib.sha256(shown.encode()).hexdigest(), pairs, counts


_NONE = np.zeros(0, np.int64)


def _byte_level() -> dict[str, int]:
    """Byte of each sign of a byte-level vocabulary: printable Latin-1 signs stand for
    themselves, the other bytes in order for the signs from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _raw(token: str, shown: dict[str, int]) -> bytes:
    return bytes(shown[c] for c in token) if all(c in shown for c in token) else token.encode()


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BLOCK_CHARS:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def _lists(found: list[np.ndarray]) -> pa.Array:
    stops = np.cumsum([0, *map(len, found)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(stops), pa.array(np.concatenate(found).astype(np.int64)))


def aligned(documents: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """One row per distinct non-empty text: ``key`` (SHA-256 of it), ``n`` (documents that have
    it), ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, ``pairs`` (distinct
    linked pairs, A's id in the high half of a long) and ``counts`` (their links).

    A text that a tokenizer does not give back byte by byte has zeros, '' and no pairs. The
    vocabularies are read on the driver and sent to the executors once.
    """
    spark = documents.sparkSession
    with open(a_file, encoding="utf-8") as a, open(b_file, "rb") as b:
        files = spark.sparkContext.broadcast((a.read(), b.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(*files.value)
            texts = batch.column(0).to_pylist()
            for i, j in _blocks(texts):
                *numbers, digests, pairs, counts = zip(*aligner.measured(texts[i:j]))
                keys = pa.array([hashlib.sha256(t.encode()).digest() for t in texts[i:j]], pa.binary())
                arrays = [keys, batch.column(1).slice(i, j - i), *(pa.array(x, pa.int64()) for x in numbers), pa.array(digests), _lists(pairs), _lists(counts)]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "n", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "counts"])

    texts = documents.where("text <> ''").groupBy("text").agg(F.count("*").alias("n"))
    return texts.mapInArrow(run, _COLUMNS)


def pair_counts(texts: DataFrame) -> DataFrame:
    """``pair``, ``n`` (links of the whole corpus that hold it) and ``best`` (no other pair of
    the same B id has more), from the rows of ``aligned``."""
    links = texts.select("n", F.explode(F.arrays_zip("pairs", "counts")).alias("link"))
    totals = links.groupBy(F.col("link.pairs").alias("pair")).agg(F.sum(F.col("n") * F.col("link.counts")).alias("n"))
    totals = store(totals.withColumn("b", F.expr("pair & 4294967295")), "totals")
    highest = totals.groupBy("b").agg(F.max("n").alias("highest"))
    return totals.join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _least_frequent(pairs: DataFrame, most: int) -> int:
    """The smallest power of two so that at most ``most`` pairs have at least as many links."""
    sizes = pairs.groupBy(F.floor(F.log2(F.col("n").cast("double"))).cast("int").alias("size")).agg(F.count("*").alias("n"))
    held, least = 0, 62
    for size, n in sorted(sizes.collect(), reverse=True):
        held += n
        if held > most:
            break
        least = size
    return 2 ** max(0, least)


def document_measures(documents: DataFrame, a_file: str, b_file: str, most_frequent: int = MOST_FREQUENT) -> DataFrame:
    """One row per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``
    (links whose pair has the most links of its B id, ties included), ``count_sum`` (sum over
    the links of their pair's count) and ``groups_sha256``.

    Null and empty texts, and texts that a tokenizer does not give back, have zeros and ''.
    Repeated rows and null ids stay and count as documents; an empty table gives no rows;
    other columns are ignored. Frequent pairs, at most ``most_frequent``, are broadcast; the
    others meet their texts in a join, where no pair is frequent.
    """
    texts = store(aligned(documents, a_file, b_file), "texts")
    pairs = store(pair_counts(texts), "pairs")
    least = _least_frequent(pairs, most_frequent)
    links = texts.select("key", F.explode(F.arrays_zip("pairs", "counts")).alias("link")).select("key", F.col("link.pairs").alias("pair"), F.col("link.counts").alias("links"))
    frequent = F.broadcast(pairs.where(F.col("n") >= least))
    found = _sums(links.join(frequent, "pair"))
    if pairs.where(F.col("n") < least).limit(1).count():
        rare = links.join(frequent.select("pair"), "pair", "left_anti").join(pairs.where(F.col("n") < least), "pair")
        found = found.union(_sums(rare))
    sums = found.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    measures = store(texts.drop("n", "pairs", "counts").join(sums, "key", "left"), "measures")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    keyed = documents.select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"))
    return keyed.join(measures, "key", "left").select(
        "doc_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")
    )


def _sums(links: DataFrame) -> DataFrame:
    return links.groupBy("key").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum"))


# Workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
