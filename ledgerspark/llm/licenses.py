"""License scans: phrases by place, and an exact set-similarity join of text blocks with
license templates.

Blocks are overlapping windows of words, so it does not matter how a notice is wrapped or which
marks stand before its lines. A template belongs to the smallest power of two that is at least
its number of words, c; its windows have 2 c words and begin every c words, so one of them
holds any place of up to c words whole. A template T is found in a block B of its size if B
has at least ``CONTAINMENT`` of T's distinct words. Words are ordered by how many blocks of the whole corpus have them,
rarest first; of T only the first |T| - need + 1 and of B the first |B| - need + 1 can hold
their first common word, which gives prefix, length and positional filters without loss.
The texts are read once: a pass over documents keeps, per block, the words that any
template has (blocks with fewer than the smallest need cannot match), and the join runs on
that narrow table. Templates are a parameter of at most ``MAX_TEMPLATES``, so their prefix
index is broadcast.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import store

CONTAINMENT = 0.9
MAX_TEMPLATES = 1000

# Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Sentences of public licenses and notices, and their labels.
TEMPLATES = (
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at",
    ),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the Software), to deal in the Software without restriction",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str | bytes) -> list[bytes]:
    """Words of a text: ASCII letters (lower-cased) and digits and all other code points."""
    raw = text if isinstance(text, bytes) else text.encode()
    return _WORD.findall(raw.lower())


def need(size: int, containment: float) -> int:
    """Fewest common words for a template of ``size`` words."""
    return math.ceil(round(containment * size, 9))


def _phrase_places(found: list[bytes], phrases: list[tuple[list[bytes], str]]) -> tuple[list[int], set[str]]:
    starts, labels = [], set()
    for phrase, label in phrases:
        at = -1
        for _ in range(found.count(phrase[0])):
            at = found.index(phrase[0], at + 1)
            if found[at : at + len(phrase)] == phrase:
                starts.append(at)
                labels.add(label)
    return starts, labels


_SCANNED = (
    "row long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, blocks array<struct<size: int, terms: array<int>>>"
)


def size_of(template: str) -> int:
    """Half the words of the windows that a template is looked for in."""
    return 1 << max(0, len(words(template)) - 1).bit_length()


def scan(documents: DataFrame, sizes: dict[int, tuple[dict[bytes, int], int]], phrases=PHRASES) -> DataFrame:
    """Per document: word count, phrase places, and the template words of each block that has
    enough of them. ``sizes``: numbers of the template words, and the fewest a block needs, by
    block size. A null text counts as empty."""
    split = [([w.encode() for w in phrase.split()], label) for phrase, label in phrases]
    types = pa.list_(pa.struct([("size", pa.int32()), ("terms", pa.list_(pa.int32()))]))

    def row(text: bytes | None) -> tuple:
        found, blocks = words(text or b""), []
        for size, (number, least) in sizes.items():
            held: dict[int, set[int]] = {}
            for at, term in enumerate(map(number.get, found)):
                if term is not None:
                    block = at // size
                    held.setdefault(block, set()).add(term)
                    if block:
                        held.setdefault(block - 1, set()).add(term)
            blocks += [{"size": size, "terms": sorted(terms)} for terms in held.values() if len(terms) >= least]
        starts, labels = _phrase_places(found, split)
        return len(found), len(starts), min(starts, default=None), max(starts, default=None), sorted(labels), blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(x.as_py()) for x in batch.column(2).cast(pa.binary())]
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64()] * 4 + [pa.list_(pa.string()), types]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *arrays], names=["doc_id", "row", "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"]
            )

    ids = documents.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    return ids.mapInArrow(run, f"doc_id {ids.dtypes[0][1]}, {_SCANNED}")


def similarity_join(blocks: DataFrame, templates: list[tuple[str, int, set[int]]], containment: float = CONTAINMENT) -> DataFrame:
    """``row``, ``label`` and ``containment`` of each block and template that meet the threshold.

    ``blocks``: ``row``, ``size`` and ``terms`` (distinct word numbers); ``templates``: label, block
    size and word numbers.
    """
    spark = blocks.sparkSession
    counted = {r["term"]: r["count"] for r in blocks.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    terms = sorted(set().union(*(t for *_, t in templates)), key=lambda t: (counted.get(t, 0), t))
    rank = {t: i for i, t in enumerate(terms)}
    index = []
    for label, size, own in templates:
        ranks, least = sorted(rank[t] for t in own), need(len(own), containment)
        index += [(size, r, i, label, least, ranks) for i, r in enumerate(ranks[: len(ranks) - least + 1])]
    prefixes = F.broadcast(spark.createDataFrame(index, "size int, rank int, place int, label string, least int, ranks array<int>").coalesce(1))
    by_number = F.split(F.lit(",".join(str(rank[t]) for t in sorted(terms))), ",").cast("array<int>")
    ordered = blocks.select("row", "size", F.sort_array(F.transform("terms", lambda t: F.get(by_number, t))).alias("own"))
    entries = ordered.select("row", "size", "own", F.posexplode("own").alias("at", "rank"))
    held, whole = F.size("own"), F.size("ranks")
    possible = F.least("at", "place") + 1 + F.least(held - 1 - F.col("at"), whole - 1 - F.col("place"))
    candidates = entries.join(prefixes, ["size", "rank"]).where((held >= F.col("least")) & (F.col("at") <= held - F.col("least")) & (possible >= F.col("least")))
    checked = candidates.withColumn("common", F.size(F.array_intersect("own", "ranks"))).where("common >= least")
    return checked.select("row", "label", (F.col("common") / whole).alias("containment"))


def licensed(documents: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document: word count, phrase places, phrase labels, all labels, score.

    The score is 1 with a phrase, else the best containment of a template that meets the
    threshold, else 0. Repeated rows and null ids are scanned each; a null text is empty;
    other columns are ignored.
    """
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"at most {MAX_TEMPLATES} templates")
    vocabulary = sorted({w for _, text in templates for w in words(text)})
    number = {w: i for i, w in enumerate(vocabulary)}
    sets = [(label, size_of(text), {number[w] for w in words(text)}) for label, text in templates]
    sizes = {}
    for size in sorted({size for _, size, _ in sets}):
        own = [terms for _, s, terms in sets if s == size]
        sizes[size] = ({vocabulary[t]: t for t in set().union(*own)}, min(need(len(terms), containment) for terms in own))
    scanned = store(scan(documents, sizes), "scanned")
    blocks = scanned.select("row", F.inline("blocks"))
    found = similarity_join(blocks, sets, containment)
    by_row = store(found.groupBy("row").agg(F.max("containment").alias("best"), F.collect_set("label").alias("more")), "found")
    every = F.array_sort(F.array_union("base_labels", F.coalesce("more", F.array().cast("array<string>"))))
    return scanned.join(by_row, "row", "left").select(
        *("doc_id n_words n_base first_word last_word".split()),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def oracle(templates: Sequence[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> str:
    """``licensed`` over ``documents`` in SQL: every block against every template of its size."""
    split = "regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    rows = []
    for no, (label, text) in enumerate(templates):
        own = sorted({w.decode() for w in words(text)})
        rows += [f"({no}, '{label}', {size_of(text)}, {len(own)}, {need(len(own), containment)}, '{w}')" for w in own]
    places = []
    for phrase, label in PHRASES:
        same = " AND ".join(f"w[k + {i + 1}] = '{word}'" for i, word in enumerate(phrase.split()))
        places.append(f"[{{'at': k, 'label': '{label}'}} FOR k IN range(len(w)) IF {same}]")
    return f"""
WITH docs AS (SELECT row_number() OVER () AS no, doc_id, {split.format("coalesce(text, '')")} AS w FROM documents),
places AS (SELECT no, doc_id, len(w) AS n_words, flatten([{", ".join(places)}]) AS p FROM docs),
templates (template, label, width, size, need, word) AS (VALUES {", ".join(rows)}),
starts AS (SELECT no, w, width, unnest(range(0, len(w), width)) AS block FROM docs CROSS JOIN (SELECT DISTINCT width FROM templates)),
blocks AS (SELECT no, width, block, unnest(list_distinct(w[block + 1:block + 2 * width])) AS word FROM starts),
common AS (SELECT no, block, template, label, size, count(*) AS n FROM blocks JOIN templates USING (width, word) GROUP BY ALL HAVING count(*) >= any_value(need)),
found AS (SELECT no, max(n / size) AS best, list(DISTINCT label) AS more FROM common GROUP BY no)
SELECT doc_id, n_words, len(p) AS n_base, list_min([x.at FOR x IN p]) AS first_word, list_max([x.at FOR x IN p]) AS last_word,
       array_to_string(list_sort(list_distinct([x.label FOR x IN p])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat([x.label FOR x IN p], coalesce(more, [])))), ',') AS labels,
       CASE WHEN len(p) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM places LEFT JOIN found USING (no)
"""


# Workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
