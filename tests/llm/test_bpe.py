"""Ids and decoded texts against the tokenizers library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from ledgerspark.llm import bpe
from ledgerspark.llm.queries import vocabulary_file


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(vocabulary_file())
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def codec():
    with open(vocabulary_file(), encoding="utf-8") as f:
        return bpe.Codec(f.read())


def odd_texts():
    rng = random.Random(7)
    yield from ["", " \n", "<|startoftext|>Hello<|endoftext|> <|end", "ΑΣ ΟΔΟΣ Σ", "é İstanbul ² Ⅷ 一二 x\x1cy\x85z w​", "aaaa aaaaaaa 'S don't I'LL!!''s", "😀👨‍👩‍👧 ñ"]
    for _ in range(3000):
        yield "".join(rng.choice("aabeinrst'! <|>1é") for _ in range(rng.randrange(60)))
    for _ in range(1000):
        yield "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x500), rng.randrange(0x3000, 0x9000), rng.randrange(0x1F300, 0x1F700)])) for _ in range(20))


def test_ids_and_texts_equal_the_library(library, codec):
    for text in odd_texts():
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids, text
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_token_is_found_and_encodes_to_itself(codec):
    assert len(codec.automaton) == len(codec.symbols)


def test_query_rows(spark, sf_dir, library):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs += [(None, None), (1, None), (1, ""), (1, ""), (-5, "x" * 300_000)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n_tokens int")
    assert sorted(map(tuple, bpe.encoded(df, vocabulary_file()).collect()), key=str) == sorted(want, key=str)
    assert bpe.encoded(df.limit(0), vocabulary_file()).count() == 0
