"""Links of two tokenizers against the libraries on whole texts, one document at a time."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerspark.llm import token_links
from ledgerspark.llm.queries import vocabulary_file

A, B = vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def spans(sizes):
    at = 0
    for n in sizes:
        yield at, at + n
        at += n


def one(libraries, text):
    """Ids of A and B, groups and links of a text, or None if it has no tokens."""
    if not text:
        return None
    library_a, library_b = libraries
    a, b = library_a.encode(" " + text, add_special_tokens=False).ids, library_b.encode(text)
    signs = {**{chr(i): i for i in range(33, 256) if i not in (173, *range(127, 161))}}
    signs |= {chr(256 + n): i for n, i in enumerate([*range(33), *range(127, 161), 173])}
    raw_a = [bytes(signs[c] for c in library_a.id_to_token(i)) for i in a]
    raw_b = [bytes([int(p[3:5], 16)]) if library_b.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [library_b.id_to_piece(i)]]
    if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
        return None
    left, right = list(spans(map(len, raw_a))), list(spans(map(len, raw_b)))
    # Compares each token of A with the tokens of B from the first that can overlap on.
    links, first = [], 0
    for i, (start, stop) in enumerate(left):
        while right[first][1] <= start:
            first += 1
        j = first
        while j < len(right) and right[j][0] < stop:
            links.append((a[i], b[j]))
            j += 1
    both = sorted({e for _, e in left} & {e for _, e in right})
    groups, before = [], 0
    for end in both:
        groups.append(tuple(",".join(str(t) for t, (_, e) in zip(ids, at) if before < e <= end) for ids, at in ((a, left), (b, right))))
        before = end
    return a, b, groups, links


def brute(libraries, docs):
    found = [(i, one(libraries, text)) for i, text in docs]
    counts = Counter(link for _, x in found if x for link in x[3])
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    for i, x in found:
        if x is None:
            yield i, 0, 0, 0, 0, 0, 0, ""
            continue
        a, b, groups, links = x
        digest = hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest()
        best = sum(counts[link] == highest[link[1]] for link in links)
        yield i, len(a), len(b), len(groups), len(links), best, sum(counts[link] for link in links), digest


def odd_texts():
    rng = random.Random(3)
    yield from (None, "", " ", "  two  spaces ", "a", "<|endoftext|> <s> </s> <unk> <0x41>", "mark ▁ inside▁", "\r\n\t x\n\n y", "no break  em \x85 \x1c z", "don't I'LL 's")
    yield from ("😀👨‍👩‍👧 ñ ñ ﬁ Ⅷ", "中文 字 テスト", "\0 nul \0", "x" * 5000, "ab " * 3000, "a  b   c", " lead", "trail ")
    for _ in range(300):
        yield "".join(rng.choice("ab eé\n\t  ▁<>'1中😀") for _ in range(rng.randrange(40)))


def shown(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_odd_texts(spark, libraries):
    docs = list(enumerate(odd_texts())) + [(None, "again and again"), (None, "again and again"), (7, "again and again")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, key string, n int")
    want = sorted(brute(libraries, docs), key=str)
    assert shown(token_links.document_measures(df, A, B)) == want
    assert token_links.document_measures(df.limit(0), A, B).count() == 0
    assert shown(token_links.document_measures(df.where("text IS NULL OR text = ''"), A, B)) == [r for r in want if r[0] in {i for i, t in docs if not t}]


@pytest.mark.parametrize("most", [token_links.MOST_FREQUENT, 50, 0])
def test_whole_table_with_any_number_of_broadcast_pairs(spark, sf_dir, libraries, most):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert shown(token_links.document_measures(df, A, B, most)) == sorted(brute(libraries, docs), key=str)


def test_small_stores_and_blocks_change_nothing(libraries, monkeypatch):
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        aligner = token_links.Aligner(a.read(), b.read())
    texts = [t for t in odd_texts() if t]
    whole = [(*x[:5], x[5].tolist(), x[6].tolist()) for x in aligner.measured(texts)]
    monkeypatch.setattr(token_links, "CACHED_CHARS", 10)
    single = [(*x[:5], x[5].tolist(), x[6].tolist()) for t in texts for x in aligner.measured([t])]
    assert whole == single


def test_blocks_cover_all_texts(monkeypatch):
    monkeypatch.setattr(token_links, "BLOCK_CHARS", 5)
    assert list(token_links._blocks([])) == []
    assert list(token_links._blocks(["aaaaaaaaa", "b", "cc", "ddddd", ""])) == [(0, 1), (1, 3), (3, 5)]


def test_each_distinct_text_is_one_row(spark):
    df = spark.createDataFrame([(i, "same text") for i in range(500)] + [(1, "other")], "doc_id long, text string")
    assert sorted(r["n"] for r in token_links.aligned(df, A, B).collect()) == [1, 500]
