"""Token counts against the library on whole texts."""

import os
import random

import pytest

from boardlake.llm import tokens

NAME = "byte_bpe_50k.json"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    return tokens.load_tokenizer(NAME)


def whole(library, text):
    return len(library.encode(text, add_special_tokens=False))


def chunked(library, text, chunk, overlap):
    return tokens.count_long(tokens.chunk_encoder(library, text, None), len(text), chunk, overlap)[0]


def made(seed, size):
    rng = random.Random(seed)
    parts = ["word", " the", "\n\n", "   ", "\t", "don't", "12345", "%%%", "é", "日本語", " ", "<|endoftext|>", "<|endof", "'s", "x" * 90, " " * 70, "‍", "😀"]
    return "".join(rng.choice(parts) for _ in range(size))


@pytest.mark.parametrize("seed", range(25))
def test_chunks_count_as_the_whole_text(library, seed):
    text = made(seed, 400)
    for chunk, overlap in ((300, 140), (700, 200), (257, 150)):
        assert chunked(library, text, chunk, overlap) == whole(library, text)


@pytest.mark.parametrize("text", ["a" * 5000, " " * 5000, "\n" * 3000 + "a", "<|endoftext|>" * 300, "ab " * 2000, ""])
def test_texts_without_early_boundaries(library, text):
    assert chunked(library, text, 400, 150) == whole(library, text)


@pytest.mark.parametrize("seed", range(10))
def test_plain_chunks_count_as_the_whole_text(library, seed):
    rng = random.Random(seed)
    parts = ["word", " the", "\n\n", "   ", "\t", "don't", "12345", "%%%", "é", "'s", "x" * 90, " " * 70, "a"]
    text = "".join(rng.choice(parts) for _ in range(600))
    for chunk, overlap in ((300, 140), (700, 200), (257, 150)):
        count, splices = tokens.count_long(tokens.chunk_encoder(library, text, {}), len(text), chunk, overlap)
        assert count == whole(library, text) and splices > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_long_documents_are_spliced(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    got = tokens.count_tokens(docs, NAME).collect()
    assert len(got) == len(text) and all(r.n_tokens == whole(library, text[r.doc_id] or "") for r in got)
    long = [r for r in got if len(text[r.doc_id] or "") > tokens.CHUNK_CHARS]
    assert len(long) > 20 and all(r.n_splices >= (len(text[r.doc_id]) - 1) // (2 * tokens.CHUNK_CHARS) for r in long)
    assert sum(r.n_splices > 0 for r in got) == len(long)


def test_rows(spark, library):
    texts = [None, "", "plain text, twice", "plain text, twice", "a <|endoftext|> b", made(1, 3000), "\x1f x\x85y z", "one " * 1024, "one " * 1025]
    rows = [(i if i else None, t, "clash", True) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, over_limit boolean")
    got = {(r.doc_id or 0): r for r in tokens.count_tokens(docs, NAME, chunk=2000).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        n = whole(library, text or "")
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((text or "").encode()), n > 1024)


def test_empty_table(spark):
    assert tokens.count_tokens(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
