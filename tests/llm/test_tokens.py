"""Byte-level BPE and token counts against the libraries they must agree with."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from llm.conftest import docs_of
from tokenizers import Tokenizer

from tesela.llm import bpe, token_counts

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digest(tik, text):
    ids = np.array(tik.encode_ordinary(text), "<u4")
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_is_that_of_the_library(spark, tik, hard_texts, monkeypatch):
    got = sorted(tuple(r)[1:] for r in bpe.round_trip(docs_of(spark, hard_texts), RANKS, P.PATTERN).collect())
    assert got == sorted(digest(tik, t or "") for _, t in hard_texts)


def test_ids_keep_their_rows_and_decode(spark, tik, hard_texts):
    encoded = bpe.encode(docs_of(spark, hard_texts), RANKS, P.PATTERN).cache()
    want = sorted((i or -1, tik.encode_ordinary(t or "")) for i, t in hard_texts)
    assert sorted((r.doc_id or -1, list(r.ids)) for r in encoded.collect()) == want
    assert sorted((r.doc_id or -1, bytes(r.decoded)) for r in bpe.decode(encoded, RANKS).collect()) == sorted((i or -1, (t or "").encode()) for i, t in hard_texts)


def test_whole_table(spark, tik):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in bpe.round_trip(docs, RANKS, P.PATTERN).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digest(tik, texts[r.doc_id])


def test_merges_of_short_and_long_words(tik):
    merger = bpe.Merger(bpe.read_ranks(RANKS))
    rng = random.Random(5)
    for _ in range(300):
        word = bytes(rng.choice(b"abtheinr e\xc3\xa9  ") for _ in range(rng.choice([1, 5, 30, 49, 400])))
        assert merger._short(word) == merger._long(word) == tik._encode_single_piece(word)


def test_several_blocks_of_one_task(spark, tik, hard_texts):
    """Blocks end by words and by different words; both times at the same texts."""
    docs = docs_of(spark, [(i, f"{t} {i} {'z' * (i % 7)}") for i, (_, t) in enumerate(hard_texts * 3)], 1)
    before = bpe.BLOCK_WORDS
    try:
        bpe.BLOCK_WORDS = 40
        got = sorted(tuple(r)[1:] for r in bpe.round_trip(docs, RANKS, P.PATTERN).collect())
    finally:
        bpe.BLOCK_WORDS = before
    assert got == sorted(digest(tik, r.text) for r in docs.collect())


def test_counts_are_those_of_the_library(spark, library, hard_texts):
    texts = [*hard_texts, (20, "a<|endoftext|> b <|endoftext|><|endoftext|>  c <|endof")]
    got = token_counts.token_counts(docs_of(spark, texts), JSON, P.PATTERN, limit=20).collect()
    want = sorted((i or -1, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 20) for i, t in texts)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


PREFIX_TEXTS = [
    "it's we'll  you'rex 'l  \n\n  a\t b<|endoftext|>  c<|endof 日本語 ñandú 12345!!'s..  ",
    "'",
    "''ll've",
    "aaaaaaaaaaaaaaaa bbbbb   ",
    "\r\n\r\n  don't  stop 😀😀",
]


@pytest.mark.parametrize("text", PREFIX_TEXTS)
def test_every_prefix(library, text):
    counter = token_counts.TextCounter(token_counts.read_merges(JSON), P.PATTERN)
    assert counter.prefixes(text) == [len(library.encode(text[:n], add_special_tokens=False).ids) for n in range(len(text) + 1)]


@pytest.mark.parametrize("text", ["foo <|endoftext|>", "foo  <|endoftext|> b", "a! <|endoftext|><|endoftext|>", "it'<|endoftext|>", "x \n <|endoftext|> <|endoftext|>"])
def test_every_prefix_in_special_strings_behind_blanks(library, text):
    test_every_prefix(library, text)


def test_truncation_by_prefixes(spark, library):
    texts = list(enumerate([*PREFIX_TEXTS, "", None]))
    for r in token_counts.truncate(docs_of(spark, texts), JSON, P.PATTERN, 5).collect():
        whole = dict(texts)[r.doc_id] or ""
        fits = [n for n in range(len(whole) + 1) if len(library.encode(whole[:n], add_special_tokens=False).ids) <= 5]
        assert (r.text, r.n_tokens) == (whole[: fits[-1]], len(library.encode(r.text, add_special_tokens=False).ids))
    table = token_counts.token_counts(docs_of(spark, texts), JSON, P.PATTERN, limit=5, prefixes=True)
    for r in table.collect():
        assert r.prefix_tokens[-1] == r.n_tokens and r.prefix_tokens[r.fits_chars] <= 5


def test_empty_table(spark):
    empty = docs_of(spark, [(1, "a")]).where("false")
    assert bpe.round_trip(empty, RANKS, P.PATTERN).count() == 0
    assert token_counts.token_counts(empty, JSON, P.PATTERN).count() == 0
