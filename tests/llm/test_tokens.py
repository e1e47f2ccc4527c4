"""Counts against the tokenizer library, text by text."""

import random

import pytest

pytest.importorskip("public_tokenizers")

from lexweave.llm import tokens  # noqa: E402
from lexweave.llm.queries import tokenizer_path  # noqa: E402

ODD = [chr(c) for c in [*range(0x250), *range(0x250, 0x3100, 3), *range(0x1F300, 0x1F700, 5)]]


def library(texts):
    return [len(e.ids) for e in tokens._tokenizer(tokenizer_path()).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_whole_tokens_are_proven():
    whole = tokens.prove_whole_tokens(tokenizer_path())
    assert len(whole) > 40_000 and " the" in whole and "<|endoftext|>" not in whole
    assert set(library(whole[::200])) == {1}


def test_random_texts():
    rng = random.Random(1)
    count = tokens.counter(tokenizer_path(), frozenset(tokens.prove_whole_tokens(tokenizer_path())))
    texts = ["".join(rng.choice(ODD) + rng.choice(["", " ", "'s", "<|endoftext|>", "\n\n", "  "]) for _ in range(60)) for _ in range(2000)]
    texts += ["", " ", "\n", "don't  stop", "a" * 5000, " " * 3000, "<|endoftext|>" * 3, "日本語のテキスト", "x y", "1²¾", "ªº"]
    assert count(texts) == library(texts)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 5)
    tokens.counter.cache_clear()
    count = tokens.counter(tokenizer_path(), frozenset({" the"}))
    texts = [f"zq{i} the wxyz{i}" for i in range(50)]
    assert count(texts) == library(texts)
    tokens.counter.cache_clear()


def test_column(spark):
    rows = [(1, "hello world", 9), (1, "hello world", 9), (2, None, 9), (None, "", 9), (3, "the " * 2000, 9), (4, "é<|endoftext|>", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted((tuple(r) for r in tokens.count_tokens(docs, tokenizer_path()).collect()), key=str)
    n = library([t for _, t, _ in rows])
    assert got == sorted(((i, len((t or "").encode()), k, k > 1024) for (i, t, _), k in zip(rows, n, strict=True)), key=str)
    assert tokens.count_tokens(docs.limit(0), tokenizer_path()).count() == 0


def test_driver_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(docs, tokenizer_path()).collect()}
    assert got == dict(zip(rows, library(rows.values()), strict=True))
