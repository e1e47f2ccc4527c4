"""Bucket boundaries against all choices, and batches against their rules."""

import itertools

import numpy as np
import pytest

from lexweave.llm import packing


def padding(lengths, counts, bounds):
    return sum(int(c) * (min(b for b in bounds if b >= x) - int(x)) for x, c in zip(lengths, counts, strict=True))


def test_boundaries_are_optimal():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = rng.integers(1, 9)
        lengths, counts, k = np.sort(rng.choice(40, n, replace=False)), rng.integers(1, 9, n), int(rng.integers(1, 5))
        got = packing.boundaries(lengths, counts, k)
        best = min(padding(lengths, counts, [*s, lengths[-1]]) for r in range(k) for s in itertools.combinations(lengths[:-1], r))
        assert len(got) <= k and padding(lengths, counts, got) == best


def test_huge_counts_stay_exact():
    lengths, counts = np.array([1, 10**6, 10**6 + 1]), np.array([10**12, 1, 10**12])
    assert packing.boundaries(lengths, counts, 2) == [1, 10**6 + 1]


@pytest.mark.parametrize("text, n", [(None, 0), ("", 0), ("  ", 0), ("a b\tc\n", 3), ("a b", 1), ("\x0b a", 1)])
def test_words(spark, text, n):
    assert spark.createDataFrame([(text,)], "text string").select(packing.n_words()).first()[0] == n


def check(rows, buckets, budget):
    by = {}
    for r in rows:
        assert r["n_tokens"] <= r["bucket_len"]
        by.setdefault((r["bucket"], r["bucket_len"]), {}).setdefault(r["batch"], []).append(r["slot"])
    assert len(by) <= buckets
    for (_, bound), batches in by.items():
        each = max(1, budget // max(bound, 1))
        assert sorted(batches) == list(range(len(batches)))  # dense, and all but the last full
        for b, slots in batches.items():
            assert sorted(slots) == list(range(len(slots)))
            assert len(slots) == each or b == len(batches) - 1 and len(slots) < each


def test_batches(spark):
    rows = [(i % 400, "w " * (i % 37), "x") for i in range(500)] + [(7, None, "x"), (None, "a b", "x"), (None, "a b", "x"), (8, "w " * 5000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket string")
    got = packing.pack(docs, buckets=5, budget=100).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got if r["doc_id"] is not None) == sorted((i, len((t or "").split())) for i, t, _ in rows if i is not None)
    check(got, 5, 100)
    assert [r["batch"] for r in got if r["n_tokens"] == 5000] == [0]


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_bins_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(packing, "BINS", 10)
    docs = spark.createDataFrame([(i, "w " * i) for i in range(200)], "doc_id long, text string")
    got = packing.pack(docs, buckets=4, budget=300).collect()
    assert len(got) == 200
    check(got, 4, 300)


def test_one_giant_length_moves_no_boundary(spark):
    """Lengths stay exact beside one far over BINS: the boundaries are those of the best choice of all."""
    lengths = [1, 3, 4, 9, 11, 17, 40, 1_000_001]
    rows = [(100 * i + c, n) for i, n in enumerate(lengths) for c in range(1 + 5 * (i % 3))]
    docs = spark.createDataFrame([(i, "", n) for i, n in rows], "doc_id long, text string, n long")
    got = packing.pack(docs, buckets=4, length=docs["n"]).collect()
    counts = [sum(n == x for _, n in rows) for x in lengths]
    best = min(padding(lengths, counts, [*s, lengths[-1]]) for s in itertools.combinations(lengths[:-1], 3))
    assert {r["bucket_len"] for r in got} <= set(lengths)
    assert sum(r["bucket_len"] - r["n_tokens"] for r in got) == best


def test_lengths_of_a_tokenizer(spark):
    from lexweave.llm import queries, tokens

    path = queries.tokenizer_path()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(docs, path).collect()}
    rows = packing.pack(docs, tokenizer=path).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want
    check(rows, packing.BUCKETS, packing.BUDGET)
