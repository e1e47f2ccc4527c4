"""Fingerprints and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from lexweave.llm import simhash


def brute_print(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(rows):
    prints = [brute_print(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                up[root(i)] = root(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(doc)
    least = {r: min((d for d in ds if d is not None), default=None) for r, ds in ids.items()}
    return sorted(((doc, f"{prints[i]:016x}", least[root(i)]) for i, (doc, _) in enumerate(rows)), key=str)


def run(spark, rows, **kw):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    got = simhash.near_duplicates(docs).select("doc_id", simhash.hex_print().alias("p"), "component_id").collect()
    return sorted(map(tuple, got), key=str)


def texts(n=120, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [rng.choice("alpha Beta gamma delta épsilon zeta eta theta".split()) + str(rng.randrange(50)) for _ in range(rng.randrange(1, 80))]
        out.append((i, " ".join(words)))
        if i % 5 == 0 and len(words) > 40:
            words[3] = "changed"
            out.append((1000 + i, " ".join(words)))
            out.append((2000 + i, "\n".join(words)))
    return out


def test_fingerprints():
    for _, t in [*texts(), (0, None), (0, ""), (0, "A"), (0, "ÀB c"), (0, "a b c d")]:
        assert simhash.fingerprint(t) == brute_print(t)


def test_components(spark):
    rows = texts() + [(5000, None), (5001, ""), (5002, " "), (7, "alpha1 alpha1"), (None, "alpha1 alpha1"), (None, "only here with no id")]
    assert run(spark, rows) == brute_components(rows)


def test_driver_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert run(spark, rows) == brute_components(rows)


def test_empty(spark):
    assert run(spark, []) == []


def linked(prints):
    parts = simhash.Parts(len(prints))
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= 3):
            parts.join(i, i + 1 + int(j))
    return parts.roots()


def test_dense_cells_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(4)
    center = np.uint64(0x0123456789ABCDEF)
    flips = (np.uint64(1) << rng.integers(0, 64, (1500, 4), dtype=np.uint64)) * (rng.random((1500, 4)) < 0.7)
    prints = np.unique(np.concatenate([center ^ np.bitwise_xor.reduce(flips.astype(np.uint64), axis=1), rng.integers(0, 2**64, 300, dtype=np.uint64)]))
    roots = linked(prints)
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    for cell in (1024, 200):
        monkeypatch.setattr(simhash, "CELL", cell)
        links = simhash.links(df)
        assert links.count() < 60 * len(prints)
        got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
        root = [got.get(int(x), int(x)) for x in prints.view(np.int64)]
        assert len(set(zip(root, roots.tolist(), strict=True))) == len(set(root)) == len(set(roots.tolist()))


def test_masks_cover_every_pair():
    rng = random.Random(3)
    for n in (10, 10**7, 10**10):
        masks = simhash.block_masks(n)
        for _ in range(300):
            diff = sum({1 << rng.randrange(64) for _ in range(3)})
            assert any(not diff & m for m in masks)


def test_pivots_bound_distances():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 200, dtype=np.uint64)
    table = simhash.pivot_table(x)
    d = np.bitwise_count(x[:, None] ^ x[None, :])
    assert (np.abs(table[:, None, :].astype(int) - table[None, :, :]).max(2) <= d).all()


A, B, C = "a b c d e f", "other words are here now", "no id at all here"


def stays(rows):
    """One row of each component, by comparing all fingerprints: the least id, then the least hash; no id comes last."""
    import xxhash

    prints = [simhash.fingerprint(t) for _, t, *_ in rows]
    left, seen = [], set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            at = todo.pop()
            near = {j for j in range(len(rows)) if (prints[j] ^ prints[at]).bit_count() <= 3} - group
            group |= near
            todo += near
        seen |= group
        left.append(min(group, key=lambda j: (rows[j][0] is None, rows[j][0] or 0, xxhash.xxh64_intdigest((rows[j][1] or "").encode(), 42))))
    return {(rows[i][0], rows[i][1]) for i in left}


@pytest.mark.parametrize(
    "rows",
    [
        [(3, A), (1, A), (1, A), (9, B), (None, C)],
        [(1, A), (1, B)],
        [(3, B), (5, A), (5, B)],
        [(None, A), (None, A), (4, A), (None, B), (None, B)],
        [(2, None), (1, ""), (3, " ")],
        [(7, A), (7, A), (7, B), (7, B), (7, C)],
    ],
)
def test_one_of_each(spark, rows):
    docs = spark.createDataFrame([(*r, "en", 1, 2) for r in rows], "doc_id long, text string, lang string, h int, root int")
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    have = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert len(have) == len(set(have)) and set(have) == stays(rows)


def test_one_of_each_of_no_rows(spark):
    assert simhash.one_of_each(spark.createDataFrame([], "doc_id long, text string")).collect() == []
