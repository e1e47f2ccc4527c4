"""Leaks against exact search, edited copies, and the alignment against plain dynamic programming."""

import random

import numpy as np
import pytest

from lexweave.llm import decontaminate as d


def plain_distance(pattern, text):
    """Least edits of the pattern against any region of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_alignment():
    rng = random.Random(7)
    for _ in range(60):
        pattern = "".join(rng.choice("abcd") for _ in range(30))
        edited = list(pattern)
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(edited))
            edited[i : i + 1] = rng.choice([[], ["x"], [edited[i], "y"]])
        text = "zzzz" + "".join(edited) + "zzzzzzzzzz"
        width = 13
        codes = d._codes(text.ljust(30 + width, "~"))[: 30 + width]
        cost, begin, end = d._align(d._codes(pattern)[None, :], np.array([30]), codes[None, :], width)
        assert cost[0] == plain_distance(pattern, text)
        region = text[begin[0] : end[0]]
        assert plain_distance(region, pattern) <= cost[0] + abs(len(region) - 30) or cost[0] == 0 and region == pattern


def items(n=20, seed=2):
    rng = random.Random(seed)
    return [(i, " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(12, 50)))) for i in range(n)]


def noise(rng, n):
    return " ".join("".join(rng.choice("qrstuvwxyz") for _ in range(6)) for _ in range(n))


def test_every_verbatim_item_is_found_and_placed():
    rng, bench = random.Random(1), items()
    index = d.Index.build(bench)
    for i, text in bench:
        doc = f"Éé {noise(rng, 20)}. {text.upper()}! {noise(rng, 300)}"
        leak = {x.item_id: x for x in d.leaks([doc], index)[0]}[i]
        assert doc[leak.start : leak.end] == text.upper() and leak.edits == 0 and leak.n_segments == leak.of_segments
    assert d.leaks([noise(rng, 500), None, ""], index) == {}


@pytest.mark.parametrize("share, least", [(0.02, 20), (0.04, 18)])
def test_edited_items_are_found(share, least):
    rng, bench = random.Random(5), items()
    index, hits = d.Index.build(bench), 0
    for i, text in bench:
        chars = list(text)
        for _ in range(int(len(chars) * share)):
            chars[rng.randrange(len(chars))] = "#"
        hits += any(x.item_id == i for xs in d.leaks([noise(rng, 50) + " " + "".join(chars)], index).values() for x in xs)
    assert hits >= least


def test_filter_keeps_all_that_plain_search_finds():
    rng = random.Random(11)
    bench = [(0, items()[3][1][: d.SEGMENT])]
    index = d.Index.build(bench)
    target, k = d.compared(bench[0][1]), max(1, int(len(d.compared(bench[0][1])) * d.BUDGET))
    for _ in range(40):
        chars = list(target)
        for _ in range(rng.randrange(0, 8)):
            chars[rng.randrange(len(chars))] = rng.choice("abcdxyz")
        doc = noise(rng, 6) + " " + "".join(chars) + " " + noise(rng, 6)
        assert bool(d.leaks([doc], index)) == (plain_distance(target, d.compared(doc)) <= k)


def test_driver_table(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = {(i, b["item_id"]) for b in bench.collect() for i, t in texts.items() if d.compared(b["text"]) in d.compared(t)}
    got = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, bench).collect()}
    assert want and got == want
    clean = d.without_leaks(docs, bench)
    assert {r["doc_id"] for r in clean.collect()} == set(texts) - {i for i, _ in want} and clean.columns == docs.columns


def test_blocks_of_the_benchmark(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK", 500)
    bench = items()
    docs = spark.createDataFrame([(i, f"x {t} y", 0) for i, t in bench] + [(99, "clean words", 0)], "doc_id long, text string, item_id int")
    table = spark.createDataFrame([*bench, bench[0], (None, "n" * 90), (50, None), (51, "short")], "item_id long, text string")
    assert len(list(d.blocks(table))) > 1
    got = [(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, table).collect()]
    assert sorted(got) == [(i, i) for i, _ in bench]
    assert [r["doc_id"] for r in d.without_leaks(docs, table).collect()] == [99]


def test_odd_tables(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (1, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, items()[0][1])], "item_id long, text string")
    for bench in (none, some):
        assert d.contaminated(docs, bench).count() == 0 and d.without_leaks(docs, bench).count() == 3
    assert d.contaminated(docs.limit(0), some).count() == 0


def test_short_items_stand_between_word_edges():
    index = d.Index.build([(1, "Quite short item"), (2, "Tiny?"), (d.NO_ID, "another short one")])
    assert {x.item_id for x in d.leaks(["so a QUITE, short item. yes"], index)[0]} == {1}
    assert d.leaks(["quite short items", "unquite short item", "quite shirt item", "it is tiny here", "tiny"], index) == {4: [d.Leak(2, 0, 4, 1, 1, 0)]}
    assert [x.item_id for x in d.leaks([f"{noise(random.Random(1), 40)} another short one"], index)[0]] == [d.NO_ID]


def test_items_without_id(spark):
    docs = spark.createDataFrame([(1, "say another short one now", 5), (2, "clean words", 6)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(None, "Another short one")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, bench).collect()] == [(1, None)]
    assert [tuple(r) for r in d.without_leaks(docs, bench).collect()] == [(2, "clean words", 6)]


def test_shared_passages_and_hot_grams(monkeypatch):
    """Items with one passage in common are all found, however few postings are spread out at a time."""
    rng = random.Random(6)
    shared = noise(rng, 14)
    bench = [(i, f"{shared} {noise(rng, 20)}") for i in range(60)]
    texts = [f"{noise(rng, 30)} {shared} {noise(rng, 30)}", bench[7][1], noise(rng, 90)]
    want = d.leaks(texts, d.Index.build(bench))
    assert len(want[0]) == 60 and max(want[1], key=lambda x: x.n_segments).item_id == 7 and 2 not in want
    monkeypatch.setattr(d, "SPREAD", 50)
    assert d.leaks(texts, d.Index.build(bench)) == want
