"""SimHash near-duplicates by pivot distance tables.

A fingerprint has a bit for each of 64 places: 1 if it is set in over half of the
XXH64 values (seed 42) of the text's three-word shingles. Documents link at
``RADIUS`` or fewer differing bits, and a component holds all that links reach.

1. Equal fingerprints become one row with the least id; copies never meet in pairs.
2. Every fingerprint gets a row in the pivot table: its Hamming distances to
   ``PIVOTS`` reference fingerprints. By the triangle inequality two fingerprints
   within the radius differ by at most the radius in every coordinate.
3. Fingerprints within the radius agree on one of a few sets of whole blocks of bits
   (with r differing bits and r + c blocks, some c blocks are untouched). Rows meet in
   the tables of these sets, so the work follows the size of a table's cells. More
   fingerprints take longer keys; no cell is dropped or capped.
4. In a cell, pairs whose pivot distances differ by over the radius are discarded and
   the rest is verified by XOR. Only links that join two parts of a cell are kept, so
   that a cell of n rows gives under n links, and rows already known to lie in one
   part are not compared again. A cell of over ``CELL`` rows is parted into blocks,
   and every pair of blocks is a task of its own.
5. Components come from the links by alternating star contractions.

Edge cases: a null or empty text, or one without words, has fingerprint zero and links
as any other; under three words the whole sequence is the one shingle. Every row is a
node, rows that repeat an id too. Rows without an id get the component of their
fingerprint and never name one; if a component has no id at all, it is null. Very long texts are
hashed whole, in pieces. An empty table gives no rows. Other columns are not read, and ``one_of_each``
returns them as they are, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import batch_of, cut, lean

RADIUS, PIVOTS, CELL, SHINGLE, SEED = 3, 16, 1024, 3, 42


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash as an unsigned number."""
    words = (text or "").encode().lower().split()  # bytes: A-Z alone is lowered, ASCII white space alone splits
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False)) if len(words) >= SHINGLE else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64, max(1, len(words) - SHINGLE + 1))
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view(np.uint64)[0])


_PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("h", pa.int64())])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, the fingerprint's bits as a signed long, and h, a hash of the text, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64)), batch.column(2)], schema=_PRINTS)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), _text_hash(text_col).alias("h")).mapInArrow(lean(run), "doc_id long, fp long, h long")


def _text_hash(text_col: str) -> Column:
    """Tells a null text from an empty one."""
    return F.xxhash64(F.col(text_col).isNull(), F.col(text_col).cast("string"))


def pivot_table(prints: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Hamming distances of uint64 fingerprints to the reference fingerprints, a row each."""
    refs = np.random.default_rng(64).integers(0, 2**64, pivots, dtype=np.uint64)
    return np.bitwise_count(prints[:, None] ^ refs[None, :]).astype(np.int8)


def block_masks(n: int, radius: int = RADIUS) -> list[int]:
    """Masks of block sets of which any two fingerprints within the radius agree on one.

    More blocks give longer keys: 16, 25 or 31 bits at radius 3, as many as n rows need.
    """
    kept = next((c for c in (1, 2, 3) if n <= 4 * 2 ** (64 * c // (radius + c))), 3)
    edges = [64 * i // (radius + kept) for i in range(radius + kept + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in itertools.pairwise(edges)]
    return [sum(c) for c in itertools.combinations(blocks, kept)]


class Parts:
    """Disjoint sets over 0 .. n - 1; the least member stands for its set."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if np.array_equal(up, self.up):
                return up
            self.up = up

    def join(self, a: int, b: int) -> bool:
        while self.up[a] != a:
            a = self.up[a]
        while self.up[b] != b:
            b = self.up[b]
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def cell_links(prints: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links (indexes) that join the parts of a cell, from rows in left against rows in right."""
    table, parts, links = pivot_table(prints), Parts(len(prints)), []
    for i in left:
        root = parts.roots()
        others = right[root[right] != root[i]]
        if not len(others):
            continue
        near = others[(np.abs(table[others] - table[i]) <= radius).all(1)]  # the pivots discard
        near = near[np.bitwise_count(prints[near] ^ prints[i]) <= radius]  # the fingerprints decide
        links += [(int(i), int(j)) for j in near if parts.join(int(i), int(j))]
    return links


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_SMALL = 8


def _small_cells(rows: np.ndarray, sizes: np.ndarray) -> tuple[list[int], list[int]]:
    """All verified links of cells of up to _SMALL rows that stand whole in rows."""
    able, prints = (sizes > 1) & (sizes <= _SMALL) & (rows[:, 2] == rows[:, 3]), np.ascontiguousarray(rows[:, 5]).view(np.uint64)
    table, a, b = pivot_table(prints) if able.any() else None, [], []
    for d in range(1, _SMALL):
        i = np.flatnonzero(able[:-d])
        i = i[(rows[i, :4] == rows[i + d, :4]).all(1)] if len(i) else i
        if not len(i):
            break
        i = i[(np.abs(table[i] - table[i + d]) <= RADIUS).all(1)]
        i = i[np.bitwise_count(prints[i] ^ prints[i + d]) <= RADIUS]
        a += prints[i].view(np.int64).tolist()
        b += prints[i + d].view(np.int64).tolist()
    return a, b


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the cells of a partition; rows (table, key, one, two, block, fp) come ordered by the first four."""
    held: list[np.ndarray] = []
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            if not batch.num_rows:
                continue
            held.append(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
            if (held[0][0, :4] == held[-1][-1, :4]).all():
                continue  # one cell still, of at most two blocks
        if not held:
            continue
        rows = np.concatenate(held)
        starts = np.append(0, np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1)) + 1)
        done = len(rows) if batch is None else int(starts[-1])
        ends = np.append(starts[1:], len(rows))
        a, b = _small_cells(rows[:done], np.repeat(ends - starts, ends - starts)[:done])
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            if s < done and (e - s > _SMALL or e - s > 1 and rows[s, 2] != rows[s, 3]):
                prints = np.ascontiguousarray(rows[s:e, 5]).view(np.uint64)
                one, two = (np.flatnonzero(rows[s:e, 4] == rows[s, k]) for k in (2, 3))
                for i, j in cell_links(prints, one, two):
                    a.append(int(rows[s + i, 5]))
                    b.append(int(rows[s + j, 5]))
        if a:
            yield batch_of(_LINKS, a, b)
        held = [rows[done:]] if done < len(rows) else []


def links(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b) of the distinct fingerprints in column fp that join all parts which true links join."""
    masks = block_masks(distinct.count())
    signed = [m - 2**64 if m >= 2**63 else m for m in masks]
    keys = F.array(*(F.struct(F.lit(i).cast("long").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)))
    rows = distinct.select("fp", F.inline(keys))
    full = rows.groupBy("t", "key").count().where(F.col("count") > CELL).select("t", "key", F.ceil(F.col("count") / CELL).alias("n"))
    parted = rows.join(full, ["t", "key"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    parted = parted.withColumn("block", F.pmod(F.xxhash64("fp", "t"), F.col("n"))).select("t", "key", "block", "fp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("other"))
    parted = parted.select("t", "key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "fp")
    return parted.repartition("t", "key", "one", "two").sortWithinPartitions("t", "key", "one", "two").mapInArrow(lean(_cells, 10_000), "a long, b long")


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) of every node of the pairs; root is the least node of its component.

    Alternating star contractions: each round hangs neighbours under the least one seen.
    Minima are taken by aggregation and joined back, so that a hub is spread by the
    joins; every round is written out, so that a lost executor costs one round.
    """
    edges = cut(pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u")
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = cut(small.distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, h, root (the component's least fingerprint) and component_id (its least id) of every row."""
    prints = cut(fingerprints(docs, id_col, text_col))
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(classes.select("fp")))
    linked = classes.join(roots, F.col("fp") == F.col("node")).select("fp", "least", "root")
    named = linked.groupBy("root").agg(F.min("least").alias("component"))
    linked = linked.join(named, "root").select(F.col("fp").alias("linked_fp"), "component", "root")
    label = classes.join(linked, F.col("fp") == F.col("linked_fp"), "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component", "least").alias("component_id"))
    label = cut(label)  # so that both sides of the last join are plain exchanges, of which skewed parts are split
    return prints.join(label, "fp").select("doc_id", "fp", "h", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp and component_id (the least id of its component) of every row."""
    return labelled(docs, id_col, text_col).select("doc_id", "fp", "component_id")


def hex_print(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every component, with all its columns: the one with the least id, and of these the least hash of its text.

    Rows without an id come after all others. Rows that repeat an id with texts of different components stay
    each for its own; of rows alike in id and text one stays. Texts are only moved where such rows are kept.
    """
    found = cut(labelled(docs, id_col, text_col))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "h")).alias("r")).select(F.col("r.doc_id").alias("__id"), F.col("r.h").alias("__h"))
    first = cut(first)
    kept = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (_text_hash(text_col) == F.col("__h"))
    own = found.groupBy(F.col("doc_id").alias("i"), F.col("h").alias("t")).agg(F.count("*").alias("n")).where("n > 1")
    many = cut(first.join(own, F.col("__id").eqNullSafe(F.col("i")) & (F.col("__h") == F.col("t"))).select("__id", "__h"))
    if not many.limit(1).count():
        return docs.join(first.hint("shuffle_hash"), kept, "left_semi")
    single = first.join(many.select(F.col("__id").alias("i"), F.col("__h").alias("t")), F.col("__id").eqNullSafe(F.col("i")) & (F.col("__h") == F.col("t")), "left_anti")
    alike = docs.join(many, kept, "left_semi")
    # rows may differ in other columns: the least of these stays
    rows = alike.select(F.struct(*(F.col(c) for c in docs.columns)).alias("row"), F.col(id_col).cast("long").alias("i"), _text_hash(text_col).alias("t"))
    one = rows.groupBy("i", "t").agg(F.min("row").alias("row")).select(*(F.col("row")[c].alias(c) for c in docs.columns))
    return docs.join(single.hint("shuffle_hash"), kept, "left_semi").unionByName(one)
