"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and items are compared in lower case with every run of other characters than
letters and digits as one space. An item is cut into segments of ``SEGMENT`` characters
that overlap by half (a shorter item is one segment); a document holds a segment if some
region of it aligns with the segment at ``BUDGET`` or less edits a character. Items of under ``LEAST``
characters are too short for edits: they must stand as they are, from word edge to word edge, and
those of under ``Q`` characters must be all of the document.

1. Filter: within k edits of a segment of m characters, a region shares at least
   m + 1 - q - k * q of the segment's q-grams with it, and they lie on diagonals (place in
   the text less place in the segment) that differ by at most k. Shared q-grams are
   counted in diagonal bands of width 2k that overlap by half, so that one band holds
   all of them; bands that reach the bound are kept, all others cannot match.
2. Verify: banded alignment gives the least number of edits of the whole segment against
   any region in the band. Candidates are aligned together, one array operation a cell.

Documents are never moved: the benchmark goes to them, in blocks of at most ``BLOCK``
characters, so that what is broadcast has a bound however long the benchmark is.

Segments that several items share are searched once. Postings are spread out in pieces of ``SPREAD``, so
that a q-gram of many segments takes time but no more memory.

Edge cases: a null or empty text or item holds and matches nothing. Rows that repeat an
id are searched each; an item that repeats with one id and text counts once; items without an id
count as one item, with a null id. A long text is searched whole, as one run. Empty tables
give no rows. Other columns are not read, and ``without_leaks`` returns them as they are, whatever their names.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import batch_of, lean, text_chunks

Q, SEGMENT, BUDGET, LEAST, BLOCK, SPREAD = 8, 80, 0.1, 40, 8_000_000, 4_000_000
#: Stands for items without an id.
NO_ID = -(2**63)
_OTHER = re.compile(r"[\W_]+")
_CHUNK = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_EDGES = (0, 32)  # the end of a compared text, and the space


_LATIN_1 = bytes(32 if _OTHER.match(chr(c)) else c for c in range(256))


def compared(text: str | None) -> str:
    low = (text or "").lower()
    try:
        return b" ".join(low.encode("latin-1").translate(_LATIN_1).split()).decode("latin-1")
    except UnicodeEncodeError:
        return _OTHER.sub(" ", low).strip()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash for the q-gram that starts at each place, of two hashes of half the length each time."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    out, done = codes.astype(np.uint64), 1
    while done < Q:
        more = min(done, Q - done)
        n = len(codes) - done - more + 1
        out = (out[:n] * _MIX) ^ out[more : more + n]  # places overlap where Q is no power of two
        out ^= out >> np.uint64(31)
        done += more
    return out * _MIX >> np.uint64(8)


@dataclass(frozen=True)
class Index:
    """The segments of a block of the benchmark and where their q-grams stand."""

    items: list[np.ndarray]  # of each segment
    parts: dict[int, int]  # of each item, its segments
    whole: dict[str, list[int]]  # items of under Q characters
    budget: np.ndarray  # edits that each segment may take
    codes: np.ndarray  # characters of all segments, one after another
    start: np.ndarray  # of each segment in codes, and the end
    grams: np.ndarray  # distinct hashes, sorted
    first: np.ndarray  # of each hash in the postings, and the end
    segment: np.ndarray  # postings
    place: np.ndarray
    low: np.ndarray  # whether some hash has these low bits

    @staticmethod
    def build(items: list[tuple[int, str]]) -> Index:
        owners: dict[tuple[str, bool], set[int]] = {}
        whole: dict[str, list[int]] = {}
        count: dict[int, int] = {}
        for item, text in sorted({(i, c) for i, t in items if (c := compared(t))}):
            n = len(text)
            if n < Q:
                whole.setdefault(text, []).append(item)
                count[item] = count.get(item, 0) + 1
                continue
            starts = [0] if n <= SEGMENT else [*range(0, n - SEGMENT, SEGMENT // 2), n - SEGMENT]
            for part in {(text[s : s + SEGMENT], n >= LEAST) for s in starts}:
                known = owners.setdefault(part, set())
                if item not in known:
                    known.add(item)
                    count[item] = count.get(item, 0) + 1
        order_of = sorted(owners)
        parts = [_codes(text) for text, _ in order_of]
        budget = np.array([max(1, int(len(text) * BUDGET)) if edits else 0 for text, edits in order_of], np.int64)
        hashes = [_gram_hashes(p) for p in parts]
        all_hashes = np.concatenate([np.zeros(0, np.uint64), *hashes])
        segment = np.repeat(np.arange(len(parts)), [len(h) for h in hashes]) if parts else np.zeros(0, int)
        place = np.concatenate([np.zeros(0, int), *(np.arange(len(h)) for h in hashes)])
        order = np.argsort(all_hashes, kind="stable")
        grams, first = np.unique(all_hashes[order], return_index=True)
        bits = max(16, int(np.ceil(np.log2(max(len(grams), 1) * 64))))
        low = np.zeros(1 << bits, bool)
        low[(grams & np.uint64((1 << bits) - 1)).astype(np.int64)] = True
        start = np.cumsum([0, *(len(p) for p in parts)])
        return Index([np.array(sorted(owners[p]), np.int64) for p in order_of], count, whole, budget, np.concatenate([np.zeros(0, np.uint64), *parts]), start, grams, np.append(first, len(all_hashes)), segment[order], place[order], low)

    def lengths(self) -> np.ndarray:
        return np.diff(self.start)


def _align(pattern: np.ndarray, lengths: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edits of each pattern row against a region of its text row that starts among the first width places.

    The j-th cell of a row stands on the j-th diagonal of the band. Gives the edits and
    where the region starts and ends.
    """
    n, most = pattern.shape
    cost, begin = np.zeros((n, width), np.int32), np.tile(np.arange(width, dtype=np.int32), (n, 1))
    final_cost, final_begin, final_end = np.full(n, 1 << 20, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
    for i in range(most):
        change = cost + (text[:, i : i + width] != pattern[:, i : i + 1])
        skip = np.concatenate([cost[:, 1:] + 1, np.full((n, 1), 1 << 20, np.int32)], axis=1)
        from_skip = skip < change
        begin = np.where(from_skip, np.concatenate([begin[:, 1:], begin[:, -1:]], axis=1), begin)
        cost = np.where(from_skip, skip, change)
        for j in range(1, width):
            more = cost[:, j - 1] + 1 < cost[:, j]
            if more.any():
                cost[:, j] = np.where(more, cost[:, j - 1] + 1, cost[:, j])
                begin[:, j] = np.where(more, begin[:, j - 1], begin[:, j])
        last = np.flatnonzero(lengths == i + 1)
        if len(last):
            best = cost[last].argmin(1)
            final_cost[last], final_begin[last], final_end[last] = cost[last, best], begin[last, best], best + i + 1
    return final_cost, final_begin, final_end


def search(texts: list[str], index: Index) -> list[tuple[int, int, int, int, int]]:
    """(text, segment, start, end, edits) of all segments that the compared texts hold; places are of compared text."""
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1)
    codes = _codes("\x00".join(texts) + "\x00") if texts else np.zeros(0, np.uint64)
    hashes = _gram_hashes(codes)
    if not len(hashes) or not len(index.grams):
        return []
    at = np.flatnonzero(index.low[(hashes & np.uint64(len(index.low) - 1)).astype(np.int64)])
    found = np.searchsorted(index.grams, hashes[at])
    found[found == len(index.grams)] = 0
    same = index.grams[found] == hashes[at]
    at, found = at[same], found[same]
    if not len(at):
        return []
    lengths = index.lengths()
    budget = np.maximum(index.budget, 1)  # bands have a width
    bound = lengths + 1 - Q - index.budget * Q
    span = int(len(codes) + 4 * SEGMENT)
    per = index.first[found + 1] - index.first[found]
    pieces = np.append(np.flatnonzero(np.diff((np.cumsum(per) - per) // SPREAD, prepend=-1)), len(per))
    keys, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for s, e in itertools.pairwise(pieces.tolist()):
        n = per[s:e]
        posting = np.repeat(index.first[found[s:e]] - np.cumsum(n) + n, n) + np.arange(n.sum())
        segment = index.segment[posting]
        diagonal = np.repeat(at[s:e], n) - index.place[posting]
        k = budget[segment]
        band = np.concatenate([diagonal // k, diagonal // k - 1])  # a band holds two steps of k diagonals
        both = np.concatenate([segment, segment])
        new, more = np.unique(both.astype(np.int64) * span + (band + SEGMENT + 1), return_counts=True)
        if len(keys):
            old, keys = keys, np.union1d(keys, new)
            sums = np.zeros(len(keys), np.int64)
            sums[np.searchsorted(keys, old)] += count
            sums[np.searchsorted(keys, new)] += more
            count = sums
        else:
            keys, count = new, more
    seg, band = keys // span, keys % span - SEGMENT - 1
    keep = count >= np.maximum(bound[seg], 1)
    seg, band = seg[keep], band[keep]
    if not len(seg):
        return []
    out = []
    for s in range(0, len(seg), 4096):
        out += _verify(codes, ends, sizes, index, seg[s : s + 4096], band[s : s + 4096], budget, lengths)
    return out


def _verify(codes: np.ndarray, ends: np.ndarray, sizes: np.ndarray, index: Index, seg: np.ndarray, band: np.ndarray, budget: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    k = budget[seg]
    width = int(4 * k.max() + 1)
    base = band * k - k  # a region may start up to k before the band's first diagonal
    longest = int(lengths[seg].max())
    window = base[:, None] + np.arange(longest + width)[None, :]
    inside = (window >= 0) & (window < len(codes))
    text = np.where(inside, codes[np.clip(window, 0, len(codes) - 1)], 0)
    places = index.start[seg][:, None] + np.arange(longest)[None, :]
    pattern = np.where(np.arange(longest)[None, :] < lengths[seg][:, None], index.codes[np.minimum(places, len(index.codes) - 1)], 1)
    cost, begin, end = _align(pattern, lengths[seg], text, width)
    out = {}
    for i in np.flatnonzero(cost <= index.budget[seg]):
        start, stop = int(base[i] + begin[i]), int(base[i] + end[i])
        if not index.budget[seg[i]] and not ((start <= 0 or codes[start - 1] in _EDGES) and codes[stop] in _EDGES):
            continue  # a short item stands between word edges
        t = int(np.searchsorted(ends, max(start, 0) + (stop - max(start, 0)) // 2, side="right"))
        head = int(ends[t] - sizes[t] - 1)
        hit = (t, int(seg[i]), max(start - head, 0), min(stop - head, int(sizes[t])), int(cost[i]))
        if hit[:2] not in out or hit[4] < out[hit[:2]][4]:
            out[hit[:2]] = hit
    return list(out.values())


def _place_map(text: str) -> np.ndarray:
    """The place in the text of every place of its compared form, and the end of the last."""
    low = text.lower()
    if len(low) != len(text):  # a few letters grow in lower case: find each one's source
        source = np.repeat(np.arange(len(text)), [len(c.lower()) for c in text])
    else:
        source = np.arange(len(text))
    out: list[int] = []
    last = 0
    for m in re.finditer(r"[^\W_]+", low):
        if out:
            out.append(int(source[last]))  # the space stands where the word ended
        out += source[m.start() : m.end()].tolist()
        last = min(m.end(), len(low) - 1)
    return np.array([*out, out[-1] + 1 if out else 0])


@dataclass(frozen=True)
class Leak:
    item_id: int
    start: int
    end: int
    n_segments: int
    of_segments: int
    edits: int


def leaks(texts: list[str | None], index: Index) -> dict[int, list[Leak]]:
    """Per text that holds benchmark segments, one entry an item; places are code points of the text."""
    found: dict[int, dict[int, list[tuple[int, int, int, int]]]] = {}
    for first, run in text_chunks(texts, _CHUNK):
        forms = [compared(x) for x in run]
        for t, seg, start, end, edits in search(forms, index):
            for item in index.items[seg].tolist():
                found.setdefault(first + t, {}).setdefault(item, []).append((seg, start, end, edits))
        for t, form in enumerate(forms):
            for item in index.whole.get(form, ()):
                found.setdefault(first + t, {}).setdefault(item, []).append((-1, 0, len(form), 0))
    out: dict[int, list[Leak]] = {}
    for t, items in found.items():
        places = _place_map(texts[t] or "")
        for item, hits in sorted(items.items()):
            start, end = (int(places[min(p, len(places) - 1)]) for p in (min(h[1] for h in hits), max(h[2] for h in hits) - 1))
            out.setdefault(t, []).append(Leak(item, start, end + 1, len({h[0] for h in hits}), index.parts[item], min(h[3] for h in hits)))
    return out


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """The benchmark's indexes, each of about BLOCK characters."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("item_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // BLOCK))
    for i in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield Index.build([(r["item_id"], r["text"]) for r in part.collect()])


_OUT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("n_segments", pa.int64()), ("of_segments", pa.int64()), ("edits", pa.int64())])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for every document and item of which it holds a segment: where, how many segments, the least edits."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for index in blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(ids[t], None if x.item_id == NO_ID else x.item_id, x.start, x.end, x.n_segments, x.of_segments, x.edits) for t, xs in sorted(leaks(batch.column(1).to_pylist(), held.value).items()) for x in xs]
                if rows:
                    yield batch_of(_OUT, *zip(*rows, strict=True))

        part = slim.mapInArrow(lean(run), "doc_id long, item_id long, start long, end long, n_segments long, of_segments long, edits long")
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that hold no segment of any item, with all their columns; no shuffle."""
    at_text = docs.columns.index(text_col)
    for index in blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bad = leaks(batch.column(at_text).to_pylist(), held.value)
                yield batch.filter(pa.array([t not in bad for t in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(lean(run), docs.schema)
    return docs
