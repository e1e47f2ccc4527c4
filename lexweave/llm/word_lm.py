"""Cross-entropy difference of word bigrams, over counts that grow with the corpus.

Two interpolated bigram models share one vocabulary, every word of the corpus, and are matched
in order, smoothing and size: the target model counts the rows that the labels call good, the
background model counts all rows, scaled to as many tokens as the target has. No model has
counted the row it scores (the row's own n-grams are taken off first). A row's score is its loss
per token under the target model less that under the background model, in bits; the lower,
the more it is like the target.

    p(w)     = (c(w) + ALPHA) / (N + ALPHA * V)
    p(w | v) = (c(v w) + MU * p(w)) / (c(v) + MU)

Tokens are lower-case runs of letters, marks and digits; every other character that is not
white space, and every character of a script written without spaces, is a token by itself. An edge
stands before and after each text. No word, bigram or row is left out. N and V are of the whole
corpus, and V is exact up to ``SKETCH`` words and from the least ``SKETCH`` hashes beyond.

1. Frequent words and bigrams: a task hands on what has a share of 2 ** -``RARITY`` in a run of
   ``FLUSH`` characters. What has twice that share in the corpus must be among it, and at most
   2 ** RARITY of each kind can have it. A second pass counts these exactly; they are sent to all
   tasks (at most 2 * 2 ** RARITY numbers of 24 bytes), and frequent bigrams are scored where
   they stand.
2. All others meet in buckets, by the hash of their second word, or by both words where that is
   frequent. A bucket holds all rows of its bigrams, so it counts and scores them at once, and no
   table of counts is shuffled again. As sum over v of log c(v) over a text is the same as over w,
   a bucket needs no count but those of w and v w. There is a bucket for each ``BUCKET`` tokens; no
   key has over 2 ** (1 - RARITY) of the corpus.
   Which rows are good is sent to the tasks as well, up to ``SENT`` ids, else joined; the result is the same.
3. The losses go back to the rows as whole numbers of 2 ** -``SCALE`` bits, so that their sum does
   not depend on the order.

What is shuffled is packed: runs of rows with the planes of their bytes compressed.

Edge cases: a null or empty text has one token, the closing edge. A document with several
labels is good if none says otherwise; rows that repeat an id count each, give a row each, and
take off only themselves. Without good rows the target model is uniform over the vocabulary. A
text of over FLUSH characters is a run of its own. An empty table gives no rows. Columns other than
id and text are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import batch_of, fresh_dir, lean

ALPHA, MU = 0.5, 4.0
RARITY, SKETCH, SCALE = 16, 16_384, 14
FLUSH, BUCKET = 4 << 20, 1 << 20
#: Thai to Myanmar and Khmer, kana, Han and its extensions.
_UNSPACED = "฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
_TOKEN = re.compile(rf"(?:(?![{_UNSPACED}_])\w)+|\S")
_MOST_ROWS = 30_000
#: Good ids that are sent to all tasks.
SENT = 8_000_000


def words(text: str | None) -> list[str]:
    """The tokens of a text; what the arrays below must agree with."""
    return _TOKEN.findall((text or "").lower())


def _mix(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    x = v * np.uint64(0x9E3779B97F4A7C15) + w
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Run:
    """Some rows of a task: what came with them, and their bigrams v w, one after another."""

    def __init__(self, first: int, tails: list, sizes: np.ndarray, v: np.ndarray, w: np.ndarray):
        self.first, self.tails, self.sizes, self.v, self.w = first, tails, sizes.astype(np.int64), v, w
        self.row = np.repeat(np.arange(len(sizes), dtype=np.int64), self.sizes)


class _Kinds:
    """What characters are: white space (0), part of a word (1) or a token by themselves (2)."""

    def __init__(self):
        self.table = np.full(0x110000, 3, np.uint8)

    def of(self, codes: np.ndarray) -> np.ndarray:
        kind = self.table[codes]
        if (kind == 3).any():
            for c in np.unique(codes[kind == 3]).tolist():
                m = _TOKEN.match(chr(c) + "x")
                self.table[c] = 0 if m is None else len(m[0]) == 1 and 2 or 1
            kind = self.table[codes]
        return kind


def _token_hashes(texts: list[str], kinds: _Kinds) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all tokens of lower-case texts, none of them 0, and the number of each text's tokens."""
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = kinds.of(codes)
    word = kind == 1
    begins = kind == 2
    begins[:1] |= word[:1]
    begins[1:] |= word[1:] & ~word[:-1]
    start = np.flatnonzero(begins)
    kept = kind > 0
    first = (np.cumsum(kept) - 1)[start] if len(start) else start  # where tokens begin among characters that are kept
    sizes = np.diff(np.append(first, int(kept.sum())))
    ends = np.cumsum([len(t) + 1 for t in texts])
    per = np.diff(np.append(0, np.searchsorted(start, ends)))
    if not len(start):
        return np.zeros(0, np.uint64), per
    power = np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    letters = _mix(codes[kept].astype(np.uint64), np.full(1, 7, np.uint64))
    hashes = _mix(np.add.reduceat(letters * power[place], first), sizes.astype(np.uint64))
    hashes[hashes == 0] = 1
    return hashes, per


def _runs(batches: Iterator[pa.RecordBatch], flush: int) -> Iterator[Run]:
    """Rows (row number, text, ...) in runs of about so many characters, whole rows each."""
    kinds, first, tails, texts, held = _Kinds(), 0, [], [], 0

    def run() -> Run:
        h, per = _token_hashes(texts, kinds)
        sizes = per + 1
        w = np.zeros(len(h) + len(per), np.uint64)  # an edge, 0, stands behind each row's tokens
        at = np.ones(len(w), bool)
        at[np.cumsum(sizes) - 1] = False
        w[at] = h
        return Run(first, tails, sizes, np.concatenate([np.zeros(1, np.uint64), w[:-1]]), w)

    for batch in batches:
        for number, text, *tail in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not texts:
                first = number
            texts.append((text or "").lower())
            tails.append(tail)
            held += len(texts[-1])
            if held >= flush or len(texts) >= _MOST_ROWS:
                yield run()
                tails, texts, held = [], [], 0
    if texts:
        yield run()


def _flags(run: Run, at: int) -> np.ndarray:
    return np.array([bool(t[at]) for t in run.tails], bool)


# ---- the frequent and the totals

_SEEN = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), ("t", pa.int64())])
_SEEN_DDL = "kind int, key long, n long, t long"
_TOTAL, _WORD, _GRAM, _LEAST = range(4)


def _survey(rows: DataFrame, flush: int, rarity: int, sketch: int) -> dict[int, np.ndarray]:
    """By kind: the totals, what is frequent somewhere with its count there, and the least hashes of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, n, t = np.zeros(0, np.uint64), 0, 0
        for r in _runs(batches, flush):
            n += len(r.w)
            t += int(r.sizes[_flags(r, 0)].sum())
            own, often = np.unique(r.w, return_counts=True)
            mixed = np.sort(_mix(own, np.zeros(1, np.uint64)))[:sketch]
            least = np.unique(np.concatenate([least, mixed]))[:sketch]
            grams, many = np.unique(_mix(r.v, r.w), return_counts=True)
            for kind, keys, count in ((_WORD, own, often), (_GRAM, grams, many)):
                some = count * 2**rarity >= len(r.w)
                if some.any():
                    yield batch_of(_SEEN, np.full(int(some.sum()), kind), keys[some].view(np.int64), count[some], np.zeros(int(some.sum()), np.int64))
        yield batch_of(_SEEN, [_TOTAL], [0], [n], [t])
        yield batch_of(_SEEN, np.full(len(least), _LEAST), least.view(np.int64), np.ones(len(least), np.int64), np.zeros(len(least), np.int64))

    path = fresh_dir(rows.sparkSession, "lm-survey")
    rows.mapInArrow(lean(run), _SEEN_DDL).groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).write.parquet(path)
    seen = rows.sparkSession.read.parquet(path)
    total = seen.where(F.col("kind") == _TOTAL).first()
    out = {_TOTAL: np.array([total["n"], total["t"]] if total else [0, 0], np.int64)}
    for kind in (_WORD, _GRAM):  # each stands for a share of all tokens, so there are no more than 2 ** rarity
        often = seen.where((F.col("kind") == kind) & (F.col("n") * 2**rarity >= int(out[_TOTAL][0])))
        out[kind] = np.sort(often.select("key").toArrow()["key"].to_numpy().view(np.uint64))
    unsigned = F.col("key").bitwiseXOR(F.lit(-(2**63)))
    out[_LEAST] = np.sort(seen.where(F.col("kind") == _LEAST).orderBy(unsigned).limit(sketch).select("key").toArrow()["key"].to_numpy().view(np.uint64))
    return out


def vocabulary_size(least: np.ndarray, sketch: int = SKETCH) -> float:
    """The number of words whose least hashes these are: exact below the sketch's size."""
    return float(max(len(least), 1)) if len(least) < sketch else (sketch - 1) * 2.0**64 / float(least[-1])


def _counted(rows: DataFrame, wanted: np.ndarray, grams: np.ndarray, flush: int) -> dict[int, np.ndarray]:
    """Exact counts (n, t) of the given words and bigrams, in their order."""
    held = rows.sparkSession.sparkContext.broadcast((wanted, grams))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = held.value
        sums = [np.zeros((2, len(k)), np.int64) for k in keys]
        for r in _runs(batches, flush):
            own = np.repeat(_flags(r, 0), r.sizes)
            for k, s, x in zip(keys, sums, (r.w, _mix(r.v, r.w)), strict=True):
                if len(k):
                    at = np.minimum(np.searchsorted(k, x), len(k) - 1)
                    same = k[at] == x
                    s[0] += np.bincount(at[same], minlength=len(k))
                    s[1] += np.bincount(at[same & own], minlength=len(k))
        for kind, k, s in zip((_WORD, _GRAM), keys, sums, strict=True):
            some = np.flatnonzero(s[0])
            if len(some):
                yield batch_of(_SEEN, np.full(len(some), kind), k[some].view(np.int64), s[0][some], s[1][some])

    table = rows.mapInArrow(lean(run), _SEEN_DDL).groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toArrow()
    kind, key = table["kind"].to_numpy(), table["key"].to_numpy().view(np.uint64)
    out = {}
    for which, k in ((_WORD, wanted), (_GRAM, grams)):
        out[which] = np.zeros((2, len(k)), np.int64)
        own = kind == which
        out[which][:, np.searchsorted(k, key[own])] = [table["n"].to_numpy()[own], table["t"].to_numpy()[own]]
    return out


class Model:
    """What all tasks know: totals and the frequent words and bigrams."""

    def __init__(self, totals: np.ndarray, size: float, words_: np.ndarray, word_counts: np.ndarray, grams: np.ndarray, gram_counts: np.ndarray):
        self.n, self.t, self.size = int(totals[0]), int(totals[1]), size
        self.words, self.word_counts, self.grams, self.gram_counts = words_, word_counts, grams, gram_counts
        self.ratio = self.t / self.n if self.t else 1.0  # the background is scaled to the size of the target

    def losses(self, grams: np.ndarray, alone: np.ndarray, own_gram: np.ndarray, own_word: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whole numbers of 2 ** -SCALE bits of each entry under target and background; counts are rows n and t."""
        out = []
        for both, one, total, off, ratio in ((grams[1], alone[1], self.t, good, 1.0), (grams[0], alone[0], self.n, True, self.ratio)):
            word = ratio * (one - own_word * off)
            p = (word + ALPHA) / (ratio * total + ALPHA * self.size)
            bits = np.log2(word + MU) - np.log2(ratio * (both - own_gram * off) + MU * p)
            out.append(np.rint(bits * 2**SCALE).astype(np.int64) * own_gram)
        return out[0], out[1]


# ---- buckets

_PACKED = pa.schema([("bucket", pa.int32()), ("run", pa.int64()), ("data", pa.binary())])
_PACKED_DDL = "bucket int, run long, data binary"
_ROWS = -1


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, each as the planes of its bytes that are not all alike zero, compressed."""
    head, planes = [len(columns)], []
    for c in columns:
        c = np.ascontiguousarray(c)
        p = c.view(np.uint8).reshape(len(c), c.itemsize).T
        used = [i for i in range(c.itemsize) if p[i].any()]
        head += [len(c), c.itemsize, np.dtype(c.dtype).kind == "i", sum(1 << i for i in used)]
        planes += [p[i].tobytes() for i in used]
    raw = np.array(head, np.int64).tobytes() + b"".join(planes)
    return np.int64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], decompressed_size=int(np.frombuffer(data[:8], np.int64)[0]), codec="zstd", asbytes=True)
    head = np.frombuffer(raw, np.int64, 1)
    head = np.frombuffer(raw, np.int64, 1 + 4 * int(head[0]))
    at, out = head.nbytes, []
    for n, size, signed, used in head[1:].reshape(-1, 4).tolist():
        p = np.zeros((size, n), np.uint8)
        for i in range(size):
            if used >> i & 1:
                p[i] = np.frombuffer(raw, np.uint8, n, at)
                at += n
        out.append(np.ascontiguousarray(p.T).reshape(-1).view(f"{'i' if signed else 'u'}{size}"))
    return out


def _sums(row: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums by row of whole numbers."""
    out = np.zeros((2, n), np.int64)
    np.add.at(out[0], row, a)
    np.add.at(out[1], row, b)
    return out[0], out[1]


def _order(minor: np.ndarray, major: np.ndarray) -> np.ndarray:
    """The order by major and then minor; a major of few bits is sorted by its digits."""
    order = np.argsort(minor)
    small = major.astype(np.uint16) if len(major) and int(major.max()) < 1 << 16 else major
    return order[np.argsort(small[order], kind="stable")]


def _runs_of(*keys: np.ndarray) -> np.ndarray:
    """Where a new group begins in rows ordered by the keys."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new)


def _spread(r: Run, model: Model, buckets: int) -> Iterator[tuple[int, bytes]]:
    """A run's rows with what its frequent bigrams lose, and the others by bucket."""
    good = _flags(r, 1)
    gram = _mix(r.v, r.w)
    key = _order(gram, r.row)
    begins = _runs_of(r.row[key], gram[key])
    own_gram, order = np.diff(np.append(begins, len(key))), key[begins]  # the first of each bigram of a row
    row, v, w, gram = r.row[order], r.v[order], r.w[order], gram[order]
    # how often the row has the word
    key = _order(r.w, r.row)
    begins = _runs_of(r.row[key], r.w[key])
    often = np.diff(np.append(begins, len(key)))
    count = np.empty(len(key), np.int64)
    count[key] = np.repeat(often, often)
    own_word = count[order]

    def place(keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, x), max(len(keys) - 1, 0))
        return at, (keys[at] == x if len(keys) else np.zeros(len(x), bool))

    at, frequent = place(model.grams, gram)
    at_word, word_frequent = place(model.words, w)
    f = np.flatnonzero(frequent)
    # the words of frequent bigrams are frequent
    a, b = model.losses(model.gram_counts[:, at[f]], model.word_counts[:, at_word[f]], own_gram[f], own_word[f], good[row[f]])
    a, b = _sums(row[f], a, b, len(r.sizes))
    ids = np.array([0 if t[0] is None else t[0] for t in r.tails], np.int64)
    none = np.array([t[0] is None for t in r.tails], np.uint8)
    yield _ROWS, _pack(ids, none, r.sizes, a, b)
    rest = np.flatnonzero(~frequent)
    meet = np.where(word_frequent[rest], gram[rest], _mix(w[rest], np.ones(1, np.uint64))) >> np.uint64(32)
    bucket = (meet * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = _order(w[rest], bucket)
    rest, bucket = rest[order], bucket[order]
    edges = np.append(_runs_of(bucket), len(bucket))
    for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        x = rest[s:e]
        new = _runs_of(w[x])
        yield int(bucket[s]), _pack(w[x][new], np.diff(np.append(new, len(x))).astype(np.uint32), (v[x] >> np.uint64(24)), (2 * row[x] + good[row[x]]).astype(np.uint16), own_gram[x].astype(np.uint32), own_word[x].astype(np.uint32))


def _scored(parts: list[tuple[int, bytes]], model: Model) -> Iterator[tuple[int, bytes]]:
    """What the bigrams of one bucket lose, by run and row."""
    columns: list[list[np.ndarray]] = [[] for _ in range(6)]
    for i, (_, data) in enumerate(parts):
        w, times, v, row, own_gram, own_word = _unpack(data)
        for held, c in zip(columns, (np.repeat(w, times), v, row, own_gram, own_word, np.full(len(v), i, np.uint32)), strict=True):
            held.append(c)
    w, v, row, own_gram, own_word, run = (np.concatenate(c) for c in columns)
    own_gram, own_word, good = own_gram.astype(np.int64), own_word.astype(np.int64), (row & 1).astype(bool)
    order = np.argsort(v)
    order = order[np.argsort(w[order], kind="stable")]
    # counts of each bigram and of each word, put back at its entries
    by_gram, by_word = _runs_of(w[order], v[order]), _runs_of(w[order])
    counts = []
    for begins in (by_gram, by_word):
        sizes = np.diff(np.append(begins, len(order)))
        sums = [np.add.reduceat(x[order], begins) if len(order) else x for x in (own_gram, own_gram * good)]
        back = np.empty((2, len(order)), np.int64)
        back[:, order] = [np.repeat(s, sizes) for s in sums]
        counts.append(back)
    if len(model.words):
        at = np.minimum(np.searchsorted(model.words, w), len(model.words) - 1)
        same = model.words[at] == w
        counts[1][:, same] = model.word_counts[:, at[same]]
    a, b = model.losses(counts[0], counts[1], own_gram, own_word, good)
    edges = np.append(_runs_of(run), len(run))
    for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        rows, place = np.unique(row[s:e] >> 1, return_inverse=True)
        yield parts[int(run[s])][0], _pack(rows.astype(np.uint16), *_sums(place, a[s:e], b[s:e], len(rows)))


def _grouped(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, list[dict]]]:
    """The rows of each value of a column by which they come ordered."""
    at, held = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if r[column] != at and held:
                yield at, held
                held = []
            at = r[column]
            held.append(r)
    if held:
        yield at, held


_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("target_bits", pa.float64()), ("background_bits", pa.float64()), ("score", pa.float64())])


def _with_flags(rows: DataFrame, good: DataFrame) -> DataFrame:
    """The rows and whether their doc_id is among the good ones.

    Up to ``SENT`` ids are sent to the tasks as an array, of 8 bytes an id, so that no text moves; more are joined.
    """
    path = fresh_dir(rows.sparkSession, "lm-good")
    good.write.parquet(path)
    good = rows.sparkSession.read.parquet(path)
    if good.count() > SENT:
        return rows.join(good, F.col("doc_id") == F.col("good_id"), "left").select("row", "text", "doc_id", F.col("good_id").isNotNull().alias("good"))
    held = rows.sparkSession.sparkContext.broadcast(np.sort(good.toArrow()["good_id"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(2)
            known = np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), held.value) & ids.is_valid().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(known)], names=["row", "text", "doc_id", "good"])

    return rows.mapInArrow(run, "row long, text string, doc_id long, good boolean")


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", flush: int = FLUSH, bucket: int = BUCKET, rarity: int = RARITY, sketch: int = SKETCH) -> DataFrame:
    """doc_id, n_tokens, the loss per token under both models, and their difference, of every row."""
    spark = docs.sparkSession
    good = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("good_id")).agg(F.min(F.coalesce(F.col("quality"), F.lit(0))).alias("quality")).where("quality > 0").select("good_id")
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    rows = _with_flags(slim, good)
    flagged = rows.select("row", "text", "good")
    seen = _survey(flagged, flush, rarity, sketch)
    counts = _counted(flagged, seen[_WORD], seen[_GRAM], flush)
    held = spark.sparkContext.broadcast(Model(seen[_TOTAL], vocabulary_size(seen[_LEAST], sketch), seen[_WORD], counts[_WORD], seen[_GRAM], counts[_GRAM]))
    buckets = max(1, -(-int(seen[_TOTAL][0]) // bucket))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _runs(batches, flush):
            for at, data in _spread(r, held.value, buckets):
                yield batch_of(_PACKED, [at if at >= 0 else _ROWS - r.first % 1024], [r.first], [data])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, parts in _grouped(batches, "bucket"):
            rows_ = at < 0
            for run, data in ((p["run"], p["data"]) for p in parts) if rows_ else _scored([(p["run"], p["data"]) for p in parts], held.value):
                yield batch_of(_PACKED, [_ROWS if rows_ else at], [run], [data])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _grouped(batches, "run"):
            own = next(p for p in parts if p["bucket"] < 0)
            ids, none, n, a, b = _unpack(own["data"])
            a, b = a.copy(), b.copy()
            for p in parts:
                if p["bucket"] >= 0:
                    at, x, y = _unpack(p["data"])
                    a[at] += x
                    b[at] += y
            target, background = a / n / 2**SCALE, b / n / 2**SCALE
            yield batch_of(_OUT, pa.array(ids, mask=none.astype(bool)), n, target, background, target - background)

    spread_out = rows.mapInArrow(lean(spread), _PACKED_DDL).repartition("bucket").sortWithinPartitions("bucket")
    back = spread_out.mapInArrow(lean(scored), _PACKED_DDL).repartition("run").sortWithinPartitions("run")
    return back.mapInArrow(lean(gathered), "doc_id long, n_tokens long, target_bits double, background_bits double, score double")
