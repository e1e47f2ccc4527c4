"""Quality rules: counts over words and lines, and an isolation forest over their ratios.

Words are runs of anything but ASCII white space. The base rule fails a document of
fewer than ``min_words`` words, or with over ``max_repeat`` per cent of its words in
five-word windows that the text holds twice or more.

An isolation forest over all rule statistics grows on the whole corpus, but for the documents that fail
the base rule: as the method has it, each tree parts 256 rows, drawn for it alone from all of them, by random
statistics at random values. Documents unlike the rest part from it after few
splits; the path length becomes a score in (0, 1). Each split also tells how much it isolates a
document, in bits (of its rows, which share goes the document's way), and so which statistic
isolates it most, over what is usual for that statistic: the median over every document.

Labels choose thresholds and nothing else: for each statistic, the score over which documents that it
isolates are rejected, from every labelled row that it isolates. Good rows weigh more, so that clean
documents stay; where good rows are as odd, the threshold is out of reach. Medians and thresholds come
from counts over whole numbers of 2^-14 bits and 2^-16 of a score, so that the driver gets a bounded table
however many rows there are. Every document is scored over its whole text.

Edge cases: a null or empty text has no words and fails the base rule. Without labels
of both kinds there is no verdict to learn and the base rule alone decides. A document
with several labels takes the worst; of rows that repeat an id the one with the least hash of its
text stands for it, and rows without an id are not learned from. A caller may bound the ids that are learned from;
the queries do not. Repeated rows are judged each for itself; very long
texts are judged whole; an empty table gives no rows. Columns other than id and text are never read for a
judgement, whatever their names, and ``keep`` returns them as they are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import batch_of, cut, lean

TREES, SUBSAMPLE = 128, 256
BITS_GRID, SCORE_GRID = 2**14, 2**16
WIDE = 4_096  # rows scored at once
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT, WINDOW = 10, 20, 5
_SPACES = " \t\n\r\x0b\x0c"
_UPPER, _DIGITS, _MARKS = (bytes(ord(c) for c in s) for s in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "!?.,;:\"'()[]{}/\\-_=+@^~`"))


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words that lie in a window of so many words which occurs twice or more."""
    grams = list(zip(*(words[i:] for i in range(window)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    count = Counter(grams)
    covered = end = 0
    for i, gram in enumerate(grams):
        if count[gram] > 1:
            covered += i + window - max(i, end)
            end = i + window
    return covered


def statistics(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; then lines, capitals, digits and marks."""
    text = text or ""
    data = text.encode()
    words = data.split()  # bytes split at ASCII white space alone
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    without = [len(data) - len(data.translate(None, s)) for s in (_UPPER, _DIGITS, _MARKS)]
    return (len(words), len(text) - sum(map(text.count, _SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words), len(lines), *without)


def features(stats: np.ndarray) -> np.ndarray:
    """Ratios of the rule statistics, one row a document; length itself is not judged."""
    s = stats.astype(float)
    words, chars, lines = (np.maximum(s[:, i], 1) for i in (0, 1, 5))
    return np.column_stack([s[:, 1] / words, s[:, 2] / words, s[:, 3] / lines, s[:, 4] / words, s[:, 6] / chars, s[:, 7] / chars, s[:, 8] / words])


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    m = np.maximum(n, 2)
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, 2 * (np.log(m - 1) + np.euler_gamma) - 2 * (m - 1) / m))


def draws(n: int, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 7) -> list[np.ndarray]:
    """Which of n rows each tree parts; every row is as likely as any other."""
    rng = np.random.default_rng(seed)
    return [rng.choice(n, min(subsample, n), replace=False) for _ in range(trees)]


@dataclass(frozen=True)
class Forest:
    """Trees as heap-ordered arrays: feature (-1 in a leaf), value, the path length that a leaf stands for, and the
    bits by which a step into a node isolates."""

    feature: np.ndarray
    value: np.ndarray
    path: np.ndarray
    bits: np.ndarray
    depth: int
    scale: float

    @staticmethod
    def fit(x: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 7) -> Forest:
        return Forest.grow([x[own] for own in draws(len(x), trees, subsample, seed)], seed)

    @staticmethod
    def grow(drawn: list[np.ndarray], seed: int = 7) -> Forest:
        """A tree of each set of rows, all of one size."""
        rng = np.random.default_rng([seed, 1])
        trees, size, width = len(drawn), len(drawn[0]), drawn[0].shape[1]
        depth = max(1, math.ceil(math.log2(max(size, 2))))
        nodes = 2 ** (depth + 1) - 1
        feature, value, path, bits = np.full((trees, nodes), -1), *(np.zeros((trees, nodes)) for _ in range(3))
        for t in range(trees):
            todo = [(0, 0, drawn[t])]
            while todo:
                node, level, rows = todo.pop()
                low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(width),) * 2
                able = np.flatnonzero(high > low)
                if level == depth or len(rows) <= 1 or not len(able):
                    path[t, node] = level + average_path(len(rows))
                    continue
                f = rng.choice(able)
                v = rng.uniform(low[f], high[f])
                feature[t, node], value[t, node] = f, v
                left = rows[:, f] < v
                for child, own in ((2 * node + 1, left), (2 * node + 2, ~left)):
                    bits[t, child] = -math.log2(max(own.sum(), 0.5) / len(rows))
                    todo.append((child, level + 1, rows[own]))
        return Forest(feature, value, path, bits, depth, float(average_path(size)) or 1.0)

    def score(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """2 ** -(mean path / usual path), near 1 for anomalies and under a half for usual rows; and the mean bits of each feature."""
        rows, total, why = np.arange(len(x)), np.zeros(len(x)), np.zeros(x.shape)
        for t in range(len(self.feature)):
            at = np.zeros(len(x), int)
            for _ in range(self.depth):
                f = self.feature[t, at]
                at = np.where(f < 0, at, 2 * at + 1 + (x[rows, np.maximum(f, 0)] >= self.value[t, at]))
                why[rows, np.maximum(f, 0)] += np.where(f < 0, 0.0, self.bits[t, at])
            total += self.path[t, at]
        return np.exp2(-total / len(self.feature) / self.scale), why / len(self.feature)


def base_failed(stats: np.ndarray, min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT) -> np.ndarray:
    return (stats[:, 0] < min_words) | (100 * stats[:, 4] > max_repeat * stats[:, 0])


def calibrate(good: np.ndarray, bad: np.ndarray, n_good: int | None = None, n_bad: int | None = None, weight: float = 10.0, times: tuple[np.ndarray, np.ndarray] | None = None) -> float:
    """The threshold over which a score is an anomaly: least weighted errors, a lost good row weighing more.

    Among equal errors it is the middle of the widest gap between neighbouring scores. The rows may be some of
    n_good and n_bad; times tells how many rows have each good and each bad score.
    """
    many_good, many_bad = times or (np.ones(len(good), int), np.ones(len(bad), int))
    scores = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([(scores[1:] + scores[:-1]) / 2, [np.inf]])
    if not len(good) and len(bad):
        cuts, scores = np.append(scores[0] * 0.999, cuts), np.append(0.0, scores)
    gaps = np.concatenate([np.diff(scores), [0]])

    def upto(values: np.ndarray, many: np.ndarray) -> np.ndarray:
        order = np.argsort(values)
        return np.append(0, np.cumsum(many[order]))[np.searchsorted(values[order], cuts, side="right")]

    lost, missed = many_good.sum() - upto(good, many_good), upto(bad, many_bad)
    cost = weight * lost / max(n_good or many_good.sum(), 1) + missed / max(n_bad or many_bad.sum(), 1)
    return float(cuts[max(range(len(cuts)), key=lambda i: (-cost[i], gaps[i]))])


def median(values: np.ndarray, times: np.ndarray) -> float:
    """The median of rows of which so many have each value."""
    order = np.argsort(values)
    upto = np.cumsum(times[order])
    low, high = (values[order][np.searchsorted(upto, k, side="right")] for k in ((upto[-1] - 1) // 2, upto[-1] // 2))
    return (float(low) + float(high)) / 2


@dataclass(frozen=True)
class Judge:
    forest: Forest | None
    usual: np.ndarray  # bits of each feature for the median row
    thresholds: np.ndarray  # a score for each feature

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The anomaly score of every row of features and the feature that isolates it most."""
        score, why = self.forest.score(x)
        return score, (why - self.usual).argmax(1)

    def verdict(self, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The anomaly score of every row, the feature that isolates it most, and whether it is rejected."""
        if not self.forest or not len(stats):
            return np.zeros(len(stats)), np.full(len(stats), -1), np.zeros(len(stats), bool)
        score, main = self.of(features(stats))
        return score, main, score > self.thresholds[main]


def _least(ids: DataFrame, bound: int) -> DataFrame:
    """The ids in column doc_id with the least hashes, at most bound; ids may repeat."""
    hashed = ids.select("doc_id", F.xxhash64("doc_id").alias("h"))
    n = hashed.agg(F.approx_count_distinct("doc_id")).first()[0]
    if n > 3 * bound:  # those with a small hash, so that tasks hand on few rows
        few = hashed.where(F.col("h") < F.lit(int(-(2**63) + 2**64 * min(1.0, 2.0 * bound / n)))).distinct()
        if few.limit(bound).count() == bound:
            hashed = few
    return hashed.distinct().orderBy("h", "doc_id").limit(bound).select("doc_id")


def _learned(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, bound: int | None) -> DataFrame:
    """(at, quality, sampled, stats): a row a document that passes the base rule, written once; at follows the ids, sampled ones first."""
    per_doc = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min((F.col("quality") > 0).cast("int")).alias("quality"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    marks = per_doc.withColumn("sampled", F.lit(1))
    if bound is not None:
        chosen = _least(texts.select("doc_id"), bound).select("doc_id", F.lit(None).cast("int").alias("quality"), F.lit(1).alias("sampled"))
        for quality in (0, 1):
            chosen = chosen.unionByName(_least(per_doc.where(F.col("quality") == quality), bound).select("doc_id", F.lit(quality).alias("quality"), F.lit(0).alias("sampled")))
        marks = chosen.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("sampled").alias("sampled"))
        texts = texts.join(marks.select("doc_id").hint("merge"), "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_of(_COUNTED, batch.column(0).to_pylist(), batch.column(1).to_pylist(), [list(statistics(t)) for t in batch.column(2).to_pylist()])

    counted = texts.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(lean(run), "doc_id long, h long, stats array<long>")
    passed = (F.get("stats", F.lit(0)) >= MIN_WORDS) & (100 * F.get("stats", F.lit(4)) <= MAX_REPEAT * F.get("stats", F.lit(0)))
    rows = counted.groupBy("doc_id").agg(F.min_by("stats", "h").alias("stats")).where(passed).join(marks.hint("merge"), "doc_id", "left").withColumn("sampled", F.coalesce("sampled", F.lit(1)))
    return cut(rows.orderBy(F.desc("sampled"), "doc_id").select(F.monotonically_increasing_id().alias("at"), "quality", "sampled", "stats"))


def _matrix(stats: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return features(np.array(stats.to_pylist() or np.zeros((0, 9)), np.int64).reshape(-1, 9))


def _drawn(rows: DataFrame, n: int) -> list[np.ndarray]:
    """The features of the rows that each tree parts, by their rank among the n sampled rows."""
    part = F.shiftright("at", 33)  # ids begin anew in each partition
    held = sorted((r["p"], r["n"]) for r in rows.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())  # a row a partition
    parts, ends = np.array([p for p, _ in held], np.int64), np.cumsum([k for _, k in held])
    chosen = draws(n)
    ranks = np.unique(np.concatenate(chosen))  # TREES * SUBSAMPLE at most
    own = np.searchsorted(ends, ranks, side="right")
    at = (parts[own] << 33) + ranks - np.append(0, ends)[own]
    wanted = rows.sparkSession.createDataFrame(pa.table({"at": at}))
    got = rows.join(F.broadcast(wanted), "at").select("at", "stats").toArrow().sort_by("at")
    x = _matrix(got["stats"])
    return [x[np.searchsorted(ranks, own)] for own in chosen]


def _usual(rows: DataFrame, forest: Forest) -> np.ndarray:
    """The median bits of each feature over all rows."""
    held = rows.sparkSession.sparkContext.broadcast(forest)  # TREES * 511 nodes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.rint(held.value.score(_matrix(batch.column(0)))[1] * BITS_GRID).astype(np.int64)
            for j in range(bits.shape[1]):
                values, times = np.unique(bits[:, j], return_counts=True)
                yield batch_of(_BITS, np.full(len(values), j), values, times)

    got = rows.select("stats").mapInArrow(lean(run, WIDE), "feature int, value long, n long").groupBy("feature", "value").agg(F.sum("n").alias("n")).toArrow()
    feature, value, n = (got[c].to_numpy() for c in ("feature", "value", "n"))
    return np.array([median(value[feature == j], n[feature == j]) / BITS_GRID for j in range(feature.max() + 1)])


def _thresholds(rows: DataFrame, bare: Judge) -> np.ndarray:
    """The score for each feature over which rows are rejected, from all labelled rows."""
    held = rows.sparkSession.sparkContext.broadcast(bare)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, main = held.value.of(_matrix(batch.column(1)))
            yield batch_of(_SCORES, batch.column(0).to_pylist(), main, np.rint(score * SCORE_GRID).astype(np.int64))

    got = rows.where("quality is not null").select("quality", "stats").mapInArrow(lean(run, WIDE), "quality int, feature int, value long").groupBy("quality", "feature", "value").agg(F.count("*").alias("n")).toArrow()
    quality, feature, value, n = (got[c].to_numpy() for c in ("quality", "feature", "value", "n"))
    cuts = np.full(len(bare.usual), math.inf)
    for j in np.unique(feature[quality == 0]):
        good, bad = ((feature == j) & (quality == q) for q in (1, 0))
        cuts[j] = calibrate(value[good] / SCORE_GRID, value[bad] / SCORE_GRID, n[quality == 1].sum(), n[quality == 0].sum(), times=(n[good], n[bad]))
    return cuts


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int | None = None) -> Judge:
    """Grows the forest on the whole corpus and sets thresholds on all labelled rows; given a bound, on at most so many rows of each."""
    rows = _learned(docs, labels, id_col, text_col, bound)
    n, good, bad = rows.agg(F.coalesce(F.sum("sampled"), F.lit(0)), F.count(F.expr("if(quality = 1, 1, null)")), F.count(F.expr("if(quality = 0, 1, null)"))).first()
    if not n or not good or not bad:
        return Judge(None, np.zeros(0), np.zeros(0))
    forest = Forest.grow(_drawn(rows, n))
    bare = Judge(forest, _usual(rows.where("sampled = 1"), forest), np.zeros(0))
    return Judge(forest, bare.usual, _thresholds(rows, bare))


_COUNTED = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("stats", pa.list_(pa.int64()))])
_BITS = pa.schema([("feature", pa.int32()), ("value", pa.int64()), ("n", pa.int64())])
_SCORES = pa.schema([("quality", pa.int32()), ("feature", pa.int32()), ("value", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", pa.bool_()), ("anomaly", pa.float64()), ("kept", pa.bool_())])


def _judged(judge: Judge, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    stats = np.array([statistics(t) for t in texts] or np.zeros((0, 9)), np.int64).reshape(-1, 9)
    failed, (score, _, rejected) = base_failed(stats), judge.verdict(stats)
    return stats, failed, score, ~failed & ~rejected


def assess(docs: DataFrame, judge: Judge, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts, base_failed, the anomaly score and the verdict of every row."""
    held = docs.sparkSession.sparkContext.broadcast(judge)  # TREES * 511 nodes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats, failed, score, kept = _judged(held.value, batch.column(1).to_pylist())
            yield batch_of(_OUT, batch.column(0).to_pylist(), *stats[:, :5].T, failed, score, kept)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(lean(run), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, anomaly double, kept boolean")


def keep(docs: DataFrame, judge: Judge, text_col: str = "text") -> DataFrame:
    """The rows that the rules keep, with all their columns as they came; no shuffle."""
    held, at_text = docs.sparkSession.sparkContext.broadcast(judge), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_judged(held.value, batch.column(at_text).to_pylist())[3]))

    return docs.mapInArrow(lean(run), docs.schema)
