"""Packing by optimal length buckets.

Every document has a length in tokens: those of a tokenizer file, counted over the whole text, or words between
ASCII white space where no file is given, or any count column. The global histogram of different lengths goes to the driver as it is, since d of them take
d * (d - 1) / 2 tokens at least: ``BINS`` rows stand for 2 G tokens. Dynamic programming over it
chooses the ``BUCKETS`` boundaries with the least padding in all. A document pads to its bucket's
boundary; batches of a bucket hold as many documents as the token budget allows, at
least one, so that a document over the budget is a batch of its own. Nothing is cut.

Places within a bucket come from counts of (bucket, shard) and a rank within the shard, one of ``SHARDS``
by a hash of the document, so that no task ever holds a whole bucket.

Edge cases: a null or empty text has length 0 and packs with a boundary of 0 tokens as if
it were 1. Equal lengths and repeated rows are ordered by id, then by a hash of the text;
rows equal in all of these are alike and take neighbouring places in any order. An empty
table gives no rows. Very long texts are counted whole. The other columns are not read, whatever their names.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexweave.llm import tokens
from lexweave.llm.common import cut, lean

BUCKETS, BUDGET, BINS, SHARDS = 16, 8192, 65_536, 4096


def n_words(text: str = "text") -> Column:
    """Runs of anything but ASCII white space."""
    return F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(F.array_remove(F.split(F.col(text), r"[\x20\x09-\x0D]+"), ""))).cast("long")


def boundaries(lengths: np.ndarray, counts: np.ndarray, k: int) -> list[int]:
    """The k or fewer upper bounds, of the given sorted lengths, with the least padding in all.

    best[j] is the least padding of the first j lengths; the last bucket (i, j] pads to
    lengths[j], which costs lengths[j] * rows in it less their tokens. Over i this is the
    lower envelope of lines at a growing place, so each round takes one sweep.
    """
    n = len(lengths)
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(object)
    total = np.concatenate([[0], np.cumsum(lengths.astype(object) * counts.astype(object))])
    size = [int(x) for x in lengths]
    best: list[float] = [0] + [float("inf")] * n
    back = []
    for _ in range(min(k, n)):
        hull: list[tuple[int, int, int]] = []  # slope, height, i; slopes fall
        now, cut_at, head = [float("inf")] * (n + 1), [0] * (n + 1), 0
        for j in range(1, n + 1):
            if best[j - 1] != float("inf"):
                slope, height = -int(rows[j - 1]), int(best[j - 1]) + int(total[j - 1])
                while len(hull) >= 2 and (height - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - slope):
                    hull.pop()
                hull.append((slope, height, j - 1))
                head = min(head, len(hull) - 1)
            x = size[j - 1]
            while head + 1 < len(hull) and hull[head + 1][0] * x + hull[head + 1][1] <= hull[head][0] * x + hull[head][1]:
                head += 1
            if hull:
                slope, height, i = hull[head]
                now[j], cut_at[j] = slope * x + height + int(rows[j]) * x - int(total[j]), i
        if now[n] >= best[n]:
            break
        best, back = now, [*back, cut_at]
    out, j = [], n
    for cut_at in reversed(back):
        out.append(size[j - 1])
        j = cut_at[j]
        if not j:
            break
    return sorted(out)


_LENGTHS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("h", pa.int64())])


def lengths_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: Column | None = None, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens and h, a hash of the text, of every row."""
    text = F.col(text_col).cast("string")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), (n_words(text_col) if length is None else length.cast("long")).alias("n_tokens"), F.xxhash64(text).alias("h"))
    if length is not None or tokenizer is None:
        return slim
    whole = tokens.proven(docs.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokens.counter(tokenizer, whole.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count([t or "" for t in batch.column(1).to_pylist()]), pa.int64()), batch.column(2)], schema=_LENGTHS)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h")).mapInArrow(lean(run), "doc_id long, n_tokens long, h long")


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, id_col: str = "doc_id", text_col: str = "text", length: Column | None = None, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_len, batch, slot of every row.

    Batches are numbered within their bucket, slots within their batch.
    """
    rows = cut(lengths_of(docs, id_col, text_col, length, tokenizer))
    histogram = rows.groupBy(F.coalesce("n_tokens", F.lit(0)).alias("len")).count().orderBy("len").toArrow()
    lengths, counts = histogram["len"].to_numpy(), histogram["count"].to_numpy()
    n = int(counts.sum())
    if len(lengths) > BINS:
        warnings.warn(f"{len(lengths)} different lengths are on the driver; boundaries stay exact", stacklevel=2)
    bounds = boundaries(lengths, counts, buckets) if n else [0]
    table = F.array(*(F.lit(b).cast("long") for b in bounds))
    bucket = F.size(F.filter(table, lambda b: b < F.col("n_tokens")))
    placed = rows.withColumn("bucket", bucket).withColumn("shard", F.pmod(F.xxhash64("doc_id", "h"), F.lit(SHARDS)))
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("bucket", "shard").count().select("bucket", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("doc_id", "h"))
    ranked = placed.withColumn("rank", rank).join(offsets, ["bucket", "shard"])
    place = F.col("offset") + F.col("rank") - 1
    bound = F.element_at(table, F.col("bucket") + 1)
    each = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest(bound, F.lit(1).cast("long"))))
    return ranked.select("doc_id", "n_tokens", F.col("bucket").cast("long").alias("bucket"), bound.alias("bucket_len"), F.floor(place / each).cast("long").alias("batch"), (place % each).cast("long").alias("slot"))
