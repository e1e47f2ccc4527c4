"""What the operators of this subpackage share: reading, lineage cuts, batches of text."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A cluster names it in spark.checkpoint.dir. Only where that is unset, as in
    tests on one machine, a temporary folder takes its place.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="lexweave-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder, with a plan that only reads them back."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Deletes a folder that is no longer read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def text_chunks(texts: Iterable[str | None], most_chars: int) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts) of runs that hold about most_chars; null counts as empty.

    A longer text makes a run of its own, whole.
    """
    run: list[str] = []
    first = chars = 0
    for i, text in enumerate(texts):
        text = text or ""
        if run and chars + len(text) > most_chars:
            yield first, run
            first, run, chars = i, [], 0
        run.append(text)
        chars += len(text)
    if run:
        yield first, run


def batch_of(schema: pa.Schema, *columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


ROWS = 500


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, in order, a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def release() -> None:
    """Hands unused memory back: workers outlive their tasks, beside executors that fill their heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], rows: int = ROWS) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A map over batches that gets few rows at a time and keeps no memory after its task."""

    @functools.wraps(run)
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(slices(batches, rows))
        finally:
            release()

    return mapped
