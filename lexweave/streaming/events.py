"""Structured Streaming over append-only logs: windows, sessions, last records, deferred edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.operators.concepts import dropped

LATE, GAP = "1 hour", "30 minutes"


def read_events(spark: SparkSession, folder: str, pattern: str = "events.parquet") -> DataFrame:
    schema = spark.read.parquet(f"{folder}/{pattern}").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks take no other type


def tumbling(events: DataFrame, width: str = "1 hour", late: str = LATE) -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str = "1 hour", step: str = "15 minutes", late: str = LATE) -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width, step)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = GAP, late: str = LATE) -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def deduplicated(events: DataFrame, key: str = "event_id", late: str = LATE) -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def run_to_table(stream: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over what is there now and returns its table, which lies in the shared folder.

    In complete mode a batch holds the whole result and takes the place of the one before; else batches
    add up. A batch that runs twice overwrites itself.
    """
    spark, path, done = stream.sparkSession, f"{checkpoint.rstrip('/')}-{name}", []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{number}")
        if mode == "complete" and number:
            dropped(spark, f"{path}/{number - 1}")
        done.append(number)

    q = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{path}/{done[-1]}" if mode == "complete" else f"{path}/*") if done else spark.createDataFrame([], stream.schema)


def last_records(stream: DataFrame, path: str, keys: list[str], order: str, checkpoint: str) -> None:
    """Keeps the last record of each key as the newest snapshot under path, batch by batch.

    A batch that runs twice changes nothing: the snapshot before it stays until the next one is written.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = spark.read.parquet(f"{path}/{number - 1}") if number else None
        rows = batch if old is None else old.unionByName(batch)
        columns = [c for c in rows.columns if c not in keys]
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(order, *columns)).alias("r")).select(*keys, "r.*")
        last.write.mode("overwrite").parquet(f"{path}/{number}")
        if number > 1:
            dropped(spark, f"{path}/{number - 2}")

    q = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def deferred_edges(edges: DataFrame, keys: DataFrame) -> DataFrame:
    """Edges of a stream with whether both ends are among the held keys now."""
    k = keys.select("key").distinct()
    both = edges.join(k.select(F.col("key").alias("src"), F.lit(True).alias("has_src")), "src", "left").join(k.select(F.col("key").alias("dst"), F.lit(True).alias("has_dst")), "dst", "left")
    return both.withColumn("writable", F.col("has_src").isNotNull() & F.col("has_dst").isNotNull()).drop("has_src", "has_dst")
