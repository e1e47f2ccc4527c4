"""Readers and writers of stage files: JSON trees, JSON lines, logs, caches, snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave import schemas
from lexweave.operators import tree

AFFECTED = 200


def json_trees(spark: SparkSession, path: str) -> DataFrame:
    """Node rows of nested JSON files, one tree a file."""
    return tree.flatten(spark.read.text(path, wholetext=True))


def discover(spark: SparkSession, path: str) -> DataFrame:
    """(file, what): part trees, manifests and files that cannot be read."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    whole = F.expr("try_parse_json(value)").isNotNull()
    return files.select("file", F.when(~whole, "unreadable").when(F.get_json_object("value", "$.kind") == "part", "part").otherwise("manifest").alias("what"))


def tri_state(spark: SparkSession, expected: list[str], path: str, skipped: list[str] = ()) -> DataFrame:
    """(file, state): loaded, absent, failed or skipped for every expected file."""
    want = spark.createDataFrame([(f,) for f in expected], "file string")
    have = discover(spark, path)
    state = F.when(F.col("file").isin(*skipped), "skipped").when(F.col("what").isNull(), "absent").when(F.col("what") == "unreadable", "failed").otherwise("loaded")
    return want.join(have, "file", "left").select("file", state.alias("state"))


def newest_run(files: DataFrame) -> DataFrame:
    """The run of a listing (run, mtime) that changed last, by name among equals."""
    return files.agg(F.max_by("run", F.struct("mtime", "run")).alias("run"))


def listing(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return rows.select("path", F.col("modificationTime").alias("mtime"), F.element_at(F.split("path", "/"), -2).alias("run"))


def json_lines(spark: SparkSession, path: str, ddl: str) -> tuple[DataFrame, DataFrame]:
    """Rows of a schema, and the lines that do not parse, with file and text."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), "value").where("trim(value) <> ''")
    schema = schemas.struct(ddl).add("__bad", "string")
    parsed = lines.withColumn("r", F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}))
    return parsed.where("r.__bad is null").select("file", "r.*").drop("__bad"), parsed.where("r.__bad is not null").select("file", "value")


def tolerant(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The table at a path, or an empty one of its schema where there is none."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schemas.struct(ddl)).parquet(path)
    except AnalysisException:
        return schemas.empty(spark, ddl)


def write_json_lines(df: DataFrame, path: str, order: list[str]) -> None:
    """Sorted JSON lines, so that equal tables give equal files."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").json(path)


def graph_json(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(kind, json): nodes and links as JSON values, a row each; links are keyed by their whole merge key."""
    key = F.concat_ws("|", "type", "src", "dst", F.coalesce(F.element_at("props", "char_span"), F.lit("")))
    n = nodes.select(F.lit("node").alias("kind"), F.to_json(F.struct(*nodes.columns)).alias("json"))
    return n.unionByName(edges.select(F.lit("link").alias("kind"), F.to_json(F.struct(key.alias("key"), *edges.columns)).alias("json")))


def write_layout(lines: DataFrame, path: str) -> None:
    lines.repartition("part").sortWithinPartitions("part", "page", "line_no").write.mode("overwrite").partitionBy("part").parquet(path)


def append_decisions(decisions: DataFrame, path: str, verdicts: list[str]) -> DataFrame:
    """Appends valid decisions and returns the others with why they were refused."""
    bad = F.when(~F.col("verdict").isin(*verdicts), "unknown_verdict").when(F.col("id").isNull(), "no_subject")
    checked = decisions.withColumn("refused", bad)
    checked.where("refused is null").drop("refused").withColumn("ts", F.current_timestamp()).write.mode("append").parquet(path)
    return checked.where("refused is not null")


def audit_row(op: str, reason: str, affected: DataFrame, key: str = "id") -> DataFrame:
    """One row of the audit log: how many rows an operation touched, and the first 200 of them."""
    first = affected.select(F.col(key).cast("string").alias("k")).orderBy("k").limit(AFFECTED)
    total = affected.agg(F.count("*").alias("affected_count"))
    return total.crossJoin(first.agg(F.array_sort(F.collect_list("k")).alias("affected"))).select(F.lit(op).alias("op"), F.lit(reason).alias("reason"), "affected_count", "affected")


def golden_labels(spark: SparkSession, path: str, verdicts: list[str]) -> tuple[DataFrame, DataFrame]:
    """Labels in file and line order, decisions.jsonl first, and what cannot be used."""
    rows, broken = json_lines(spark, path, schemas.GOLDEN)
    late = F.when(F.col("file") == "decisions.jsonl", 0).otherwise(1)
    good = rows.where(F.col("verdict").isin(*verdicts)).withColumn("file_no", late)
    odd = rows.where(~F.col("verdict").isin(*verdicts)).select("file", F.to_json(F.struct("kind", "path", "verdict")).alias("value"))
    return good, broken.unionByName(odd)


def page_map(spark: SparkSession, path: str) -> DataFrame:
    """(part_id, title, page_start, page_end) of a Markdown table with page ranges."""
    lines = spark.read.text(path)
    row = r"^\|\s*([a-z0-9-]+)\s*\|\s*(.*?)\s*\|\s*(\d+)\s*(?:[-–]\s*(\d+))?\s*\|"
    got = lines.where(F.col("value").rlike(row))
    num = lambda i: F.nullif(F.regexp_extract("value", row, i), F.lit("")).cast("int")
    return got.select(F.regexp_extract("value", row, 1).alias("part_id"), F.regexp_extract("value", row, 2).alias("title"), num(3).alias("page_start"), F.coalesce(num(4), num(3)).alias("page_end"))


def part_registry(spark: SparkSession, path: str) -> DataFrame:
    """(part_id, title) of known parts in any of the shapes a registry file has: a map, a list, objects under parts."""
    text = spark.read.text(path, wholetext=True).where("try_parse_json(value) is not null")
    as_map = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("part_id", "title")).where("part_id not in ('parts', 'registry')")
    rows = "array<struct<id:string,part_id:string,title:string>>"
    listed = text.select(F.inline(F.coalesce(F.from_json(F.get_json_object("value", "$.parts"), rows), F.from_json("value", rows))))
    return as_map.unionByName(listed.select(F.coalesce("part_id", "id").alias("part_id"), "title")).where("part_id is not null").dropDuplicates(["part_id"])


def legislation_records(spark: SparkSession, path: str) -> DataFrame:
    """Valid records of statutes; a year of 0 is no year."""
    ddl = "records array<struct<key:string,title:string,year:int,instrument_kind:string,provision:string>>"
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.inline(F.from_json("value", ddl)["records"])).where("key is not null and title is not null")
    return rows.withColumn("year", F.nullif("year", F.lit(0)))


def replay_key(task: Column | str, version: Column | str, payload: Column | str) -> Column:
    return F.sha1(F.concat_ws("|", task, version, payload))


def replay_split(calls: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls (task, version, payload) with their stored reply, and those still owed; errors are never replayed."""
    keyed = calls.withColumn("key", replay_key("task", "version", "payload"))
    good = cache.where("error is null").select("key", "reply").dropDuplicates(["key"])
    return keyed.join(good, "key"), keyed.join(good, "key", "left_anti")


class SnapshotStore:
    """Tables as immutable snapshots; a pointer table names the current ones, so that a load shows whole or not at all."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def current(self) -> dict[str, str]:
        from pyspark.errors import AnalysisException

        try:
            rows = self.spark.read.parquet(f"{self.root}/_pointers")
        except AnalysisException:
            return {}
        return {r["table"]: r["path"] for r in rows.groupBy("table").agg(F.max_by("path", "seq").alias("path")).collect()}

    def read(self, table: str, ddl: str) -> DataFrame:
        path = self.current().get(table)
        return self.spark.read.parquet(path) if path else schemas.empty(self.spark, ddl)

    def publish(self, tables: dict[str, DataFrame]) -> None:
        """Writes all tables and then one pointer file for all of them."""
        paths = {}
        for name, df in tables.items():
            paths[name] = f"{self.root}/{name}/{uuid.uuid4().hex}"
            df.write.parquet(paths[name])
        rows = self.spark.read.parquet(f"{self.root}/_pointers") if self.current() else None
        seq = (rows.agg(F.max("seq")).first()[0] if rows is not None else 0) + 1
        self.spark.createDataFrame([(t, p, seq) for t, p in paths.items()], "table string, path string, seq long").coalesce(1).write.mode("append").parquet(f"{self.root}/_pointers")
