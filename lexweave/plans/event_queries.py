"""Queries with windows and intervals: islands, as-of, overlaps, last records, transitions, streams."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexweave.operators import detection, evaluation, layout, resolution
from lexweave.plans.catalog import query, table
from lexweave.streaming import events as streams


@query("""
WITH o AS (SELECT *, CASE WHEN role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn) THEN 0 ELSE 1 END AS new FROM conversations),
     i AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS isle FROM o)
SELECT conv_id, role, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS n FROM i GROUP BY conv_id, isle, role
""")
def role_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").withColumn("new", F.coalesce((F.col("role") != F.lag("role").over(own)).cast("int"), F.lit(1)))
    isles = rows.withColumn("isle", F.sum("new").over(own))
    return isles.groupBy("conv_id", "isle", "role").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.count("*").alias("n")).drop("isle")


@query("""
SELECT event_id, last_value(CASE WHEN event_type = 'error' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cue FROM events
""")
def asof_cue(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    return table(spark, sf_dir, "events").select("event_id", F.last(F.when(F.col("event_type") == "error", F.col("event_id")), True).over(back).alias("cue"))


@query("""
WITH s AS (SELECT l_orderkey, l_linenumber AS n, epoch(l_shipdate) // 86400 AS s, epoch(l_shipdate) // 86400 + CAST(l_quantity AS BIGINT) AS e FROM lineitem)
SELECT a.l_orderkey, a.n AS a, b.n AS b, count(*) AS n FROM s a JOIN s b USING (l_orderkey) WHERE a.n < b.n AND a.s < b.e AND b.s < a.e GROUP BY 1, 2, 3
""")
def interval_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order whose spans of days, as long as their quantity, have a day in common."""
    day = F.floor(F.col("l_shipdate").cast("timestamp").cast("long") / 86400)
    spans = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("n"), day.alias("s"), (day + F.col("l_quantity").cast("long")).alias("e"))
    a, b = (spans.select("l_orderkey", F.col("n").alias(x), F.col("s").alias(f"s{x}"), F.col("e").alias(f"e{x}")) for x in "ab")
    return a.join(b, "l_orderkey").where((F.col("a") < F.col("b")) & detection.overlaps("sa", "ea", "sb", "eb")).groupBy("l_orderkey", "a", "b").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, CASE WHEN p_retailprice >= lo AND p_retailprice < hi THEN band END AS band FROM part, (SELECT i AS band, 900.0 + 50 * i AS lo, 950.0 + 50 * i AS hi FROM range(0, 40) t(i)) WHERE p_retailprice >= lo AND p_retailprice < hi")
def point_in_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = spark.range(40).select(F.col("id").alias("band"), (900.0 + 50 * F.col("id")).alias("lo"), (950.0 + 50 * F.col("id")).alias("hi"))
    return table(spark, sf_dir, "part").join(F.broadcast(bands), (F.col("p_retailprice") >= F.col("lo")) & (F.col("p_retailprice") < F.col("hi"))).select("p_partkey", "band")  # 40 rows


@query("SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2")
def last_record_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.last_records(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("""
WITH b AS (SELECT o_orderkey AS path, o_orderstatus AS s FROM orders WHERE o_orderkey % 5 <> 0),
     a AS (SELECT o_orderkey AS path, CASE WHEN o_orderkey % 4 = 0 THEN 'F' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 7 <> 0)
SELECT coalesce(b.s, '(new)') AS before, coalesce(a.s, '(gone)') AS now, count(*) AS n FROM b FULL JOIN a USING (path) GROUP BY 1, 2
""")
def status_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), F.col("o_orderstatus").alias("status"))
    return resolution.transitions(o.where("path % 5 <> 0"), o.where("path % 7 <> 0").withColumn("status", F.when(F.col("path") % 4 == 0, "F").otherwise(F.col("status"))))


@query("""
SELECT user_id, event_id, next_type FROM (SELECT user_id, event_id, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type FROM events) WHERE next_type IS NOT NULL
""")
def next_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    nxt = F.lead("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, sf_dir, "events").select("user_id", "event_id", nxt.alias("next_type")).where("next_type is not null")


@query("""
WITH r AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS here FROM lineitem), g AS (SELECT k, here, lag(here) OVER (PARTITION BY k ORDER BY here) AS before FROM r)
SELECT k, before, here FROM g WHERE before IS NOT NULL AND here <> before + 1
UNION ALL SELECT -1 - conv_id, CAST(before AS INTEGER), CAST(turn AS INTEGER) FROM (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations) WHERE before IS NOT NULL AND turn <> before + 1
""")
def numbering_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).distinct()
    turns = table(spark, sf_dir, "conversations").select((-1 - F.col("conv_id")).alias("k"), F.col("turn").cast("int").alias("n"))
    nodes = lines.unionByName(turns).select(F.col("k").cast("string").alias("parent_path"), F.concat_ws("/", F.col("k").cast("string"), F.col("n").cast("string")).alias("path"), F.col("n").alias("sib_no"), F.col("n").cast("string").alias("label"), F.lit("clause").alias("kind"))
    return evaluation.sibling_gaps(nodes).select(F.split_part("path", F.lit("/"), F.lit(1)).cast("long").alias("k"), "before", "here")


@query("SELECT user_id, count(*) AS n, round(sum(value), 6) AS total, min(ts) AS first_ts FROM events GROUP BY 1")
def user_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"), F.min("ts").alias("first_ts"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


def _streamed(spark: SparkSession, sf_dir: str, build, mode: str = "complete") -> DataFrame:
    from lexweave.operators.concepts import shared_folder

    name = f"lexweave_{uuid.uuid4().hex}"
    return streams.run_to_table(build(streams.read_events(spark, sf_dir)), name, os.path.join(shared_folder(spark), name), mode)


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, streams.tumbling).withColumns({"start": F.col("start").cast("timestamp_ntz"), "total": F.round("total", 6)})


@query("SELECT CAST(time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL (15 * i) MINUTE AS TIMESTAMP) AS start, count(*) AS n FROM events, range(0, 4) t(i) GROUP BY 1")
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, streams.sliding).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""
WITH s AS (SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS new FROM events),
     i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS isle FROM s)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM i GROUP BY user_id, isle
""")
def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.sessions(table(spark, sf_dir, "events"))


@query("""
SELECT l_shipdate AS page, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 3
""")
def slot_repetitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").alias("page")).agg(F.count("*").alias("n")).where(F.col("n") >= layout.REPEATS)


@query("SELECT c_nationkey AS part, list_sort(list(c_acctbal))[1 + (count(*) - 1) // 2] AS low, list_sort(list(c_acctbal))[1 + count(*) // 2] AS high FROM customer GROUP BY 1")
def index_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("part")).agg(layout.lower_median(F.col("c_acctbal")).alias("low"), layout.upper_median(F.col("c_acctbal")).alias("high"))
