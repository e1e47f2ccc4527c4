"""Queries of sampling, scoring, outliers, gates and review."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.functions import text as tx
from lexweave.operators import embeddings, evaluation, tools
from lexweave.plans.catalog import query, table

_CELLS = """
c AS (SELECT c_mktsegment, count(*) AS population FROM customer GROUP BY 1),
t AS (SELECT *, (SELECT count(*) FROM customer) AS total FROM c),
b AS (SELECT *, population * least(40, total) // total AS base, population * least(40, total) % total AS rest, least(40, total) AS want FROM t),
a AS (SELECT c_mktsegment, population, CAST(base + CASE WHEN row_number() OVER (ORDER BY rest DESC, c_mktsegment) <= want - sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS taken FROM b)"""


@query(f"WITH {_CELLS} SELECT * FROM a")
def stratified_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.allocation(table(spark, sf_dir, "customer"), ["c_mktsegment"], 40)


@query(f"WITH {_CELLS} SELECT c_custkey, c_mktsegment FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha1('seed|' || c_mktsegment || '|' || c_custkey), c_custkey) AS n FROM customer JOIN a USING (c_mktsegment)) WHERE n <= taken")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.stratified_sample(table(spark, sf_dir, "customer"), ["c_mktsegment"], 40, "c_custkey", "seed").select("c_custkey", "c_mktsegment")


@query("""
SELECT lang, count(*) FILTER (wanted = found) AS tp, count(*) FILTER (found IS NOT NULL AND found IS DISTINCT FROM wanted) AS fp,
       count(*) FILTER (wanted IS NOT NULL AND found IS DISTINCT FROM wanted) AS fn,
       CAST(count(*) FILTER (found IS NOT NULL AND found IS DISTINCT FROM wanted) + 3 * count(*) FILTER (wanted IS NOT NULL AND found IS DISTINCT FROM wanted) AS DOUBLE) AS cost
FROM (SELECT lang, CASE WHEN quality = 1 THEN 'good' END AS wanted, CASE WHEN n_chars > 1000 THEN 'good' END AS found FROM documents JOIN labels USING (doc_id)) GROUP BY 1
""")
def confusion_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return evaluation.confusion(rows.select("lang", F.when(F.col("quality") == 1, "good").alias("wanted"), F.when(F.col("n_chars") > 1000, "good").alias("found")), "lang")


@query("""
SELECT resolver, bucket, decisions, stated, observed, stated - observed > 0.1 AS overconfident FROM (
  SELECT source AS resolver, CAST(least(floor(score * 10), 9) AS INTEGER) AS bucket, count(*) AS decisions, round(avg(score), 6) AS stated, round(avg(quality), 6) AS observed
  FROM (SELECT source, least(n_chars, 1023) / 1024 AS score, quality FROM documents JOIN labels USING (doc_id)) GROUP BY 1, 2)
""")
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return evaluation.calibration(rows.select(F.col("source").alias("resolver"), (F.least("n_chars", F.lit(1023)) / 1024).alias("confidence"), (F.col("quality") == 1).alias("correct")))


@query("""
WITH v AS (SELECT 'orders' AS name, c_nationkey AS part, CAST(count(*) AS DOUBLE) AS value FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 2),
     m AS (SELECT *, (SELECT list_sort(list(value))[1 + count(*) // 2] FROM v) AS median FROM v),
     d AS (SELECT *, (SELECT list_sort(list(abs(value - median)))[1 + count(*) // 2] FROM m) AS mad FROM m)
SELECT name, part, value, median, mad, CASE WHEN mad > 0 THEN round(0.6745 * (value - median) / mad, 6) END AS z,
       (SELECT count(*) FROM v) >= 4 AND abs(coalesce(CASE WHEN mad > 0 THEN round(0.6745 * (value - median) / mad, 6) END, 0)) > 3.5 AS outlier FROM d
""")
def mad_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("part")).agg(F.count("*").cast("double").alias("value"))
    return evaluation.mad_outliers(rows.select(F.lit("orders").alias("name"), "part", "value"))


@query("""
WITH m(name, value) AS (SELECT 'reference_precision_min', (SELECT avg(quality) FROM labels) UNION ALL SELECT 'detection_recall_min', NULL
  UNION ALL SELECT 'wrongly_resolved_unresolvables_max', CAST((SELECT count(*) FROM labels WHERE quality > 1) AS DOUBLE) UNION ALL SELECT 'structural_violations_unexplained_max', CAST((SELECT count(*) FROM labels WHERE toxic = 1) AS DOUBLE)),
g(name, op, threshold) AS (VALUES ('reference_precision_min', '>=', 0.9), ('wrongly_resolved_unresolvables_max', '<=', 0.0), ('structural_violations_unexplained_max', '<=', 0.0), ('detection_recall_min', '>=', 0.95), ('stratified_audit_agreement_min', '>=', 0.9))
SELECT name, CAST(threshold AS DOUBLE) AS threshold, round(value, 6) AS value, CASE WHEN value IS NULL THEN 'skipped' WHEN (op = '>=' AND value >= threshold) OR (op = '<=' AND value <= threshold) THEN 'pass' ELSE 'fail' END AS status FROM g LEFT JOIN m USING (name)
""")
def gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    one = labels.agg(F.avg("quality").alias("a"), F.count_if(F.col("quality") > 1).cast("double").alias("b"), F.count_if(F.col("toxic") == 1).cast("double").alias("c"))
    metrics = one.selectExpr("stack(4, 'reference_precision_min', a, 'detection_recall_min', cast(null as double), 'wrongly_resolved_unresolvables_max', b, 'structural_violations_unexplained_max', c) as (name, value)")
    return evaluation.gates(metrics).withColumn("value", F.round("value", 6))


@query("SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), (o_orderstatus, o_orderpriority), ())")
def grouping_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("lexweave_orders")
    return spark.sql("SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n FROM lexweave_orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), (o_orderstatus, o_orderpriority), ())")


@query("""
WITH q AS (SELECT 'ref' AS kind, CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT 'term', CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'error' UNION ALL SELECT 'anomaly', CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 0),
     d AS (SELECT 'ref' AS kind, CAST(l_orderkey AS VARCHAR) AS id, arg_max(l_linestatus, (l_shipdate, l_linenumber, l_linestatus)) AS verdict FROM lineitem GROUP BY 2)
SELECT kind, id, verdict FROM q LEFT JOIN d USING (kind, id)
""")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = lambda t, cond, kind, key: table(spark, sf_dir, t).where(cond).select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"))
    rows = item("orders", "o_orderstatus = 'P'", "ref", "o_orderkey").unionByName(item("events", "event_type = 'error'", "term", "event_id")).unionByName(item("labels", "quality = 0", "anomaly", "doc_id"))
    last = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("id")).agg(F.max_by("l_linestatus", F.struct("l_shipdate", "l_linenumber", "l_linestatus")).alias("verdict")).withColumn("kind", F.lit("ref"))
    return rows.join(last, ["kind", "id"], "left").select("kind", "id", "verdict")


@query("""
WITH f AS (SELECT 'p' || n_nationkey AS path, CAST(n_regionkey AS VARCHAR) AS page FROM nation),
     a AS (SELECT c_custkey AS answer_id, 'p' || (c_custkey % 30) AS path, CASE WHEN c_custkey % 9 = 0 THEN 'x' ELSE CAST(c_custkey % 5 AS VARCHAR) END AS page FROM customer)
SELECT a.*, CASE WHEN NOT EXISTS (SELECT 1 FROM f WHERE f.path = a.path) THEN 'unknown_path' WHEN page = 'x' THEN 'page_unparseable' WHEN EXISTS (SELECT 1 FROM f WHERE f.path = a.path AND f.page = a.page) THEN 'ok' ELSE 'page_mismatch' END AS status FROM a
""")
def citation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "nation").select(F.concat(F.lit("p"), F.col("n_nationkey").cast("string")).alias("path"), F.col("n_regionkey").alias("page"))
    page = F.when(F.col("c_custkey") % 9 == 0, "x").otherwise((F.col("c_custkey") % 5).cast("string"))
    text = F.concat(F.lit("As stated in [[p"), (F.col("c_custkey") % 30).cast("string"), F.lit("|"), page, F.lit("]], it holds."))
    return tools.verify_citations(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("answer_id"), text.alias("text")), facts)


@query("""
WITH q AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 50 = 0),
     s AS (SELECT q.vec_id AS query, e.vec_id AS id, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS c FROM q JOIN embeddings e ON e.vec_id <> q.vec_id)
SELECT query, id, round(c, 6) AS score, CAST(row_number() OVER (PARTITION BY query ORDER BY round(c, 9) DESC, id) AS INTEGER) AS rank FROM s QUALIFY row_number() OVER (PARTITION BY query ORDER BY round(c, 9) DESC, id) <= 5
""")
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    queries = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("vector"))
    return embeddings.nearest(queries, e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), 5).select("query", "id", F.round("score", 6).alias("score"), "rank")


@query("SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST((SELECT embedding FROM embeddings WHERE vec_id = 0) AS DOUBLE[])), 6) AS cosine FROM embeddings")
def cosine_to_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    first = e.where("vec_id = 0").select(F.col("embedding").alias("v"))
    return e.crossJoin(F.broadcast(first)).select("vec_id", F.round(tx.cosine("embedding", "v"), 6).alias("cosine"))  # one row


@query("""
WITH f AS (SELECT DISTINCT source, lang FROM documents WHERE n_chars > 3000), w AS (SELECT DISTINCT source, lang FROM documents WHERE doc_id % 3 = 0)
SELECT count(*) FILTER (f.source IS NOT NULL AND w.source IS NOT NULL) AS tp, count(f.source) AS n_found, count(w.source) AS n_wanted,
       round(count(*) FILTER (f.source IS NOT NULL AND w.source IS NOT NULL) / count(f.source), 6) AS precision, round(count(*) FILTER (f.source IS NOT NULL AND w.source IS NOT NULL) / count(w.source), 6) AS recall
FROM f FULL JOIN w ON f.source = w.source AND f.lang = w.lang
""")
def precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    t = evaluation.precision_recall(d.where("n_chars > 3000"), d.where("doc_id % 3 = 0"), "source", "lang")
    return t.select(F.col("tp").cast("long").alias("tp"), "n_found", "n_wanted", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query("""
WITH g AS (SELECT n_nationkey AS gk, 100 + 10 * n_nationkey AS gs, 105 + 10 * n_nationkey AS ge FROM nation WHERE n_nationkey % 4 <> 3),
     f AS (SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'g' ELSE 'f' END || n_nationkey AS found_id, 101 + 10 * n_nationkey AS fs, 106 + 10 * n_nationkey AS fe FROM nation)
SELECT 'g' || gk AS given_id, found_id, CASE WHEN gk % 2 = 0 THEN 'id' ELSE 'overlap' END AS how, CAST(fs - gs AS INTEGER) AS start_delta, CAST(fe - ge AS INTEGER) AS end_delta FROM g JOIN f ON CAST(substr(found_id, 2) AS INTEGER) = gk
""")
def page_map_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    given = n.where("n_nationkey % 4 <> 3").selectExpr("concat('g', n_nationkey) as part_id", "100 + 10 * n_nationkey as page_start", "105 + 10 * n_nationkey as page_end")
    found = n.selectExpr("concat(if(n_nationkey % 2 = 0, 'g', 'f'), n_nationkey) as part_id", "101 + 10 * n_nationkey as page_start", "106 + 10 * n_nationkey as page_end")
    return evaluation.page_map_diff(found, given)


@query("SELECT count(*) AS asked, count(*) FILTER (v IN ('correct', 'wrong')) AS usable, count(*) FILTER (v = 'correct') AS agreed, CAST(count(*) FILTER (i % 2 = 0) AS BIGINT) AS duplicates, round(count(*) FILTER (v = 'correct') / count(*) FILTER (v IN ('correct', 'wrong')), 6) AS rate FROM (SELECT c_custkey AS i, CASE WHEN c_custkey % 10 = 0 THEN 'unsure' WHEN c_acctbal > 0 THEN 'correct' ELSE 'wrong' END AS v FROM customer)")
def audit_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey as index", "case when c_custkey % 10 = 0 then 'unsure' when c_acctbal > 0 then 'correct' else 'wrong' end as verdict", "0 as nr")
    again = c.where("index % 2 = 0").selectExpr("index", "'wrong' as verdict", "1 as nr")
    return evaluation.agreement(c.unionByName(again), c).withColumn("rate", F.round("rate", 6))
