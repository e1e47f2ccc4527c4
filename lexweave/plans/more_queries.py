"""Queries that bind further operators to the driver's tables: vocabularies, scopes, layouts, caches, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.functions import ids
from lexweave.operators import concepts, embeddings, evaluation, graph, layout, resolution, tools, vocabulary
from lexweave.plans import tree_queries
from lexweave.plans.catalog import query, table


@query("""
WITH n AS (SELECT conv_id, turn, 'c' || conv_id AS part, CASE WHEN turn % 3 = 0 THEN 'In each Contract ' || turn ELSE 'plain' END AS text FROM conversations)
SELECT conv_id, turn, last_value(CASE WHEN turn % 3 = 0 THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cue FROM n
""")
def nearest_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    path = F.concat_ws("/", F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("s"), F.col("turn").cast("string"))
    text = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("In each Contract "), F.col("turn").cast("string"))).otherwise("plain")
    nodes = c.select(path.alias("path"), F.col("turn").alias("ord"), text.alias("text"), F.lit(None).cast("string").alias("title"), F.lit("clause").alias("kind"))
    cues = vocabulary.nearest_cues(nodes)
    return cues.select(F.expr("cast(substring(split_part(path, '/', 1), 2) as bigint)").alias("conv_id"), F.expr("cast(split_part(path, '/', 3) as bigint)").alias("turn"), "cue")


@query("""
WITH s AS (SELECT 'r' || r_regionkey AS scope FROM region WHERE r_regionkey < 3 UNION ALL SELECT 'r' || n_regionkey || '/n' || n_nationkey FROM nation WHERE n_nationkey % 2 = 0),
     u AS (SELECT 'r' || n_regionkey || '/n' || n_nationkey || '/c' || c_custkey AS path FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT path, coalesce((SELECT 'part:' || arg_max(scope, length(scope)) FROM s WHERE starts_with(path, scope || '/')), 'document') AS scope FROM u
""")
def governing_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = tree_queries.nodes(spark, sf_dir)
    uses = nodes.where(F.col("path").contains("/c")).select(F.lit("t").alias("term"), "path")
    number = F.regexp_extract("path", r"(\d+)$", 1).cast("int")
    own = nodes.where(~F.col("path").contains("/c")).where((F.col("path").contains("/n") & (number % 2 == 0)) | (~F.col("path").contains("/") & (number < 3)))
    sites = own.select(F.lit("t").alias("term"), F.concat(F.lit("part:"), "path").alias("scope"), F.col("path").alias("definition_node_id"))
    every = sites.unionByName(spark.createDataFrame([("t", "document", "d")], "term string, scope string, definition_node_id string"))
    return vocabulary.governing_scopes(uses, every).select("path", "scope")


@query("""
WITH w AS (SELECT DISTINCT p_name AS l FROM part UNION SELECT DISTINCT string_split(p_name, ' ')[1] FROM part), p AS (SELECT l, unnest(string_split(l, ' ')) AS x FROM w)
SELECT DISTINCT a.l AS a, b.l AS b FROM p a JOIN p b USING (x) WHERE a.l < b.l AND (list_has_all(string_split(a.l, ' '), string_split(b.l, ' ')) OR list_has_all(string_split(b.l, ' '), string_split(a.l, ' ')))
""")
def similar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    names = p.select(F.col("p_name").alias("id")).union(p.select(F.split_part("p_name", F.lit(" "), F.lit(1)))).distinct()
    return concepts.similar_pairs(names.withColumn("label", F.col("id")))


@query("""
WITH t AS (SELECT DISTINCT text FROM documents), c AS (SELECT DISTINCT sha1('m|' || text) AS k FROM documents WHERE doc_id % 3 = 0)
SELECT 'hit' AS side, count(*) AS n FROM t WHERE sha1('m|' || text) IN (SELECT k FROM c) UNION ALL SELECT 'owed', count(*) FROM t WHERE sha1('m|' || text) NOT IN (SELECT k FROM c)
""")
def cache_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    cache = d.where("doc_id % 3 = 0").select(ids.vector_key(F.lit("m"), "text").alias("vector_ref"), F.array(F.lit(1.0)).alias("vector")).dropDuplicates(["vector_ref"])
    hit, owed = embeddings.cache_split(d, cache, "m")
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("side"), "n")
    return count(hit, "hit").unionByName(count(owed, "owed"))


@query("""
WITH t AS (SELECT o_custkey AS part, o_orderkey AS idx, CAST(o_orderkey % 50 AS INTEGER) AS page_start, CAST(o_orderkey % 50 AS INTEGER) AS page_end, CAST(o_orderkey % 2 AS INTEGER) AS n_cols, CAST(1 + o_orderkey % 4 AS BIGINT) AS n_rows FROM orders),
     j AS (SELECT *, CASE WHEN page_start = lag(page_end) OVER w + 1 AND n_cols = lag(n_cols) OVER w THEN 0 ELSE 1 END AS new FROM t WINDOW w AS (PARTITION BY part ORDER BY idx)),
     c AS (SELECT *, sum(new) OVER (PARTITION BY part ORDER BY idx ROWS UNBOUNDED PRECEDING) AS chain FROM j)
SELECT part, idx, CAST(chain AS BIGINT) AS chain, CAST(coalesce(sum(n_rows) OVER (PARTITION BY part, chain ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS row_offset FROM c
""")
def stitched_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = (F.col("o_orderkey") % 50).cast("int")
    t = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("part"), F.col("o_orderkey").alias("idx"), page.alias("page_start"), page.alias("page_end"), (F.col("o_orderkey") % 2).cast("int").alias("n_cols"), (1 + F.col("o_orderkey") % 4).alias("n_rows"))
    return layout.stitched_tables(t).select("part", "idx", "chain", "row_offset")


@query("""
SELECT regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '\\d+', '#', 'g') AS key, count(DISTINCT page) AS pages
FROM (SELECT doc_id % 40 AS page, unnest(string_split(text, chr(10))) AS text FROM documents) WHERE trim(text) <> '' GROUP BY 1 HAVING count(DISTINCT page) >= 3
""")
def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select((F.col("doc_id") % 40).alias("page"), F.posexplode(F.split("text", "\n")).alias("line_no", "text")).where("trim(text) <> ''")
    placed = lines.withColumns({"x0": F.lit(50.0), "x1": F.lit(400.0), "y0": F.lit(10.0), "y1": F.lit(20.0)})
    pages = placed.select("page").distinct().withColumn("height", F.lit(842.0))
    return layout.repetitions(placed, pages).where(F.col("pages") >= layout.REPEATS).where(~F.col("key").startswith("header:"))


@query("""
WITH s AS (SELECT conv_id, turn, 'p' || (turn // 2 % 3) AS t FROM conversations),
     o AS (SELECT conv_id, t, CAST(row_number() OVER w AS INTEGER) AS page, CASE WHEN t IS DISTINCT FROM lag(t) OVER w THEN 1 ELSE 0 END AS new FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
     i AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY page) AS isle FROM o), r AS (SELECT conv_id, t, min(page) AS page_start, max(page) AS page_end FROM i GROUP BY conv_id, isle, t)
SELECT conv_id, CASE WHEN n = 1 THEN t ELSE t || '-' || n END AS part_id, page_start, page_end FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, t ORDER BY page_start) AS n FROM r)
""")
def page_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation is a document, each turn a page."""
    from pyspark.sql.window import Window

    none = F.lit(None).cast("string")
    page = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
    title = F.concat(F.lit("p"), (F.floor(F.col("turn") / 2) % 3).cast("string"))
    pages = table(spark, sf_dir, "conversations").select("conv_id", page.alias("page"), title.alias("title"), none.alias("header_version"), none.alias("model_version"))
    return layout.detect_parts(pages, ("conv_id",)).select("conv_id", "part_id", "page_start", "page_end")


@query("""
WITH l AS (SELECT user_id AS k, CAST(event_id % 1000 AS INTEGER) AS s, CAST(event_id % 1000 + 30 AS INTEGER) AS e FROM events WHERE event_type = 'signup'),
     f AS (SELECT user_id AS k, CAST(event_id % 1000 AS INTEGER) AS s, CAST(event_id % 1000 + 20 AS INTEGER) AS e, event_type AS found FROM events WHERE event_type <> 'signup'),
     h AS (SELECT l.k, l.s, l.e, f.s AS fs, f.e AS fe, found, row_number() OVER (PARTITION BY l.k, l.s, l.e ORDER BY least(l.e, f.e) - greatest(l.s, f.s) DESC, f.s, f.e) AS n FROM (SELECT DISTINCT * FROM l) l JOIN (SELECT k, s, e, min(found) AS found FROM f GROUP BY 1, 2, 3) f ON l.k = f.k AND f.s < l.e AND l.s < f.e)
SELECT l.k, l.s AS start, l.e AS "end", fs, fe, found FROM (SELECT DISTINCT * FROM l) l LEFT JOIN h ON h.k = l.k AND h.s = l.s AND h.e = l.e AND h.n = 1
""")
def best_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    at = (F.col("event_id") % 1000).cast("int")
    labels = e.where("event_type = 'signup'").select(F.col("user_id").alias("k"), at.alias("start"), (at + 30).alias("end")).distinct()
    found = e.where("event_type <> 'signup'").select(F.col("user_id").alias("k"), at.alias("start"), (at + 20).alias("end"), F.col("event_type").alias("found")).groupBy("k", "start", "end").agg(F.min("found").alias("found"))
    return evaluation.overlapping_best(labels, found, ["k"])


@query("""
WITH r AS (SELECT 's' || (l_suppkey % 10) AS part, l_partkey % 200 AS t FROM lineitem WHERE l_returnflag = 'R')
SELECT 'legislation/' || t AS statute, count(DISTINCT part) AS n_parts, count(*) AS n FROM r GROUP BY 1
""")
def citing_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.lit("external").alias("status"), F.concat(F.lit("s"), (F.col("l_suppkey") % 10).cast("string")).alias("part"), F.concat(F.lit("legislation/"), (F.col("l_partkey") % 200).cast("string")).alias("target_path"))
    return tools.citing_parts(refs).select("statute", F.size("parts").cast("long").alias("n_parts"), "n")


@query("""
WITH n AS (SELECT CAST(doc_id AS VARCHAR) AS id, sha1(text) AS h, source AS part, text FROM documents),
     f AS (SELECT h FROM n GROUP BY 1 HAVING count(*) >= 3 AND count(DISTINCT part) >= 2)
SELECT id FROM n WHERE h IN (SELECT h FROM f) OR regexp_full_match(text, '\\s*\\[[^\\]]{1,80}\\]\\s*')
""")
def furniture_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), F.sha1("text").alias("content_hash"), "text")
    return graph.furniture(nodes)


@query("""
SELECT 'r' || c_nationkey AS part, label, min(c_custkey) AS first FROM (SELECT *, CAST(c_custkey % 7 AS VARCHAR) AS label FROM customer) GROUP BY 1, 2
""")
def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    part = F.concat(F.lit("r"), F.col("c_nationkey").cast("string"))
    nodes = c.select(F.concat_ws("/", part, F.col("c_custkey").cast("string")).alias("path"), part.alias("parent_path"), F.lit("clause").alias("kind"), (F.col("c_custkey") % 7).cast("string").alias("label"), F.lit(None).cast("string").alias("title"), F.col("c_custkey").alias("ord"))
    return resolution.label_index(nodes).where("ns = '*'").select("part", "label", F.split_part("path", F.lit("/"), F.lit(2)).cast("long").alias("first"))


@query("""
WITH c AS (SELECT CAST(o_orderkey AS VARCHAR) AS payload FROM orders), d AS (SELECT sha1('t|1|' || CAST(o_orderkey AS VARCHAR)) AS k, CASE WHEN o_orderkey % 4 = 0 THEN 'e' END AS error FROM orders WHERE o_orderkey % 2 = 0)
SELECT CASE WHEN sha1('t|1|' || payload) IN (SELECT k FROM d WHERE error IS NULL) THEN 'known' ELSE 'owed' END AS side, count(*) AS n FROM c GROUP BY 1
""")
def replay_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexweave.sources import tables

    o = table(spark, sf_dir, "orders")
    calls = o.select(F.lit("t").alias("task"), F.lit("1").alias("version"), F.col("o_orderkey").cast("string").alias("payload"))
    cache = o.where("o_orderkey % 2 = 0").select(tables.replay_key(F.lit("t"), F.lit("1"), F.col("o_orderkey").cast("string")).alias("key"), F.lit("r").alias("reply"), F.when(F.col("o_orderkey") % 4 == 0, "e").alias("error"))
    known, owed = tables.replay_split(calls, cache)
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("side"), "n")
    return count(known, "known").unionByName(count(owed, "owed"))


@query("""
WITH v AS (SELECT c_custkey AS path, 'left' AS "check", CASE WHEN c_custkey % 2 = 0 THEN 'a' ELSE 'b' END AS kind, c_nationkey AS parent FROM customer WHERE c_acctbal < 0 OR c_custkey % 2 = 0)
SELECT kind, count(*) AS hits, count(*) >= 3 AND count(*) >= 0.8 * (SELECT count(*) FROM customer c WHERE (c.c_custkey % 2 = 0) = (kind = 'a')) AS systematic FROM v GROUP BY kind
""")
def systematic(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    kind = F.when(F.col("c_custkey") % 2 == 0, "a").otherwise("b")
    kids = c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("path"), kind.alias("kind"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("parent_path"), "c_acctbal")
    tops = kids.select(F.col("parent_path").alias("path")).distinct().select("path", F.lit("part").alias("kind"), F.lit(None).cast("string").alias("parent_path"))
    v = kids.where("c_acctbal < 0 or kind = 'a'").select(F.lit("left").alias("check"), "path")
    tested = kids.groupBy("kind").agg(F.count("*").alias("tested")).select(F.lit("left").alias("check"), F.lit("part").alias("parent_kind"), "kind", "tested")
    found = evaluation.systematic(v, tested, kids.drop("c_acctbal").unionByName(tops))
    return found.groupBy("kind").agg(F.count("*").alias("hits"), F.bool_and("systematic").alias("systematic"))
