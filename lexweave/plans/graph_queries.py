"""Queries of the graph load over the driver's tables: salience, furniture, edges, loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexweave.functions import ids
from lexweave.operators import concepts, graph
from lexweave.plans.catalog import query, table


def _salience_sql(cited: str, kinds: str) -> str:
    return f"""
WITH f AS (SELECT target, count(*) AS frequency, count(DISTINCT citing_part) AS breadth FROM ({cited}) GROUP BY 1),
     m AS (SELECT kind, avg(frequency) AS mu, stddev_pop(frequency) AS sd, count(*) AS n FROM f JOIN ({kinds}) USING (target) GROUP BY 1)
SELECT target, kind, coalesce(frequency, 0) AS frequency, coalesce(breadth, 0) AS breadth,
       coalesce(round(breadth * ln(1 + frequency), 6), 0.0) AS salience,
       coalesce(n >= 3 AND sd > 0 AND frequency > mu + 4.0 * sd, false) AS flagged
FROM ({kinds}) LEFT JOIN f USING (target) LEFT JOIN m USING (kind)
"""


@query(_salience_sql("SELECT l_partkey AS target, l_suppkey AS citing_part FROM lineitem", "SELECT p_partkey AS target, p_brand AS kind FROM part"))
def salience_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cites = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("target"), F.col("l_suppkey").alias("citing_part"))
    return graph.salience(cites, table(spark, sf_dir, "part").select(F.col("p_partkey").alias("target"), F.col("p_brand").alias("kind")))


@query(_salience_sql("SELECT unnest(string_split(p_name, ' ')) AS target, p_brand AS citing_part FROM part", "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS target, 'term' AS kind FROM part"))
def salience_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("target"), F.col("p_brand").alias("citing_part"))
    return graph.salience(words, words.select("target").distinct().withColumn("kind", F.lit("term")))


@query("""
SELECT sha1(line) AS content_hash, count(*) AS n, count(DISTINCT source) AS parts
FROM (SELECT trim(unnest(string_split(text, chr(10)))) AS line, source FROM documents) WHERE line <> ''
GROUP BY 1 HAVING count(*) >= 3 AND count(DISTINCT source) >= 2
""")
def furniture_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"), "source").select(F.trim("line").alias("line"), "source").where("line <> ''")
    rows = lines.select(F.sha1("line").alias("content_hash"), "source").groupBy("content_hash").agg(F.count("*").alias("n"), F.count_distinct("source").alias("parts"))
    return rows.where((F.col("n") >= graph.REPEATS) & (F.col("parts") >= graph.PARTS))


_NORMAL = "regexp_replace(array_to_string([trim(regexp_replace(x, '[ \\t\\x0B\\f\\r]+', ' ', 'g')) FOR x IN string_split(nfc_normalize(text), chr(10))], chr(10)), '^\\s+|\\s+$', '', 'g')"


@query(f"SELECT sha1({_NORMAL}) AS content_hash, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def content_hash_dupes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", ids.content_hash("text").alias("content_hash"))
    return rows.groupBy("content_hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("""
SELECT 'CONTAINS' AS type, 'r' || r_regionkey AS src, 'n' || n_nationkey AS dst FROM region JOIN nation ON n_regionkey = r_regionkey
UNION ALL SELECT 'CONTAINS', 'n' || c_nationkey, 'c' || c_custkey FROM customer
UNION ALL SELECT 'CONTAINS', 'c' || o_custkey, 'o' || o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey
""")
def containment_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    t = {n: table(spark, sf_dir, n) for n in ("nation", "customer", "orders")}
    nodes = (
        t["nation"].select(F.concat_ws("/", key("r", "n_regionkey"), key("n", "n_nationkey")).alias("path"), key("r", "n_regionkey").alias("parent_path"), key("n", "n_nationkey").alias("id"))
        .unionByName(table(spark, sf_dir, "region").select(key("r", "r_regionkey").alias("path"), F.lit(None).cast("string").alias("parent_path"), key("r", "r_regionkey").alias("id")))
    )
    top = graph.contains_edges(nodes).select("type", "src", "dst")
    mid = t["customer"].select(F.lit("CONTAINS").alias("type"), key("n", "c_nationkey").alias("src"), key("c", "c_custkey").alias("dst"))
    low = t["orders"].join(t["customer"].select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi").select(F.lit("CONTAINS").alias("type"), key("c", "o_custkey").alias("src"), key("o", "o_orderkey").alias("dst"))
    return top.unionByName(mid).unionByName(low)


@query("""
SELECT 'NEXT' AS type, src, dst FROM (
  SELECT l_orderkey || '-' || l_linenumber AS src, lead(l_orderkey || '-' || l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS dst
  FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) WHERE dst IS NOT NULL
""")
def next_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    name = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    nodes = own.select(name.alias("id"), name.alias("path"), F.col("l_orderkey").cast("string").alias("parent_path"), F.col("l_linenumber").alias("sib_no"), F.lit("item").alias("kind"))
    return graph.next_edges(nodes).select("type", "src", "dst")


@query("""
SELECT 'SUPPLIED_BY' AS type, l_suppkey AS dst, CASE WHEN s_suppkey IS NULL THEN 'dst' ELSE '' END AS missing, count(*) AS n
FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20) ON l_suppkey = s_suppkey GROUP BY ALL
""")
def deferred_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "lineitem").select(F.lit("SUPPLIED_BY").alias("type"), F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("src"), F.col("l_suppkey").cast("string").alias("dst"))
    keys = table(spark, sf_dir, "supplier").where("s_nationkey < 20").select(F.col("s_suppkey").cast("string").alias("key")).unionByName(edges.select(F.col("src").alias("key")).distinct())
    ok, later = graph.writable_and_deferred(edges, keys)
    both = ok.withColumn("missing", F.lit("")).unionByName(later)
    return both.groupBy("type", F.col("dst").cast("long").alias("dst"), "missing").agg(F.count("*").alias("n"))


@query("SELECT 'ORDERED_BY' AS type, 'dst' AS side, CAST(o_custkey AS VARCHAR) AS key, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY ALL")
def dangling_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "orders").select(F.lit("ORDERED_BY").alias("type"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("src"), F.col("o_custkey").cast("string").alias("dst"))
    held = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").cast("string").alias("key"))
    return graph.dangling(edges, held.unionByName(edges.select(F.col("src").alias("key"))))


def _order_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders and customers as nodes, ordered-by edges; the batch is the order's number modulo 4."""
    o = table(spark, sf_dir, "orders")
    batch = F.concat(F.lit("B"), (F.col("o_orderkey") % 4).cast("string"))
    orders = o.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"), F.concat(F.lit("s"), (F.col("o_orderkey") % 3).cast("string"), F.lit("/o"), F.col("o_orderkey").cast("string")).alias("path"), batch.alias("batch_id"))
    people = o.groupBy("o_custkey").agg(F.min(batch).alias("batch_id")).select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("id"), F.lit("").alias("path"), "batch_id")
    edges = o.select(F.lit("ORDERED_BY").alias("type"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("src"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("dst"), batch.alias("batch_id"))
    return orders.unionByName(people), edges, people.select("id")


@query("""
WITH own AS (SELECT o_custkey, min(o_orderkey % 4) AS b, bool_or(o_orderkey % 4 <> 0) AS touched FROM orders GROUP BY 1)
SELECT 'nodes' AS what, (SELECT count(*) FROM orders WHERE o_orderkey % 4 <> 0) + (SELECT count(*) FROM own WHERE b <> 0 OR touched) AS n
UNION ALL SELECT 'edges', count(*) FROM orders WHERE o_orderkey % 4 <> 0
UNION ALL SELECT 'kept', count(*) FROM own WHERE b = 0 AND touched
""")
def rollback_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest, edges, kept = graph.rollback(*_order_graph(spark, sf_dir)[:2], "B0", _order_graph(spark, sf_dir)[2])
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
    return count(rest, "nodes").unionByName(count(edges, "edges")).unionByName(count(kept, "kept"))


@query("""
SELECT 'o' || o_orderkey AS id FROM orders WHERE NOT (o_orderkey % 3 = 1 AND o_orderkey % 4 <> 1)
""")
def sweep_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges, people = _order_graph(spark, sf_dir)
    kept, _ = graph.sweep(nodes.withColumnRenamed("batch_id", "load_id"), edges.withColumnRenamed("batch_id", "load_id"), ["s1"], "B1", people)
    return kept.where("path <> ''").select("id")


@query("""
SELECT c_custkey AS lineage_key, CASE WHEN c_custkey % 11 = 0 THEN 'removed' WHEN c_custkey % 7 = 0 THEN 'changed' ELSE 'unchanged' END AS change FROM customer
UNION ALL SELECT -1 - c_custkey, 'added' FROM customer WHERE c_custkey % 13 = 0
""")
def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    old = c.select(F.col("c_custkey").alias("lineage_key"), F.sha1("c_name").alias("content_hash"))
    new = c.where("c_custkey % 11 <> 0").select(F.col("c_custkey").alias("lineage_key"), F.sha1(F.when(F.col("c_custkey") % 7 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name"))).alias("content_hash"))
    return graph.version_diff(old, new.unionByName(c.where("c_custkey % 13 = 0").select((-1 - F.col("c_custkey")).alias("lineage_key"), F.sha1("c_name").alias("content_hash"))))


@query("""
WITH m AS (SELECT DISTINCT c_mktsegment AS concept, o_orderkey AS node FROM orders JOIN customer ON c_custkey = o_custkey),
     h AS (SELECT concept, count(*) AS n_held FROM m GROUP BY 1),
     u AS (SELECT DISTINCT l_orderkey AS node, p_type AS term FROM lineitem JOIN part ON p_partkey = l_partkey),
     s AS (SELECT concept, term, count(*) AS n_using FROM m JOIN u USING (node) GROUP BY 1, 2)
SELECT concept, term, n_using, n_held, round(CAST(n_using AS DOUBLE) / n_held, 4) AS share FROM s JOIN h USING (concept) WHERE round(CAST(n_using AS DOUBLE) / n_held, 4) >= 0.05
""")
def associated_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_mktsegment").alias("concept"), F.col("o_orderkey").alias("node"))
    uses = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("node"), F.col("p_type").alias("term"))
    return graph.associated_terms(members, uses, 0.05).select("concept", "term", "n_using", "n_held", "share")


@query("""
SELECT coalesce(n.k, o.c_custkey) AS k, coalesce(n.segment, o.c_mktsegment) AS segment, coalesce(n.balance, o.c_acctbal) AS balance,
       CASE WHEN o.c_custkey IS NULL THEN 'B2' ELSE 'B1' END AS first_batch_id, CASE WHEN n.k IS NULL THEN 'B1' ELSE 'B2' END AS batch_id
FROM (SELECT * FROM customer WHERE c_custkey % 3 <> 0) o
FULL JOIN (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) END AS segment, c_acctbal AS balance FROM customer WHERE c_custkey % 5 = 0) n ON n.k = o.c_custkey
""")
def load_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    old = c.where("k % 3 <> 0").withColumns({"batch_id": F.lit("B1"), "first_batch_id": F.lit("B1"), "load_id": F.lit("l1")})
    new = c.where("k % 5 = 0").withColumn("segment", F.when(F.col("k") % 2 == 0, F.lower("segment")))
    return graph.overlay(old, new, ["k"], "B2", "l2").drop("load_id")


@query("""
SELECT 'total' AS what, 'nodes' AS name, (SELECT count(*) FROM customer) AS n UNION ALL SELECT 'total', 'edges', (SELECT count(*) FROM orders)
UNION ALL SELECT 'node', c_mktsegment, count(*) FROM customer GROUP BY ALL UNION ALL SELECT 'edge', o_orderpriority, count(*) FROM orders GROUP BY ALL
""")
def graph_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.graph_counts(table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "kind"), table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "type"))


@query("SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL HAVING count(*) > 1")
def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.key_violations(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment")


@query("""
WITH e AS (SELECT o_custkey AS src, o_orderpriority AS dst, o_orderkey AS nr FROM orders)
SELECT src, dst, count(*) AS n, arg_max(nr, nr) AS last FROM e GROUP BY 1, 2
""")
def edge_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "orders").select(*graph.edge("HAS", F.col("o_custkey"), F.col("o_orderpriority"), last="o_orderkey"), F.col("o_orderkey").alias("nr"))
    return graph.deduplicated(edges).select("src", "dst", "n", F.element_at("props", "last").cast("long").alias("last"))


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS root FROM documents QUALIFY count(*) OVER (PARTITION BY text) > 1")
def dup_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    before = F.lag("doc_id").over(Window.partitionBy("h").orderBy("doc_id"))
    pairs = rows.withColumn("a", before).where("a is not null").select("a", F.col("doc_id").alias("b"))
    return concepts.components(pairs).select(F.col("id").alias("doc_id"), "root")


@query("""
SELECT 'nodes' AS name, 3 * (SELECT count(*) FROM region) AS expected, (SELECT count(*) FROM nation) AS written, 3 * (SELECT count(*) FROM region) = (SELECT count(*) FROM nation) AS ok
UNION ALL SELECT 'edges', (SELECT count(*) FROM nation), (SELECT count(*) FROM nation), true
""")
def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda t, name, k=1: table(spark, sf_dir, t).agg((F.count("*") * k).alias("n")).select(F.lit(name).alias("name"), "n")
    return graph.reconciled(n("region", "nodes", 3).unionByName(n("nation", "edges")), n("nation", "nodes").unionByName(n("nation", "edges")))
