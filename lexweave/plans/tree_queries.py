"""Queries of hierarchies: region / nation / customer / order as a tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.operators import tree
from lexweave.plans.catalog import query, table

_PATHS = """
p AS (SELECT 'r' || r_regionkey AS path, r_regionkey AS sib_no, r_name AS text FROM region
 UNION ALL SELECT 'r' || n_regionkey || '/n' || n_nationkey, n_nationkey, n_name FROM nation
 UNION ALL SELECT 'r' || n_regionkey || '/n' || n_nationkey || '/c' || c_custkey, c_custkey, c_name FROM customer JOIN nation ON n_nationkey = c_nationkey)"""


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    nation = table(spark, sf_dir, "nation")
    people = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows
    rows = [
        table(spark, sf_dir, "region").select(key("r", "r_regionkey").alias("path"), F.col("r_regionkey").cast("long").alias("sib_no"), F.col("r_name").alias("text")),
        nation.select(F.concat_ws("/", key("r", "n_regionkey"), key("n", "n_nationkey")).alias("path"), F.col("n_nationkey").cast("long").alias("sib_no"), F.col("n_name").alias("text")),
        people.select(F.concat_ws("/", key("r", "n_regionkey"), key("n", "n_nationkey"), key("c", "c_custkey")).alias("path"), F.col("c_custkey").alias("sib_no"), F.col("c_name").alias("text")),
    ]
    every = rows[0].unionByName(rows[1]).unionByName(rows[2])
    parent = F.nullif(F.regexp_replace("path", "/?[^/]+$", ""), F.lit(""))
    return every.select("path", parent.alias("parent_path"), "sib_no", "text", F.lit("clause").alias("kind"), F.lit(None).cast("string").alias("title"), F.col("sib_no").alias("ord"))


@query(f"WITH {_PATHS} SELECT path, len(string_split(path, '/')) AS depth, string_split(path, '/')[1] AS part FROM p")
def tree_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(spark, sf_dir).select("path", F.size(F.split("path", "/")).cast("long").alias("depth"), tree.part_of("path").alias("part"))


@query(f"""
WITH {_PATHS}, a AS (SELECT path, array_to_string(string_split(path, '/')[1:i], '/') AS ancestor, len(string_split(path, '/')) - i AS up FROM p, range(1, 3) t(i) WHERE i < len(string_split(path, '/')))
SELECT path, ancestor, CAST(up AS INTEGER) AS up FROM a
""")
def ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.ancestors(nodes(spark, sf_dir))


@query(f"WITH {_PATHS} SELECT a.path, count(*) AS n FROM p a JOIN p b ON b.path = a.path OR starts_with(b.path, a.path || '/') GROUP BY 1")
def descendant_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.closure(nodes(spark, sf_dir)).groupBy(F.col("top").alias("path")).agg(F.count("*").alias("n"))


@query(f"WITH {_PATHS} SELECT path FROM p WHERE path LIKE 'r1/%' OR path = 'r1'")
def descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.descendants(nodes(spark, sf_dir), "r1").select("path")


@query(f"WITH {_PATHS} SELECT path FROM p a WHERE NOT EXISTS (SELECT 1 FROM p b WHERE starts_with(b.path, a.path || '/'))")
def tree_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.leaves(nodes(spark, sf_dir)).select("path")


@query(f"""
WITH {_PATHS} SELECT a.path, sha1(string_agg(b.text, ' ' ORDER BY b.sib_no, b.path)) AS h
FROM p a JOIN p b ON b.path = a.path OR starts_with(b.path, a.path || '/') GROUP BY 1
""")
def subtree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.subtree_text(nodes(spark, sf_dir)).select("path", F.sha1("subtree_text").alias("h"))


@query("SELECT l_orderkey AS path, string_agg(l_linestatus, chr(10) ORDER BY l_linenumber, l_linestatus) AS derived_text FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_linestatus FROM lineitem) GROUP BY 1")
def derived_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus").distinct()
    name = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), "l_linestatus")
    items = rows.select(name.alias("path"), F.col("l_linenumber").alias("ord"), F.col("l_linestatus").alias("text"), F.lit("item").alias("kind"))
    tops = rows.select(F.col("l_orderkey").cast("string").alias("path"), F.lit(0).alias("ord"), F.lit(None).cast("string").alias("text"), F.lit("part").alias("kind")).distinct()
    return tree.derived_text(tops.unionByName(items)).where(~F.col("path").contains("/")).select(F.col("path").cast("long").alias("path"), "derived_text")


@query(f"""
WITH {_PATHS}, d AS (SELECT 'r' || n_regionkey || '/n' || n_nationkey || '/c' || c_custkey AS path, o_orderdate, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)
SELECT a.path, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date, round(sum(o_totalprice), 2) AS total
FROM p a JOIN d ON d.path = a.path OR starts_with(d.path, a.path || '/') GROUP BY 1
""")
def extent_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = nodes(spark, sf_dir)
    per = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("sib_no")).agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"), F.sum(F.col("o_totalprice").cast("decimal(18,4)")).alias("t"))
    low = n.where(F.col("path").rlike("/c")).join(per, "sib_no").select("path", "a", "b", "t")
    return tree.closure(n).join(low, "path").groupBy(F.col("top").alias("path")).agg(F.min("a").alias("first_date"), F.max("b").alias("last_date"), F.round(F.sum("t").cast("double"), 2).alias("total"))


@query(f"""
WITH {_PATHS}, w AS (SELECT p.path, list(q.sib_no ORDER BY len(q.path)) AS walk, string_split(p.path, '/')[1] AS part FROM p JOIN p q ON q.path = p.path OR starts_with(p.path, q.path || '/') GROUP BY 1)
SELECT path, CAST(row_number() OVER (PARTITION BY part ORDER BY walk, path) - 1 AS INTEGER) AS ord FROM w
""")
def preorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.preorder(nodes(spark, sf_dir)).select("path", "ord")


@query("SELECT c_nationkey AS parent_path, c_mktsegment AS stem, c_custkey AS ord, CASE WHEN n = 1 THEN c_mktsegment ELSE c_mktsegment || '-' || n END AS name FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS n FROM customer)")
def stem_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("parent_path"), F.col("c_mktsegment").alias("stem"), F.col("c_custkey").alias("ord"))
    return tree.stem_names(rows)


@query(f"WITH {_PATHS} SELECT path, array_to_string(string_split(path, '/')[1:2], '/') AS section FROM p")
def section_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes(spark, sf_dir).select("path", tree.section_of("path").alias("section"))
