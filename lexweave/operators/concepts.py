"""Concepts: proposals, collisions with defined terms, near-duplicates and their clusters."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexweave.functions import ids
from lexweave.functions.text import cosine

MERGE_COSINE, VECTOR_BLOCK = 0.80, 2_000


def label_form(label: Column | str) -> Column:
    c = F.col(label) if isinstance(label, str) else label
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def parse_proposals(replies: DataFrame, nodes: DataFrame) -> DataFrame:
    """Concepts of JSON replies (scope_path, value): unknown members are dropped, and concepts without any."""
    ddl = "array<struct<label:string,members:array<string>,confidence:double,relations:array<struct<verb:string,target:string>>>>"
    rows = replies.select("scope_path", F.inline(F.from_json("value", ddl))).where("label is not null and trim(label) <> ''")
    inner = rows.select("*", F.explode(F.array_distinct("members")).alias("member")).join(nodes.select(F.col("path").alias("member"), F.col("id").alias("node_id")), "member")
    kept = inner.groupBy("scope_path", "label").agg(F.array_sort(F.collect_set("node_id")).alias("member_node_ids"), F.max("confidence").alias("confidence"), F.max("relations").alias("relations"))
    return kept.select(ids.concept_id("scope_path", "label").alias("id"), "label", "scope_path", "member_node_ids", "relations", F.lit(True).alias("llm_derived"), F.least(F.greatest(F.coalesce("confidence", F.lit(0.0)), F.lit(0.0)), F.lit(1.0)).alias("confidence"))


def declared_surfaces(sites: DataFrame) -> DataFrame:
    """(surface, term): normalised terms and aliases, the first term of a surface."""
    rows = sites.select("term", F.explode(F.array_union(F.array("term"), "aliases")).alias("s")).select("term", label_form("s").alias("surface"), (F.col("s") != F.col("term")).cast("int").alias("late"))
    return rows.groupBy("surface").agg(F.min_by("term", F.struct("late", "term")).alias("term"))


def lexically_similar(a: Column, b: Column) -> Column:
    """Equal labels, or one's words all among the other's."""
    x, y = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    return (a == b) | (F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0)


def term_collisions(concepts: DataFrame, sites: DataFrame, vectors: DataFrame | None = None, threshold: float = MERGE_COSINE) -> DataFrame:
    """(id, term, reason) of concepts that a defined term already names: by surface, else by cosine, else by words."""
    surfaces = declared_surfaces(sites)
    c = concepts.select("id", label_form("label").alias("surface"))
    exact = c.join(surfaces, "surface").select("id", "term", F.lit("surface").alias("reason"))
    rest = c.join(exact, "id", "left_anti")
    # words in common are a key; a pair without any can only meet by cosine
    words = surfaces.select(F.col("surface").alias("s"), "term", F.explode(F.array_distinct(F.split("surface", " "))).alias("w"))
    near = rest.select("id", "surface", F.explode(F.array_distinct(F.split("surface", " "))).alias("w")).join(words, "w").select("id", "surface", "s", "term").distinct()
    lexical = near.where(lexically_similar(F.col("surface"), F.col("s"))).groupBy("id").agg(F.min("term").alias("term")).withColumn("reason", F.lit("words"))
    if vectors is None:
        return exact.unionByName(lexical)
    v = vectors.select(label_form("text").alias("k"), "vector")
    have = rest.join(v.withColumnRenamed("k", "surface"), "surface")
    terms = surfaces.join(v.withColumnRenamed("k", "surface"), "surface").select("term", F.col("vector").alias("tv"))
    best = in_blocks(have, terms, "id", "term").withColumn("cos", cosine("vector", "tv")).groupBy("id").agg(F.max("cos").alias("cos"), F.max_by("term", F.struct("cos", "term")).alias("term"))
    by_vector = best.where(F.col("cos") >= threshold).select("id", "term", F.lit("cosine").alias("reason"))
    return exact.unionByName(by_vector).unionByName(lexical.join(best, "id", "left_anti"))


def in_blocks(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Every row of a stated set against every row of another, a block of each at a time.

    A block has about ``VECTOR_BLOCK`` rows; each pair of blocks is a key of its own, so that no task holds a whole side.
    """
    n, m = (max(1, -(-df.count() // VECTOR_BLOCK)) for df in (left, right))
    x = left.withColumn("__i", F.pmod(F.xxhash64(left_key), F.lit(n))).withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    y = right.withColumn("__j", F.pmod(F.xxhash64(right_key), F.lit(m))).withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return x.withColumn("__i", F.col("__i").cast("int")).join(y.withColumn("__j", F.col("__j").cast("int")), ["__i", "__j"]).drop("__i", "__j")


def similar_pairs(concepts: DataFrame, vectors: DataFrame | None = None, threshold: float = MERGE_COSINE) -> DataFrame:
    """(a, b) of similar concepts: one's words are all among the other's, or vectors of the threshold's cosine.

    A label whose words are all among another's has its rarest word there too, so that only that one is
    looked for: frequent words bring no rows together.
    """
    c = concepts.select("id", label_form("label").alias("l"))
    w = c.select("id", "l", F.explode(F.array_distinct(F.split("l", " "))).alias("w"))
    often = w.groupBy("w").agg(F.count("*").alias("n"))
    rare = w.join(often, "w").groupBy("id", "l").agg(F.min_by("w", F.struct("n", "w")).alias("w"))
    small, big = rare.select(F.col("id").alias("a"), F.col("l").alias("la"), "w"), w.select(F.col("id").alias("b"), F.col("l").alias("lb"), "w")
    met = small.join(big, "w").where("a <> b").where(lexically_similar(F.col("la"), F.col("lb")))
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    if vectors is None:
        return pairs
    v = c.join(vectors.select(label_form("text").alias("l"), "vector"), "l").select("id", "vector")
    x, y = (v.select(F.col("id").alias(n), F.col("vector").alias(f"v{n}")) for n in "ab")
    close = in_blocks(x, y, "a", "b").where(F.col("a") < F.col("b")).where(cosine("va", "vb") >= threshold).select("a", "b")
    return pairs.unionByName(close).distinct()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: the one the cluster names; only on one machine may a temporary one take its place."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named is None and sc._jsc.sc().getCheckpointDir().isEmpty() and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="lexweave-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a folder that is no longer read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def components(pairs: DataFrame) -> DataFrame:
    """(id, root) of all ids of the pairs: least label first, then roots of roots, until nothing changes."""
    shared_folder(pairs.sparkSession)
    edges = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    labels = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("root")).checkpoint()
    while True:
        seen = edges.join(labels.select(F.col("id").alias("b"), "root"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("m"))
        step = labels.join(seen, "id").select("id", F.least("root", "m").alias("root"))
        up = step.select(F.col("id").alias("root"), F.col("root").alias("top"))
        new = step.join(up, "root").select("id", F.least("root", "top").alias("root")).checkpoint()
        if not new.join(labels.withColumnRenamed("root", "old"), "id").where("root <> old").limit(1).count():
            return new
        labels = new


def merged(concepts: DataFrame, pairs: DataFrame) -> DataFrame:
    """One concept a cluster: the most confident stands for it, members and relations are united."""
    roots = components(pairs)
    c = concepts.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    rank = F.struct((-F.col("confidence")).alias("x"), "label", "id")
    heads = c.groupBy("root").agg(F.min_by("id", rank).alias("id"), F.min_by("label", rank).alias("label"), F.min_by("scope_path", F.struct(F.length("scope_path").alias("n"), "scope_path")).alias("scope_path"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("member_node_ids")))).alias("member_node_ids"), F.max("confidence").alias("confidence"), F.count("*").alias("size"))
    return heads.drop("root")


def remapped_relations(concepts: DataFrame, heads: DataFrame, pairs: DataFrame) -> DataFrame:
    """(src, verb, dst) between clusters: unknown targets, self relations and verbs that are labels are dropped."""
    roots = components(pairs)
    c = concepts.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    rank = F.struct((-F.col("confidence")).alias("x"), "label", "id")
    head = c.groupBy("root").agg(F.min_by("id", rank).alias("head"))
    by_label = c.join(head, "root").groupBy(label_form("label").alias("target")).agg(F.min("head").alias("dst"))
    rows = c.join(head, "root").select(F.col("head").alias("src"), F.inline("relations")).withColumn("target", label_form("target")).withColumn("verb", label_form("verb"))
    labels = by_label.select(F.col("target").alias("verb"))
    return rows.join(by_label, "target").where("src <> dst").join(labels, "verb", "left_anti").select("src", "verb", "dst").distinct()


def scanned_scopes(units: DataFrame, replies: DataFrame) -> DataFrame:
    """Every unit, and whether a reply covers it."""
    done = replies.select(F.col("scope_path").alias("path")).distinct().withColumn("scanned", F.lit(True))
    return units.select("path").join(done, "path", "left").select("path", F.coalesce("scanned", F.lit(False)).alias("scanned"))


def first_per(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")
