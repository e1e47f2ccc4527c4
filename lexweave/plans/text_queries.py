"""Queries of scalar text functions and vocabulary signals over documents and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.functions import ids
from lexweave.functions import text as tx
from lexweave.operators import vocabulary
from lexweave.plans.catalog import query, table


@query("SELECT lower(w) AS token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+(?:[''’-][A-Za-z]+)*')) AS w FROM documents) GROUP BY 1")
def token_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.token_frequencies(table(spark, sf_dir, "documents"))


@query("""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z]+(?:[''’-][A-Za-z]+)*')) AS token, generate_subscripts(regexp_extract_all(text, '[A-Za-z]+(?:[''’-][A-Za-z]+)*'), 1) AS i FROM documents),
     p AS (SELECT *, lag(token) OVER (PARTITION BY doc_id ORDER BY i) AS previous FROM w)
SELECT doc_id AS section, count(*) FILTER (lower(token) = lower(previous) AND length(token) > 2 AND regexp_full_match(token, '[A-Za-z]+')) AS doubled,
       count(*) FILTER (regexp_matches(token, '^[a-z][A-Z][a-z]')) AS stray FROM p GROUP BY 1
""")
def typo_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("section"), "text")
    return vocabulary.flagged_tokens(rows).groupBy("section").agg(F.count_if(F.col("reason") == "doubled_word").alias("doubled"), F.count_if(F.col("reason") == "stray_leading_character").alias("stray"))


@query()
def typo_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("section"), "text")
    return vocabulary.typo_density(rows)


@query("""
WITH f AS (SELECT w AS token, count(*) AS n FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS w FROM part UNION ALL SELECT lower(n_name) || 'x' FROM nation UNION ALL SELECT lower(n_name) FROM nation, range(5)) GROUP BY 1),
     r AS (SELECT token FROM f WHERE n <= 1 AND length(token) >= 5), c AS (SELECT token AS near FROM f WHERE n >= 5 AND length(token) >= 5)
SELECT token, min(near) AS near FROM r JOIN c ON levenshtein(token, near) = 1 GROUP BY 1
""")
def rare_near_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.lower("n_name").alias("w"))
    words = table(spark, sf_dir, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("w")).unionByName(n.select(F.concat("w", F.lit("x")).alias("w"))).unionByName(n.select("w", F.explode(F.sequence(F.lit(1), F.lit(5)))).select("w"))
    return vocabulary.rare_near_common(words.groupBy(F.col("w").alias("token")).agg(F.count("*").alias("n")))


@query("""
WITH w AS (SELECT DISTINCT string_split(p_name, ' ')[1] AS s FROM part UNION SELECT DISTINCT p_name FROM part WHERE p_size <= 5),
     h AS (SELECT p_partkey, p_name, EXISTS (SELECT 1 FROM w WHERE s = p_name) AS whole FROM part)
SELECT p_partkey, 0 AS start, CAST(length(p_name) AS INTEGER) AS "end", p_name AS surface FROM h WHERE whole
UNION ALL SELECT p_partkey, 0, CAST(length(string_split(p_name, ' ')[1]) AS INTEGER), string_split(p_name, ' ')[1] FROM h WHERE NOT whole
UNION ALL SELECT p_partkey, CAST(length(string_split(p_name, ' ')[1]) + 1 AS INTEGER), CAST(length(p_name) AS INTEGER), string_split(p_name, ' ')[2] FROM h WHERE NOT whole AND string_split(p_name, ' ')[2] IN (SELECT s FROM w)
""")
def term_uses_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    names = p.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("s")).union(p.where("p_size <= 5").select("p_name")).distinct()
    return vocabulary.longest_matches(p.select("p_partkey", F.col("p_name").alias("text")), names.select(F.col("s").alias("surface")), "p_partkey")


@query("SELECT url, trim(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM pages")
def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("url", ids.slug("url").alias("slug"))


@query("SELECT doc_id, sha1('corpus|v1|' || source || '/' || doc_id) AS id, sha1('corpus|' || source || '/' || doc_id) AS lineage_key, 'concept-' || substr(sha1(source || '|' || lower(lang)), 1, 16) AS concept FROM documents")
def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", ids.node_id(F.lit("corpus"), F.lit("v1"), path).alias("id"), ids.lineage_key(F.lit("corpus"), path).alias("lineage_key"), ids.concept_id("source", "lang").alias("concept"))


@query("""
SELECT item_id, CASE WHEN n <= 1 THEN '1' WHEN n = 2 THEN '2' ELSE '3+' END AS words, CASE WHEN item_id / greatest(total - 1, 1) < 1/3 THEN 'early' WHEN item_id / greatest(total - 1, 1) < 2/3 THEN 'middle' ELSE 'late' END AS position
FROM (SELECT item_id, len(list_filter(string_split_regex(trim(text), '\\s+'), lambda w: w <> '')) AS n, count(*) OVER () AS total FROM benchmark)
""")
def buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    return items.select("item_id", tx.word_count_bucket("text").alias("words"), tx.position_bucket("item_id", F.lit(items.count())).alias("position"))


@query("SELECT conv_id, turn, CASE WHEN length(text) > 60 THEN substr(text, 1, 60) || ' […truncated]' ELSE text END AS clipped FROM conversations")
def clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.clip("text", 60).alias("clipped"))


@query("SELECT item_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS title FROM benchmark")
def title_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", tx.title_form("text").alias("title"))


@query("""
SELECT p_partkey, string_agg(upper(substr(w, 1, 1)), '' ORDER BY i) AS initials FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, generate_subscripts(string_split(p_name, ' '), 1) AS i FROM part)
WHERE lower(w) NOT IN ('of', 'and', 'the', 'for', 'to', 'in', 'on', 'or', 'a', 'an', 'by', 'with') GROUP BY 1
""")
def initials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", tx.initials("p_name").alias("initials"))


_UNICODE_WORD = r"\p{L}\p{M}\p{Nd}\p{Nl}"


@query(f"""
SELECT item_id, CAST(list_sum([CASE WHEN regexp_full_match(p, '[{_UNICODE_WORD}]+') THEN ceil(length(p) / 4) ELSE 1 END FOR p IN regexp_extract_all(text, '[{_UNICODE_WORD}_]+|[^{_UNICODE_WORD}_\\s]')]) AS BIGINT) AS tokens FROM benchmark
""")
def estimated_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", tx.estimated_tokens("text").alias("tokens"))


@query("SELECT item_id, CAST(len(list_filter(string_split_regex(regexp_replace(text, '([.;:!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: s <> '')) AS INTEGER) AS n FROM benchmark")
def sentence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", F.size(tx.sentences("text")).alias("n"))


@query("SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 0 ELSE CAST(least(floor(s_acctbal / 1000), 9) AS INTEGER) END AS bucket FROM supplier")
def confidence_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", tx.confidence_bucket(F.col("s_acctbal") / 10000).alias("bucket"))


@query("""
WITH s AS (SELECT DISTINCT string_split(p_name, ' ')[2] AS w FROM part)
SELECT w, f FROM s, unnest([CASE WHEN length(w) >= 3 THEN w || 's' END, CASE WHEN length(w) >= 3 THEN w || 'es' END, CASE WHEN length(w) >= 3 AND regexp_matches(w, '[^aeiouAEIOU]y$') THEN regexp_replace(w, 'y$', 'ies') END,
  CASE WHEN length(w) > 4 AND regexp_matches(w, 'ies$') THEN regexp_replace(w, 'ies$', 'y') END, CASE WHEN length(w) > 4 AND regexp_matches(w, 'es$') THEN regexp_replace(w, 'es$', '') END, CASE WHEN length(w) > 3 AND regexp_matches(w, '[^s]s$') THEN regexp_replace(w, 's$', '') END]) t(f)
WHERE f IS NOT NULL AND f <> w GROUP BY ALL
""")
def inflections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("w")).distinct().select("w", F.explode(tx.inflections("w")).alias("f"))
