"""The queries of the ten operators over their whole tables, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm import decontaminate, html_text, language, packing, pii, quality, simhash, tokens, warc, word_lm
from lexweave.llm.common import read

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """The vocabulary file; LEXWEAVE_TOKENIZERS names another folder."""
    folder = os.environ.get("LEXWEAVE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.findings(read(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read(spark, sf_dir, "documents"), tokenizer_path())


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer=tokenizer_path())


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.assess(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_print().alias("fingerprint"), "component_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = word_lm.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "n_tokens", *(F.round(c, 9).alias(c) for c in ("target_bits", "background_bits", "score")))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_pii, op2_token_counts, op3_packing, op4_html_extraction, op5_language_id, op6_quality_rules, op7_simhash, op8_decontamination, op9_lm_scoring, op10_warc)}

#: DuckDB SQL where it can state the whole result. Operators 2 to 9 have learnt, merged or iterated results and
#: operator 1 a corpus model beside its base spans; they are tested against brute force instead.
ORACLE_SQL = {
    "op10_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages
), h AS (
  SELECT page_id, top, octet_length(encode(html)) AS n, sha1(html) AS hex FROM p
), d AS (
  SELECT page_id, top, n, list_aggregate([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (5 * (3 - i % 4))) & 31), 1)
    FOR i IN range(0, 32)], 'string_agg', '') AS b32 FROM h
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, b32 AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
""",
}
