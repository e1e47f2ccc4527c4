"""A training-corpus pipeline over documents: STAGES one by one, or run() for all of them.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but
the last return the columns of documents. Results of stages are written as Parquet to the
shared folder between them.

Edge cases, with the results that the operators state: a null or empty text, and one of few words, fails the
base rules and goes. Of exact or near copies one row stays, the one with the least id (rows without an id
come last, ties go by a hash of the text), so that rows that repeat an id stay where their texts differ. Very long
texts are worked on whole. Without labels of both kinds the base rules alone decide; without benchmark items nothing
leaks. Other columns pass every stage but the last as they are, whatever their names. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm import decontaminate, packing, pii, quality, simhash
from lexweave.llm.common import drop_dir, fresh_dir, read
from lexweave.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the calibrated isolation forest reject go."""
    return quality.keep(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates stays."""
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced; n_chars follows the new text."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in clean.columns else clean


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document is packed, by its tokens: its bucket, batch and slot."""
    return packing.pack(docs, tokenizer=tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", personal_data),
    ("packing", length_packing),
]

#: A learnt forest, connected components and dynamic programming are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = fresh_dir(spark, "pipeline")
    last = None
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last is not None:  # nothing reads the stage before any more
            drop_dir(spark, last)
        last = path
    return docs
