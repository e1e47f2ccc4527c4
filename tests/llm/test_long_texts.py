"""Very long texts, and columns whose names the operators use themselves."""

import pytest
from pyspark.sql import functions as F

from lexweave.llm import decontaminate, language, packing, pii, quality, queries, simhash, tokens, warc, word_lm

LONG = " ".join(f"w{i % 977} the" for i in range(120_000))
NAMES = ["h", "fp", "root", "row", "n", "good", "spans", "terms", "entities", "n_tokens", "bucket", "shard", "count", "key", "value", "file", "score", "kept", "item_id", "quality", "part", "word"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, LONG, "en"), (2, "a short text of the corpus", "en"), (3, None, "de"), (3, "", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").select("*", *(F.lit(7).alias(c) for c in NAMES))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect() if r["doc_id"] < 3}


def test_pii(docs):
    assert by_id(pii.findings(docs), "n_email", "n_terms") == {1: (0, 0), 2: (0, 0)}
    got = pii.sanitise(docs)
    assert got.columns == docs.columns and by_id(got, "text")[1] == (LONG,)


def test_tokens_and_packing(docs):
    path = queries.tokenizer_path()
    want = len(tokens._tokenizer(path).encode(LONG, add_special_tokens=False).ids)
    assert by_id(tokens.count_tokens(docs, path), "n_tokens", "over_limit")[1] == (want, True)
    rows = by_id(packing.pack(docs, tokenizer=path), "n_tokens", "bucket_len")
    assert rows[1] == (want, want)


def test_language(docs):
    got = language.identify(docs, language.fit(docs))
    assert got.count() == 4 and by_id(got, "lang_pred")[1][0] in ("en", "und")


def test_quality(docs, labels):
    judge = quality.fit(docs, labels)
    assert by_id(quality.assess(docs, judge), "n_words", "n_repeat_words")[1] == quality.statistics(LONG)[:1] + quality.statistics(LONG)[4:5]
    assert quality.keep(docs, judge).columns == docs.columns


def test_simhash(docs):
    assert by_id(simhash.near_duplicates(docs), "component_id") == {1: (1,), 2: (2,)}
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns and got.count() == 3


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(9, " ".join(LONG.split()[200_000:200_040]))], "item_id long, text string")
    assert by_id(decontaminate.contaminated(docs, bench), "item_id") == {1: (9,)}
    got = decontaminate.without_leaks(docs, bench)
    assert got.columns == docs.columns and got.count() == 3


def test_lm(docs, labels):
    rows = by_id(word_lm.score(docs, labels), "n_tokens")
    assert rows == {1: (240_001,), 2: (7,)}


def test_warc(spark):
    page = "<p>" + "x" * 3_000_000 + "WARC/1.1\r\n" + "y" * 100
    pages = spark.createDataFrame([(1, "u", page), (2, "v", "small")], "page_id long, url string, html string").select("*", *(F.lit("c").alias(c) for c in ("file", "start", "next", "sha", "size", "first", "type")))
    got = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect()}
    assert got == {1: (len(page), "response", None), 2: (5, "response", None)}
