"""The pipeline stage by stage against brute force, on a small table with planted cases."""

import pytest

import corpus_pipeline
from lexweave.llm import pii, quality, simhash
from tests.llm.test_decontaminate import items, noise

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    import random

    rng = random.Random(9)
    path = str(tmp_path_factory.mktemp("tables"))
    bench = items()
    clean = [(i, noise(rng, 40 + i)) for i in range(40)]
    junk = [(100 + i, " ".join(f"{w}%%%" for w in noise(rng, 60).split())) for i in range(20)]
    planted = [(200, clean[3][1]), (201, clean[5][1]), (202, f"{noise(rng, 30)} {bench[2][1]} {noise(rng, 30)}"), (203, noise(rng, 30) + " write to me@corp.example now"), (204, "too short"), (205, None)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in clean + junk + planted]
    spark.createDataFrame(rows + rows[:1], DDL).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in clean[:30]] + [(i, 0, 0) for i, _ in junk[:15]], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        rows = docs.collect()
        kept[name] = sorted(r["doc_id"] for r in rows)
        if name != "packing":
            assert docs.columns == columns
        if name == "pii":
            text = {r["doc_id"]: r["text"] for r in rows}
            assert "[EMAIL]" in text[203] and "@" not in text[203]
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
    clean = list(range(40))
    assert kept["quality_rules"] == sorted([0, *clean, 200, 201, 202, 203])
    assert kept["simhash_near_dedup"] == sorted([*clean, 202, 203])
    assert kept["benchmark_decontamination"] == kept["pii"] == kept["packing"] == sorted([*clean, 203])


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r["doc_id"] for r in got) == [*range(40), 203]
    assert len({(r["bucket"], r["batch"], r["slot"]) for r in got}) == len(got)


def test_against_brute_force(spark):
    """The first two stages over a driver table, row by row."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    judge = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {i for i, t in texts.items() if quality._judged(judge, [t])[3][0]}
    first = corpus_pipeline.quality_rules(spark, docs, folder)
    assert {r["doc_id"] for r in first.collect()} == good
    prints = {i: simhash.fingerprint(texts[i]) for i in good}
    left = set()
    for i in sorted(good):
        group, todo = {i}, [i]
        while todo:
            at = todo.pop()
            near = {j for j in good if (prints[j] ^ prints[at]).bit_count() <= 3} - group
            group |= near
            todo += near
        left.add(min(group))
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, first, folder).collect()} == left


def test_empty_tables(spark, tmp_path):
    none = str(tmp_path)
    spark.createDataFrame([], DDL).write.parquet(f"{none}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{none}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{none}/labels.parquet")
    assert corpus_pipeline.run(spark, none).collect() == []


def test_pii_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a@b.cc", "h")], "doc_id long, text string, terms string")
    assert pii.sanitise(docs).first().asDict() == {"doc_id": 1, "text": "[EMAIL]", "terms": "h"}
