"""Held-out accuracy, and the rules of the sample."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexweave.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs, language.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def rows(spark, more=()):
    words = {"en": "the house and the garden of this town", "de": "das haus und der garten der stadt"}
    own = [(i, f"{words[l]} {i}", l) for i, l in enumerate(["en", "de"] * 40)]
    return spark.createDataFrame(own + list(more), "doc_id long, text string, lang string")


def test_learns_only_from_folds_with_a_language(spark):
    alien = [(i, "zzz qqq xxx", "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else None) for i in range(100, 160)]
    model = language.fit(rows(spark, alien))
    assert model.languages == ["de", "en"]
    assert language.fit(rows(spark)).centroids.tolist() == language.fit(rows(spark)).centroids.tolist()


def test_sample_is_bounded(spark):
    model = language.fit(rows(spark), bound=3)
    assert len(model.owner) <= 6 and model.predict("the garden and the house")[0] == "en"


def test_odd_rows(spark):
    odd = [(1000, None, "en"), (1001, "123 !!", "en"), (1002, "", None), (None, "der garten", "de"), (1003, "the town", None), (1003, "the town", None), (1004, "ж" * 50, None)]
    got = [(r["doc_id"], r["lang_pred"], r["held_out"], r["rejected"]) for r in language.identify(spark.createDataFrame(odd, "doc_id long, text string, lang string"), language.fit(rows(spark))).collect()]
    by = {g[0]: g for g in got}
    assert len(got) == 7
    assert [by[i][1] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert by[None][1:3] == ("de", False) and by[1003][1] == "en"
    assert by[1004][1] in ("de", "en") and by[1004][3]


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.identify(empty, language.fit(empty)).count() == 0
    some = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert language.identify(some, language.fit(some)).first()["lang_pred"] == "und"


def test_clusters_split():
    x = np.array([[1, 0.1], [1, 0.0], [0.1, 1], [0, 1]], np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centers = language._clusters(x, 2)
    assert (x @ centers.T).argmax(1).tolist() in ([0, 0, 1, 1], [1, 1, 0, 0])


def test_fit_is_that_of_plain_rows(spark):
    """The distributed fit against learn() over the same sample, and predictions of whole tables against plain cosines."""
    rows = [(i, t, "en" if i % 2 else "de") for i, t in enumerate(["the cat and the dog", "der Hund und die Katze", "a cat is there", "eine Katze ist da"] * 30)]
    rows = [(i, f"{t} {i % 7} {'x' * (i % 5)}", lang) for i, t, lang in rows] + [(3, "another text with the id", "en"), (None, "no id", "en"), (5, None, "en"), (8, "123", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("h", F.lit("x"))
    h = {(r["doc_id"], r["text"]): (r["a"], r["b"], r["out"]) for r in docs.selectExpr("doc_id", "text", "xxhash64(doc_id) as a", "xxhash64(text) as b", "coalesce(crc32(cast(doc_id as string)) % 5 = 0, false) as out").collect()}
    picked = []
    for lang in ("de", "en"):
        able = [(i, t) for i, t, own in rows if own == lang and i is not None and t is not None and not h[i, t][2]]
        for i in sorted(sorted({i for i, _ in able}, key=lambda i: h[i, next(t for j, t in able if j == i)][0])[:20]):
            texts = [t for j, t in able if j == i and language.grams(t) is not None]
            if texts:
                picked.append((lang, min(texts, key=lambda t: h[i, t][1])))
    want, got = language.learn(picked), language.fit(docs, bound=20)
    assert got.languages == want.languages and np.allclose(got.idf, want.idf) and np.allclose(got.centroids, want.centroids, atol=1e-6) and np.allclose(got.least, want.least, atol=1e-6)
    text = {i: t for i, t, _ in rows}
    for r in language.identify(docs.where("doc_id not in (3, 5, 8)"), got).collect():  # these have two texts
        counts = language.grams(text[r["doc_id"]])
        if counts is None:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        v = np.sqrt(counts) * got.idf
        cosines = [float(c @ v / np.linalg.norm(v)) for c in got.centroids]
        best = max(cosines)
        assert r["score"] == pytest.approx(best, abs=1e-4)
        assert max(c for c, o in zip(cosines, got.owner, strict=True) if got.languages[o] == r["lang_pred"]) == pytest.approx(best, abs=1e-4)
