"""Graph rows, loads, rollback, sweep, salience."""

import pytest
from pyspark.sql import functions as F

from lexweave.operators import embeddings, graph
from lexweave.plans.sample_queries import _references, _sites
from lexweave.operators import vocabulary
from lexweave.sources import samples


@pytest.fixture(scope="module")
def world(spark):
    nodes, refs = _references(spark)
    sites = _sites(nodes)
    return nodes, refs, sites, vocabulary.term_uses(nodes, sites).checkpoint()


def test_edges(spark, world):
    nodes, refs, sites, uses = world
    assert graph.contains_edges(nodes).count() == nodes.where("parent_path is not null").count()
    per = nodes.where("kind <> 'ref' and parent_path is not null").groupBy("parent_path").count().agg(F.sum(F.col("count") - 1)).first()[0]
    assert graph.next_edges(nodes).count() == per
    held = {r["id"] for r in nodes.collect()}
    resolved = graph.resolves_edges(refs, nodes).collect()
    assert sum(e["dst"] in held for e in resolved) == refs.where("status = 'resolved'").count()
    assert all(e["dst"].startswith("legislation/") for e in resolved if e["dst"] not in held)
    assert graph.candidate_edges(refs, nodes).count() >= 1
    law = {r["key"]: (r["year"], r["derived"]) for r in graph.legislation_rows(refs, spark.createDataFrame([("legislation/regulation-eu-2016-679", "GDPR", 2016, "eu_regulation", None)], "key string, title string, year int, instrument_kind string, provision string")).collect()}
    assert law == {"legislation/patents-act-1977/section/55": (1977, True), "legislation/regulation-eu-2016-679": (2016, False)}
    assert graph.term_rows(sites).count() == 5
    assert graph.definition_edges(sites, nodes).count() == 5
    assert graph.use_edges(uses, nodes).count() == uses.count()
    using = {(r["src"], r["dst"]) for r in graph.defined_using_edges(uses, sites).collect()}
    assert ("Widget", "Supplier") in using and ("Breach", "Supplier") in using


def test_dedupe_and_dangling(spark):
    e = spark.createDataFrame([("A", "x", "y", {"p": "1", "q": "1"}, 1), ("A", "x", "y", {"p": "2"}, 2), ("USES_TERM", "x", "t", {"char_span": "0-1"}, 3), ("USES_TERM", "x", "t", {"char_span": "4-5"}, 4)], "type string, src string, dst string, props map<string,string>, nr int")
    got = {(r["type"], r["n"]): r["props"] for r in graph.deduplicated(e).collect() if r["type"] == "A"}
    assert got == {("A", 2): {"p": "2", "q": "1"}}
    assert graph.deduplicated(e).count() == 3
    keys = spark.createDataFrame([("x",), ("y",)], "key string")
    assert [(r["side"], r["key"], r["n"]) for r in graph.dangling(e, keys).collect()] == [("dst", "t", 2)]
    ok, later = graph.writable_and_deferred(e, keys)
    assert ok.count() == 2 and {r["missing"] for r in later.collect()} == {"dst"}


def test_load_ids_ignore_order(spark, world):
    nodes = world[0]
    edges = graph.contains_edges(nodes)
    a = graph.load_id("B1", nodes, edges).first()[0]
    assert a == graph.load_id("B1", nodes.orderBy(F.desc("id")), edges.repartition(5)).first()[0]
    assert a != graph.load_id("B2", nodes, edges).first()[0] != graph.load_id("B2", nodes.limit(5), edges).first()[0]


def test_overlay_is_idempotent(spark):
    old = spark.createDataFrame([], "id string, a string, b string, batch_id string, first_batch_id string, load_id string")
    one = spark.createDataFrame([("1", "x", "y"), ("2", None, "z")], "id string, a string, b string")
    first = graph.overlay(old, one, ["id"], "B1", "l1")
    again = graph.overlay(first, one, ["id"], "B1", "l1")
    assert sorted(first.collect()) == sorted(again.select(first.columns).collect())
    more = graph.overlay(first, spark.createDataFrame([("1", None, "new"), ("3", "q", None)], "id string, a string, b string"), ["id"], "B2", "l2")
    got = {r["id"]: (r["a"], r["b"], r["batch_id"], r["first_batch_id"]) for r in more.collect()}
    assert got == {"1": ("x", "new", "B2", "B1"), "2": (None, "z", "B1", "B1"), "3": ("q", None, "B2", "B2")}


def tables(spark):
    nodes = spark.createDataFrame([("n1", "p/1", "B1", "l1"), ("n2", "p/2", "B2", "l2"), ("n3", "q/1", "B2", "l2"), ("t1", "", "B1", "l2"), ("t2", "", "B1", "l2")], "id string, path string, batch_id string, load_id string")
    edges = spark.createDataFrame([("USES_TERM", "n1", "t1", "B1", "l1"), ("USES_TERM", "n2", "t1", "B2", "l2"), ("NEXT", "n1", "n2", "B1", "l1"), ("ABOUT", "n3", "n1", "B2", "l2")], "type string, src string, dst string, batch_id string, load_id string")
    return nodes, edges, spark.createDataFrame([("t1",), ("t2",)], "id string")


def test_rollback(spark):
    nodes, edges, referents = tables(spark)
    rest, left, kept = graph.rollback(nodes, edges, "B1", referents)
    assert {r["id"] for r in rest.collect()} == {"n2", "n3", "t1"}
    assert {(r["src"], r["dst"]) for r in left.collect()} == {("n2", "t1")}
    assert [r["id"] for r in kept.collect()] == ["t1"]


def test_sweep(spark):
    nodes, edges, referents = tables(spark)
    rest, left = graph.sweep(nodes, edges, ["p"], "l2", referents)
    assert {r["id"] for r in rest.collect()} == {"n2", "n3", "t1"}
    assert {(r["type"], r["src"], r["dst"]) for r in left.collect()} == {("USES_TERM", "n2", "t1")}
    again = graph.sweep(rest, left, ["p"], "l2", referents)
    assert again[0].count() == 3 and again[1].count() == 1
    skipped = graph.sweep(nodes.where("id <> 'n1'"), edges.where("src <> 'n1'"), [], "l2", referents, ["NEXT"])
    assert skipped[0].count() == 3  # t2 has no edge


def test_furniture_and_salience(spark, world):
    nodes, refs, sites, uses = world
    rooms = graph.furniture(nodes, 3, 2)
    paths = {r["path"] for r in nodes.join(rooms, "id").collect()}
    assert paths == {"core-terms/3", "form-1/1"} or "form-1/2" in paths
    s = {r["target"]: r for r in graph.node_salience(nodes, refs).collect()}
    ids = {r["path"]: r["id"] for r in nodes.collect()}
    hit = s[ids["call-off-schedule-9/a/3/3.4"]]
    assert (hit["frequency"], hit["breadth"]) == (2, 2) and hit["salience"] == pytest.approx(2.197225)
    assert s[ids["form-1/2"]]["salience"] == 0
    t = {r["target"]: r["frequency"] for r in graph.term_salience(uses, nodes, sites).collect()}
    assert t["Supplier"] == uses.where("term = 'Supplier'").count()
    shown = graph.with_salience(nodes, graph.node_salience(nodes, refs))
    assert shown.count() == nodes.count() and shown.where("salience is null").count() == 0
    assert graph.boosted(spark.createDataFrame([("a", 0.5)], "id string, score double"), spark.createDataFrame([("a", 1.0)], "id string, salience double")).first()["score"] == pytest.approx(0.5 + 0.02 * 0.6931472)


def test_outliers(spark):
    cites = spark.createDataFrame([("big", i) for i in range(400)] + [(f"t{i}", 0) for i in range(30)], "target string, citing_part int")
    targets = cites.select("target").distinct().withColumn("kind", F.lit("k"))
    assert [r["target"] for r in graph.salience(cites, targets).where("flagged").collect()] == ["big"]


def test_versions_root_impact(spark, world):
    nodes = world[0]
    changed = nodes.withColumn("content_hash", F.when(F.col("path") == "core-terms/1/1.2", "x").otherwise(F.col("content_hash"))).where("path <> 'form-1/2'").withColumn("id", F.concat("id", F.lit("2")))
    diff = {r["change"]: r["count"] for r in graph.version_diff(nodes, changed).groupBy("change").count().collect()}
    assert diff == {"changed": 1, "removed": 1, "unchanged": nodes.count() - 2}
    assert graph.supersedes_edges(nodes, changed).count() == nodes.count() - 1
    root = graph.document_root(nodes, "sample-deed").first()
    assert (root["page_start"], root["page_end"], root["n_parts"]) == (1, 4, 4)
    e = spark.createDataFrame([("RESOLVES_TO", "a", "b"), ("CONTAINS", "c", "a"), ("RESOLVES_TO", "b", "a")], "type string, src string, dst string")
    assert {(r["id"], r["hops"]) for r in graph.impact(e, "b").collect()} == {("b", 0), ("a", 1), ("c", 2)}


def test_embeddings(spark, world):
    nodes = world[0]
    plan = embeddings.plan(nodes, 5).cache()
    level = {r["path"]: r["level"] for r in plan.collect()}
    assert level["core-terms"] == "summary" and level["core-terms/2/2.3"] == "leaf" and level["core-terms/1"] == "summary"
    window = embeddings.plan(nodes, window=True).where("path = 'core-terms/2/2.1/b'").first()
    assert window["level"] == "leaf_window" and window["text"].startswith("The Buyer pays")
    none = spark.createDataFrame([], "vector_ref string, vector array<float>")
    have, owed = embeddings.cache_split(plan, none, "m")
    assert have.count() == 0 and owed.count() == plan.select("text").distinct().count()
    vectors = embeddings.embed_owed(owed, lambda texts: [[float(len(t)), 1.0] for t in texts]).cache()
    recs, pending = embeddings.records(plan, vectors.limit(5), "m")
    assert recs.count() + pending.count() == plan.count()
    assert embeddings.broken_records(embeddings.records(plan, vectors, "m")[0], nodes).count() == 0


def test_nearest_in_blocks(spark, monkeypatch):
    import numpy as np

    x = np.random.default_rng(2).normal(size=(120, 6))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vector array<double>")
    queries = df.where("id % 10 = 0").selectExpr("id as query", "vector")
    want = {tuple(r) for r in embeddings.nearest(queries, df, 3).select("query", "id", "rank").collect()}
    monkeypatch.setattr(embeddings, "QUERIES", 4)
    assert {tuple(r) for r in embeddings.nearest(queries, df, 3).select("query", "id", "rank").collect()} == want and len(want) == 36


def test_nearest(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vector array<double>").repartition(7)
    got = embeddings.nearest(df.where("id % 50 = 0").selectExpr("id as query", "vector"), df, 3).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in (0, 50, 100, 150):
        order = [i for i in np.argsort(-(unit @ unit[q])) if i != q][:3]
        assert [r["id"] for r in sorted((r for r in got if r["query"] == q), key=lambda r: r["rank"])] == order
