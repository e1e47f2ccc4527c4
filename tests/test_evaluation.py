"""Checks, scores, samples, gates."""

import collections

import pytest
from pyspark.sql import functions as F

from lexweave.operators import evaluation as e
from lexweave.sources import samples


def test_sample_passes_but_for_the_recorded_gap(spark):
    nodes = samples.nodes(spark).cache()
    found = e.claimed(e.check_tree(nodes), nodes)
    rows = {(r["check"], r["path"]): r["explained_by"] for r in found.collect()}
    assert rows["numbering_gap", "core-terms/2/2.3"] == "numbering_gap: 2.2 is not printed"
    assert {k for k, _ in rows} <= {"numbering_gap", "extent_nests", "own_box_above_first_child"}


def test_checks_fire(spark):
    n = samples.nodes(spark)
    bad = n.withColumn("content_hash", F.when(F.col("path") == "core-terms/1/1.2", "x").otherwise(F.col("content_hash"))).withColumn("citable", F.when(F.col("kind") == "intro", True).otherwise(F.col("citable"))).withColumn("page_end", F.when(F.col("path") == "form-1/1", 9).otherwise(F.col("page_end"))).withColumn("ord", F.when(F.col("path") == "form-1/2", 0).otherwise(F.col("ord")))
    rows = {(r["check"], r["path"]) for r in e.check_tree(bad).collect()}
    assert {("content_hash", "core-terms/1/1.2"), ("citable_flags", "core-terms/1/1.1/intro"), ("page_range", "form-1/1"), ("order_preorder", "form-1/2")} <= rows


def test_geometry(spark):
    row = lambda path, sib, box: (path, "p" if path != "p" else None, "clause", sib, 0, [] if box is None else [(1, *map(float, box))], [])
    ddl = "path string, parent_path string, kind string, sib_no int, ord int, bboxes_own array<struct<page:int,x0:double,y0:double,x1:double,y1:double>>, bboxes_extent array<struct<page:int,x0:double,y0:double,x1:double,y1:double>>"
    nodes = spark.createDataFrame([row("p", 0, (50, 0, 300, 10)), row("p/1", 0, (40, 20, 300, 40)), row("p/2", 1, (60, 30, 300, 50)), row("p/3", 2, (60, 10, 300, 15))], ddl)
    got = {(r["check"], r["path"]) for df in e.geometry_checks(nodes) for r in df.collect()}
    assert {("child_left_edge", "p/1"), ("sibling_overlap", "p/2"), ("siblings_ascend", "p/3")} <= got
    assert ("child_left_edge", "p/2") not in got


def test_systematic_and_ledger(spark):
    nodes = spark.createDataFrame([("p", None, "part")] + [(f"p/{i}", "p", "clause") for i in range(5)], "path string, parent_path string, kind string")
    v = spark.createDataFrame([("left", f"p/{i}") for i in range(4)], "check string, path string")
    tested = spark.createDataFrame([("left", "part", "clause", 5)], "check string, parent_kind string, kind string, tested int")
    assert e.systematic(v, tested, nodes).where("systematic").count() == 4
    told, stale = e.with_ledger(v, spark.createDataFrame([("left", "p/0", "seen"), ("left", "p/9", "old")], "check string, path string, reason string"))
    assert told.where("reason = 'seen'").count() == 1 and [r["path"] for r in stale.collect()] == ["p/9"]


def test_spans_boxes_distributions(spark):
    from lexweave.plans.sample_queries import _references

    nodes, refs = _references(spark)
    assert e.ref_span_integrity(refs, nodes).count() == 0
    assert e.ref_span_integrity(refs.withColumn("text", F.lit("zz")), nodes).count() == refs.count()
    assert e.mad_outliers(e.distributions(nodes)).count() > 0
    assert e.group_contexts(refs, nodes).where("n > 1").count() >= 1
    assert e.status_matrix(refs, refs).count() == 4
    assert e.snapshot(refs).count() == refs.count()


def test_seeded_sample_is_proportional_and_stable():
    cells = {("a",): list(range(10)), ("b",): list(range(10, 40))}
    one, two = e.seeded_shuffle_sample(cells, 8, "x"), e.seeded_shuffle_sample(dict(reversed(cells.items())), 8, "x")
    assert one == two and collections.Counter(i < 10 for i in one) == {True: 2, False: 6}
    assert e.seeded_shuffle_sample(cells, 99) == list(range(40))


def test_samples_by_hash(spark):
    df = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(100)], "id long, s string")
    got = e.stratified_sample(df, ["s"], 10, "id", "q")
    assert {r["s"]: r["count"] for r in got.groupBy("s").count().collect()} == {"a": 8, "b": 2}
    assert sorted(got.collect()) == sorted(e.stratified_sample(df.repartition(9), ["s"], 10, "id", "q").collect())
    assert e.stratified_sample(df, ["s"], 500, "id").count() == 100


def test_labels(spark):
    rows = [("ref", "a", "1", 0), ("ref", "a", "2", 1), ("ref", None, "3", 2), ("ref", None, "4", 3)]
    last = e.last_records(spark.createDataFrame(rows, "kind string, path string, verdict string, n int"), ["kind", "path"], ["n"])
    assert {r["verdict"] for r in last.collect()} == {"2", "4"}
    labels = spark.createDataFrame([("p", 0, 10, "x"), ("p", 20, 30, "y")], "path string, start int, end int, wanted string")
    found = spark.createDataFrame([("p", 0, 3, "u"), ("p", 2, 10, "x"), ("p", 90, 99, "z")], "path string, start int, end int, found string")
    got = {r["start"]: r["found"] for r in e.overlapping_best(labels, found, ["path"]).collect()}
    assert got == {0: "x", 20: None}
    gold = spark.createDataFrame([("ref", "a/1/ref@3-5+1", None, None), ("term", None, "n1", (1, 2))], "kind string, path string, node_id string, char_span struct<start:int,end:int>")
    nodes = spark.createDataFrame([("n1", "a/2")], "id string, path string")
    assert {(r["subject"], r["start"], r["end"]) for r in e.golden_subjects(gold, nodes).collect()} == {("a/1", 3, 5), ("a/2", 1, 2)}


def test_gates_fire_and_skip(spark):
    m = spark.createDataFrame([("reference_precision_min", 0.8), ("detection_recall_min", None)], "name string, value double")
    got = {r["name"]: r["status"] for r in e.gates(m).collect()}
    assert got["reference_precision_min"] == "fail" and got["detection_recall_min"] == "skipped"
    odd = e.gates(m, {"mystery": (">=", 1.0)})
    assert odd.first()["status"] == "unimplemented" and e.exit_code(odd) == 2
    assert e.exit_code(e.gates(spark.createDataFrame([], "name string, value double"))) == 0
    assert spark.range(1).select(e.rate(F.lit(1), F.lit(0))).first()[0] is None


def test_graph_walks(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("c", "d"), ("x", "x")], "src string, dst string")
    got = e.cycles_and_depth(edges)
    assert got == {"components": 4, "cyclic": [["b", "c"], ["x"]], "longest_chain": 3}


def test_outline(spark):
    nodes = spark.createDataFrame([("p", 1, "p/1", "1", "Supply of widgets"), ("p", 2, "p/2", "2", "Price"), ("p", 3, "p/3", None, "Annex")], "part string, ord int, path string, label string, title string")
    entries = spark.createDataFrame([("p", 1, "1", "Other name"), ("p", 2, None, "Prices"), ("p", 3, None, "Nothing like it")], "part string, nr int, label string, title string")
    got = {(r["entry"], r["path"], r["how"]) for r in e.outline_triage(entries, nodes).collect()}
    assert got == {("Other name", "p/1", "label"), ("Prices", "p/2", "title"), ("Nothing like it", None, "outline_only"), (None, "p/3", "tree_only")}


def test_capitalised_and_report(spark):
    from lexweave.plans.sample_queries import _sites

    nodes = samples.nodes(spark)
    runs = {r["run"]: r["verdict"] for r in e.capitalised_never_defined(nodes, _sites(nodes)).collect()}
    assert "Supplier" not in runs and "Buyer" in "".join(runs)
    df = spark.createDataFrame([(2, "b"), (1, "a")], "n int, s string")
    assert e.report({"x": df}).splitlines()[4] == "| 1 | a |"
    assert e.fingerprint(df) == e.fingerprint(df.orderBy("n")) != e.fingerprint(df.limit(1))
    assert e.capped(df, ["n"], 1)[1] == 1


def test_concept_hygiene(spark):
    nodes = samples.nodes(spark)
    first = nodes.where("path = 'core-terms/1/1.2'").first()["id"]
    concepts = spark.createDataFrame([("a", [first]), ("b", ["gone"])], "id string, member_node_ids array<string>")
    got = {r["name"]: (r["count"], r["of"]) for r in e.concept_hygiene(concepts, spark.createDataFrame([("a", "b")], "a string, b string"), nodes.where("kind = 'part'"), nodes, concepts.limit(0)).collect()}
    assert got == {"duplicates": (1, 2), "covered_units": (1, 4), "collisions": (0, 2), "orphans": (1, 2)}


@pytest.mark.parametrize("labels, gaps", [(["1.1", "1.2", "1.4"], 1), (["(a)", "(b)", "(d)"], 1), (["(i)", "(ii)", "(iii)"], 0), (["a", "b", "c"], 0)])
def test_sibling_gaps(spark, labels, gaps):
    nodes = spark.createDataFrame([("p", f"p/{i}", "item", i, x) for i, x in enumerate(labels)], "parent_path string, path string, kind string, sib_no int, label string")
    assert e.sibling_gaps(nodes).count() == gaps
