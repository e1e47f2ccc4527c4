"""Tree algebra over the sample contract."""

import json

from lexweave import schemas
from lexweave.operators import layout, tree
from lexweave.sources import samples


def test_valid_sample(spark):
    assert schemas.validate_nodes(samples.nodes(spark)).collect() == []


def test_rules_fire(spark):
    bad = samples.nodes(spark).where("path in ('core-terms', 'core-terms/1/1.2', 'core-terms/1/1.1')").selectExpr("* except (text, row, citable)", "if(kind = 'clause', 'x', null) as text", "1 as row", "citable")
    child = samples.nodes(spark).where("path = 'core-terms/1/1.1/a'")
    rules = {(r["path"], r["rule"]) for r in schemas.validate_nodes(bad.unionByName(child)).collect()}
    assert ("core-terms/1/1.1", "branch_or_leaf") in rules and ("core-terms/1/1.2", "place_outside_cell") in rules


def test_ancestors_and_texts(spark):
    n = samples.nodes(spark)
    up = {(r["ancestor"], r["up"]) for r in tree.ancestors(n).where("path = 'core-terms/1/1.1/a'").collect()}
    assert up == {("core-terms", 3), ("core-terms/1", 2), ("core-terms/1/1.1", 1)}
    assert tree.descendants(n, "core-terms/1").where("path = 'core-terms/1'").count() == 1
    assert tree.descendants(n, "core-terms/1/1").count() == 0
    text = tree.subtree_text(n).where("path = 'core-terms/2'").first()[1]
    assert text.startswith("Price The Buyer pays")
    derived = tree.derived_text(n).where("path = 'core-terms/2'").first()[1]
    assert derived.startswith("The Buyer pays") and derived.count("\n") == 2
    assert {r["path"] for r in tree.leaves(n).where("path like 'form-1%'").collect()} == {"form-1/1", "form-1/2"}
    assert tree.scan_units(n).where("path = 'core-terms/1/1.1'").count() == 0
    assert tree.provisions_of(n, "core-terms/1").count() == 4


def test_orders_extents_counts(spark):
    n = samples.nodes(spark)
    assert tree.preorder(n).alias("a").join(n.alias("b"), "path").where("a.ord <> b.ord").count() == 0
    box = tree.extents(n).where("path = 'core-terms'").first()
    assert (box["y0"], box["y1"], box["x0"]) == (80.0, 75.0 + 20 * 13, 60.0)
    assert tree.kind_counts(n).where("part = 'form-1' and kind = 'form_row'").first()["n"] == 2
    assert tree.page_ranges(n).where("path = 'core-terms'").first()["page_end"] == 1


def test_names(spark):
    names = {r["path"]: r["name"] for r in tree.human_names(tree.unit_labels(samples.nodes(spark))).collect()}
    assert names["core-terms/1/1.1/a"] == "Core Terms, Clause 1.1(a)"
    assert names["call-off-schedule-9/b/3/3.4"] == "Call-Off Schedule 9 (Security), Paragraph 3.4"


def test_stems_stamps_json(spark):
    rows = spark.createDataFrame([("p", "intro", 1), ("p", "intro", 2), ("q", "intro", 1)], "parent_path string, stem string, ord int")
    assert sorted(r["name"] for r in tree.stem_names(rows).collect()) == ["intro", "intro", "intro-2"]
    v = spark.createDataFrame([("core-terms/1", "overlap", None, "x"), ("core-terms/2", "gap", "seen", "y")], "path string, check string, reason string, detail string")
    notes = {r["path"]: r["anomalies"] for r in tree.stamped(samples.nodes(spark), v).where("path in ('core-terms/1', 'core-terms/2')").collect()}
    assert notes == {"core-terms/1": ["unresolved_overlap: x"], "core-terms/2": ["gap_seen: y"]}
    row = json.loads(tree.to_json(samples.nodes(spark)).where("path = 'core-terms/1'").first()["json"])
    assert "text" not in row and "anomalies" not in row and row["title"] == "Supply of widgets"


def test_tables(spark):
    cells = spark.createDataFrame([("p", 0, r, c, f"{r}{c}", "value", 0.7) for r in (0, 1) for c in (0, 1)], "parent_path string, table_no int, row int, col int, text string, role string, confidence double")
    got = tree.table_nodes(cells)
    assert got.where("kind = 'table'").first()["n_rows"] == 2 and got.where("path = 'p/table-0/1/0'").first()["text"] == "10"


def test_build_from_lines(spark):
    split = layout.split_furniture(samples.lines(spark), samples.pages(spark))
    body = split.where("not is_furniture").select(*samples.lines(spark).columns)
    nodes = {r["path"]: r for r in tree.build(layout.build_blocks(body)).collect()}
    assert nodes["core-terms/1/1.1"]["parent_path"] == "core-terms/1"
    assert nodes["core-terms/1/1.1/intro"]["text"] == "The Supplier delivers widgets in good time."
    assert nodes["core-terms/1/1.1/a"]["kind"] == "item"
    assert nodes["core-terms/1"]["title"] == "Supply"
    ids = tree.identified(tree.build(layout.build_blocks(body)), "d", "v1")
    assert ids.where("id is null").count() == 0


def test_restarted_numbers_open_a_scope(spark):
    rows = [("p", i, "number", n, n, d, 50.0, 10.0, False, True, t, 1, 1, []) for i, (n, d, t) in enumerate([("1", 1, "A"), ("1.1", 2, "x"), ("1", 1, "B"), ("1.1", 2, "y")])]
    blocks = spark.createDataFrame(rows, layout.BLOCKS)
    paths = [r["path"] for r in tree.build(blocks).orderBy("ord").collect()]
    assert paths == ["p", "p/1", "p/1/1.1", "p/part-2", "p/part-2/1", "p/part-2/1/1.1"]


def test_flatten(spark):
    tree_json = {"path": "p", "kind": "part", "title": "T", "children": [{"path": "p/1", "kind": "clause", "text": "x"}, {"path": "p/2", "kind": "clause", "text": "y", "children": []}]}
    got = tree.flatten(spark.createDataFrame([(json.dumps(tree_json),), ("{broken",)], "value string"))
    assert [(r["path"], r["ord"], r["sib_no"]) for r in got.orderBy("ord").collect()] == [("p", 0, 0), ("p/1", 1, 0), ("p/2", 2, 1)]
