"""Layout operators over the sample lines."""

import pytest
from pyspark.sql import functions as F

from lexweave.operators import layout
from lexweave.sources import samples


@pytest.fixture(scope="module")
def split(spark):
    return layout.split_furniture(samples.lines(spark), samples.pages(spark)).cache()


def test_furniture(split):
    got = {r["text"] for r in split.where("is_furniture").collect()}
    assert "Version: 3.0" in got and {"1", "2", "3", "4"} <= got and "Core Terms" in got and "1. Supply" not in got


def test_parts(split):
    parts = layout.detect_parts(layout.page_signatures(split)).orderBy("page_start").collect()
    assert [(p["part_id"], p["page_start"], p["page_end"], p["template_version"], p["family"]) for p in parts] == [("core-terms", 1, 2, "v3.0", "core_terms"), ("joint-schedule-1-definitions", 3, 4, "v3.0", "joint_schedule")]


@pytest.mark.parametrize("text, level, number", [("1. Supply", "heading", "1"), ("1.2 x", "clause", "1.2"), ("1.2.3. x", "subclause", "1.2.3"), ("1.2.3.4 x", "item", "1.2.3.4"), ("(a) x", "item", "a"), ("iv) x", "item", "iv"), ("(A) x", "item", "A"), ("plain", None, None)])
def test_numbers(spark, text, level, number):
    m = spark.createDataFrame([(text,)], "text string").select(layout.number_match("text").alias("m")).first()["m"]
    assert (m and m["level"], m and m["number"]) == (level, number)


@pytest.mark.parametrize("raw, key", [("3.0.11", "v3.0.11"), ("v 3.3", "v3.3"), ("V2", "v2"), (None, "v0"), (" ", "v0")])
def test_versions(spark, raw, key):
    assert spark.createDataFrame([(raw,)], "r string").select(layout.version_key("r")).first()[0] == key


def test_coverage_and_fit(spark):
    lines = samples.lines(spark)
    cover = {r["part"]: (r["numbered"], r["unmatched"]) for r in layout.numbering_coverage(lines).collect()}
    assert cover["core-terms"][1] == 0
    scores = layout.rulebook_scores(lines, {"default": layout.RULES, "none": {"heading": (1, "^never$")}}).first()
    assert scores["rulebook"] == "default"
    metrics = spark.createDataFrame([("p", "unmatched_rate", 0.5), ("q", "unmatched_rate", 0.01)], "part string, name string, value double")
    alarms = layout.fit_alarms(metrics)
    parts = spark.createDataFrame([("p",), ("q",)], "part_id string")
    assert {r["part_id"]: r["refused"] for r in layout.admitted(parts, alarms).collect()} == {"p": True, "q": False}
    assert layout.number_styles(lines).count() >= 3
    assert layout.find_interpretation(lines, ["means"], ["clause"]).first()["what"] == "cue_lines"


def test_ink_medians_indents(spark):
    lines = samples.lines(spark)
    ink = layout.orphan_ink(lines, lines.where("line_no > 1")).where("part = 'core-terms'").first()
    assert ink["residual"] == 2 * (len("CoreTerms") + len("Version:3.0"))
    blocks = layout.build_blocks(lines)
    assert layout.depth_out_of_range(blocks, 3).where("number = '1.1.1.1'").count() == 1
    flat = layout.indent_disagreement(blocks.where("part = 'core-terms'")).where("depth = 2").first()
    assert flat["tested"] and not flat["disagrees"]
    assert layout.modal_size(lines).where("part = 'core-terms'").first()["size"] == 10.0
    assert layout.font_histogram(lines).count() > 0 and layout.page_profile(lines, samples.pages(spark)).count() == 4
    clusters = layout.indent_clusters(spark.createDataFrame([("p", "clause", x) for x in (50.0, 51.0, 70.0)], "part string, level string, left double")).orderBy("edge").collect()
    assert [(c["edge"], c["n"]) for c in clusters] == [(50.0, 2), (70.0, 1)]


def test_visual_lines(spark):
    rows = [("p", 1, 0, 10.0, 100.0, 50.0, 112.0, "left", 10.0, False), ("p", 1, 1, 60.0, 102.0, 90.0, 113.0, "right", 10.0, False), ("p", 1, 2, 10.0, 130.0, 50.0, 140.0, "next", 10.0, True)]
    got = layout.visual_lines(spark.createDataFrame(rows, "part string, page int, line_no int, x0 double, y0 double, x1 double, y1 double, text string, size_max double, bold boolean")).orderBy("line_no").collect()
    assert [r["text"] for r in got] == ["left right", "next"]


def test_grids_and_cells(spark):
    rules = spark.createDataFrame([(1, 0.0, y, 100.0, y) for y in (0.0, 20.0, 40.0)] + [(1, x, 0.0, x, 40.0) for x in (0.0, 50.0, 100.0)], "page int, x0 double, y0 double, x1 double, y1 double")
    slots = layout.intervals(layout.grids(rules))
    lines = spark.createDataFrame([(1, 0, "a", 5.0, 5.0, 20.0, 10.0), (1, 1, "b", 60.0, 5.0, 80.0, 10.0), (1, 2, "c", 5.0, 25.0, 20.0, 30.0), (1, 3, "d", 5.0, 31.0, 20.0, 36.0)], "page int, line_no int, text string, x0 double, y0 double, x1 double, y1 double")
    got = {(r["row"], r["col"]): r["text"] for r in layout.fill_cells(slots, lines).collect()}
    assert got == {(0, 0): "a", (0, 1): "b", (1, 0): "c d"}
    cells = spark.createDataFrame([(1, 0, r, c, t, r == 0) for r, row in enumerate([("No", "Term", "Text"), ("1", "A", "x"), ("2", "B", "y")]) for c, t in enumerate(row)], "page int, grid long, row int, col int, text string, bold boolean")
    roles = {(r["row"], r["col"]): r["role"] for r in layout.cell_roles(cells).collect()}
    assert roles[0, 1] == "header" and roles[1, 0] == "number" and roles[1, 1] == "label" and roles[1, 2] == "value"


def test_gaps_stitching_tokens(spark):
    lines = spark.createDataFrame([(1, 0, 0, 0, y, y + 10.0) for y in (0.0, 12.0, 60.0)], "page int, grid int, row int, col int, y0 double, y1 double")
    assert layout.undrawn_gaps(lines).first()["gap"] == 38.0
    tables = spark.createDataFrame([("p", 0, 1, 1, 2, 3), ("p", 1, 2, 2, 2, 2), ("p", 2, 4, 4, 2, 1)], "part string, idx int, page_start int, page_end int, n_cols int, n_rows int")
    assert [(r["chain"], r["row_offset"]) for r in layout.stitched_tables(tables).orderBy("idx").collect()] == [(1, 0), (1, 3), (2, 0)]
    words = spark.createDataFrame([(1, "1.1", 50.0, 10.0, 60.0, 20.0), (1, "1.1", 90.0, 10.0, 99.0, 20.0)], "page int, text string, x0 double, y0 double, x1 double, y1 double")
    lines = spark.createDataFrame([(1, 0, "1.1", 9.0, 21.0)], "page int, line_no int, token string, y0 double, y1 double")
    assert layout.token_boxes(words, lines).first()["x0"] == 50.0


def test_heading_like(spark):
    col = layout.heading_like(F.col("s"), F.lit(10.0), F.col("b"), F.col("d"), F.col("t"))
    rows = spark.createDataFrame([(12.0, False, 2, "x."), (10.0, True, 1, "x."), (10.0, True, 2, "short"), (10.0, False, 2, "x")], "s double, b boolean, d int, t string")
    assert [r[0] for r in rows.select(col).collect()] == [True, True, True, False]
