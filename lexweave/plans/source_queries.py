"""Queries of readers, writers, logs and caches, and of the operators that work on their tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave import schemas
from lexweave.functions import fuzzy, ids
from lexweave.operators import concepts, embeddings, evaluation, graph, layout, resolution, tools, tree, vocabulary
from lexweave.operators.concepts import shared_folder
from lexweave.plans import tree_queries
from lexweave.plans.catalog import query, table
from lexweave.plans.operator_queries import _concepts, _none, _text, _uses
from lexweave.sources import providers, tables


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _put(spark: SparkSession, files: dict[str, str]) -> str:
    """A folder of small files, written through the file system that Spark reads."""
    folder = _folder(spark, "files")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for name, text in files.items():
        out = fs.create(path(f"{folder}/{name}"), True)
        out.write(bytearray(text.encode()))
        out.close()
    return folder


# ---- files


@query("SELECT 'd' || doc_id % 20 AS part, 'd' || doc_id % 20 || '/' || doc_id AS path, CAST(1 AS INTEGER) AS depth FROM documents")
def json_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty files with a nested tree each, written and read back as rows."""
    child = F.struct(_text("d", F.col("doc_id") % 20, "/", F.col("doc_id")).alias("path"), F.lit("clause").alias("kind"))
    trees = table(spark, sf_dir, "documents").groupBy(_text("d", F.col("doc_id") % 20).alias("path")).agg(F.collect_list(child).alias("children"))
    folder = _folder(spark, "trees")
    rows = trees.select(F.col("path").alias("nr"), F.to_json(F.struct("path", F.lit("part").alias("kind"), "children")).alias("value"))
    rows.repartition("nr").write.partitionBy("nr").text(folder)
    return tables.json_trees(spark, folder).where("depth = 1").select("part", "path", "depth")


_FILES = {"a.json": '{"kind": "part", "path": "a"}', "index.json": '{"parts": []}', "broken.json": '{"kind": '}


@query("SELECT * FROM (VALUES ('a.json', 'part'), ('index.json', 'manifest'), ('broken.json', 'unreadable')) t(file, what)")
def discovered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.discover(spark, _put(spark, _FILES))


@query("SELECT * FROM (VALUES ('a.json', 'loaded'), ('broken.json', 'failed'), ('gone.json', 'absent'), ('index.json', 'skipped')) t(file, state)")
def file_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.tri_state(spark, ["a.json", "broken.json", "gone.json", "index.json"], _put(spark, _FILES), ["index.json"])


@query("SELECT 'r' || arg_max(o_custkey % 7, (o_orderdate, 'r' || o_custkey % 7)) AS run FROM orders")
def newest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "orders").select(_text("r", F.col("o_custkey") % 7).alias("run"), F.col("o_orderdate").alias("mtime"))
    return tables.newest_run(files)


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 10 > 0 THEN c_name END AS name, c_custkey % 10 = 0 AS broken FROM customer")
def tolerant_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth line is cut off and comes back as it stands."""
    k = F.col("c_custkey")
    folder = _folder(spark, "lines")
    table(spark, sf_dir, "customer").select(F.when(k % 10 == 0, _text('{"k": ', k)).otherwise(F.to_json(F.struct(k.alias("k"), F.col("c_name").alias("name")))).alias("value")).write.text(folder)
    good, bad = tables.json_lines(spark, folder, "k long, name string")
    return good.select("k", "name", F.lit(False).alias("broken")).unionByName(bad.select(F.regexp_extract("value", r"(\d+)", 1).cast("long").alias("k"), _none().alias("name"), F.lit(True).alias("broken")))


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def written_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "json")
    tables.write_json_lines(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal"), folder, ["s_suppkey"])
    return spark.read.schema("s_suppkey long, s_name string, s_acctbal double").json(folder)


@query("SELECT 'there' AS what, count(*) AS n FROM supplier UNION ALL SELECT 'absent', 0")
def tolerant_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda df, what: df.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n")
    ddl = "s_suppkey long, s_name string"
    return count(tables.tolerant(spark, f"{sf_dir}/supplier.parquet", ddl), "there").unionByName(count(tables.tolerant(spark, f"{sf_dir}/nothing.parquet", ddl), "absent"))


@query("SELECT 'node' AS kind, 'c' || c_custkey AS key FROM customer UNION ALL SELECT 'link', 'HAS|c' || o_custkey || '|o' || o_orderkey || '|' FROM orders")
def graph_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "customer").select(_text("c", F.col("c_custkey")).alias("id"), "c_name")
    edges = table(spark, sf_dir, "orders").select(F.lit("HAS").alias("type"), _text("c", F.col("o_custkey")).alias("src"), _text("o", F.col("o_orderkey")).alias("dst"), F.create_map().cast("map<string,string>").alias("props"))
    rows = tables.graph_json(nodes, edges)
    return rows.select("kind", F.coalesce(F.get_json_object("json", "$.key"), F.get_json_object("json", "$.id")).alias("key"))


@query("SELECT 's' || l_suppkey % 10 AS part, CAST(l_orderkey % 50 AS INTEGER) AS page, count(*) AS n FROM lineitem GROUP BY 1, 2")
def stored_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark, "layout")
    tables.write_layout(table(spark, sf_dir, "lineitem").select(_text("s", F.col("l_suppkey") % 10).alias("part"), (F.col("l_orderkey") % 50).cast("int").alias("page"), F.col("l_linenumber").alias("line_no")), folder)
    return spark.read.parquet(folder).groupBy("part", "page").agg(F.count("*").alias("n"))


@query("SELECT CASE event_id % 3 WHEN 0 THEN 'agreed' WHEN 1 THEN 'refused: unknown_verdict' ELSE 'refused: no_subject' END AS state, count(*) AS n FROM events GROUP BY 1")
def decision_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, folder = F.col("event_id") % 3, _folder(spark, "decisions")
    rows = table(spark, sf_dir, "events").select(F.when(k < 2, _text("e", F.col("event_id"))).alias("id"), F.when(k == 1, "perhaps").otherwise("agreed").alias("verdict"))
    refused = tables.append_decisions(rows, folder, ["agreed"])
    state = spark.read.parquet(folder).select(F.col("verdict").alias("state")).unionByName(refused.select(_text("refused: ", F.col("refused")).alias("state")))
    return state.groupBy("state").agg(F.count("*").alias("n"))


@query("SELECT 'rollback' AS op, count(*) AS affected_count, least(count(*), 200) AS listed, min('c' || c_custkey) AS first FROM customer")
def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = tables.audit_row("rollback", "test", table(spark, sf_dir, "customer").select(_text("c", F.col("c_custkey")).alias("id")))
    return row.select("op", "affected_count", F.size("affected").cast("long").alias("listed"), F.col("affected")[0].alias("first"))


_GOLDEN = {
    "decisions.jsonl": '{"kind": "ref", "path": "a/ref@1-3", "verdict": "correct"}\n{"kind": "ref", "path": "b", "verdict": "maybe"}\n',
    "more.jsonl": '{"kind": "term", "path": "c", "verdict": "wrong"}\nnot json\n',
}


@query("SELECT * FROM (VALUES ('a/ref@1-3', 'correct', 0), ('c', 'wrong', 1), ('b', 'unusable', -1), (NULL, 'unusable', -1)) t(path, verdict, file_no)")
def golden_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, odd = tables.golden_labels(spark, _put(spark, _GOLDEN), ["correct", "wrong"])
    return good.select("path", "verdict", "file_no").unionByName(odd.select(F.get_json_object("value", "$.path").alias("path"), F.lit("unusable").alias("verdict"), F.lit(-1).alias("file_no")))


@query("SELECT * FROM (VALUES ('core-terms', 'Core Terms', 1, 22), ('form-1', 'Order Form', 23, 23)) t(part_id, title, page_start, page_end)")
def page_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.page_map(spark, _put(spark, {"map.md": "# Map\n\n| id | title | pages |\n| - | - | - |\n| core-terms | Core Terms | 1 - 22 |\n| form-1 | Order Form | 23 |\n"}))


@query("SELECT * FROM (VALUES ('a-1', 'Title A'), ('b-2', 'Title B'), ('c-3', 'Title C')) t(part_id, title)")
def part_registries(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = {"map.json": '{"a-1": "Title A"}', "list.json": '[{"id": "b-2", "title": "Title B"}]', "parts.json": '{"parts": [{"part_id": "c-3", "title": "Title C"}]}', "bad.json": "{"}
    found = [tables.part_registry(spark, f"{_put(spark, {n: t})}/{n}") for n, t in shapes.items()]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query("SELECT * FROM (VALUES ('legislation/a-act-1990', 'A Act', 1990), ('legislation/b-act', 'B Act', NULL)) t(key, title, year)")
def statute_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = '{"records": [{"key": "legislation/a-act-1990", "title": "A Act", "year": 1990}, {"key": "legislation/b-act", "title": "B Act", "year": 0}, {"title": "no key"}]}'
    return tables.legislation_records(spark, _put(spark, {"records.json": text})).select("key", "title", "year")


@query("SELECT 'c' || c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'second' ELSE 'first' END AS load FROM customer")
def published_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; readers see the last one whole."""
    store = tables.SnapshotStore(spark, _folder(spark, "store"))
    c = table(spark, sf_dir, "customer").select(_text("c", F.col("c_custkey")).alias("id"), "c_custkey")
    store.publish({"nodes": c.select("id", F.lit("first").alias("load"))})
    changed = c.where("c_custkey % 2 = 0").select("id", F.lit("second").alias("load"))
    old = store.read("nodes", "id string, load string")
    store.publish({"nodes": old.join(changed.select("id"), "id", "left_anti").unionByName(changed)})
    return store.read("nodes", "id string, load string")


@query("SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN 'stored' ELSE upper(p_brand || p_partkey) END AS reply FROM part")
def provider_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored replies are replayed, others asked for; a call that always fails stays without one."""

    def provider(task: str, payload: str) -> str:
        if payload.startswith("fail"):
            raise OSError("down")
        return payload.upper()

    k = F.col("p_partkey")
    payload = F.when(k % 50 == 0, _text("fail", k)).otherwise(F.concat("p_brand", k.cast("string")))
    calls = table(spark, sf_dir, "part").select("p_partkey", F.lit("t").alias("task"), F.lit("1").alias("version"), payload.alias("payload"))
    cache = calls.where("p_partkey % 2 = 0 and p_partkey % 50 > 0").select(tables.replay_key("task", "version", "payload").alias("key"), F.lit("stored").alias("reply"), _none().alias("error"))
    done, _ = providers.complete(calls, cache, provider)
    return calls.select("p_partkey").join(done.select("p_partkey", "reply"), "p_partkey", "left")


@query("SELECT 'n' || doc_id AS node_id, 's' || length(text) AS reply FROM documents WHERE doc_id % 3 = 0 AND text IS NOT NULL")
def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = table(spark, sf_dir, "documents").where("text is not null").select(_text("n", F.col("doc_id")).alias("node_id"), F.when(F.col("doc_id") % 3 == 0, "summary").otherwise("leaf").alias("level"), "text")
    done, _ = providers.summaries(planned, spark.createDataFrame([], providers.REPLIES), lambda task, text: f"s{len(text)}")
    return done.select("node_id", "reply").distinct()


# ---- layout


@query("SELECT l_orderkey // 50 AS page, CAST(row_number() OVER (PARTITION BY l_orderkey // 50 ORDER BY l_orderkey, l_linenumber) - 1 AS INTEGER) AS line_no, 'n' || l_orderkey || '.' || l_linenumber || ' words' AS text FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)")
def visual_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pieces at nearly one height make a line, in the order of their left edges; fifty orders a page."""
    place = F.col("l_orderkey") % 50 * 10 + F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    piece = lambda x, dy, text, nr: F.struct(F.lit(x).alias("x0"), (20.0 * place + dy).alias("y0"), F.lit(x + 90).alias("x1"), (12.0 + 20 * place + dy).alias("y1"), text.alias("text"), (2 * place + nr).cast("int").alias("line_no"))
    lines = rows.select(F.lit("p").alias("part"), F.floor(F.col("l_orderkey") / 50).cast("int").alias("page"), F.explode(F.array(piece(200.0, 0.0, F.lit("words"), 0), piece(50.0, 2.0, _text("n", F.col("l_orderkey"), ".", F.col("l_linenumber")), 1))).alias("x"))
    lines = lines.select("part", "page", "x.line_no", "x.x0", "x.y0", "x.x1", "x.y1", "x.text", F.lit(10.0).alias("size_max"), F.lit(False).alias("bold"))
    return layout.visual_lines(lines).select(F.col("page").cast("long").alias("page"), "line_no", "text")


@query("""
WITH c AS (SELECT 's' || l_suppkey % 10 AS part, l_linenumber % 4 AS k, min(l_orderkey % 3) AS lo, count(*) AS n FROM lineitem GROUP BY 1, 2), t AS (SELECT part, sum(n) AS total FROM c GROUP BY 1)
SELECT part, 50.0 + 30 * k + lo AS edge, n, n >= greatest(1, ceil(0.05 * total)) AS supported FROM c JOIN t USING (part)
""")
def indent_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(_text("s", F.col("l_suppkey") % 10).alias("part"), F.lit("clause").alias("level"), (50.0 + 30 * (F.col("l_linenumber") % 4) + F.col("l_orderkey") % 3).alias("left"))
    return layout.indent_clusters(rows).select("part", "edge", "n", "supported")


@query("SELECT p_partkey, p_size > 30 OR p_partkey % 2 = 0 AND (p_partkey % 3 = 1 OR p_partkey % 5 > 0) AS heading FROM part")
def heading_typography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger than the body, or bold and at the top, or bold, short and without a full stop."""
    k = F.col("p_partkey")
    size = F.when(F.col("p_size") > 30, 11.0).otherwise(10.0)
    return table(spark, sf_dir, "part").select("p_partkey", layout.heading_like(size, F.lit(10.0), k % 2 == 0, k % 3, F.concat("p_name", F.when(k % 5 == 0, ".").otherwise(""))).alias("heading"))


@query("""
SELECT l_orderkey AS page, l_linenumber AS row, 30.0 AS gap FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY 1, 2
""")
def undrawn_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of even rows hold two lines thirty points apart, others two points."""
    n = F.col("l_linenumber")
    cells = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), n.alias("row")).distinct()
    top = F.array(F.lit(0.0), F.when(F.col("row") % 2 == 0, 40.0).otherwise(12.0))
    lines = cells.select("page", F.lit(0).alias("grid"), "row", F.lit(0).alias("col"), F.explode(top).alias("y0")).withColumn("y1", F.col("y0") + 10)
    return layout.undrawn_gaps(lines).select("page", "row", "gap")


@query("SELECT 'cue_lines' AS what, '' AS value, count(*) AS n FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT 'unknown_unit', 'Articles', count(*) FROM supplier WHERE s_suppkey % 3 = 1 HAVING count(*) > 0")
def interpretation_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") % 3
    text = F.when(k == 0, "In this Schedule the following apply").when(k == 1, 'the "Articles" and the "Clauses"').otherwise("plain")
    return layout.find_interpretation(table(spark, sf_dir, "supplier").select(text.alias("text")), ["In this Schedule"], ["Clause"])


# ---- trees, references, concepts


@query("SELECT 'p' || p_partkey % 4 || '/' || p_partkey AS path, CASE p_partkey % 4 WHEN 0 THEN 'Clause' WHEN 3 THEN NULL ELSE 'Paragraph' END AS unit_label FROM part")
def unit_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    families = spark.createDataFrame([("p0", "core_terms"), ("p1", "joint_schedule"), ("p2", "call_off_schedule"), ("p3", "other")], "path string, part_family string")
    tops = families.select("path", F.col("path").alias("part"), F.lit("part").alias("kind"), "part_family")
    own = table(spark, sf_dir, "part").select(_text("p", F.col("p_partkey") % 4, "/", F.col("p_partkey")).alias("path"), _text("p", F.col("p_partkey") % 4).alias("part"), F.lit("clause").alias("kind"), _none().alias("part_family"))
    return tree.unit_labels(tops.unionByName(own)).where("kind = 'clause'").select("path", "unit_label")


@query("SELECT p_partkey, round(100 * (1 - 1 / (2 * length(p_name) - 1)), 4) AS cut, CASE WHEN string_split(p_name, ' ')[1] = string_split(p_name, ' ')[2] THEN 100.0 ELSE 95.0 END AS swapped FROM part")
def similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name without its last letter by the plain ratio, and its two words in the other order by the weighted one."""
    p = table(spark, sf_dir, "part")
    cut = F.expr("substring(p_name, 1, length(p_name) - 1)")
    other = F.concat_ws(" ", F.split_part("p_name", F.lit(" "), F.lit(2)), F.split_part("p_name", F.lit(" "), F.lit(1)))
    return p.select("p_partkey", F.round(fuzzy.similarity("p_name", cut), 4).alias("cut"), F.round(fuzzy.weighted_similarity("p_name", other), 4).alias("swapped"))


@query("SELECT 'corpus' AS document, 'v1' AS version, count(*) AS n FROM documents")
def inferred_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "documents").select(_text("d/", F.col("doc_id")).alias("path")).withColumn("id", ids.node_id(F.lit("corpus"), F.lit("v1"), "path"))
    return resolution.infer_identity(nodes, ["other", "corpus"], ["v0", "v1"])


def _refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 4
    status = F.when(k == 0, "ambiguous").when(k < 3, "unresolved").otherwise("resolved")
    found = F.when(k < 2, F.array(F.struct(_text("t", F.col("o_custkey")).alias("path"), F.lit(0.5).cast("double").alias("score"), F.lit("r").alias("reason")))).otherwise(F.array().cast(schemas.CANDIDATES))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", _text("o", F.col("o_orderkey")).alias("path"), status.alias("status"), F.when(k == 3, "x").alias("target_path"), F.lit(0.1).alias("confidence"), F.lit("scope").alias("resolver"), found.alias("candidates"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 4 < 2")
def residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolution.residue(_refs(spark, sf_dir)).select("o_orderkey")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 AND o_orderkey % 3 = 0 AND o_custkey % 2 = 0 THEN 'resolved' WHEN o_orderkey % 4 < 2 AND o_orderkey % 3 = 0 THEN 'unresolved' ELSE CASE WHEN o_orderkey % 4 = 0 THEN 'ambiguous' WHEN o_orderkey % 4 < 3 THEN 'unresolved' ELSE 'resolved' END END AS status,
 CASE WHEN o_orderkey % 4 < 2 AND o_orderkey % 3 = 0 AND o_custkey % 2 = 0 THEN 0.9 ELSE 0.1 END AS confidence, CASE WHEN o_orderkey % 4 < 2 THEN CASE WHEN o_orderkey % 3 = 0 AND o_custkey % 2 = 1 THEN 0.55 ELSE 0.5 END END AS score FROM orders
""")
def applied_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chosen candidate resolves where its node is held, and gains a little where not; other choices are void."""
    refs = _refs(spark, sf_dir)
    choices = refs.where("o_orderkey % 3 = 0").select("path", _text("t", F.col("o_custkey")).alias("chosen"), F.lit(0.9).alias("confidence"))
    held = refs.where("o_custkey % 2 = 0").select(_text("t", F.col("o_custkey")).alias("path")).distinct()
    done = resolution.apply_choices(refs, choices, held)
    return done.select("o_orderkey", "status", "confidence", F.round(F.try_element_at("candidates", F.lit(1))["score"], 6).alias("score"))


@query("""
SELECT 'x' || o_orderkey AS path FROM orders WHERE o_orderkey % 2 <> o_custkey % 2 AND o_orderkey % 3 > 0
""")
def crossing_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References out of the sub-part that they stand in."""
    o = table(spark, sf_dir, "orders")
    home, far = _text("s/p", F.col("o_orderkey") % 2), _text("s/p", F.col("o_custkey") % 2)
    tops = spark.createDataFrame([("s", "part", "S", None), ("s/p0", "heading", "Part A: one", "s"), ("s/p1", "heading", "Part B: two", "s")], "path string, kind string, title string, parent_path string")
    own = o.select(F.explode(F.array(F.concat(home, _text("/o", F.col("o_orderkey"))), F.concat(far, _text("/c", F.col("o_custkey"))))).alias("path")).distinct()
    nodes = tops.unionByName(own.select("path", F.lit("clause").alias("kind"), _none().alias("title"), F.regexp_replace("path", "/[^/]+$", "").alias("parent_path")))
    refs = o.select(_text("x", F.col("o_orderkey")).alias("path"), F.lit("s").alias("part"), F.concat(home, _text("/o", F.col("o_orderkey"))).alias("parent_path"), F.when(F.col("o_orderkey") % 3 > 0, F.concat(far, _text("/c", F.col("o_custkey")))).alias("target_path"))
    return resolution.crossings(refs, nodes).select("path")


@query("""
SELECT event_type AS term, 'n' || user_id AS node_id, 'span' AS rule FROM events WHERE event_id % 4 = 1 OR user_id % 5 = 0 UNION ALL SELECT p_name, 'lost' || p_partkey, 'missing_node' FROM part WHERE p_partkey % 2 = 0
""")
def broken_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    uses = e.select(F.col("event_type").alias("term"), _text("n", F.col("user_id")).alias("node_id"), F.struct(F.lit(4).alias("start"), F.lit(8).alias("end")).alias("char_span"), F.lit("text").alias("field"), F.when(F.col("event_id") % 4 == 1, "more").otherwise("text").alias("surface"))
    nodes = e.where("user_id % 5 <> 0").select(_text("n", F.col("user_id")).alias("id")).distinct().select("id", F.lit("the text here").alias("text"), _none().alias("title"))
    p = table(spark, sf_dir, "part")
    kept = nodes.unionByName(p.where("p_partkey % 2 = 1").select(_text("lost", F.col("p_partkey")).alias("id"), F.lit("t").alias("text"), _none().alias("title")))
    return vocabulary.broken_uses(uses, kept, p.select(F.col("p_name").alias("term"), _text("lost", F.col("p_partkey")).alias("definition_node_id")))


@query("""
WITH o AS (SELECT DISTINCT user_id FROM events), t AS (SELECT max(user_id) AS total FROM o)
SELECT event_type AS term, '1' AS words, CASE WHEN user_id / greatest(total - 1, 1) < 1/3 THEN 'early' WHEN user_id / greatest(total - 1, 1) < 2/3 THEN 'middle' ELSE 'late' END AS position, count(*) AS n FROM events, t WHERE event_id % 4 > 1 GROUP BY 1, 2, 3
""")
def audited_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "events").select(F.col("user_id").alias("ord")).distinct().select(_text("n", F.col("ord")).alias("id"), "ord", _text("p/", F.col("ord")).alias("path"))
    return vocabulary.audit_population(_uses(spark, sf_dir), nodes).groupBy("term", "words", "position").agg(F.count("*").alias("n"))


@query("SELECT 'k' || p_partkey AS src, 'needs' AS verb, 'k' || (p_partkey + 1) AS dst FROM part WHERE p_partkey + 1 IN (SELECT p_partkey FROM part)")
def concept_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations to the next label; those to no label, to oneself and by a verb that is a label are dropped."""
    k = F.col("p_partkey")
    relation = lambda verb, target: F.struct(F.lit(verb).alias("verb"), target.alias("target"))
    c = table(spark, sf_dir, "part").select(_text("k", k).alias("id"), _text("Label ", k).alias("label"), F.lit(0.5).alias("confidence"), F.array(relation("Needs", _text("LABEL ", k + 1)), relation("is", _text("label ", k)), relation("label 3", _text("label ", k + 1)), relation("is", F.lit("nothing"))).alias("relations"))
    none = spark.createDataFrame([], "a string, b string")
    return concepts.remapped_relations(c, c, none)


@query("""
SELECT name, count, of FROM (
 SELECT 'duplicates' AS name, (SELECT count(*) - count(DISTINCT p_name) FROM part) AS count, (SELECT count(*) FROM part) AS of
 UNION ALL SELECT 'covered_units', (SELECT count(DISTINCT p_size) FROM part WHERE p_size % 2 = 0), (SELECT count(DISTINCT p_size) FROM part)
 UNION ALL SELECT 'collisions', 1, (SELECT count(*) FROM part)
 UNION ALL SELECT 'orphans', (SELECT count(*) FROM part WHERE p_size % 2 = 1), (SELECT count(*) FROM part))
""")
def concept_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _concepts(spark, sf_dir)
    first = c.groupBy("label").agg(F.min("id").alias("a"))
    pairs = c.join(first, "label").where("a <> id").select("a", F.col("id").alias("b"))
    units = table(spark, sf_dir, "part").select(_text("u", F.col("p_size")).alias("path"), "p_size").distinct()
    nodes = units.where("p_size % 2 = 0").select("path", _text("n", F.col("p_size")).alias("id"))
    return evaluation.concept_hygiene(c, pairs, units, nodes, spark.createDataFrame([("k1",)], "id string"))


@query("""
SELECT 'r' || n_regionkey || '/n' || n_nationkey || '/c' || c_custkey AS path,
 concat_ws(' ', lag(c_name) OVER w, c_name, lead(c_name) OVER w) AS text FROM customer JOIN nation ON n_nationkey = c_nationkey WINDOW w AS (PARTITION BY n_nationkey ORDER BY c_custkey)
""")
def leaf_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = tree_queries.nodes(spark, sf_dir).withColumn("id", F.col("path"))
    return embeddings.plan(nodes, window=True).where("level = 'leaf_window' and path like '%/c%'").select("path", "text")


# ---- evaluation


@query("SELECT 'o' || l_orderkey || '/' || l_linenumber AS path, 'o' || l_orderkey AS against FROM lineitem WHERE l_linenumber % 3 = 0 GROUP BY 1, 2")
def left_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children whose box begins left of their parent's by over the tolerance."""
    n = F.col("l_linenumber")
    box = lambda x0, y0, y1: F.array(F.struct(F.lit(1).alias("page"), x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), F.lit(500.0).alias("x1"), y1.cast("double").alias("y1")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    kids = rows.select(_text("o", F.col("l_orderkey"), "/", n).alias("path"), _text("o", F.col("l_orderkey")).alias("parent_path"), n.alias("sib_no"), F.lit("clause").alias("kind"), box(F.when(n % 3 == 0, 40).otherwise(49), 100 + 20 * n, 115 + 20 * n).alias("bboxes_own"))
    tops = rows.select("l_orderkey").distinct().select(_text("o", F.col("l_orderkey")).alias("path"), _none().alias("parent_path"), F.lit(0).alias("sib_no"), F.lit("clause").alias("kind"), box(F.lit(50), F.lit(90), F.lit(100)).alias("bboxes_own"))
    nodes = tops.unionByName(kids).withColumn("bboxes_extent", F.col("bboxes_own"))
    return evaluation.geometry_checks(nodes)[0].select("path", "against")


@query("""
SELECT 'p' || p_partkey % 20 AS part, CASE WHEN p_partkey % 2 = 0 THEN sha1(p_partkey || '') END AS entry, 'p' || p_partkey % 20 || '/' || p_partkey AS path, CASE WHEN p_partkey % 2 = 0 THEN 'label' ELSE 'tree_only' END AS how FROM part
""")
def outline_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries for even provisions meet them by label; the others stand in the tree alone."""
    k = F.col("p_partkey")
    nodes = table(spark, sf_dir, "part").select(_text("p", k % 20).alias("part"), k.alias("ord"), _text("p", k % 20, "/", k).alias("path"), _text("L", k).alias("label"), F.sha1(k.cast("string")).alias("title"))
    return evaluation.outline_triage(nodes.where("ord % 2 = 0").select("part", F.col("ord").alias("nr"), "label", "title"), nodes)


@query("SELECT true AS same, false AS other")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table in two orders has one fingerprint; another table has another."""
    s = table(spark, sf_dir, "supplier")
    a, b, c = evaluation.fingerprint(s), evaluation.fingerprint(s.repartition(7).select(*reversed(s.columns))), evaluation.fingerprint(s.where("s_suppkey > 1"))
    return spark.createDataFrame([(a == b, a == c)], "same boolean, other boolean")


@query("SELECT s_suppkey, (SELECT count(*) FROM supplier) - least(25, (SELECT count(*) FROM supplier)) AS hidden FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 25")
def capped_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report's list and the number of rows that it hides."""
    rows, hidden = evaluation.capped(table(spark, sf_dir, "supplier"), [F.desc("s_acctbal"), "s_suppkey"])
    return rows.select("s_suppkey", F.lit(hidden).cast("long").alias("hidden"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN 'held/' || o_custkey ELSE 'p/' || o_custkey END AS subject, CAST(CASE o_orderkey % 3 WHEN 0 THEN o_orderkey ELSE 7 END AS INTEGER) AS start FROM orders
""")
def golden_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference's path holds its span, others carry theirs; a label without a path has that of its node."""
    k, o = F.col("o_orderkey") % 3, table(spark, sf_dir, "orders")
    path = F.when(k == 0, _text("p/", F.col("o_custkey"), "/ref@", F.col("o_orderkey"), "-", F.col("o_orderkey") + 4)).when(k == 1, _text("p/", F.col("o_custkey")))
    labels = o.select("o_orderkey", _text("n", F.col("o_custkey")).alias("node_id"), path.alias("path"), F.when(k > 0, F.struct(F.lit(7).alias("start"), F.lit(9).alias("end"))).alias("char_span"))
    nodes = o.select("o_custkey").distinct().select(_text("n", F.col("o_custkey")).alias("id"), _text("held/", F.col("o_custkey")).alias("path"))
    return evaluation.golden_subjects(labels, nodes).select("o_orderkey", "subject", "start")


@query("""
WITH RECURSIVE d AS (SELECT 0 AS k, 1 AS depth UNION ALL SELECT c_custkey, depth + 1 FROM d JOIN customer ON c_custkey // 2 = k AND c_custkey > 0)
SELECT count(*) AS components, max(depth) AS longest_chain, CAST(1 AS BIGINT) AS cyclic FROM d
""")
def definition_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each definition uses the one of half its number; the first uses itself."""
    k = F.col("c_custkey")
    edges = table(spark, sf_dir, "customer").select(_text("c", k).alias("src"), _text("c", F.floor(k / 2)).alias("dst"))
    found = evaluation.cycles_and_depth(edges)
    return spark.createDataFrame([(found["components"], found["longest_chain"], len(found["cyclic"]))], "components long, longest_chain int, cyclic long")


@query("SELECT p_name AS label, count(*) AS n FROM part WHERE p_name = 'red widget' GROUP BY 1")
def concepts_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "part").select(_text("n", F.col("p_size")).alias("id"), _text("p/", F.col("p_size")).alias("path")).distinct()
    c = _concepts(spark, sf_dir).withColumn("relations", F.array().cast("array<struct<src:string,label:string,dst:string>>"))
    g = tools.Graph(nodes, nodes, nodes, nodes, c)
    return tools.find_by_concept(g, "Red  Widget".replace("  ", " "), 99.0).groupBy("label").agg(F.count("*").alias("n"))


@query("SELECT * FROM (VALUES (1, 'ok'), (2, 'unknown_tool'), (3, 'budget_exhausted')) t(nr, outcome)")
def tool_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three calls on a budget of two: one answers, one has no such name, one is too many."""
    nodes = tree_queries.nodes(spark, sf_dir).withColumns({"citable": F.lit(True), "bboxes_own": F.array().cast(schemas.BOXES), "bboxes_extent": F.array().cast(schemas.BOXES)})
    runner = tools.ToolRunner(tools.Graph(nodes, nodes, nodes, nodes, nodes), budget=2)
    results = [runner.run("cite", path="r1"), runner.run("nothing"), runner.run("cite", path="r2")]
    return spark.createDataFrame([(i + 1, r["error"] if isinstance(r, dict) else "ok") for i, r in enumerate(results)], "nr int, outcome string")


@query("""
WITH n AS (SELECT 'r' || n_regionkey || '/n' || n_nationkey AS path FROM nation WHERE n_regionkey = 1)
SELECT path AS src, 'r1' AS dst, 'settled' AS state FROM n UNION ALL SELECT path, 'legislation/x', 'external' FROM n
""")
def answer_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = tree_queries.nodes(spark, sf_dir).withColumn("label", _none())
    nations = nodes.where("path like 'r%/n%' and path not like '%/c%'")
    one = nations.select(F.col("path").alias("parent_path"), F.lit("resolved").alias("status"), F.split_part("path", F.lit("/"), F.lit(1)).alias("target_path"), F.array().cast(schemas.CANDIDATES).alias("candidates"))
    two = nations.select(F.col("path").alias("parent_path"), F.lit("external").alias("status"), F.lit("legislation/x").alias("target_path"), F.array().cast(schemas.CANDIDATES).alias("candidates"))
    paths = [r["path"] for r in nations.where("path like 'r1/%'").select("path").collect()]  # at most twelve
    return tools.answer_graph(tools.Graph(nodes, one.unionByName(two), nodes, nodes, nodes), paths)[1]


@query("SELECT 'n' || c_nationkey AS src, 'm' || c_custkey AS dst FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'x', 'y' WHERE false")
def superseding_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of one lineage and another id supersede each other; equal ids do not."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string").alias("lineage_key")
    old = c.select(key, _text("m", F.col("c_custkey")).alias("id"))
    new = c.select(key, F.when(F.col("c_custkey") % 2 == 0, _text("n", F.col("c_nationkey"))).otherwise(_text("m", F.col("c_custkey"))).alias("id"))
    return graph.supersedes_edges(old, new).select("src", "dst")
