"""Lookups, review queue, files, stores and streams."""

import json

import pytest

from lexweave import schemas
from lexweave.operators import tools
from lexweave.plans.sample_queries import sample_graph
from lexweave.sources import samples, tables
from lexweave.streaming import events


@pytest.fixture(scope="module")
def graph(spark):
    return sample_graph(spark)


def test_find_and_get(graph):
    found = tools.find_provision(graph, "withhold charges").collect()
    assert len(found) == 8 and "core-terms/2/2.3" in [r["path"] for r in found][:3]
    assert [r["score"] for r in found] == sorted((r["score"] for r in found), reverse=True)
    got = tools.get_provision(graph, "core-terms/2/2.1").first()
    assert got["children"] == ["core-terms/2/2.1/a", "core-terms/2/2.1/b"] and got["derived_text"].count("\n") == 1
    assert tools.get_provision(graph, "nowhere").count() == 0


def test_references_define_cite(graph):
    out = [r["text"] for r in tools.follow_references(graph, "core-terms/1/1.1").collect()]
    assert "2.1(a)" in out and "9.9" not in out
    back = tools.follow_references(graph, "core-terms/2/2.1", "inbound").collect()
    assert [r["parent_path"] for r in back] == ["core-terms/1/1.1/intro"]
    kpi = tools.define(graph, "KPI").first()
    assert kpi["term"] == "Key Performance Indicator" and len(kpi["governs"]) == 4
    assert tools.define(graph, "supplier").first()["term"] == "Supplier"
    assert tools.define(graph, "Charges").first()["gap"] == "delegated"
    assert tools.define(graph, "nothing").count() == 0
    assert tools.cite(graph, "core-terms/1/1.2").first()["page"] == 1
    assert tools.cite(graph, "core-terms/1/1.1/intro").count() == 0


def test_concept_history_graph(graph):
    hit = tools.find_by_concept(graph, "Widget Supply").first()
    assert hit["members"] == ["core-terms/1/1.1/a"] and not hit["citable"]
    lineage = graph.nodes.where("path = 'core-terms/1'").first()["lineage_key"]
    assert tools.history(graph.nodes, lineage).count() == 1
    nodes, edges = tools.answer_graph(graph, ["core-terms/1/1.1/a", "core-terms/1/1.1/b"])
    assert {r["state"] for r in edges.collect()} == {"settled", "external"} and nodes.count() >= 4
    assert tools.citing_parts(graph.refs).count() == 2


def test_review_and_citations(spark, graph):
    queue = tools.review_queue(graph)
    kinds = {r["kind"] for r in queue.collect()}
    assert kinds == {"ref", "term", "anomaly"}
    first = queue.first()
    d = spark.createDataFrame([(first["kind"], first["id"], v, "2024", n) for n, v in enumerate(("no", "yes"))], "kind string, id string, verdict string, ts string, nr int")
    assert tools.review_queue(graph, d).where("verdict = 'yes'").count() == 1
    assert tools.queue_counts(queue).count() >= 3
    answers = spark.createDataFrame([(1, "See [[a/1|3]], [[a/1|4]], [[a/1|x]] and [[b|1]].")], "answer_id int, text string")
    got = [r["status"] for r in tools.verify_citations(answers, spark.createDataFrame([("a/1", 3)], "path string, page int")).collect()]
    assert sorted(got) == ["ok", "page_mismatch", "page_unparseable", "unknown_path"]


def test_runner(graph):
    run = tools.ToolRunner(graph, budget=2)
    assert run.run("nothing") == {"error": "unknown_tool"}
    assert run.run("cite", path="core-terms/1/1.2").count() == 1
    assert run.run("cite", path="x") == {"error": "budget_exhausted"}


def test_files(spark, tmp_path):
    d = tmp_path / "run"
    d.mkdir()
    (d / "p.json").write_text(json.dumps({"path": "p", "kind": "part", "children": [{"path": "p/1", "kind": "clause", "text": "x"}]}))
    (d / "index.json").write_text("{}")
    (d / "bad.json").write_text("{")
    assert {r["file"]: r["what"] for r in tables.discover(spark, str(d)).collect()} == {"p.json": "part", "index.json": "manifest", "bad.json": "unreadable"}
    state = {r["file"]: r["state"] for r in tables.tri_state(spark, ["p.json", "bad.json", "gone.json", "off.json"], str(d), ["off.json"]).collect()}
    assert state == {"p.json": "loaded", "bad.json": "failed", "gone.json": "absent", "off.json": "skipped"}
    assert tables.json_trees(spark, f"{d}/p.json").count() == 2
    assert tables.newest_run(tables.listing(spark, str(tmp_path))).first()["run"] == "run"


def test_lines_logs_registries(spark, tmp_path):
    (tmp_path / "g").mkdir()
    (tmp_path / "g/decisions.jsonl").write_text('{"kind":"ref","path":"a","verdict":"correct"}\n{broken\n{"kind":"ref","path":"b","verdict":"odd"}\n')
    good, bad = tables.golden_labels(spark, str(tmp_path / "g"), ["correct", "wrong"])
    assert good.count() == 1 and bad.count() == 2
    (tmp_path / "map.md").write_text("| id | title | pages |\n|---|---|---|\n| core-terms | Core Terms | 1-22 |\n| form-1 | Form | 23 |\n")
    assert {(r["part_id"], r["page_start"], r["page_end"]) for r in tables.page_map(spark, str(tmp_path / "map.md")).collect()} == {("core-terms", 1, 22), ("form-1", 23, 23)}
    (tmp_path / "r.json").write_text('{"a-1": "A one", "b-2": "B two"}')
    assert tables.part_registry(spark, str(tmp_path / "r.json")).count() == 2
    (tmp_path / "r2.json").write_text('{"parts": [{"id": "a-1", "title": "A one"}]}')
    assert tables.part_registry(spark, str(tmp_path / "r2.json")).first()["title"] == "A one"
    (tmp_path / "l.json").write_text('{"records": [{"key": "legislation/x", "title": "X", "year": 0}, {"title": "no key"}]}')
    assert [(r["key"], r["year"]) for r in tables.legislation_records(spark, str(tmp_path / "l.json")).collect()] == [("legislation/x", None)]
    refused = tables.append_decisions(spark.createDataFrame([("1", "yes"), ("2", "maybe"), (None, "no")], "id string, verdict string"), str(tmp_path / "log"), ["yes", "no"])
    assert refused.count() == 2 and spark.read.parquet(str(tmp_path / "log")).count() == 1
    audit = tables.audit_row("sweep", "stale", spark.range(500).selectExpr("cast(id as string) as id")).first()
    assert audit["affected_count"] == 500 and len(audit["affected"]) == 200
    tables.write_json_lines(spark.createDataFrame([(2, "b"), (1, "a")], "n int, s string"), str(tmp_path / "out"), ["n"])
    assert tables.json_lines(spark, str(tmp_path / "out"), "n int, s string")[0].count() == 2
    tables.write_layout(samples.lines(spark), str(tmp_path / "layout"))
    assert spark.read.parquet(str(tmp_path / "layout")).where("part = 'core-terms'").count() > 0


def test_replay(spark):
    calls = spark.createDataFrame([("t", "1", "a"), ("t", "1", "b"), ("t", "1", "c")], "task string, version string, payload string")
    keys = calls.select(tables.replay_key("task", "version", "payload").alias("key"), "payload").collect()
    cache = spark.createDataFrame([(keys[0]["key"], "ok", None), (keys[1]["key"], None, "boom")], "key string, reply string, error string")
    have, owed = tables.replay_split(calls, cache)
    assert [r["reply"] for r in have.collect()] == ["ok"] and owed.count() == 2


def test_store(spark, tmp_path):
    store = tables.SnapshotStore(spark, str(tmp_path / "store"))
    assert store.read("t", "a int").count() == 0
    store.publish({"t": spark.range(3), "u": spark.range(1)})
    store.publish({"t": spark.range(5)})
    assert store.read("t", "id long").count() == 5 and store.read("u", "id long").count() == 1
    assert tables.tolerant(spark, str(tmp_path / "none"), schemas.TERM_USES).columns[0] == "term"
    from lexweave.operators.graph import contains_edges

    n = samples.nodes(spark)
    assert tables.graph_json(n, contains_edges(n)).where("kind = 'link'").count() == n.where("parent_path is not null").count()


def test_streams(spark, tmp_path):
    ev = events.read_events(spark, "/root/testdata/sf0.001")
    plain = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    once = events.run_to_table(events.deduplicated(ev).groupBy().count(), "dedup", str(tmp_path / "c1"))
    assert once.first()[0] == plain.select("event_id").distinct().count()
    events.last_records(ev, str(tmp_path / "last"), ["user_id"], "ts", str(tmp_path / "c2"))
    got = spark.read.parquet(str(tmp_path / "last/0"))
    assert got.count() == plain.select("user_id").distinct().count()
    edges = spark.createDataFrame([("a", "b"), ("a", "z")], "src string, dst string")
    assert {r["dst"]: r["writable"] for r in events.deferred_edges(edges, spark.createDataFrame([("a",), ("b",)], "key string")).collect()} == {"b": True, "z": False}


def test_providers(spark):
    from lexweave.sources import providers

    planned = spark.createDataFrame([("n1", "summary", "alpha"), ("n2", "summary", "boom"), ("n3", "leaf", "x")], "node_id string, level string, text string")
    none = spark.createDataFrame([], providers.REPLIES)

    def service(task, payload):
        if payload == "boom":
            raise ValueError("no")
        return f"{task} of {payload}"

    done, new = providers.summaries(planned, none, service)
    assert [(r["node_id"], r["reply"]) for r in done.collect()] == [("n1", "summary of alpha")]
    assert sorted((r["error"] for r in new.collect()), key=str) == [None, "ValueError: no"] or {r["error"] for r in new.collect()} == {None, "ValueError: no"}
    again, owed = providers.summaries(planned, new, None)
    assert again.count() == 1 and [r["error"] for r in owed.collect()] == ["pending"]
