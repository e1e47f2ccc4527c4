"""Definitions, surfaces, uses and misspellings over the sample contract and small tables."""

import pytest

from lexweave.operators import concepts
from lexweave.operators import vocabulary as v
from lexweave.sources import samples


@pytest.fixture(scope="module")
def sites(spark):
    n = samples.nodes(spark)
    merged = v.merged_sites(v.declared_sites(n), v.discovered_sites(n))
    return v.attach_aliases(merged, v.bracket_aliases(n))[0].cache()


def test_cues(spark):
    cue = {r["path"]: r["cue"] for r in v.nearest_cues(samples.nodes(spark)).collect()}
    assert cue["core-terms/1"].startswith("In each Contract") and cue["core-terms"] is None
    assert cue["call-off-schedule-9/b/3/3.4"].startswith("In this Schedule")


def test_tables(spark):
    t = v.definition_tables(samples.nodes(spark)).first()
    assert (t["n_rows"], t["n_terms"], t["n_quoted"], t["under_cue"], t["is_definitions"]) == (4, 4, 4, True, True)


def test_sites(sites):
    got = {r["term"]: r for r in sites.collect()}
    assert set(got) == {"Supplier", "Charges", "Key Performance Indicator", "Widget", "Breach"}
    assert got["Key Performance Indicator"]["aliases"] == ["KPI"]
    assert got["Charges"]["pointer"] == "Schedule 4"
    assert got["Breach"]["scope"] == "part:call-off-schedule-9/b" and got["Supplier"]["scope"] == "document"
    assert {r["source"] for r in got.values()} == {"both"} and not any(r["duplicate"] for r in got.values())


def test_vocabulary_and_scopes(spark, sites):
    parts = samples.nodes(spark).where("kind = 'part'").selectExpr("path as part")
    rows = v.part_vocabulary(sites, parts).collect()
    have = {(r["part"], r["surface"]) for r in rows}
    assert ("core-terms", "KPIs") in have and ("core-terms", "Widgets") in have
    assert ("call-off-schedule-9", "Breach") in have and ("core-terms", "Breach") not in have
    uses = spark.createDataFrame([("Breach", "call-off-schedule-9/b/2"), ("Breach", "call-off-schedule-9/a/3"), ("Supplier", "form-1/1")], "term string, path string")
    got = {(r["term"], r["path"]): r["scope"] for r in v.governing_scopes(uses, sites).collect()}
    assert got == {("Breach", "call-off-schedule-9/b/2"): "part:call-off-schedule-9/b", ("Supplier", "form-1/1"): "document"}


def test_uses(spark, sites):
    n = samples.nodes(spark)
    uses = v.term_uses(n, sites).cache()
    got = {(r["path"], r["surface"]): (r["term"], r["status"], r["ambiguity_kind"]) for r in uses.collect()}
    assert got["call-off-schedule-9/b/3/3.4", "KPIs"] == ("Key Performance Indicator", "confident", None) or got["call-off-schedule-9/b/3/3.4", "KPIs"][2] == "sentence_initial"
    assert got["call-off-schedule-9/b/3/3.4", "Supplier"][2] == "sentence_initial"
    assert ("joint-schedule-1/table-0/0/0", "Supplier") not in got
    assert got["core-terms/2/2.1/a", "Charges"] == ("Charges", "confident", None)
    assert v.broken_uses(uses, n, sites).count() == 0
    assert v.audit_population(uses, n).count() == uses.where("status = 'confident'").count()
    batches = v.routing_batches(uses, 2)
    assert batches.groupBy("batch").count().where("count > 2").count() == 0 and batches.count() == uses.where("status = 'ambiguous'").count()
    row = uses.where("status = 'ambiguous'").first()
    verdict = spark.createDataFrame([(row["term"], row["node_id"], row["char_span"], "not_a_use", 0.9)], "term string, node_id string, char_span struct<start:int,end:int>, verdict string, confidence double")
    assert v.apply_verdicts(uses, verdict).count() == uses.count() - 1
    taken = v.apply_verdicts(uses, verdict.selectExpr("term", "node_id", "char_span", "'use' as verdict", "0.5 as confidence"))
    assert taken.where("method = 'llm' and status = 'confident'").count() == 1


@pytest.mark.parametrize(
    "text, surfaces, found",
    [
        ("Data Room data", ["Data", "Data Room"], [(0, 9, "Data Room")]),
        ("Widgets", ["Widget"], []),
        ("Widget-Widget", ["Widget"], [(0, 6, "Widget"), (7, 13, "Widget")]),
        ("aa aa aa", ["aa aa"], [(0, 5, "aa aa")]),
        ("widget", ["Widget"], []),
    ],
)
def test_longest_matches(text, surfaces, found):
    assert v.matches(text, surfaces) == found


def test_surfaces_in_blocks(spark, monkeypatch):
    texts = [("a", "Data Room data of the Data Rooms"), ("b", "no such words"), ("c", "Widget-Widget and Data"), ("d", None)]
    df, names = spark.createDataFrame(texts, "path string, text string"), ["Data", "Data Room", "Widget", "Data Rooms", "of the", "the Data", None, ""]
    surfaces = spark.createDataFrame([(n,) for n in names], "surface string")
    want = {(k, *m) for k, t in texts if t for m in v.matches(t, [n for n in names if n])}
    for limit in (8_000_000, 9):
        monkeypatch.setattr(v, "SURFACES", limit)
        assert {tuple(r) for r in v.longest_matches(df, surfaces).collect()} == want


def test_typos(spark):
    rows = spark.createDataFrame([("s", "the the cat xThe aBc sooo Brrk fine it's IPRs")], "section string, text string")
    got = {(r["token"], r["reason"]) for r in v.flagged_tokens(rows).where("reason is not null").collect()}
    assert got == {("the", "doubled_word"), ("xThe", "stray_leading_character"), ("aBc", "stray_leading_character"), ("sooo", "triple_letter_run"), ("Brrk", "no_vowel"), ("it's", "internal_capital")}
    freq = spark.createDataFrame([("provider", 9), ("provided", 1), ("provder", 1), ("callof", 1), ("calloff", 6), ("abcd", 1)], "token string, n long")
    near = {r["token"]: r["near"] for r in v.rare_near_common(freq).collect()}
    assert near == {"provder": "provider", "callof": "calloff"}
    assert v.typo_density(rows).first()["typo_dense"]


def test_diff(spark):
    a, b = (spark.createDataFrame([(t,) for t in ts], "term string") for ts in ("AB", "BC"))
    assert {r["term"]: r["side"] for r in v.declared_discovered_diff(a, b).collect()} == {"A": "declared_only", "B": "both", "C": "discovered_only"}


def test_concepts(spark, sites):
    n = samples.nodes(spark)
    reply = '[{"label": "Risk  Transfer", "members": ["core-terms/1/1.2", "nowhere"], "confidence": 1.7, "relations": [{"verb": "limits", "target": "Supply"}]}, {"label": "Empty", "members": ["nowhere"]}, {"label": "risk", "members": ["core-terms/2"], "confidence": 0.4}, {"label": "Supplier", "members": ["core-terms/2"]}, {"label": "Supply", "members": ["core-terms/1"], "confidence": 0.5}]'
    c = concepts.parse_proposals(spark.createDataFrame([("core-terms", reply)], "scope_path string, value string"), n).cache()
    assert {(r["label"], r["confidence"]) for r in c.collect()} == {("Risk  Transfer", 1.0), ("risk", 0.4), ("Supplier", 0.0), ("Supply", 0.5)}
    assert [(r["term"], r["reason"]) for r in concepts.term_collisions(c, sites).collect()] == [("Supplier", "surface")]
    pairs = concepts.similar_pairs(c)
    assert pairs.count() == 1
    merged = {r["label"]: r for r in concepts.merged(c, pairs).collect()}
    assert merged["Risk  Transfer"]["size"] == 2 and len(merged["Risk  Transfer"]["member_node_ids"]) == 2
    rel = concepts.remapped_relations(c, c, pairs).collect()
    assert [(r["verb"]) for r in rel] == ["limits"]
    units = n.where("kind = 'part'")
    assert concepts.scanned_scopes(units, spark.createDataFrame([("core-terms",)], "scope_path string")).where("scanned").count() == 1


def test_concepts_by_vector(spark, sites):
    c = spark.createDataFrame([("c1", "provider of goods", "p", ["x"], 0.5), ("c2", "delivery", "p", ["y"], 0.5)], "id string, label string, scope_path string, member_node_ids array<string>, confidence double")
    vectors = spark.createDataFrame([("provider of goods", [1.0, 0.1]), ("delivery", [0.0, 1.0]), ("supplier", [1.0, 0.0])], "text string, vector array<double>")
    assert [(r["id"], r["term"], r["reason"]) for r in concepts.term_collisions(c, sites, vectors).collect()] == [("c1", "Supplier", "cosine")]
    assert concepts.similar_pairs(c, vectors).count() == 0


def test_components(spark):
    import random

    rng = random.Random(0)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 160)]
    pairs = [(a, b) for a, b in pairs if a != b]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    got = {r["id"]: r["root"] for r in concepts.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for p in pairs for x in p}
