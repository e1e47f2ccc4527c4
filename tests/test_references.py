"""Detection and resolution of references over the sample contract."""

import math
import random
import time

import pytest

from lexweave.functions.fuzzy import ratio
from lexweave.operators import detection as d
from lexweave.operators import resolution as r
from lexweave.sources import samples


def rows(df, *cols):
    return sorted((tuple(x[c] for c in cols) for x in df.select(*cols).collect()), key=str)


@pytest.mark.parametrize(
    "text, numbers",
    [
        ("see Clauses 1.1, 1.2 and 3.4", ["1.1", "1.2", "3.4"]),
        ("see Clauses 2.1 to 2.4.", ["2.1", "2.2", "2.3", "2.4"]),
        ("see Clauses 10.4 to 11.2", ["10.4", "11.2"]),
        ("see Paragraphs 1 to 99", ["1", "99"]),
        ("clause 9.2(b)", ["9.2"]),
        ("Annex A and B", ["A", "B"]),
        ("the clause of it", []),
    ],
)
def test_lists_and_ranges(text, numbers):
    assert [x["number"] for x in d.detect(text)[0]] == numbers


def test_spans_reproduce_their_words():
    text = "Under Joint Schedule 1 (Definitions) and Clause 2.1(a) of the Core Terms"
    for x in d.detect(text)[0]:
        assert text[x["start"] : x["end"]] == x["surface"]
    a, b = d.detect(text)[0]
    assert (a["family"], a["title_paren"], b["item"], b["ctx_unit"]) == ("Joint", "Definitions", "a", "core terms")


@pytest.mark.parametrize(
    "text, title, year",
    [
        ("the Freedom of Information (Scotland) Act 2002 applies", "Freedom of Information (Scotland) Act", 2002),
        ("must comply with Law. Bribery Act 2010 applies", "Bribery Act", 2010),
        ("Regulation (EU) 2016/679", "Regulation (EU) 2016/679", 2016),
        ("regulation (eu) No 1215/2012", "Regulation (EU) 1215/2012", 2012),
        ("the Act 2010", None, None),
    ],
)
def test_statutes(text, title, year):
    found = d.legislation(text, [])
    assert [(x["leg_title"], x["leg_year"]) for x in found] == ([(title, year)] if title else [])


def test_provisions_of_one_act():
    text = "Sections 55 and 56 of the Patents Act 1977"
    assert [(x["provision"], text[x["start"] : x["end"]]) for x in d.legislation(text, [])] == [("section/55", "55"), ("section/56", "56")]


def test_statutes_come_before_citations_and_anaphora_last():
    kinds = [x["ref_kind"] for x in d.detect("Section 5 of the Data Act 2018, Schedule 2 and this Clause")[0]]
    assert kinds == ["legislation", "schedule", "clause"]


def test_orphans_are_triaged():
    got = {x["keyword"]: x["verdict"] for x in d.orphans("The Schedule is long. A clause applies. See table 4.")}
    assert got == {"Schedule": "capitalised_no_number", "clause": "generic_prose", "table": "possible_missed_citation"}


@pytest.fixture(scope="module")
def refs(spark):
    nodes = samples.nodes(spark)
    found = d.pointers(nodes)
    resolved = r.resolve(nodes, found, samples.registry(spark))
    return r.references(nodes, resolved, "B1").cache()


def test_resolution(spark, refs):
    got = {(x["parent_path"], x["text"]): (x["status"], x["scope_rule"], x["target_path"]) for x in refs.collect()}
    core = "core-terms/1/1.1"
    assert got[f"{core}/intro", "2.1"] == ("resolved", "js1_1.3.8", "core-terms/2/2.1")
    assert got[f"{core}/intro", "6"] == ("ambiguous", "none", None)
    assert got[f"{core}/a", "1 (Definitions)"] == ("resolved", "title_paren", "joint-schedule-1")
    assert got[f"{core}/a", "2.1(a)"] == ("resolved", "js1_1.3.8", "core-terms/2/2.1/a")
    assert got[f"{core}/b", "55"] == ("external", "none", "legislation/patents-act-1977/section/55")
    assert got[f"{core}/b", "Regulation (EU) 2016/679"] == ("external", "none", "legislation/regulation-eu-2016-679")
    assert got["core-terms/1/1.2", "This Clause"][0] == "ambiguous"
    assert got["core-terms/1/1.2", "3.4"] == ("resolved", "js1_1.3.9", "call-off-schedule-9/a/3/3.4")
    assert got["core-terms/2/2.1/b", "9.9"][0] == "unresolved"
    assert got["core-terms/2/2.3", "4"] == ("unresolved", "js1_1.3.8", None)
    b = "call-off-schedule-9/b/3/3.4"
    assert got[b, "3.4"] == ("resolved", "js1_1.3.9", b)
    assert got[b, "1.2"][0] == "resolved"
    assert got["call-off-schedule-9/a/3/3.4", "3.4"][2] == "call-off-schedule-9/a/3/3.4"
    assert got["call-off-schedule-9/a/3/3.4", "1"][2] == "call-off-schedule-9/b/annex-1"


def test_candidates_and_rules(spark, refs):
    c = {x["text"]: x["candidates"] for x in refs.where("parent_path = 'core-terms/1/1.1/intro'").collect()}
    assert [x["path"] for x in c["6"]] == ["call-off-schedule-6", "framework-schedule-6", "joint-schedule-6"] and {x["score"] for x in c["6"]} == {0.5}
    assert refs.where("not span_ok").count() == 0
    assert refs.where("confidence is not null").count() == 0
    assert refs.groupBy("path").count().where("count > 1").count() == 0


def test_range_members_share_a_span_with_ordinals(spark, refs):
    inner = refs.where("parent_path = 'core-terms/1/1.1/intro' and text like '2.1 to%'")
    assert rows(inner, "text", "status") == [("2.1 to 2.3", "unresolved")]


def test_counts_transitions_residue(spark, refs):
    counts = r.status_counts(refs)
    assert counts.where("status is null and ref_kind is null and resolver is null and scope_rule is null").first()["n"] == refs.count()
    first = refs.selectExpr("path", "if(path like 'core%', 'unresolved', status) as status")
    moved = {(x["before"], x["now"]): x["n"] for x in r.transitions(first, refs).collect()}
    assert sum(moved.values()) == refs.count() and ("unresolved", "resolved") in moved
    assert r.residue(refs).count() > 0
    choice = spark.createDataFrame([(x["path"], "call-off-schedule-6", 0.7) for x in refs.where("text = '6'").collect()], "path string, chosen string, confidence double")
    after = r.apply_choices(refs, choice, samples.nodes(spark)).where("text = '6'").first()
    assert after["status"] == "unresolved" and max(c["score"] for c in after["candidates"]) == pytest.approx(0.55)


def test_near_miss(spark):
    keys = spark.createDataFrame([("legislation/bribery-act-2010",), ("legislation/bribery-acts-2010",), ("legislation/data-act-1998",)], "key string")
    assert [(x["a"], x["b"]) for x in r.near_miss_keys(keys).collect()] == [("legislation/bribery-act-2010", "legislation/bribery-acts-2010")]


def test_identity(spark):
    best = r.infer_identity(samples.nodes(spark), ["other", samples.DOCUMENT], ["v0", samples.VERSION]).first()
    assert (best["document"], best["version"], best["n"]) == (samples.DOCUMENT, samples.VERSION, len(samples.ROWS))


def test_orphans_titles_and_spans(spark):
    nodes = samples.nodes(spark)
    odd = d.orphan_keywords(nodes)
    assert odd.count() > 0 and d.owed_sentences(odd).count() >= 0
    assert d.title_pointers(nodes).count() > 0
    found = d.pointers(nodes)
    proposed = spark.createDataFrame([("core-terms/2/2.1/b", "schedule of rates"), ("core-terms/2/2.1/b", "not there"), ("core-terms/2/2.1/b", "Clause 9.9")], "parent_path string, surface string")
    assert [x["surface"] for x in d.accepted_spans(proposed, nodes, found).collect()] == ["schedule of rates"]


def test_pointers_are_never_broadcast(spark):
    """Many pointers a node, which the planner takes for few bytes."""
    nodes = spark.range(300).selectExpr("concat('p/', id) as path", "concat('see Clauses 1.1 to 1.8 and the rates of Clause ', id + 1) as text", "'clause' as kind")
    proposed = nodes.selectExpr("path as parent_path", "explode(array('rates', 'Clauses 1.1', 'absent')) as surface")
    spans = d.accepted_spans(proposed, nodes, d.pointers(nodes))
    assert "Broadcast" not in spans._jdf.queryExecution().executedPlan().toString()
    assert {(x["parent_path"], x["surface"], x["start"], x["end"]) for x in spans.collect()} == {(f"p/{i}", "rates", 31, 36) for i in range(300)}


@pytest.mark.parametrize("threshold", [0.7, 0.86, 0.95, 0.98, 1.0])
def test_near_misses_against_all_pairs(spark, threshold):
    rng = random.Random(4)
    names = {"".join(rng.choices("abé-1", k=rng.randrange(1, 9))) for _ in range(60)} | {"legislation/" + "ab" * n + rng.choice("xyz") + "c" * rng.randrange(4) for n in range(0, 60, 3) for _ in range(4)}
    names |= {w[: len(w) // 2] + w[len(w) // 2 + 1 :] for w in names if len(w) > 20}
    want = {(a, b, s) for a in names for b in names if a < b and (s := math.floor(ratio(a, b) * 100 + 0.5) / 10_000) >= threshold}  # halves go up
    keys = spark.createDataFrame([(w,) for w in [*names, *names, None, ""]], "key string")
    assert {tuple(x) for x in r.near_miss_keys(keys, threshold).collect()} == want


def test_near_misses_of_many_like_keys(spark):
    """20,000 keys of two lengths: 200 million pairs, of which few are close."""
    keys = spark.range(10_000).selectExpr("explode(array(concat('legislation/supplier#', lpad(id, 9, '0'), '-act'), concat('legislation/supplier#', lpad(id, 9, '0'), '-acts'))) as key")
    begun = time.perf_counter()
    got = {(x["a"], x["b"]) for x in r.near_miss_keys(keys, 0.98).collect()}
    assert got == {(f"legislation/supplier#{i:09}-act", f"legislation/supplier#{i:09}-acts") for i in range(10_000)}
    assert time.perf_counter() - begun < 60
