"""Base findings against plain regular expressions, and the corpus model on planted texts."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from lexweave.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k in PLAIN for m in re.finditer(PLAIN[k], text or "") if valid(k, m[0])]


def expected(text):
    found = brute(text)
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
    return tuple(sum(f[0] == k for f in found) for k in pii.KINDS) + (hashlib.sha256(joined.encode()).hexdigest(),)


PIECES = ["1", "2", "9", "0", ".", " ", "-", "+", "(", ")", "@", "a", "Z", "_", "%", "é", "😀", "\n", "4111 1111 1111 1111", "a@b.c", "+1 (017) 555-7713", "256.1.1.1", "1.2.3.4", "005.0.0.255"]


def test_base_findings(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randrange(60))), "x") for i in range(1500)]
    rows += [(9001, None, "x"), (9002, "", "x"), (9003, "9" * 20000 + " " + "a" * 50000 + "@", "x"), (9004, "1." * 5000, "x"), (9005, "a@b.c_d@e.f@g.h.", "x"), (9006, "+1" + "((" * 9000, "x"), (9007, "4 " * 9000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")  # a clashing name
    got = {r["doc_id"]: tuple(r)[1:6] for r in pii.findings(docs).collect()}
    assert len(got) == len(rows)
    assert [i for i, t, _ in rows if got[i] != expected(t)] == []


def test_driver_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = pii.findings(docs).collect()
    assert len(got) == len(texts)
    assert all(tuple(r)[1:6] == expected(texts[r["doc_id"]]) for r in got)


def contract(spark):
    own = [(i, f"Note {i}: agent zanzibar keeps box {i} boss@corp.example then word {i} common words here") for i in range(6)]
    return spark.createDataFrame(own + [(100 + i, f"note agent keeps common words here then {i}") for i in range(60)] + [(200, "zanzibar")], "doc_id long, text string")


def test_telling_terms_are_generalised(spark):
    docs = contract(spark)
    told = {(r["doc_id"], r["spans"].count("term:")) for r in pii.findings(docs).where("doc_id < 6").collect()}
    assert told == {(i, 3) for i in range(6)}  # zanzibar, box, word; what stands elsewhere too tells nothing
    text = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert "boss@" not in text[0] and "[EMAIL]" in text[0] and "zanzibar" not in text[0] and "agent" in text[0]
    assert text[200] == "zanzibar" and text[100].startswith("note agent")


def test_copies_prove_nothing(spark):
    docs = spark.createDataFrame([(i, "quux waldo fred@corp.example") for i in range(50)] + [(99, "other text")], "doc_id long, text string")
    assert {r["n_terms"] for r in pii.findings(docs).collect()} == {0}


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "a@b.cc"), (1, "a@b.cc"), (1, "other"), (None, "x 1.2.3.4 y")]])
def test_odd_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_email"], r["n_ip"]) for r in pii.findings(docs).collect()), key=str)
    assert got == sorted(((i, *expected(t)[:2]) for i, t in rows), key=str)
    clean = sorted((tuple(r) for r in pii.sanitise(docs).collect()), key=str)
    assert clean == sorted(((i, t and t.replace("a@b.cc", "[EMAIL]").replace("1.2.3.4", "[IP]")) for i, t in rows), key=str)


def test_native(spark):
    docs = spark.createDataFrame([(1, "a@b.cc")], "doc_id long, text string")
    plan = pii.findings(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_terms_far_away_and_in_two_texts(spark):
    """A term is found over the whole text, everywhere in it, and two different texts are enough."""
    far = " ".join(["note agent keeps common words here"] * 20)
    own = [(i, f"Zanzibar {i}. {far} boss@corp.example {far} zanzibar, then") for i in range(2)]
    docs = spark.createDataFrame(own + [(100 + i, f"then {far} {i}") for i in range(60)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.findings(docs).collect()}
    text = dict(own)[0]
    at = [m.start() for m in re.finditer("zanzibar", text.lower())]
    assert got[0]["spans"].split(",")[1:] == [f"term:{a}:{a + 8}" for a in at] and got[100]["n_terms"] == 0
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert clean[0] == text.replace("Zanzibar", "[TERM]").replace("zanzibar", "[TERM]").replace("boss@corp.example", "[EMAIL]")


def test_one_text_proves_nothing_about_rare_words(spark):
    docs = spark.createDataFrame([(1, "quux a@b.cc waldo")] + [(10 + i, f"other text {i}") for i in range(30)], "doc_id long, text string")
    assert {r["n_terms"] for r in pii.findings(docs).collect()} == {0}


def words_beside(text):
    """The different terms of a text outside its findings."""
    found, out, at = sorted((a, b) for _, a, b in brute(text)), [], 0
    for a, b in found:
        out.append(text[at:a] if a > at else "")
        at = max(at, b)
    return set(re.findall(r"[^\W_]+", " ".join([*out, text[at:]]).lower()))


def entities_of(text):
    values = {f"{k}:{re.sub('[^0-9]', '', text[a:b]) if k in ('card', 'phone') else text[a:b].lower()}" for k, a, b in brute(text)}
    return values, {v.split(":")[0] for v in values} | ({pii.ANY} if values else set())


def brute_terms(texts, generalise, remove):
    """Per text the spans of its telling terms, by counting everything in dictionaries."""
    texts = set(texts)
    n, n_term, n_entity, both, proofs = len(texts), Counter(), Counter(), Counter(), {}
    alike = Counter(frozenset(entities_of(t)[0]) for t in texts)
    for text in texts:
        n_term.update(set(re.findall(r"[^\W_]+", text.lower())))
        values, classes = entities_of(text)
        n_entity.update(values | classes)
        for t in words_beside(text) if values else ():
            for e in values | classes:
                both[e, t] += 1
                proofs[e, t] = proofs.get((e, t), 0) + (1 if e in values else 1 / alike[frozenset(values)])
    told = {}
    for (e, t), k in both.items():
        if n_entity[e] < n:
            support, prior = proofs[e, t], pii.PRIOR if ":" in e else pii.CLASS_PRIOR
            told[e, t] = math.log2(k * n / (n_term[t] * n_entity[e])) / math.log2(n / n_entity[e]) * support / (support + prior)
    out = {}
    for text in texts:
        values, classes = entities_of(text)
        found, spans = [(a, b) for _, a, b in brute(text)], []
        for m in re.finditer(r"[^\W_]+", text) if values else ():
            d = max((told.get((e, m[0].lower()), 0) for e in values | classes), default=0)
            if d >= generalise and not any(m.start() < b and m.end() > a for a, b in found):
                spans.append(f"{'removed' if d >= remove else 'term'}:{m.start()}:{m.end()}")
        out[text] = spans
    return out


def test_whole_table_against_brute_force(spark):
    rng = random.Random(11)
    pool = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(400):
        words = rng.choices(pool, k=rng.randrange(25))
        if i % 9 == 0:
            words += [rng.choice(["a@b.cc", "1.2.3.4", f"u{i % 7}@mail.cc", *(f"{x}{i}@mail.cc" for x in "stuvxyz")]), "token", rng.choice(["q", "r"])]
            rng.shuffle(words)
        rows.append((i, " ".join(words)))
    rows += [(500 + i, rows[9][1]) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for limits in ({}, {"generalise": 0.4, "remove": 0.6}):
        want = brute_terms([t for _, t in rows], limits.get("generalise", pii.GENERALISE), limits.get("remove", pii.REMOVE))
        assert any(want.values())
        got = {r["doc_id"]: [s for s in r["spans"].split(",") if s.startswith(("term", "removed"))] for r in pii.findings(docs, **limits).collect()}
        assert got == {i: want[t] for i, t in rows}


def test_driver_tables_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    want = brute_terms(texts.values(), 0.6, 0.9)
    got = {r["doc_id"]: [s for s in r["spans"].split(",") if s.startswith(("term", "removed"))] for r in pii.findings(docs, generalise=0.6, remove=0.9).collect()}
    assert sum(map(len, got.values())) > 0 and got == {i: want[t] for i, t in texts.items()}


def test_very_many_findings(spark):
    text = " ".join(f"a{i}@mail.example.com x" for i in range(100_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = pii.findings(docs).collect()[0]
    assert tuple(got)[1:6] == expected(text)
    assert pii.sanitise(docs).collect()[0]["text"] == re.sub(PLAIN["email"], "[EMAIL]", text)


def test_clashing_columns_stay(spark):
    row = (1, "x a@b.cc y", "h", "r", 7, "t")
    docs = spark.createDataFrame([row], "doc_id long, text string, h string, row string, spans int, terms string")
    assert tuple(pii.sanitise(docs).collect()[0]) == (1, "x [EMAIL] y", "h", "r", 7, "t")
