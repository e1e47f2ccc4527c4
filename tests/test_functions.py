"""Scalar functions against hand-computed values."""

import hashlib
import unicodedata

import pytest
from pyspark.sql import functions as F

from lexweave.functions import fuzzy, ids
from lexweave.functions import text as tx


def value(spark, column, **row):
    ddl = ", ".join(f"{k} {'int' if isinstance(v, int) else 'array<double>' if isinstance(v, list) else 'string'}" for k, v in row.items()) or "x int"
    return spark.createDataFrame([tuple(row.values()) or (1,)], ddl).select(column).first()[0]


def test_identities(spark):
    sha = lambda s: hashlib.sha1(s.encode()).hexdigest()
    assert value(spark, ids.node_id("d", "v", "p"), d="doc", v="v1", p="a/b") == sha("doc|v1|a/b")
    assert value(spark, ids.lineage_key("d", "p"), d="doc", p="a/b") == sha("doc|a/b")
    assert value(spark, ids.content_hash("t"), t="  a  b \r\ncafé ") == sha(unicodedata.normalize("NFC", "a b\ncafé"))
    assert value(spark, ids.concept_id("s", "l"), s="core", l=" Risk  Transfer") == "concept-" + sha("core|risk transfer")[:16]
    assert value(spark, ids.ref_path("p", "a", "b", "n"), p="x/1", a=3, b=5, n=0) == "x/1/ref@3-5"
    assert value(spark, ids.ref_path("p", "a", "b", "n"), p="x/1", a=3, b=5, n=2) == "x/1/ref@3-5+2"


def test_legislation_keys(spark):
    key = lambda t, y, k, p: spark.createDataFrame([(t, y, k, p)], "t string, y int, k string, p string").select(ids.legislation_key("t", "y", "k", "p")).first()[0]
    assert key("Bribery Act", 2010, "act", None) == "legislation/bribery-act-2010"
    assert key("Patents Act", 1977, "act", "section/55") == "legislation/patents-act-1977/section/55"
    assert key("Regulation (EU) 2016/679", 2016, "eu_regulation", None) == "legislation/regulation-eu-2016-679"
    assert key("Some Rules", None, "regulations", None) == "legislation/some-rules"


@pytest.mark.parametrize(
    "column, text, expected",
    [
        (lambda: tx.term_key("t"), ' "Supplier",; ', "Supplier"),
        (lambda: tx.quote_shape("t"), "“A”", "both"),
        (lambda: tx.quote_shape("t"), "A”", "closing_only"),
        (lambda: tx.quote_shape("t"), "“A", "opening_only"),
        (lambda: tx.quote_shape("t"), "A", "none"),
        (lambda: tx.looks_like_term("t"), "Key Term", True),
        (lambda: tx.looks_like_term("t"), "a sentence.", False),
        (lambda: tx.is_capitalised_phrase("t"), "Part of the Deal", True),
        (lambda: tx.is_capitalised_phrase("t"), "Part deal", False),
        (lambda: tx.comparison_form("t"), " “A – b”; ", '"a - b"'),
        (lambda: tx.title_form("t"), "Schedule 2 (Price)", "schedule 2 price"),
        (lambda: tx.word_count_bucket("t"), "a b", "2"),
        (lambda: tx.estimated_tokens("t"), "abcde, f", 4),
        (lambda: tx.initials("t"), "Freedom of Information", "FI"),
        (lambda: tx.title_case_runs("t"), "the Data Room and Big Deal here", ["Data Room", "Big Deal"]),
        (lambda: tx.inflections("t"), "Party", ["Partys", "Partyes", "Parties"]),
        (lambda: tx.inflections("t"), "Boxes", ["Boxess", "Boxeses", "Box", "Boxe"]),
        (lambda: tx.roman_value("t"), "(iv)", 4),
        (lambda: tx.roman_value("t"), "xxxix", 39),
        (lambda: tx.roman_value("t"), "abc", None),
        (lambda: tx.letter_ordinal("t"), "(ab)", 28),
        (lambda: tx.strip_fence("t"), 'x ```json\n[1]\n``` y', "[1]"),
        (lambda: tx.strip_fence("t"), 'so {"a": 1} it is', '{"a": 1}'),
        (lambda: tx.scrub("t", ["key", "keyring"]), "my keyring", "my [redacted]"),
        (lambda: tx.words("t"), "It's a well-known 3x", ["It's", "a", "well-known", "x"]),
        (lambda: F.array_join(F.transform(tx.sentences("t"), lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ","), "A b. C; d", "0:4,5:7,8:9"),
        (lambda: tx.anomaly_parts("t")["proposed"], "stray: 'nsert' for 'Insert'", "Insert"),
        (lambda: tx.sentence_initial(F.col("t"), F.lit(3)), "A. B", True),
        (lambda: tx.sentence_initial(F.col("t"), F.lit(2)), "A B", False),
        (lambda: tx.clip("t", 3), "abcdef", "abc […truncated]"),
    ],
)
def test_text(spark, column, text, expected):
    assert value(spark, column(), t=text) == expected


def test_initialism_position_cosine(spark):
    assert value(spark, tx.is_initialism("a", "b"), a="FOI", b="Freedom of Information")
    assert value(spark, tx.is_initialism("a", "b"), a="FI", b="Freedom of Information")
    assert not value(spark, tx.is_initialism("a", "b"), a="FX", b="Freedom of Information")
    assert [value(spark, tx.position_bucket("o", "t"), o=o, t=10) for o in (0, 4, 9)] == ["early", "middle", "late"]
    assert value(spark, tx.position_bucket("o", "t"), o=0, t=1) == "only"
    assert value(spark, tx.cosine("a", "b"), a=[1.0, 0.0], b=[1.0, 1.0]) == pytest.approx(0.70710678)
    assert value(spark, tx.cosine("a", "b"), a=[0.0, 0.0], b=[1.0, 1.0]) == 0.0
    assert [r[0] for r in spark.createDataFrame([(0.0,), (0.1,), (0.3,), (0.95,), (1.0,)], "s double").select(tx.confidence_bucket("s")).collect()] == [0, 1, 3, 9, 9]


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(new[-1], row[j + 1], row[j] + (x == y)))
        row = new
    return row[-1]


def test_similarity_scale():
    import random

    rng = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randrange(12))) for _ in range(2))
        assert fuzzy.lcs(a, b) == brute_lcs(a, b)
        assert 0 <= fuzzy.weighted_ratio(a, b) <= 100
        assert fuzzy.ratio(a, b) == pytest.approx(fuzzy.ratio(b, a))
    assert fuzzy.ratio("kitten", "kitten") == 100
    assert fuzzy.weighted_ratio("withhold charges", "the buyer may withhold charges now") > fuzzy.weighted_ratio("withhold charges", "delivery is free")
    assert fuzzy.token_set_ratio("a b", "b a c") == 100


def test_similarity_column(spark):
    df = spark.createDataFrame([("abc", "abd"), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(fuzzy.similarity("a", "b")).collect()] == [pytest.approx(66.666667), None]
