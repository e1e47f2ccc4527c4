"""Queries that call one operator each over a whole table, with SQL that states its rule in its own way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave import schemas
from lexweave.functions import ids
from lexweave.functions import text as tx
from lexweave.operators import concepts, detection, embeddings, evaluation, graph, layout, resolution, tools, tree, vocabulary
from lexweave.plans import tree_queries
from lexweave.plans.catalog import query, table


def _text(*parts: Column | str) -> Column:
    """Texts and columns joined; plain strings are texts."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _none(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


# ---- scalar text functions


@query("""
SELECT conv_id, turn, lower(trim(regexp_replace(trim(regexp_replace(translate(text, '“”‘’‐–—', '""''''---'), '\\s+', ' ', 'g')), '^[ .:;,]+|[ .:;,]+$', '', 'g'))) AS form FROM conversations
""")
def comparison_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.comparison_form("text").alias("form"))


_SHAPED = "CASE p_partkey % 5 WHEN 0 THEN '\"' || p_name || '\";' WHEN 1 THEN '“' || p_name WHEN 2 THEN p_name || '”,' WHEN 3 THEN '  ' || p_name || ' ;' ELSE '''' || p_name || '''' END"


def _shaped() -> Column:
    k, p = F.col("p_partkey") % 5, F.col("p_name")
    return F.when(k == 0, _text('"', p, '";')).when(k == 1, _text("“", p)).when(k == 2, _text(p, "”,")).when(k == 3, _text("  ", p, " ;")).otherwise(_text("'", p, "'"))


@query(f"SELECT p_partkey, {_SHAPED} AS raw, p_name AS key, CASE p_partkey % 5 WHEN 0 THEN 'both' WHEN 1 THEN 'opening_only' WHEN 2 THEN 'closing_only' WHEN 3 THEN 'none' ELSE 'both' END AS shape FROM part")
def term_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", _shaped().alias("raw"))
    return rows.select("p_partkey", "raw", tx.term_key("raw").alias("key"), tx.quote_shape("raw").alias("shape"))


@query("""
WITH k AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Red of ' || p_brand WHEN 1 THEN p_name WHEN 2 THEN 'Widget ' || p_name ELSE 'Part ' || p_partkey || '.' END AS key FROM part)
SELECT p_partkey, p_partkey % 4 IN (0, 2) AS is_term, p_partkey % 4 IN (0, 3) AS is_phrase FROM k
""")
def term_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    key = F.when(k == 0, _text("Red of ", F.col("p_brand"))).when(k == 1, F.col("p_name")).when(k == 2, _text("Widget ", F.col("p_name"))).otherwise(_text("Part ", F.col("p_partkey"), "."))
    return table(spark, sf_dir, "part").select("p_partkey", tx.looks_like_term(key).alias("is_term"), tx.is_capitalised_phrase(key).alias("is_phrase"))


@query("""
WITH w AS (SELECT p_partkey, upper(substr(string_split(p_name, ' ')[1], 1, 1)) AS a, upper(substr(string_split(p_name, ' ')[2], 1, 1)) AS b FROM part)
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN true ELSE a = b END AS fits FROM w
""")
def initialisms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`AB` and `AOB` are short for `a... of b...`; `BA` only where both letters are one."""
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    a, b = (F.upper(F.substring(word(i), 1, 1)) for i in (1, 2))
    short = F.when(F.col("p_partkey") % 3 == 0, _text(a, ".", b)).when(F.col("p_partkey") % 3 == 1, _text(a, "O", b)).otherwise(_text(b, a))
    return table(spark, sf_dir, "part").select("p_partkey", tx.is_initialism(short, _text(word(1), " of ", word(2))).alias("fits"))


@query("""
WITH w AS (SELECT item_id, text, CAST(i AS INTEGER) AS start FROM benchmark, range(0, 60, 7) t(i) WHERE i < length(text))
SELECT item_id, start, trim(substr(text, 1, start)) = '' OR regexp_matches(substr(text, 1, start), '[.;:!?]\\s*$') AS initial FROM w
""")
def sentence_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "benchmark").select("item_id", "text", F.explode(F.sequence(F.lit(0), F.lit(59), F.lit(7))).alias("start")).where(F.col("start") < F.length("text"))
    return rows.select("item_id", "start", tx.sentence_initial(F.col("text"), F.col("start")).alias("initial"))


@query("""
SELECT doc_id, string_agg(r, '|' ORDER BY i) AS runs FROM (SELECT doc_id, unnest(x) AS r, generate_subscripts(x, 1) AS i FROM (SELECT doc_id, regexp_extract_all(text, '[A-Z][A-Za-z''\\-]*(?:[^A-Za-z.;:!?\\n()]+[A-Z][A-Za-z''\\-]*)*') AS x FROM documents)) WHERE length(r) > 1 GROUP BY 1
""")
def title_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(tx.title_case_runs("text"), "|").alias("runs")).where("runs <> ''")


@query("""
SELECT c_custkey, CAST(c_custkey % 39 + 1 AS INTEGER) AS roman, CAST(c_custkey % 702 + 1 AS INTEGER) AS letter FROM customer
""")
def ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numerals and letters are written from a number and must give it back."""
    n, m = F.col("c_custkey") % 39 + 1, (F.col("c_custkey") % 702).cast("int")
    tens, units = (F.array(*map(F.lit, x)) for x in (["", "x", "xx", "xxx"], ["", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix"]))
    roman = _text("(", F.get(tens, F.floor(n / 10).cast("int")), F.get(units, (n % 10).cast("int")), ")")
    letter = lambda i: F.char(i + 97)
    letters = F.when(m < 26, letter(m)).otherwise(F.concat(letter((m / 26 - 1).cast("int")), letter(m % 26)))
    return table(spark, sf_dir, "customer").select("c_custkey", tx.roman_value(roman).alias("roman"), tx.letter_ordinal(_text("(", letters, ")")).cast("int").alias("letter"))


@query("SELECT p_partkey, 'stray_character' AS code, '''' || string_split(p_name, ' ')[1] || ''' for ''' || string_split(p_name, ' ')[2] || '''' AS detail, string_split(p_name, ' ')[1] AS found, string_split(p_name, ' ')[2] AS proposed FROM part")
def anomaly_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    note = _text("stray_character: '", word(1), "' for '", word(2), "'")
    return table(spark, sf_dir, "part").select("p_partkey", tx.anomaly_parts(note).alias("a")).select("p_partkey", "a.*")


@query("SELECT conv_id, turn, replace(replace(text, 'there', '[redacted]'), 'the', '[redacted]') AS text FROM conversations")
def scrubbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.scrub("text", ["the", "there", ""]).alias("text"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_brand ELSE '' END AS anchor FROM part")
def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    return table(spark, sf_dir, "part").select("p_partkey", tx.anchor_text(F.when(k == 0, F.col("p_name")), F.when(k == 1, F.col("p_brand"))).alias("anchor"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN p_name ELSE '{"n": ' || p_partkey || '}' END AS json FROM part""")
def fenced_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, value = F.col("p_partkey") % 3, _text('{"n": ', F.col("p_partkey"), "}")
    raw = F.when(k == 0, _text("Sure:\n```json\n", value, "\n```\n")).when(k == 1, _text("It is ", value, " then")).otherwise(_text(" ", F.col("p_name"), " "))
    return table(spark, sf_dir, "part").select("p_partkey", tx.strip_fence(raw).alias("json"))


@query("SELECT doc_id, 'concept-' || substr(sha1(source || '|' || lower(lang)), 1, 16) AS concept, 'legislation/' || source || '-act-' || (1900 + doc_id % 100) || CASE WHEN doc_id % 2 = 0 THEN '/section/' || doc_id % 9 ELSE '' END AS statute, source || '/ref@' || doc_id % 50 || '-' || (doc_id % 50 + 4) || CASE WHEN doc_id % 3 > 0 THEN '+' || doc_id % 3 ELSE '' END AS ref FROM documents")
def keys_of_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    title, provision = _text(F.col("source"), " Act"), F.when(i % 2 == 0, _text("section/", i % 9))
    return table(spark, sf_dir, "documents").select("doc_id", ids.concept_id("source", _text(" ", F.upper("lang"), " ")).alias("concept"), ids.legislation_key(title, 1900 + i % 100, F.lit("act"), provision).alias("statute"), ids.ref_path("source", i % 50, i % 50 + 4, i % 3).alias("ref"))


# ---- citations


def _cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provision an order, whose text cites by one of five forms."""
    i = F.col("o_orderkey")
    a, k, n = i % 12 + 1, i % 7 + 1, i % 70 + 1
    text = (
        F.when(i % 5 == 0, _text("see Clauses ", a, ".1 to ", a, ".", k + 1, " of this Schedule"))
        .when(i % 5 == 1, _text("under Paragraphs ", a, ", ", a + 1, ".2(b) and ", k, " of Call-Off Schedule ", n, "."))
        .when(i % 5 == 2, _text("This Clause and those Annexes bind; see Joint Schedule ", n, " (Definitions)."))
        .when(i % 5 == 3, _text("as Section ", n, " of the Widgets and Rings Act ", 1900 + n, " and Regulation (EU) No ", 2000 + k, "/", n, " say"))
        .otherwise(_text("the schedule of rates; Table ", n, " applies. A Clause stays."))
    )
    return table(spark, sf_dir, "orders").select(_text("part-", i % 10, "/", i).alias("path"), text.alias("text"), F.lit("clause").alias("kind"), _none().alias("title"))


_ORDER = "SELECT 'part-' || o_orderkey % 10 || '/' || o_orderkey AS p, o_orderkey AS i, o_orderkey % 12 + 1 AS a, o_orderkey % 7 + 1 AS k, o_orderkey % 70 + 1 AS n FROM orders"


@query(f"""
WITH o AS ({_ORDER}),
 r AS (SELECT p, a || '.' || m AS number, CAST(m - 1 AS INTEGER) AS member, m NOT IN (1, k + 1) AS expanded, 'clause' AS ref_kind, CAST(NULL AS VARCHAR) AS item, 'schedule' AS ctx_unit, true AS ctx_this, CAST(NULL AS VARCHAR) AS ctx_number FROM o, range(1, 9) t(m) WHERE i % 5 = 0 AND m <= k + 1),
 l AS (SELECT p, CASE m WHEN 0 THEN a || '' WHEN 1 THEN (a + 1) || '.2' ELSE k || '' END, CAST(m AS INTEGER), false, 'paragraph', CASE WHEN m = 1 THEN 'b' END, 'schedule', false, n || '' FROM o, range(0, 3) t(m) WHERE i % 5 = 1),
 s AS (SELECT p, n || '', 0, false, 'schedule', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), false, CAST(NULL AS VARCHAR) FROM o WHERE i % 5 IN (1, 2)),
 h AS (SELECT p, CAST(NULL AS VARCHAR), 0, false, CASE m WHEN 0 THEN 'clause' ELSE 'annex' END, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), false, CAST(NULL AS VARCHAR) FROM o, range(0, 2) t(m) WHERE i % 5 = 2)
SELECT p AS parent_path, * EXCLUDE (p) FROM (SELECT * FROM r UNION ALL SELECT * FROM l UNION ALL SELECT * FROM s UNION ALL SELECT * FROM h)
""")
def cited_provisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists, ranges, items, scope tails and anaphora, a row each."""
    found = detection.pointers(_cited(spark, sf_dir)).where("ref_kind <> 'legislation'")
    return found.select("parent_path", "number", "member", "expanded", "ref_kind", "item", "ctx_unit", "ctx_this", "ctx_number")


@query(f"""
WITH o AS ({_ORDER})
SELECT p AS parent_path, 'Widgets and Rings Act' AS leg_title, CAST(1900 + n AS INTEGER) AS leg_year, 'act' AS leg_kind, 'section/' || n AS provision, n || '' AS surface FROM o WHERE i % 5 = 3
UNION ALL SELECT p, 'Regulation (EU) ' || (2000 + k) || '/' || n, CAST(2000 + k AS INTEGER), 'eu_regulation', NULL, 'Regulation (EU) No ' || (2000 + k) || '/' || n FROM o WHERE i % 5 = 3
""")
def cited_statutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detection.pointers(_cited(spark, sf_dir)).where("ref_kind = 'legislation'")
    return found.select("parent_path", "leg_title", "leg_year", "leg_kind", "provision", "surface")


@query(f"""
WITH o AS ({_ORDER})
SELECT p AS parent_path, 'schedule' AS keyword, 'generic_prose' AS verdict, 'the schedule of rates;' AS sentence FROM o WHERE i % 5 = 4
UNION ALL SELECT p, 'Table', 'possible_missed_citation', 'Table ' || n || ' applies.' FROM o WHERE i % 5 = 4
UNION ALL SELECT p, 'Clause', 'capitalised_no_number', 'A Clause stays.' FROM o WHERE i % 5 = 4
""")
def orphan_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detection.orphan_keywords(_cited(spark, sf_dir)).select("parent_path", "keyword", "verdict", "sentence")


@query(f"""
WITH o AS ({_ORDER})
SELECT p AS parent_path, 'Table ' || n || ' applies.' AS sentence, 'Table' AS keywords FROM o WHERE i % 5 = 4 UNION ALL SELECT p, 'A Clause stays.', 'Clause' FROM o WHERE i % 5 = 4
""")
def owed_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detection.owed_sentences(detection.orphan_keywords(_cited(spark, sf_dir))).select("parent_path", "sentence", F.array_join("keywords", ",").alias("keywords"))


@query(f"""
WITH o AS ({_ORDER})
SELECT p AS parent_path, 'rates' AS surface, CAST(16 AS INTEGER) AS start FROM o WHERE i % 5 = 4 UNION ALL SELECT p, 'those', CAST(16 AS INTEGER) FROM o WHERE false
""")
def accepted_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A span that stands in the text is taken, one that overlaps a citation or stands nowhere is not."""
    nodes = _cited(spark, sf_dir)
    proposed = nodes.select(F.col("path").alias("parent_path"), F.explode(F.array(F.lit("rates"), F.lit("Joint Schedule"), F.lit("absent"))).alias("surface"))
    return detection.accepted_spans(proposed, nodes, detection.pointers(nodes)).select("parent_path", "surface", F.col("start").cast("int").alias("start"))


@query(f"""
WITH o AS ({_ORDER}) SELECT p AS parent_path, CAST(count(*) AS BIGINT) AS n FROM o, range(1, 9) t(m) WHERE i % 5 = 0 AND m <= k + 1 GROUP BY 1
""")
def titles_citing(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = _cited(spark, sf_dir).where("path like '%5' or path like '%0'").withColumn("title", F.col("text"))
    return detection.title_pointers(nodes).groupBy("parent_path").agg(F.count("*").alias("n"))


@query("SELECT 'legislation/' || lower(s_name) || '-act' AS a, 'legislation/' || lower(s_name) || '-acts' AS b, round(1 - 1 / (2 * length(s_name) + 33), 4) AS similarity FROM supplier")
def near_miss_statutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with and without a last letter; names that differ in a digit are farther apart."""
    keys = table(spark, sf_dir, "supplier").select(F.explode(F.array(_text("legislation/", F.lower("s_name"), "-act"), _text("legislation/", F.lower("s_name"), "-acts"))).alias("key"))
    return resolution.near_miss_keys(keys, 0.98)


# ---- layout


@query("SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'v0' WHEN 1 THEN 'v1.' || s_suppkey WHEN 2 THEN 'v' || s_suppkey ELSE 'v3.0' END AS version FROM supplier")
def version_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") % 4
    raw = F.when(k == 0, _none()).when(k == 1, _text("v 1.", F.col("s_suppkey"))).when(k == 2, _text("V", F.col("s_suppkey"))).otherwise(F.lit("3.0"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", layout.version_key(raw).alias("version"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of text a lineitem: numbered in one of six ways, or plain, on pages of parts."""
    i, n = F.col("l_orderkey") + F.col("l_linenumber"), F.col("l_linenumber")
    m = F.col("l_orderkey") % 20 + 1
    k = i % 7
    text = (
        F.when(k == 0, _text(m, ". Widgets"))
        .when(k == 1, _text(m, ".", n, " each"))
        .when(k == 2, _text(m, ".", n, ".1. more"))
        .when(k == 3, F.lit("(b) item"))
        .when(k == 4, F.lit("(C) upper"))
        .when(k == 5, _text(m, ")  odd"))
        .otherwise(F.lit("plain words"))
    )
    return table(spark, sf_dir, "lineitem").select(
        _text("s", F.col("l_suppkey") % 10).alias("part"), (F.col("l_orderkey") % 50).cast("int").alias("page"), "l_orderkey", F.col("l_linenumber").alias("line_no"),
        (50.0 + 10 * k).alias("x0"), (100.0 + 15 * n).alias("y0"), F.lit(400.0).alias("x1"), (112.0 + 15 * n).alias("y1"), text.alias("text"), (8.0 + n / 2).alias("size_max"), (k == 0).alias("bold"), k.alias("k"),
    )


_LINES = """lines AS (SELECT 's' || l_suppkey % 10 AS part, CAST(l_orderkey % 50 AS INTEGER) AS page, l_orderkey, l_linenumber AS line_no, l_orderkey % 20 + 1 AS m, (l_orderkey + l_linenumber) % 7 AS k, 8.0 + l_linenumber / 2 AS size_max,
  CASE (l_orderkey + l_linenumber) % 7 WHEN 0 THEN (l_orderkey % 20 + 1) || '. Widgets' WHEN 1 THEN (l_orderkey % 20 + 1) || '.' || l_linenumber || ' each' WHEN 2 THEN (l_orderkey % 20 + 1) || '.' || l_linenumber || '.1. more'
   WHEN 3 THEN '(b) item' WHEN 4 THEN '(C) upper' WHEN 5 THEN (l_orderkey % 20 + 1) || ')  odd' ELSE 'plain words' END AS text FROM lineitem)"""


@query(f"""
WITH {_LINES} SELECT l_orderkey, line_no, k <> 6 AND k <> 5 AS numbered, CASE k WHEN 0 THEN 'heading' WHEN 1 THEN 'clause' WHEN 2 THEN 'subclause' WHEN 3 THEN 'item' WHEN 4 THEN 'item' END AS level, CAST(CASE k WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 4 END AS INTEGER) AS depth,
 CASE k WHEN 0 THEN m || '' WHEN 1 THEN m || '.' || line_no WHEN 2 THEN m || '.' || line_no || '.1' WHEN 3 THEN 'b' WHEN 4 THEN 'C' END AS number FROM lines
""")
def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select("l_orderkey", "line_no", layout.looks_numbered("text").alias("numbered"), layout.number_match("text").alias("m"))
    return rows.select("l_orderkey", "line_no", "numbered", "m.level", "m.depth", "m.number")


@query(f"WITH {_LINES}, s AS (SELECT part, size_max AS size, sum(length(text)) AS n FROM lines GROUP BY 1, 2) SELECT part, arg_max(size, (n, -size)) AS size FROM s GROUP BY 1")
def modal_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.modal_size(_lines(spark, sf_dir))


@query(f"WITH {_LINES} SELECT part, round(size_max, 1) AS size, count(*) AS n FROM lines GROUP BY 1, 2")
def font_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.font_histogram(_lines(spark, sf_dir))


@query(f"""
WITH {_LINES}, c AS (SELECT page, sum(length(regexp_replace(text, '\\s+', '', 'g'))) AS chars FROM lines GROUP BY 1)
SELECT CAST(p AS INTEGER) AS page, CAST(coalesce(chars, 0) AS BIGINT) AS chars, CASE WHEN chars > 0 THEN 'layout_text' ELSE 'no_text_layer' END AS route FROM range(0, 55) t(p) LEFT JOIN c ON page = p
""")
def page_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.page_profile(_lines(spark, sf_dir), spark.range(55).select(F.col("id").cast("int").alias("page")))


@query(f"WITH {_LINES} SELECT part, count(*) FILTER (k < 5) AS numbered, CAST(0 AS BIGINT) AS unmatched, CAST(0 AS DOUBLE) AS rate FROM lines GROUP BY 1 HAVING count(*) FILTER (k < 5) > 0")
def numbering_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.numbering_coverage(_lines(spark, sf_dir)).select("part", "numbered", "unmatched", "rate")


@query(f"""
WITH {_LINES}, t AS (SELECT count(*) FILTER (k < 5) AS numbered, count(*) FILTER (k < 3) AS dotted FROM lines)
SELECT 'full' AS rulebook, numbered, numbered AS matched, CAST(1 AS DOUBLE) AS coverage FROM t UNION ALL SELECT 'dotted', numbered, dotted, round(dotted / numbered, 6) FROM t
""")
def rulebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    dotted = {k: layout.RULES[k] for k in ("heading", "clause", "subclause")}
    return layout.rulebook_scores(_lines(spark, sf_dir), {"full": layout.RULES, "dotted": dotted})


@query(f"WITH {_LINES} SELECT CASE k WHEN 0 THEN 'top' WHEN 1 THEN 'dotted' WHEN 2 THEN 'dotted' ELSE 'bracketed' END AS style, count(*) AS n FROM lines WHERE k < 5 GROUP BY 1")
def numbering_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.number_styles(_lines(spark, sf_dir))


@query(f"""
WITH {_LINES}, b AS (SELECT part, sum(length(replace(text, ' ', ''))) AS n FROM lines GROUP BY 1), q AS (SELECT part, sum(length(replace(text, ' ', ''))) AS n FROM lines WHERE k <> 6 GROUP BY 1)
SELECT part, CAST(b.n AS BIGINT) AS body, CAST(coalesce(q.n, 0) AS BIGINT) AS placed, CAST(b.n - coalesce(q.n, 0) AS BIGINT) AS residual FROM b LEFT JOIN q USING (part)
""")
def orphan_ink(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return layout.orphan_ink(lines, lines.where("k <> 6"))


def _number_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    depth = F.col("l_linenumber") % 4 + 1
    number = F.array_join(F.array_repeat((F.col("l_orderkey") % 9 + 1).cast("string"), (F.col("l_linenumber") % 6 + 1).cast("int")), ".")
    return table(spark, sf_dir, "lineitem").select(_text("s", F.col("l_suppkey") % 10).alias("part"), "l_orderkey", "l_linenumber", F.lit("number").alias("block_kind"), number.alias("number"), depth.cast("int").alias("depth"), (50.0 + F.when(F.col("l_suppkey") % 2 == 0, 10.0 * depth).otherwise(40.0 - 10.0 * depth) + F.col("l_orderkey") % 3).alias("left"))


@query("SELECT l_orderkey, l_linenumber, CAST(l_linenumber % 6 + 1 AS INTEGER) AS dots FROM lineitem WHERE l_linenumber % 6 + 1 > 4")
def depths_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.depth_out_of_range(_number_blocks(spark, sf_dir)).select("l_orderkey", "l_linenumber", "dots")


@query("""
WITH b AS (SELECT 's' || l_suppkey % 10 AS part, CAST(l_linenumber % 4 + 1 AS INTEGER) AS depth, 50.0 + CASE WHEN l_suppkey % 2 = 0 THEN 10.0 * (l_linenumber % 4 + 1) ELSE 40.0 - 10.0 * (l_linenumber % 4 + 1) END + l_orderkey % 3 AS l FROM lineitem),
     e AS (SELECT part, depth, CAST(list_sort(list(l))[(count(*) - 1) // 2 + 1] AS DOUBLE) AS e FROM b GROUP BY 1, 2)
SELECT a.part, a.depth, a.e AS left, b.e AS above, abs(a.e - b.e) >= 6 AS tested, abs(a.e - b.e) >= 6 AND a.e < b.e AS disagrees FROM e a JOIN e b ON a.part = b.part AND a.depth = b.depth + 1
""")
def indents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.indent_disagreement(_number_blocks(spark, sf_dir)).select("part", "depth", "left", "above", "tested", "disagrees")


@query("""
WITH m AS (SELECT 's' || s_suppkey AS part, CASE s_suppkey % 3 WHEN 0 THEN 'unmatched_rate' WHEN 1 THEN 'orphan_ink_share' ELSE 'depth_out_of_range' END AS name, s_suppkey % 20 / 100 AS value FROM supplier)
SELECT part, name, value, CASE name WHEN 'unmatched_rate' THEN 0.05 WHEN 'orphan_ink_share' THEN 0.1 ELSE 0.0 END AS threshold FROM m WHERE value > CASE name WHEN 'unmatched_rate' THEN 0.05 WHEN 'orphan_ink_share' THEN 0.1 ELSE 0.0 END
""")
def fit_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.fit_alarms(_metrics(spark, sf_dir)).select("part", "name", "value", "threshold")


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") % 3
    name = F.when(k == 0, "unmatched_rate").when(k == 1, "orphan_ink_share").otherwise("depth_out_of_range")
    return table(spark, sf_dir, "supplier").select(_text("s", F.col("s_suppkey")).alias("part"), name.alias("name"), (F.col("s_suppkey") % 20 / 100).alias("value"))


@query("SELECT 's' || s_suppkey AS part_id, s_suppkey % 20 / 100 > CASE s_suppkey % 3 WHEN 0 THEN 0.05 WHEN 1 THEN 0.1 ELSE 0.0 END AS refused FROM supplier")
def refused_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "supplier").select(_text("s", F.col("s_suppkey")).alias("part_id"))
    return layout.admitted(parts, layout.fit_alarms(_metrics(spark, sf_dir))).select("part_id", "refused")


@query("""
WITH w AS (SELECT l_orderkey AS page, l_linenumber AS line_no, l_linenumber || '.' AS token FROM lineitem)
SELECT page, line_no, token, 40.0 + line_no % 2 AS x0, 100.0 + 20 * line_no AS y0 FROM (SELECT DISTINCT * FROM w)
""")
def number_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line's number is a word of its page, left of an equal word; words of other lines lie elsewhere."""
    n, token = F.col("l_linenumber"), _text(F.col("l_linenumber"), ".")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), n.alias("line_no"), token.alias("token"), (100.0 + 20 * n).alias("y0"), (112.0 + 20 * n).alias("y1")).distinct()
    words = lines.select("page", F.col("token").alias("text"), "y0", "y1", F.explode(F.array(40.0 + F.col("line_no") % 2, F.lit(90.0))).alias("x0")).withColumn("x1", F.col("x0") + 8)
    far = words.withColumn("y0", F.col("y0") + 500).withColumn("y1", F.col("y1") + 500)
    return layout.token_boxes(words.unionByName(far), lines).select("page", "line_no", "token", "x0", "y0")


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.lit(0).alias("grid"), F.col("l_linenumber").alias("row"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("col"), "l_quantity", "l_returnflag").select("page", "grid", "row", "col", F.when(F.col("col") == 0, F.col("row").cast("string")).when(F.col("col") == 1, F.col("l_returnflag")).otherwise(F.lit("words")).alias("text"), (F.col("row") == 1).alias("bold"))


@query("""
SELECT l_orderkey AS page, l_linenumber AS row, CAST(c AS INTEGER) AS col, CASE WHEN l_linenumber = 1 THEN 'header' WHEN c = 0 THEN 'number' WHEN c = 1 THEN 'label' ELSE 'value' END AS role, CASE WHEN l_linenumber = 1 OR c = 0 THEN 0.9 ELSE 0.7 END AS confidence FROM lineitem, range(0, 3) t(c)
""")
def cell_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.cell_roles(_cells(spark, sf_dir)).select("page", "row", "col", "role", "confidence")


@query("""
WITH t AS (SELECT l_orderkey AS page, l_linenumber AS row FROM lineitem), n AS (SELECT page, max(row) AS m FROM t GROUP BY 1)
SELECT page, CAST(m + 1 AS INTEGER) AS n_rows, CAST(3 AS INTEGER) AS n_cols, 'p/' || page || '/table-0' AS path FROM n
""")
def table_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir).select(_text("p/", F.col("page")).alias("parent_path"), F.col("page"), F.lit(0).alias("table_no"), "row", "col", "text", F.lit("value").alias("role"), F.lit(0.7).alias("confidence"))
    made = tree.table_nodes(cells).where("kind = 'table'")
    return made.select(F.split_part("parent_path", F.lit("/"), F.lit(2)).cast("long").alias("page"), F.col("n_rows").cast("int").alias("n_rows"), F.col("n_cols").cast("int").alias("n_cols"), "path")


@query("""
SELECT l_orderkey AS page, 0 AS grid, CAST(l_linenumber AS BIGINT) AS row, CAST(l_partkey % 2 AS BIGINT) AS col, string_agg(l_returnflag, ' ' ORDER BY l_partkey, l_returnflag) AS text FROM lineitem GROUP BY 1, 2, 3, 4
""")
def filled_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines fall into the slots that hold their centres: rows 20 points high, two columns."""
    rows = table(spark, sf_dir, "lineitem")
    x = F.when(F.col("l_partkey") % 2 == 0, 10.0).otherwise(110.0)
    lines = rows.select(F.col("l_orderkey").alias("page"), F.col("l_partkey").alias("line_no"), F.col("l_returnflag").alias("text"), x.alias("x0"), (x + 50).alias("x1"), (20.0 * F.col("l_linenumber") + 2).alias("y0"), (20.0 * F.col("l_linenumber") + 12).alias("y1"))
    slots = rows.select(F.col("l_orderkey").alias("page")).distinct().select("page", F.lit(0).alias("grid"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))).alias("slot"))
    both = slots.select("*", F.lit("row").alias("axis"), (F.col("slot") * 20.0).alias("lo"), (F.col("slot") * 20.0 + 20).alias("hi")).unionByName(slots.where("slot < 2").select("*", F.lit("col").alias("axis"), (F.col("slot") * 100.0).alias("lo"), (F.col("slot") * 100.0 + 100).alias("hi")))
    return layout.fill_cells(both, lines)


@query("""
SELECT l_orderkey AS page, 'row' AS axis, count(*) + 1 AS n FROM lineitem GROUP BY 1 UNION ALL SELECT DISTINCT l_orderkey, 'col', 3 FROM lineitem
""")
def ruled_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of a grid a page: as many rows as the order has lines, three columns."""
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("page")).agg(F.count("*").alias("n"))
    rows = n.select("page", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n"))).alias("i")).select("page", F.lit(10.0).alias("x0"), (100 + 20.0 * F.col("i")).alias("y0"), F.lit(300.0).alias("x1"), (100 + 20.0 * F.col("i")).alias("y1"))
    cols = n.select("page", "n", F.explode(F.array(F.lit(10.0), F.lit(150.0), F.lit(300.0))).alias("x")).select("page", F.col("x").alias("x0"), F.lit(100.0).alias("y0"), F.col("x").alias("x1"), (100 + 20.0 * F.col("n")).alias("y1"))
    return layout.grids(rows.unionByName(cols)).groupBy("page", "axis").agg(F.count("*").alias("n"))


# ---- trees


@query("""
WITH b AS (SELECT 'r' || n_regionkey AS r, n_nationkey, c_custkey % 3 + 1 AS page, c_custkey % 50 + 0.0 AS x0, c_custkey % 70 + 0.0 AS y0, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey),
     p AS (SELECT r || '/n' || n_nationkey || '/c' || c_custkey AS path, * FROM b UNION ALL SELECT r || '/n' || n_nationkey, * FROM b UNION ALL SELECT r, * FROM b)
SELECT path, CAST(page AS INTEGER) AS page, min(x0) AS x0, min(y0) AS y0, max(x0 + 10) AS x1, max(y0 + 5) AS y1 FROM p GROUP BY 1, 2
""")
def node_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of customers, united over nations and regions."""
    n = F.regexp_extract("path", r"/c(\d+)$", 1).try_cast("long")
    box = F.struct((n % 3 + 1).cast("int").alias("page"), (n % 50 + 0.0).cast("double").alias("x0"), (n % 70 + 0.0).cast("double").alias("y0"), (n % 50 + 10.0).cast("double").alias("x1"), (n % 70 + 5.0).cast("double").alias("y1"))
    rows = tree_queries.nodes(spark, sf_dir).withColumn("bboxes_own", F.when(n.isNotNull(), F.array(box)))
    return tree.extents(rows)


@query("""
WITH c AS (SELECT 'r' || n_regionkey AS r, 'n' || n_nationkey AS n, c_custkey AS k FROM customer JOIN nation ON c_nationkey = n_nationkey), p AS (SELECT r || '/' || n || '/c' || k AS path, k FROM c UNION ALL SELECT r || '/' || n, k FROM c UNION ALL SELECT r, k FROM c)
SELECT path, CAST(min(k % 40) AS INTEGER) AS page_start, CAST(max(k % 40 + k % 3) AS INTEGER) AS page_end FROM p GROUP BY 1
""")
def page_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.regexp_extract("path", r"/c(\d+)$", 1).try_cast("int")
    rows = tree_queries.nodes(spark, sf_dir).withColumns({"page_start": n % 40, "page_end": n % 40 + n % 3})
    return tree.page_ranges(rows).where("page_start is not null")


@query("SELECT 'r' || r_regionkey AS path FROM region UNION ALL SELECT 'r' || n_regionkey || '/n' || n_nationkey FROM nation")
def scan_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.scan_units(tree_queries.nodes(spark, sf_dir)).select("path")


@query("SELECT 'r1/n' || n_nationkey || '/c' || c_custkey AS path FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1 AND c_custkey % 2 = 0")
def unit_provisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tree_queries.nodes(spark, sf_dir).withColumn("citable", F.col("path").contains("/c") & (F.col("sib_no") % 2 == 0))
    return tree.provisions_of(rows, "r1").select("path")


@query("""
WITH v AS (SELECT 'p' || p_partkey AS path, p_size % 3 AS k FROM part)
SELECT path, CASE k WHEN 0 THEN 'old' WHEN 1 THEN 'old|numbering_gap_recorded: here' ELSE 'old|unresolved_order: ' END AS notes FROM v
""")
def stamped_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(_text("p", F.col("p_partkey")).alias("path"), (F.col("p_size") % 3).alias("k"))
    nodes = parts.select("path", F.array(F.lit("old")).alias("anomalies"))
    broken = parts.where("k > 0").select("path", F.when(F.col("k") == 1, "numbering_gap").otherwise("order").alias("check"), F.when(F.col("k") == 1, "recorded").alias("reason"), F.when(F.col("k") == 1, "here").alias("detail"))
    return tree.stamped(nodes, broken).select("path", F.array_join("anomalies", "|").alias("notes"))


@query("""SELECT p_partkey, '{"path":"p' || p_partkey || '"' || CASE WHEN p_partkey % 2 = 0 THEN ',"label":"' || p_brand || '"' ELSE '' END || CASE WHEN p_partkey % 3 = 0 THEN ',"anomalies":["x"]' ELSE '' END || '}' AS json FROM part""")
def pruned_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(_text("p", k).alias("path"), F.when(k % 2 == 0, F.col("p_brand")).alias("label"), F.when(k % 3 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("anomalies"))
    return tree.to_json(rows).select(F.expr("cast(substring(path, 2) as bigint)").alias("p_partkey"), "json")


@query("""
WITH p AS (SELECT p_partkey, p_size % 6 AS k FROM part)
SELECT 'p' || p_partkey AS path, CASE k WHEN 1 THEN 'citable_intro_or_ref' WHEN 2 THEN 'intro_without_text' WHEN 3 THEN 'unknown_kind' WHEN 4 THEN 'page_range' ELSE 'table_without_size' END AS rule FROM p WHERE k > 0
""")
def broken_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule a node is broken, by the size of its part."""
    k = F.col("p_size") % 6
    kind = F.when(k.isin(1, 2), "intro").when(k == 3, "verse").when(k == 5, "table").otherwise("clause")
    cols = {c.name: F.lit(None).cast(c.dataType) for c in schemas.struct(schemas.NODES)}
    cols |= {"id": _text("p", F.col("p_partkey")), "path": _text("p", F.col("p_partkey")), "kind": kind, "citable": k == 1, "text": F.when(k != 2, F.col("p_name")), "page_start": F.when(k == 4, 9).otherwise(1), "page_end": F.lit(5)}
    return schemas.validate_nodes(table(spark, sf_dir, "part").select(*(v.alias(c) for c, v in cols.items()))).select("path", "rule")


@query("""
WITH d AS (SELECT 'd' || doc_id % 50 AS part, doc_id, 'd' || doc_id % 50 || '/' || doc_id AS path FROM documents)
SELECT part, path, CAST(1 AS INTEGER) AS depth, CAST(row_number() OVER (PARTITION BY part ORDER BY doc_id) - 1 AS INTEGER) AS sib_no FROM d
""")
def flattened_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested JSON of fifty trees, a child a document, read back as rows."""
    child = F.struct(_text("d", F.col("doc_id") % 50, "/", F.col("doc_id")).alias("path"), F.lit("clause").alias("kind"), F.substring("text", 1, 20).alias("text"))
    made = table(spark, sf_dir, "documents").groupBy(_text("d", F.col("doc_id") % 50).alias("path")).agg(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", child.alias("c")))), lambda x: x["c"]).alias("children"))
    return tree.flatten(made.select(F.to_json(F.struct("path", F.lit("part").alias("kind"), "children")).alias("value"))).where("depth = 1").select("part", "path", "depth", "sib_no")


# ---- vocabulary and concepts


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Joint Schedule ' || p_size WHEN 1 THEN 'Clause ' || p_size || '.2' END AS pointer FROM part
""")
def delegated_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("p_partkey") % 4, F.col("p_size")
    text = F.when(k == 0, _text("has the meaning given in Joint Schedule ", n, " and Clause 9;")).when(k == 1, _text("the sum as set out in Clause ", n, ".2")).when(k == 2, _text("means Clause ", n)).otherwise(F.lit("has the meaning given. In Clause 4 it is another"))
    return table(spark, sf_dir, "part").select("p_partkey", vocabulary.pointer_of(text).alias("pointer"))


@query("""
SELECT p_partkey, CASE p_partkey % 3 WHEN 2 THEN p_name || ' (see below)' ELSE p_name END AS term, CASE p_partkey % 3 WHEN 0 THEN upper(substr(string_split(p_name, ' ')[1], 1, 1) || substr(string_split(p_name, ' ')[2], 1, 1)) WHEN 1 THEN 'ring' END AS alias FROM part
""")
def split_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, p = F.col("p_partkey") % 3, F.col("p_name")
    short = F.upper(F.concat(*(F.substring(F.split_part("p_name", F.lit(" "), F.lit(i)), 1, 1) for i in (1, 2))))
    raw = F.when(k == 0, _text('"', p, '" (', short, ")")).when(k == 1, _text(p, ' ("ring")')).otherwise(_text(p, " (see below)"))
    rows = table(spark, sf_dir, "part").select("p_partkey", vocabulary.split_alias(raw).alias("s"))
    return rows.select("p_partkey", "s.term", F.try_element_at("s.aliases", F.lit(1)).alias("alias"))


@query("SELECT 'c' || c_custkey AS term, CASE c_custkey % 3 WHEN 0 THEN 'both' WHEN 1 THEN 'declared_only' ELSE 'discovered_only' END AS side FROM customer")
def sides_of_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(_text("c", F.col("c_custkey")).alias("term"), (F.col("c_custkey") % 3).alias("k"))
    return vocabulary.declared_discovered_diff(c.where("k < 2"), c.where("k <> 1"))


def _uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    kind = F.when(i % 4 == 0, "heading").when(i % 4 == 1, "sentence_initial")
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("term"), _text("n", F.col("user_id")).alias("node_id"), F.struct(i.cast("int").alias("start"), (i + 3).cast("int").alias("end")).alias("char_span"), F.when(kind.isNull(), "confident").otherwise("ambiguous").alias("status"), kind.alias("ambiguity_kind"), F.lit("exact").alias("method"), _none().alias("definition_used"))


@query("""
SELECT CAST(event_id AS INTEGER) AS start, CASE WHEN event_id % 6 = 0 THEN 'confident' WHEN event_id % 4 < 2 THEN 'ambiguous' ELSE 'confident' END AS status, CASE WHEN event_id % 6 = 0 THEN 'llm' ELSE 'exact' END AS method FROM events WHERE NOT (event_id % 6 = 1 AND event_id % 5 = 0)
""")
def judged_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict of use settles, not_a_use removes only where it is sure."""
    uses, i = _uses(spark, sf_dir), F.col("char_span.start")
    verdicts = uses.where(i % 6 < 2).select("term", "node_id", "char_span", F.when(i % 6 == 0, "use").otherwise("not_a_use").alias("verdict"), F.when(i % 5 == 0, 0.8).otherwise(0.5).alias("confidence"))
    return vocabulary.apply_verdicts(uses, verdicts).select("char_span.start", "status", "method")


@query("SELECT CASE WHEN event_id % 4 = 0 THEN 'heading' ELSE 'sentence_initial' END AS kind, count(*) AS n, true AS bounded FROM events WHERE event_id % 4 < 2 GROUP BY 1")
def routed_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ambiguous use is in a batch of its kind, of at most twenty."""
    sizes = vocabulary.routing_batches(_uses(spark, sf_dir)).groupBy(F.col("ambiguity_kind").alias("kind"), "batch").agg(F.count("*").alias("n"))
    return sizes.groupBy("kind").agg(F.sum("n").alias("n"), (F.max("n") <= vocabulary.BATCH).alias("bounded"))


def _concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(_text("k", F.col("p_partkey")).alias("id"), F.col("p_name").alias("label"), F.col("p_brand").alias("scope_path"), F.array(_text("n", F.col("p_size"))).alias("member_node_ids"), (F.col("p_partkey") % 10 / 10).alias("confidence"))


@query("""
SELECT 'k' || p_partkey AS id, lower(p_name) AS term FROM part WHERE p_name IN (SELECT p_name FROM part WHERE p_size <= 3)
""")
def collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts that bear the name of a defined term, in other letters."""
    sites = table(spark, sf_dir, "part").where("p_size <= 3").select(F.col("p_name").alias("term")).distinct().withColumn("aliases", F.array().cast("array<string>"))
    found = concepts.term_collisions(_concepts(spark, sf_dir).withColumn("label", _text(" ", F.upper("label"), " ")), sites)
    return found.where("reason = 'surface'").select("id", F.lower("term").alias("term"))


@query("""
WITH s AS (SELECT 'Term ' || p_partkey AS term, p_name AS alias, p_partkey AS k FROM part), e AS (SELECT lower(term) AS surface, term, 0 AS late FROM s UNION ALL SELECT lower(alias), term, 1 FROM s)
SELECT surface, arg_min(term, (late, term)) AS term FROM e GROUP BY 1
""")
def declared_surfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = table(spark, sf_dir, "part").select(_text("Term ", F.col("p_partkey")).alias("term"), F.array("p_name").alias("aliases"))
    return concepts.declared_surfaces(sites)


@query("""
WITH p AS (SELECT p_partkey AS k, p_name AS l, p_brand AS scope FROM part), h AS (SELECT l, arg_min(k, (-(k % 10 / 10), l, 'k' || k)) AS k, count(*) AS size FROM p GROUP BY 1)
SELECT 'k' || k AS id, l AS label, size FROM h
""")
def merged_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts of one label become one, led by the most confident."""
    c = _concepts(spark, sf_dir)
    first = c.groupBy("label").agg(F.min("id").alias("a"))
    pairs = c.join(first, "label").where("a <> id").select("a", F.col("id").alias("b"))
    return concepts.merged(c, pairs).select("id", "label", "size")


@query("SELECT 'u' || c_custkey AS path, c_custkey % 3 = 0 AS scanned FROM customer")
def scanned_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(_text("u", F.col("c_custkey")).alias("path"), "c_custkey")
    return concepts.scanned_scopes(c, c.where("c_custkey % 3 = 0").select(F.col("path").alias("scope_path")))


@query("""
SELECT p_brand AS scope_path, lower(p_name) AS label, CAST(count(DISTINCT p_size) AS INTEGER) AS members, max(least(p_size / 40, 1.0)) AS confidence FROM part GROUP BY 1, 2
""")
def parsed_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies name members that exist and one that does not; a concept with none is dropped."""
    p = table(spark, sf_dir, "part")
    nodes = p.select(_text("n", F.col("p_size")).alias("path")).distinct().withColumn("id", F.col("path"))
    real = F.struct(F.lower("p_name").alias("label"), F.array(_text("n", F.col("p_size")), F.lit("absent")).alias("members"), (F.col("p_size") / 40).alias("confidence"))
    lost = F.struct(F.lit("lost").alias("label"), F.array(F.lit("absent"), F.lit("absent")).alias("members"), F.lit(0.5).alias("confidence"))
    replies = p.select(F.col("p_brand").alias("scope_path"), F.to_json(F.array(real, lost)).alias("value"))
    return concepts.parse_proposals(replies, nodes).groupBy("scope_path", "label").agg(F.max(F.size("member_node_ids")).alias("members"), F.max("confidence").alias("confidence"))


# ---- embeddings


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", _text("n", F.col("doc_id")).alias("node_id"), F.when(F.col("doc_id") % 3 == 0, "summary").otherwise("leaf").alias("level"), F.col("text"))


@query("""
SELECT 'n' || doc_id AS node_id, CASE WHEN doc_id % 3 = 0 THEN 'summary_owed' ELSE 'vector_owed' END AS reason FROM documents WHERE text NOT IN (SELECT text FROM documents WHERE doc_id % 2 = 0 AND text IS NOT NULL)
""")
def pending_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _vectors(spark, sf_dir)
    cache = rows.where("doc_id % 2 = 0").select(ids.vector_key(F.lit("m"), "text").alias("vector_ref")).distinct()
    return embeddings.records(rows, cache, "m")[1].select("node_id", "reason")


@query("""
SELECT 'n' || doc_id AS node_id, 'missing_node' AS rule FROM documents WHERE doc_id % 7 = 0 UNION ALL SELECT 'n' || doc_id, 'unflagged_summary' FROM documents WHERE doc_id % 3 = 0 AND doc_id % 5 = 0 UNION ALL SELECT 'n' || doc_id, 'two_leaf_levels' FROM documents WHERE doc_id % 11 = 0
""")
def broken_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, own = F.col("doc_id"), table(spark, sf_dir, "documents").select("doc_id")
    levels = F.when(i % 3 == 0, F.array(F.lit("summary"))).otherwise(F.array(F.lit("leaf")))
    levels = F.when(i % 11 == 0, F.array_union(levels, F.array(F.lit("leaf"), F.lit("leaf_window")))).otherwise(levels)
    recs = own.select("doc_id", _text("n", i).alias("node_id"), F.explode(levels).alias("level")).withColumn("llm_derived", (F.col("level") == "summary") & (F.col("doc_id") % 5 != 0))
    return embeddings.broken_records(recs, own.where(i % 7 != 0).select(_text("n", i).alias("id"))).distinct()


@query("SELECT doc_id % 200 AS k, CAST(max(length(text)) AS DOUBLE) AS length FROM documents WHERE text IS NOT NULL GROUP BY 1")
def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owed texts get the vectors of a provider, here the length of the text."""
    d = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text")
    empty = spark.createDataFrame([], "vector_ref string, vector array<float>")
    _, owed = embeddings.cache_split(d, empty, "m")
    vectors = embeddings.embed_owed(owed, lambda texts: [[float(len(t))] for t in texts])
    keyed = d.select("doc_id", ids.vector_key(F.lit("m"), "text").alias("vector_ref")).join(vectors, "vector_ref")
    return keyed.groupBy((F.col("doc_id") % 200).alias("k")).agg(F.max(F.col("vector")[0]).cast("double").alias("length"))


# ---- graph


@query("""
WITH k AS (SELECT DISTINCT 'legislation/act-' || l_suppkey % 40 || '-' || (1950 + l_suppkey % 40) AS key, l_suppkey % 40 AS n FROM lineitem)
SELECT key, CASE WHEN n % 2 = 0 THEN 'Act ' || n ELSE 'Act ' || n || ' ' || (1950 + n) END AS title, CAST(1950 + n AS INTEGER) AS year, n % 2 = 1 AS derived FROM k
""")
def statute_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_suppkey") % 40
    refs = table(spark, sf_dir, "lineitem").select(F.lit("external").alias("status"), _text("legislation/act-", n, "-", 1950 + n).alias("target_path"))
    known = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 40).alias("n")).distinct().where("n % 2 = 0")
    records = known.select(_text("legislation/act-", F.col("n"), "-", 1950 + F.col("n")).alias("key"), _text("Act ", F.col("n")).alias("title"), F.lit(0).alias("year"), F.lit("act").alias("instrument_kind"), _none().alias("provision"))
    return graph.legislation_rows(refs, records).select("key", "title", "year", "derived")


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_name").alias("term"), _text("n", F.col("p_size")).alias("definition_node_id"), F.lit("declared").alias("source"), F.lit("document").alias("scope"), F.array(F.col("p_brand")).alias("aliases"), _none().alias("pointer"))


@query("SELECT p_name AS name, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS aliases FROM part GROUP BY 1")
def term_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.term_rows(_sites(spark, sf_dir)).select("name", F.array_join("aliases", ",").alias("aliases"))


@query("SELECT DISTINCT p_name AS src, 'n' || p_size AS dst FROM part WHERE p_size % 2 = 0")
def definition_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "part").where("p_size % 2 = 0").select(_text("n", F.col("p_size")).alias("id")).distinct()
    return graph.definition_edges(_sites(spark, sf_dir), nodes).select("src", "dst")


@query("SELECT 'n' || user_id AS src, event_type AS dst, event_id || '-' || (event_id + 3) AS span FROM events WHERE user_id % 2 = 1")
def use_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "events").where("user_id % 2 = 1").select(_text("n", F.col("user_id")).alias("id")).distinct()
    return graph.use_edges(_uses(spark, sf_dir), nodes).select("src", "dst", F.col("props.char_span").alias("span"))


@query("""
WITH u AS (SELECT DISTINCT event_type AS term, user_id AS n FROM events), s AS (SELECT DISTINCT p_name AS defined, p_size AS n FROM part) SELECT DISTINCT defined AS src, term AS dst FROM u JOIN s USING (n) WHERE term <> defined
""")
def defined_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.defined_using_edges(_uses(spark, sf_dir), _sites(spark, sf_dir)).select("src", "dst")


@query("SELECT 'k' || p_partkey AS src, 'n' || p_size AS dst FROM part WHERE p_size <= 25")
def about_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "part").where("p_size <= 25").select(_text("n", F.col("p_size")).alias("id")).distinct()
    return graph.about_edges(_concepts(spark, sf_dir), nodes).select("src", "dst")


@query("SELECT 'k' || p_partkey AS src, 'uses' AS label, 'k' || (p_partkey + 1) AS dst FROM part WHERE p_partkey + 1 IN (SELECT p_partkey FROM part)")
def concept_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    c = table(spark, sf_dir, "part").select(_text("k", k).alias("id"), F.array(F.struct(_text("k", k).alias("src"), F.lit("uses").alias("label"), _text("k", k + 1).alias("dst"))).alias("relations"))
    return graph.concept_edges(c).select("src", F.col("props.label").alias("label"), "dst")


@query("SELECT true AS same, false AS other")
def load_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id of a load is that of its keys in any order, and of no other keys."""
    n = table(spark, sf_dir, "customer").select(_text("c", F.col("c_custkey")).alias("id"))
    e = table(spark, sf_dir, "orders").select(F.lit("HAS").alias("type"), _text("c", F.col("o_custkey")).alias("src"), _text("o", F.col("o_orderkey")).alias("dst"), F.create_map().cast("map<string,string>").alias("props"))
    one, two, less = graph.load_id("b", n, e), graph.load_id("b", n.repartition(5), e.repartition(7, "dst")), graph.load_id("b", n, e.where("dst <> 'o1' and dst <> 'o3'"))
    a, b, c = (df.select(F.col("load_id").alias(x)) for df, x in ((one, "a"), (two, "b"), (less, "c")))
    return a.crossJoin(b).crossJoin(c).select((F.col("a") == F.col("b")).alias("same"), (F.col("a") == F.col("c")).alias("other"))  # one row each


@query("SELECT 'deed' AS path, CAST(min(l_linenumber) AS INTEGER) AS page_start, CAST(max(l_orderkey % 300 + 7) AS INTEGER) AS page_end, count(DISTINCT l_orderkey) AS n_parts FROM lineitem")
def document_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_linenumber").alias("page_start"), (F.max(F.col("l_orderkey") % 300) + 7).cast("int").alias("page_end")).withColumn("kind", F.lit("part"))
    return graph.document_root(parts, "deed").select("path", "page_start", "page_end", "n_parts")


@query("SELECT p_partkey AS id, round(p_size + 0.02 * ln(1 + CASE WHEN p_partkey % 2 = 0 THEN p_retailprice ELSE 0 END), 9) AS score FROM part")
def boosted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    got = graph.boosted(p.select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("score")), p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("salience")))
    return got.select("id", F.round("score", 9).alias("score"))


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN p_retailprice ELSE 0.0 END AS salience, p_partkey % 4 = 0 AS flagged FROM part")
def written_salience(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    values = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("target"), F.col("p_retailprice").alias("salience"), (F.col("p_partkey") % 4 == 0).alias("flagged"))
    return graph.with_salience(p.select(F.col("p_partkey").alias("id"), F.lit(-1.0).alias("salience")), values).select("id", "salience", "flagged")


@query("""
WITH RECURSIVE up AS (SELECT 0 AS id, 0 AS hops UNION ALL SELECT e.k, up.hops + 1 FROM up JOIN (SELECT c_custkey AS k, c_custkey // 3 AS t FROM customer WHERE c_custkey > 0) e ON e.t = up.id)
SELECT 'c' || id AS id, CAST(hops AS INTEGER) AS hops FROM up
""")
def impact_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers refer to the one of a third of their number; all depend on the first."""
    e = table(spark, sf_dir, "customer").where("c_custkey > 0").select(F.lit("RESOLVES_TO").alias("type"), _text("c", F.col("c_custkey")).alias("src"), _text("c", F.floor(F.col("c_custkey") / 3)).alias("dst"))
    return graph.impact(e, "c0")


# ---- evaluation


@query("SELECT p_partkey % 100 AS k, count(*) FILTER (p_size > 25) / nullif(count(*) FILTER (p_size > 10), 0) AS share FROM part GROUP BY 1")
def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 100).alias("k")).agg(F.count_if(F.col("p_size") > 25).alias("c"), F.count_if(F.col("p_size") > 10).alias("o"))
    return t.select("k", evaluation.rate("c", "o").alias("share"))


@query("""
WITH b AS (SELECT l_orderkey, l_linenumber % 3 AS page, l_quantity AS x, l_tax AS y FROM lineitem) SELECT 'o' || l_orderkey AS path, CAST(page AS INTEGER) AS page, min(x) AS x0, min(y) AS y0, max(x + 5) AS x1, max(y + 1) AS y1 FROM b GROUP BY 1, 2
""")
def united_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = F.struct((F.col("l_linenumber") % 3).cast("int").alias("page"), F.col("l_quantity").alias("x0"), F.col("l_tax").alias("y0"), (F.col("l_quantity") + 5).alias("x1"), (F.col("l_tax") + 1).alias("y1"))
    nodes = table(spark, sf_dir, "lineitem").groupBy(_text("o", F.col("l_orderkey")).alias("path")).agg(F.collect_list(box).alias("bboxes_own")).withColumn("bboxes_extent", F.col("bboxes_own"))
    return evaluation.boxes_by_page(nodes)


@query("""
SELECT 'o' || o_orderkey AS path, 'ref_span_integrity' AS check FROM orders WHERE o_orderkey % 4 = 1
""")
def broken_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(_text("o", o).alias("path"), _text("see Clause ", o, " now").alias("text"), o.alias("o"), F.length(o.cast("string")).alias("n"))
    refs = rows.select("path", F.col("path").alias("parent_path"), F.when(F.col("o") % 4 == 1, "other").otherwise(F.col("o").cast("string")).alias("text"), F.struct(F.lit(11).alias("start"), (F.col("n") + 11).alias("end")).alias("char_span"))
    return evaluation.ref_span_integrity(refs, rows.select("path", "text").withColumn("title", _none())).select("path", "check")


@query("""
SELECT 'p' || p_partkey AS path, CASE WHEN p_partkey % 3 = 0 THEN 'agreed' END AS reason, CAST(0 AS BIGINT) AS stale FROM part UNION ALL SELECT 'gone', 'agreed', 1
""")
def ledger_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "part").select(F.lit("order").alias("check"), _text("p", F.col("p_partkey")).alias("path"), "p_partkey")
    entries = v.where("p_partkey % 3 = 0").select("check", "path", F.lit("agreed").alias("reason")).unionByName(spark.createDataFrame([("order", "gone", "agreed")], "check string, path string, reason string"))
    held, stale = evaluation.with_ledger(v, entries)
    return held.select("path", "reason", F.lit(0).cast("long").alias("stale")).unionByName(stale.select("path", "reason", F.lit(1).cast("long").alias("stale")))


@query("""
WITH r AS (SELECT l_orderkey AS g, min(l_linenumber) AS a, max(l_linenumber) AS b, count(*) AS n FROM lineitem GROUP BY 1) SELECT 'g' || g AS group_id, substr('abcdefghijklmnopqrstuvwxyz', a + 1, b + 3 - a) AS phrase, n FROM r
""")
def list_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    refs = table(spark, sf_dir, "lineitem").select(_text("g", F.col("l_orderkey")).alias("group_id"), F.lit("p").alias("parent_path"), F.struct(n.alias("start"), (n + 3).alias("end")).alias("char_span"))
    return evaluation.group_contexts(refs, spark.createDataFrame([("p", "abcdefghijklmnopqrstuvwxyz")], "path string, text string"))


@query("""
WITH w AS (SELECT unnest(string_split(p_name, ' ')) AS w FROM part), c AS (SELECT upper(substr(w, 1, 1)) || substr(w, 2) AS run, count(*) AS n FROM w GROUP BY 1), d AS (SELECT DISTINCT upper(substr(string_split(p_name, ' ')[1], 1, 1)) || substr(string_split(p_name, ' ')[1], 2) AS s FROM part)
SELECT run, n, 'unknown' AS verdict FROM c WHERE run NOT IN (SELECT s FROM d) ORDER BY n DESC, run LIMIT 25
""")
def undefined_capitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capitalised words that no defined term has: a report of the most frequent."""
    p = table(spark, sf_dir, "part")
    word = lambda i: F.initcap(F.split_part("p_name", F.lit(" "), F.lit(i)))
    nodes = p.select(F.lit("clause").alias("kind"), _text(word(1), ". ", word(2), ".").alias("text"))
    sites = p.select(word(1).alias("term")).distinct().withColumn("aliases", F.array().cast("array<string>"))
    return evaluation.capitalised_never_defined(nodes, sites)


@query("""
SELECT kind, n FROM (SELECT 'references' AS kind, count(*) AS n FROM lineitem UNION ALL SELECT 'keys', count(DISTINCT l_suppkey) FROM lineitem UNION ALL SELECT 'routed', count(*) FILTER (l_returnflag IN ('R', 'A')) FROM lineitem)
""")
def statute_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolver = F.when(F.col("l_returnflag") == "R", "llm").when(F.col("l_returnflag") == "A", "human").otherwise("scope")
    refs = table(spark, sf_dir, "lineitem").select(F.lit("legislation").alias("ref_kind"), _text("legislation/", F.sha1(F.col("l_suppkey").cast("string"))).alias("target_path"), resolver.alias("resolver"))
    t = evaluation.legislation_routing(refs)[0]
    return t.selectExpr("stack(3, 'references', references, 'keys', keys, 'routed', routed) as (kind, n)")


@query("""
SELECT 'o' || l_orderkey AS path, CASE WHEN l_orderkey % 7 = 0 THEN 'no_such_page' WHEN l_orderkey % 7 = 1 THEN 'differs' ELSE 'agrees' END AS status FROM lineitem GROUP BY l_orderkey
""")
def box_round_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A word a line of an order stands in the order's box; some texts are others, some pages are not there."""
    word = F.sha1(_text(F.col("l_orderkey"), ".", F.col("l_linenumber")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", word.alias("text")).distinct()
    words = rows.where("l_orderkey % 7 <> 0").select(F.col("l_orderkey").cast("int").alias("page"), "text", (20.0 * F.col("l_linenumber")).alias("x0"), F.lit(10.0).alias("y0"), (20.0 * F.col("l_linenumber") + 15).alias("x1"), F.lit(20.0).alias("y1"))
    stray = words.withColumns({"y0": F.lit(50.0), "y1": F.lit(60.0)})
    box = F.struct(F.col("l_orderkey").cast("int").alias("page"), F.lit(0.0).alias("x0"), F.lit(5.0).alias("y0"), F.lit(999.0).alias("x1"), F.lit(25.0).alias("y1"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "text"))), lambda w: w["text"]), " ")
    nodes = rows.groupBy("l_orderkey").agg(text.alias("text")).select(_text("o", F.col("l_orderkey")).alias("path"), F.when(F.col("l_orderkey") % 7 == 1, F.lit("quite another text")).otherwise(F.col("text")).alias("text"), F.array(box).alias("bboxes_own"))
    return evaluation.box_round_trip(nodes, words.unionByName(stray)).select("path", "status")


# ---- lookups


@query("""
SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 3 THEN NULL WHEN 2 THEN p_size ELSE 2 END AS INTEGER) AS page, CASE p_partkey % 4 WHEN 3 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS x0 FROM part
""")
def decoded_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes as a JSON list, as a JSON list of JSON texts, as one flat box, or as nothing readable."""
    k, box = F.col("p_partkey") % 4, _text('{"page": 2, "bbox": [', F.col("p_size"), ", 0, 9, 9]}")
    raw = F.when(k == 0, _text("[", box, "]")).when(k == 1, F.to_json(F.array(box))).when(k == 2, _text("[", F.col("p_size"), ", 0, 9, 9]")).otherwise(F.lit("not json"))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.try_element_at(tools.decoded_boxes(raw, _none(), F.col("p_size")), F.lit(1)).alias("b"))
    return rows.select("p_partkey", "b.page", F.get("b.bbox", F.lit(0)).alias("x0"))


def _graph(spark: SparkSession, sf_dir: str) -> tools.Graph:
    """Customers under nations under regions; orders refer from their customer to a nation."""
    cols = {c.name: F.lit(None).cast(c.dataType) for c in schemas.struct(schemas.NODES)}
    n = tree_queries.nodes(spark, sf_dir)
    have = {"id": F.col("path"), "lineage_key": F.split_part("path", F.lit("/"), F.lit(1)), "citable": F.lit(True), "page_start": (F.col("sib_no") % 9 + 1).cast("int"), "page_end": (F.col("sib_no") % 9 + 1).cast("int")}
    nodes = n.select(*(F.col(c).cast(v).alias(c) if c in n.columns else have.get(c, cols[c]).alias(c) for c, v in ((f.name, f.dataType) for f in schemas.struct(schemas.NODES))))
    people = n.where("path like '%/c%'").select(F.col("path").alias("parent_path"), F.col("sib_no").alias("o_custkey"))
    o = table(spark, sf_dir, "orders").join(people, "o_custkey")
    settled = F.when(F.col("o_orderkey") % 3 == 0, "ambiguous").otherwise("resolved")
    refs = o.select(_text(F.col("parent_path"), "/ref@", F.col("o_orderkey")).alias("path"), "parent_path", tree.part_of("parent_path").alias("part"), F.lit("x").alias("text"), F.lit("clause").alias("ref_kind"), settled.alias("status"), F.when(settled == "resolved", F.array_join(F.slice(F.split("parent_path", "/"), 1, 2), "/")).alias("target_path"), F.array().cast(schemas.CANDIDATES).alias("candidates"))
    return tools.Graph(nodes, refs, schemas.empty(spark, schemas.DEFINITION_SITES), schemas.empty(spark, schemas.TERM_USES), schemas.empty(spark, schemas.CONCEPTS))


@query("SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 2")
def references_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.follow_references(_graph(spark, sf_dir), "r2").select(F.regexp_extract("path", r"@(\d+)$", 1).cast("long").alias("o_orderkey"))


@query("SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey = 7 AND o_orderkey % 3 <> 0")
def references_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    home = table(spark, sf_dir, "nation").where("n_nationkey = 7").select(_text("r", F.col("n_regionkey"), "/n7").alias("p")).first()["p"]
    return tools.follow_references(g, home, "inbound").select(F.regexp_extract("path", r"@(\d+)$", 1).cast("long").alias("o_orderkey"))


@query("""
SELECT 'r1' AS path, r_name || coalesce((SELECT chr(10) || string_agg(t, chr(10) ORDER BY s, p) FROM (SELECT n_name AS t, n_nationkey AS s, 'r1/n' || n_nationkey AS p FROM nation WHERE n_regionkey = 1 UNION ALL SELECT c_name, c_custkey, 'r1/n' || c_nationkey || '/c' || c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 1) WHERE (s, p) > (1, 'r1')), '') AS x FROM region WHERE false
UNION ALL SELECT 'r1', string_agg('r1/n' || n_nationkey, ',' ORDER BY n_nationkey) FROM nation WHERE n_regionkey = 1
""")
def provision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.get_provision(_graph(spark, sf_dir), "r1").select("path", F.array_join("children", ",").alias("x"))


@query("SELECT 'r' || n_regionkey || '/n' || n_nationkey || '/c' || c_custkey AS path FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 3 UNION ALL SELECT 'r3/n' || n_nationkey FROM nation WHERE n_regionkey = 3 UNION ALL SELECT 'r3'")
def node_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.history(_graph(spark, sf_dir).nodes, "r3").select("path")


@query("""
SELECT 'r' || n_regionkey AS part, count(*) AS n, count(*) FILTER (o_orderkey % 2 = 0) AS decided FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderkey % 3 = 0 GROUP BY 1
""")
def queue_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    even = g.refs.where(F.regexp_extract("path", r"@(\d+)$", 1).cast("long") % 2 == 0).select(F.lit("ref").alias("kind"), F.col("path").alias("id"), F.lit("agreed").alias("verdict"), F.lit("t").alias("ts"), F.lit(1).alias("nr"))
    return tools.queue_counts(tools.review_queue(g, even)).select("part", "n", "decided")


@query("SELECT 'r' || n_regionkey || '/n' || n_nationkey || '/c' || c_custkey AS path, CAST(c_custkey AS BIGINT) % 9 + 1 AS page FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey = 5")
def cited_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _graph(spark, sf_dir)
    box = F.array(F.struct(F.col("page_start").alias("page"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(1.0).alias("x1"), F.lit(1.0).alias("y1")))
    g.nodes = g.nodes.withColumn("bboxes_own", box)
    path = g.nodes.where("path like '%/c5'").select("path").first()["path"]
    return tools.cite(g, path).select(F.lit(path).alias("path"), F.col("page").cast("long").alias("page"))


@query("SELECT conv_id, 'R' || substr('oot', 1) || ' ' || conv_id AS shown FROM conversations WHERE turn = 0")
def shown_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").where("turn = 0").select("conv_id", tools.shown_part(_text("root-", F.col("conv_id"), "/x")).alias("shown"))


@query("SELECT status, ref_kind, n FROM (SELECT l_returnflag AS status, NULL AS ref_kind, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL SELECT NULL, l_linestatus, count(*) FROM lineitem GROUP BY 2 UNION ALL SELECT l_returnflag, l_linestatus, count(*) FROM lineitem GROUP BY 1, 2)")
def status_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("status"), F.col("l_linestatus").alias("ref_kind"), F.lit("r").alias("resolver"), F.lit("s").alias("scope_rule"))
    rows = resolution.status_counts(refs)
    return rows.where("status is not null or ref_kind is not null").select("status", "ref_kind", "n")
