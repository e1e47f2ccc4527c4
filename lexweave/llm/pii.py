"""Personal data, and the terms around it that would give it away.

Base findings are e-mail addresses, IP addresses, payment cards and phone numbers: per kind the
leftmost matches that do not overlap, of which those that fail the kind's test are dropped.

The information-theoretic part protects entities: each value found, and, as most values stand in one
text, the classes that a value backs off to: its kind, and personal data as a whole (``ANY``).

* The terms of an entity are the words (runs of letters and digits, lower case) anywhere in the texts that
  hold it, but for those that touch a finding. All counts are of different texts, so that copies prove nothing.
* An entity e has information IC(e) = -log2 p(e), and a term t tells PMI(t; e) =
  log2(p(t, e) / (p(t) p(e))) of it. The disclosure PMI / IC is 1 for a term that stands nowhere
  but by the entity. It shrinks by n / (n + prior): n is the number of texts that hold both, and
  the prior ``PRIOR``; for a class all texts with the same values count as one, an equal share each, so that near
  copies of one text are one proof, and the prior is ``CLASS_PRIOR``, as rare words meet a class by chance.
  No pair is left out for its number, though one text alone stays below any threshold over 2 / 3.
* A term is generalised everywhere in the texts that hold the entity from a disclosure of
  ``GENERALISE`` on, and removed from ``REMOVE`` on.

All of it is DataFrame expressions. Places come from the lengths of matches and of what lies
between them, summed in blocks. Pairs of entity and term are joined only where the counts of both leave the
threshold within reach, which drops nothing; words are placed only in texts with telling terms.

Edge cases: a null text is an empty one; without findings all counts are 0 and the hash is that
of nothing. Rows that repeat an id are told apart by their text, and equal rows get equal
results. Very long texts and texts with very many findings are whole; running sums over n matches take
n * n / BLOCK steps at most. An empty table gives no rows. Other columns are kept by ``sanitise``
as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexweave.llm.common import cut, fresh_dir

PRIOR, CLASS_PRIOR, GENERALISE, REMOVE = 0.5, 4.0, 0.8, 0.95
KINDS = ("email", "ip", "card", "phone")
ANY = "any"
#: What is summed at a time in an array, and the characters of a piece of text.
BLOCK, PIECE = 256, 16_384
TERM = r"[\p{L}\p{N}]++"

#: Java patterns with the matches of the plain ones. Possessive repeats never give back what they could not
#: use, and a match starts where its run does or where the last match ended, so that long runs take linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for the kind to be looked for at all.
_HINTS = {"email": r"@[A-Za-z0-9-]++\.", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"(?:[0-9][\x20-]?+){13}", "phone": r"\+[0-9]"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_DIGITS = r"regexp_replace({m}, r'[^0-9]', '')"
_LUHN = (
    "aggregate(sequence(1, length({d})), 0, (a, i) -> a + "
    "if(i % 2 = 1, int(substring(reverse({d}), i, 1)), int(substring('0246813579', 1 + int(substring(reverse({d}), i, 1)), 1)))) % 10 = 0"
)
_TESTS = {
    "email": "true",
    "ip": rf"{{m}} rlike r'^{_PART}(?:\.{_PART}){{3}}$'",
    "card": "length({d}) between 13 and 19 and " + _LUHN,
    "phone": "length({d}) between 9 and 15",
}
_FOUND = "array<struct<kind:string,start:int,end:int>>"
_VALUED = "array<struct<kind:string,start:int,end:int,value:string>>"


def _let(name: str, value: str, body: str) -> str:
    """SQL for a body in which a name stands for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _running(items: str, value: str, add: str) -> str:
    """SQL for (x, before) of every item x, where before sums up the values of all items ahead of it, 0 at first.

    Arrays grow by copies, so sums run within blocks and then over the blocks.
    """
    step = lambda acc, new: add.replace("{a}", acc).replace("{b}", new)
    kept = "transform(slice(items, 1, 0), x -> struct(x as x, 0 as before))"  # no item, with the type of all
    within = (
        f"transform(sequence(0, int((size(items) - 1) div {BLOCK})), b -> aggregate(slice(items, b * {BLOCK} + 1, {BLOCK}), struct(0 as acc, {kept} as done), "
        f"(a, x) -> struct({step('a.acc', value)} as acc, concat(a.done, array(struct(x as x, a.acc as before))) as done)))"
    )
    ahead = f"aggregate(blocks, struct(0 as acc, cast(array() as array<int>) as done), (a, b) -> struct({step('a.acc', 'b.acc')} as acc, concat(a.done, array(a.acc)) as done), a -> a.done)"
    joined = f"flatten(zip_with(blocks, {ahead}, (b, o) -> transform(b.done, e -> struct(e.x as x, {step('o', 'e.before')} as before))))"
    return _let("items", items, f"if(size(items) = 0, {kept}, {_let('blocks', within, joined)})")


def _placed(text: str, pattern: str, kind: str, test: str) -> str:
    """SQL for the places of a pattern's matches that pass a test, in order."""
    each = f"zip_with(split({text}, r'{pattern}', -1), regexp_extract_all({text}, r'{pattern}', 0), (gap, m) -> struct(length(gap) as gap, m as m))"
    placed = _running(each, "(x.gap + coalesce(length(x.m), 0))", "({a} + {b})")
    return f"transform(filter({placed}, e -> e.x.m is not null and {test}), e -> struct('{kind}' as kind, e.before + e.x.gap as start, e.before + e.x.gap + length(e.x.m) as end, e.x.m as value))"


def _rebuilt(text: str, ordered: str, replacement: str, between: str) -> str:
    """SQL for the text with each of the spans s, ordered by start, replaced; one that starts within another is part of it."""
    piece = (
        f"array_join(transform(if({{b}} > {{a}}, sequence(int({{a}} div {PIECE}), int(({{b}} - 1) div {PIECE})), cast(array() as array<int>)), "
        f"j -> substring(element_at(pieces, j + 1), greatest({{a}} - j * {PIECE}, 0) + 1, least({{b}} - j * {PIECE}, {PIECE}) - greatest({{a}} - j * {PIECE}, 0))), '')"
    )
    one = piece.replace("{a}", "e.before").replace("{b}", "s.start")
    parts = f"transform(cuts, e -> {_let('s', 'e.x', f'if(s.start >= e.before, concat({one}, {replacement}), {between})')})"
    last = piece.replace("{a}", "greatest(element_at(cuts, -1).before, element_at(cuts, -1).x.end)").replace("{b}", f"length({text})")
    body = f"if(size(cuts) = 0, {text}, concat(array_join({parts}, ''), {last}))"
    return _let("pieces", f"regexp_extract_all({text}, r'(?s).{{1,{PIECE}}}', 0)", _let("cuts", _running(ordered, "x.end", "greatest({a}, {b})"), body))


def base_found(text: str) -> Column:
    """The base findings in the text column, by kind and start, as (kind, start, end, value); places are code points."""
    parts = []
    for kind in KINDS:
        test = _TESTS[kind].replace("{d}", _DIGITS).replace("{m}", "e.x.m")
        parts.append(f"if({text} rlike r'{_HINTS[kind]}', {_placed(text, PATTERNS[kind], kind, test)}, cast(array() as {_VALUED}))")
    return F.expr(f"concat({', '.join(parts)})")


def _bare(found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def base_spans(text: str) -> Column:
    """The base findings without their values."""
    return _bare(base_found(text))


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("h", F.xxhash64("text"))


def find_base(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, h (a hash of the text), spans and entities of every row; the text itself is left behind."""
    rows = _slim(docs, id_col, text_col).withColumn("found", base_found("text"))
    named = "array_distinct(transform(found, m -> concat(m.kind, ':', if(m.kind in ('card', 'phone'), regexp_replace(m.value, '[^0-9]', ''), lower(m.value)))))"
    return rows.select("doc_id", "h", _bare(F.col("found")).alias("spans"), F.expr(named).alias("entities"))


def _terms(text: str) -> Column:
    return F.explode(F.array_distinct(F.transform(F.regexp_extract_all(F.col(text), F.lit(TERM), F.lit(0)), F.lower))).alias("term")


def _written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table whose size the planner sees: it is sent to the documents or they are dealt out."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _disclosure(both: Column, support: Column, n_term: Column, n_entity: Column, is_class: Column, n: int) -> Column:
    """Null where the entity stands in every text."""
    pmi = F.log2(both * F.lit(float(n)) / (n_term.cast("double") * n_entity))
    return F.try_divide(pmi, F.log2(F.lit(float(n)) / n_entity)) * support / (support + F.when(is_class, CLASS_PRIOR).otherwise(PRIOR))


def protected(base: DataFrame) -> DataFrame:
    """(h, entity, is_class, proof) of the values in every text, of their kinds, and of personal data as such.

    proof is what the text counts as evidence: one for a value, and for a class an equal share of one among all
    texts with the same values.
    """
    some = base.where("size(entities) > 0").select("h", "entities").distinct()
    values = some.select("h", F.explode("entities").alias("entity"), F.lit(False).alias("is_class"), F.lit(1.0).alias("proof"))
    kinds = F.array_union(F.array_distinct(F.transform("entities", lambda e: F.split_part(e, F.lit(":"), F.lit(1)))), F.array(F.lit(ANY)))
    signed = some.select("h", kinds.alias("kinds"), F.xxhash64(F.array_sort("entities")).alias("s"))
    alike = _written(signed.groupBy("s").agg(F.count("*").alias("n")).where("n > 1"), "pii-alike")
    classes = signed.join(alike, "s", "left").select("h", F.explode("kinds").alias("entity"), F.lit(True).alias("is_class"), (F.lit(1.0) / F.coalesce("n", F.lit(1))).alias("proof"))
    return values.unionByName(classes)


def telling_terms(rows: DataFrame, base: DataFrame, generalise: float = GENERALISE) -> tuple[DataFrame, DataFrame]:
    """(h, term, disclosure) of the terms that disclose too much of an entity in the text h, and (h, text) of what may hold some."""
    counts = base.groupBy("h").agg(F.count("*").alias("copies"))
    n = max(1, counts.count())
    copies = _written(counts.where("copies > 1"), "pii-copies")
    # the greatest disclosure that the counts allow: as many texts hold both as hold the rarer one
    within = lambda n_term, n_entity, c: _disclosure(F.least(n_term, n_entity).cast("double"), F.least(n_term, n_entity), n_term, n_entity, c, n) >= generalise
    both = cut(protected(base))
    values, classes = both.where("not is_class"), both.where("is_class")
    n_value = _written(values.groupBy("entity").agg(F.count("*").alias("n_entity")).where(within(F.col("n_entity"), F.col("n_entity"), F.lit(False))), "pii-values")
    n_class = {r["entity"]: r["count"] for r in classes.groupBy("entity").count().collect()}  # a row a kind
    sizes = F.create_map(*(F.lit(x) for item in n_class.items() for x in item)) if n_class else F.lit(None).cast("map<string,bigint>")
    held = cut(values.join(n_value, "entity").unionByName(classes.withColumn("n_entity", sizes[F.col("entity")]).where(within(F.col("n_entity"), F.col("n_entity"), F.lit(True)))))
    best = {False: n_value.agg(F.max("n_entity")).first()[0] or 0, True: max(n_class.values(), default=0)}
    holders = _written(held.select("h").distinct(), "pii-holders")
    # each copy of a text counts its share of one
    share = F.lit(1.0) / F.coalesce("copies", F.lit(1))
    n_term = rows.join(copies, "h", "left").select(_terms("text"), share.alias("share")).groupBy("term").agg(F.round(F.sum("share")).cast("long").alias("n_term"))
    able = [within(F.col("n_term"), F.lit(top), F.lit(c)) | (F.col("n_term") <= top) & within(F.col("n_term"), F.col("n_term"), F.lit(c)) for c, top in best.items() if top]
    n_term = n_term.where(able[0] | able[-1] if able else F.lit(False))
    texts = cut(rows.join(holders, "h", "left_semi").groupBy("h").agg(F.first("text").alias("text")))
    spans = texts.withColumn("spans", base_spans("text"))
    bare = spans.select("h", F.expr(_rebuilt("text", "array_sort(transform(spans, s -> struct(s.start as start, s.end as end)))", "' '", "''")).alias("text"))
    words = bare.select("h", _terms("text"))
    met = words.join(n_term, "term").join(held, "h").where(within(F.col("n_term"), F.col("n_entity"), F.col("is_class")))
    joint = met.groupBy("entity", "term").agg(
        F.count("*").cast("double").alias("both"), F.round(F.sum("proof"), 9).alias("support"), F.first("n_term").alias("n_term"), F.first("n_entity").alias("n_entity"), F.first("is_class").alias("is_class")
    )
    told = joint.withColumn("disclosure", _disclosure(F.col("both"), F.col("support"), F.col("n_term"), F.col("n_entity"), F.col("is_class"), n)).where(F.col("disclosure") >= generalise)
    told = _written(told.select("entity", "term", "disclosure"), "pii-told")
    return words.join(told, "term").join(held.select("h", "entity"), ["h", "entity"]).groupBy("h", "term").agg(F.max("disclosure").alias("disclosure")), texts


def term_spans(docs: DataFrame, base: DataFrame, text_col: str = "text", generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """Per text that holds telling terms: t_h and all their places (kind term, or removed), in order."""
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    told, texts = telling_terms(rows, base, generalise)
    told = cut(told)
    some = texts.join(told.select("h").distinct(), "h", "left_semi")
    pieces = F.arrays_zip(F.split("text", TERM, -1).alias("gap"), F.regexp_extract_all("text", F.lit(TERM), F.lit(0)).alias("word"))
    each = some.select("h", F.posexplode(pieces).alias("pos", "x")).select("h", "pos", F.col("x.gap").alias("gap"), F.col("x.word").alias("word"))
    ends = F.sum(F.length("gap") + F.length("word")).over(Window.partitionBy("h").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    placed = each.where("word is not null").select("h", "word", ends.cast("int").alias("end"))
    placed = placed.select("h", F.lower("word").alias("term"), (F.col("end") - F.length("word")).alias("start"), "end").join(told, ["h", "term"])
    spans = base.where("size(spans) > 0").groupBy("h").agg(F.first("spans").alias("spans"))
    places = placed.join(spans, "h").where(F.expr("not exists(spans, s -> start < s.end and end > s.start)"))
    kind = F.when(F.col("disclosure") >= remove, "removed").otherwise("term")
    span = F.struct(kind.alias("kind"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    grouped = places.groupBy("h").agg(F.sort_array(F.collect_list(F.struct("start", span.alias("s")))).alias("found"))
    return _written(grouped.select(F.col("h").alias("t_h"), F.transform("found", lambda x: x["s"]).alias("terms")), "pii-terms")


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """doc_id, the number of base findings of each kind, base_sha256, spans and n_terms of every row."""
    base = cut(find_base(docs, id_col, text_col))
    terms = term_spans(docs, base, text_col, **limits)
    both = base.join(terms, base["h"] == terms["t_h"], "left")
    count = [F.expr(f"size(filter(spans, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in KINDS]
    every = F.expr(f"concat(spans, coalesce(terms, cast(array() as {_FOUND})))")
    return both.withColumn("every", every).select("doc_id", *count, F.sha2(_joined("spans"), 256).alias("base_sha256"), _joined("every").alias("spans"), F.coalesce(F.size("terms"), F.lit(0)).cast("long").alias("n_terms"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """The rows with findings replaced by their kind in brackets and removed terms left out; null texts stay null."""
    base = cut(find_base(docs, id_col, text_col))
    terms = term_spans(docs, base, text_col, **limits)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("row"), text.alias("text")).withColumn("h", F.xxhash64("text"))
    rows = rows.join(terms, F.col("h") == F.col("t_h"), "left").withColumn("spans", base_spans("text"))
    ordered = f"array_sort(transform(concat(spans, coalesce(terms, cast(array() as {_FOUND}))), s -> struct(s.start as start, s.end as end, s.kind as kind)))"
    built = F.expr(_rebuilt("text", ordered, "if(s.kind = 'removed', '', concat('[', upper(s.kind), ']'))", "''"))
    changed = F.when(F.col("row")[text_col].isNull(), F.lit(None)).when((F.size("spans") == 0) & F.col("terms").isNull(), F.col("text")).otherwise(built)
    return rows.select(*(changed.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
