"""Resolution of pointers by scoped lookups: joins with label, item and division indexes.

Every pointer gets a status, a scope rule, a target and scored candidates. Deterministic
outcomes carry no confidence. An index keeps the first of a key in document order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexweave.functions import ids
from lexweave.functions.text import title_form
from lexweave.operators.tree import closure, part_of

# Candidate scores, scope rules, the part of core terms, the stems of schedule families.
STIPULATED, LOCAL, HELD, CONVENTIONAL, TITLED, REGISTERED, FAMILY_HINT, ANCESTOR = 0.60, 0.40, 0.90, 0.50, 0.95, 0.90, 0.05, 0.40
CLAUSE_RULE, PARAGRAPH_RULE = "js1_1.3.8", "js1_1.3.9"
CORE = "core-terms"
FAMILIES = {"framework": "framework-schedule", "joint": "joint-schedule", "call-off": "call-off-schedule"}
SUB_PART, DIVISION = r"^\s*Part\s+[A-Z0-9]+\b", r"(?i)\b(Annex|Appendix|Part|Table)\s+([A-Z0-9]+)\b"
CANDIDATES = "array<struct<path:string,score:double,reason:string>>"
TOP = 5
ROUNDING = 0.00006  # by which similarities of four places may be rounded up


def _first(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy("ord", "path"))).where("__n = 1").drop("__n")


def namespaces(nodes: DataFrame) -> DataFrame:
    """(path, ns): the deepest drafter-named sub-part that holds each node, or ''."""
    named = nodes.where(F.col("kind").isin("heading", "part") & F.col("title").rlike(SUB_PART) & F.col("parent_path").isNotNull()).select(F.col("path").alias("top"))
    inner = closure(nodes).join(named, "top").groupBy("path").agg(F.max_by("top", F.length("top")).alias("ns"))
    return nodes.select("path").join(inner, "path", "left").select("path", F.coalesce("ns", F.lit("")).alias("ns"))


def label_index(nodes: DataFrame) -> DataFrame:
    """(part, ns, label, path), and once more with ns '*' for the whole part."""
    own = nodes.where(F.col("label").isNotNull() & ~F.col("kind").isin("part", "ref", "item", "cell")).join(namespaces(nodes), "path")
    rows = own.select(part_of("path").alias("part"), F.explode(F.array("ns", F.lit("*"))).alias("ns"), F.regexp_replace("label", r"\.$", "").alias("label"), "path", "ord")
    return _first(rows, "part", "ns", "label").drop("ord")


def item_index(nodes: DataFrame) -> DataFrame:
    rows = nodes.where("kind = 'item' and label is not null").select("parent_path", F.regexp_replace("label", r"[()\s]", "").alias("letter"), "path", "ord")
    return _first(rows, "parent_path", "letter").drop("ord")


def division_index(nodes: DataFrame) -> DataFrame:
    """(part, ns, division, path) of annexes, parts and tables that a title names."""
    own = nodes.where("title is not null and parent_path is not null").join(namespaces(nodes), "path")
    spots = own.select(part_of("path").alias("part"), "ns", "path", "ord", F.explode(F.regexp_extract_all("title", F.lit(DIVISION), F.lit(0))).alias("division"))
    rows = spots.select("part", F.explode(F.array("ns", F.lit("*"))).alias("ns"), F.lower(F.regexp_replace("division", r"\s+", " ")).alias("division"), "path", "ord")
    return _first(rows, "part", "ns", "division").drop("ord")


def title_matches(nodes: DataFrame, pointers: DataFrame) -> DataFrame:
    """(title_key, title_part): the one part whose title is, holds or ends with a cited title; parts are few."""
    parts = nodes.where("kind = 'part'").select(F.col("path").alias("title_part"), title_form("title").alias("t"))
    cited = pointers.where("title_paren is not null").select(title_form("title_paren").alias("title_key")).distinct()
    hits = cited.join(parts, (F.col("t") == F.col("title_key")) | F.col("t").contains(F.col("title_key")))
    return hits.groupBy("title_key").agg(F.count("*").alias("n"), F.min("title_part").alias("title_part")).where("n = 1").drop("n")


def _lookup(rows: DataFrame, labels: DataFrame, items: DataFrame, part: str, ns: str | None, out: str) -> DataFrame:
    """Adds out: the path of (part, number), in the own namespace first, then the item under it."""
    whole = labels.where("ns = '*'").select(F.col("part").alias("__p"), F.col("label").alias("__l"), F.col("path").alias("__whole"))
    rows = rows.join(whole, (F.col(part) == F.col("__p")) & (F.col("number") == F.col("__l")), "left").drop("__p", "__l")
    found: Column = F.col("__whole")
    if ns:
        own = labels.select(F.col("part").alias("__p"), F.col("ns").alias("__s"), F.col("label").alias("__l"), F.col("path").alias("__own"))
        rows = rows.join(own, (F.col(part) == F.col("__p")) & (F.col(ns) == F.col("__s")) & (F.col("number") == F.col("__l")), "left").drop("__p", "__s", "__l")
        found = F.coalesce("__own", "__whole")
    rows = rows.withColumn("__base", found).drop("__whole", "__own")
    under = items.select(F.col("parent_path").alias("__u"), F.col("letter").alias("__i"), F.col("path").alias("__item"))
    rows = rows.join(under, (F.col("__base") == F.col("__u")) & (F.col("item") == F.col("__i")), "left")
    return rows.withColumn(out, F.when(F.col("item").isNull(), F.col("__base")).otherwise(F.col("__item"))).drop("__u", "__i", "__item", "__base")


def _candidate(path: Column, score: float | Column, reason: str) -> Column:
    return F.struct(path.alias("path"), (F.lit(score) if isinstance(score, float) else score).cast("double").alias("score"), F.lit(reason).alias("reason"))


def _candidates(*found: Column) -> Column:
    kept = F.filter(F.array(*found), lambda c: c["path"].isNotNull())
    ordered = F.transform(F.array_sort(F.transform(kept, lambda c: F.struct((-c["score"]).alias("s"), c["path"].alias("path"), c["score"].alias("score"), c["reason"].alias("reason")))), lambda c: F.struct(c["path"].alias("path"), c["score"].alias("score"), c["reason"].alias("reason")))
    return F.slice(ordered, 1, TOP).cast(CANDIDATES)


def _outcome(status: str, scope: str | Column, target: Column | None, candidates: Column | None, resolver: str = "scope") -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(status).alias("status"), (scope if isinstance(scope, Column) else F.lit(scope)).alias("scope_rule"), (none if target is None else target).alias("target_path"), (F.array().cast(CANDIDATES) if candidates is None else candidates).alias("candidates"), F.lit(resolver).alias("resolver"))


def resolve(nodes: DataFrame, pointers: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """The pointers with status, scope_rule, target_path, candidates and resolver.

    registry (part_id, title) names parts that are known but not held.
    """
    labels, items, divisions = label_index(nodes), item_index(nodes), division_index(nodes)
    parts = nodes.where("kind = 'part'").select(F.col("path").alias("part"), F.col("part_family").alias("family_of_part"))
    known_parts = parts.select(F.col("part").alias("__k")).distinct()

    def with_held(rows: DataFrame, path: Column, name: str) -> DataFrame:
        """Whether a part of this path is held, by an equality join."""
        return rows.withColumn("__k", path).join(known_parts.withColumn(name, F.lit(True)), "__k", "left").withColumn(name, F.coalesce(name, F.lit(False))).drop("__k")

    stems = F.create_map(*(F.lit(x) for pair in FAMILIES.items() for x in pair))
    stem = lambda c: stems[F.regexp_replace(F.regexp_replace(F.lower(c), r"[\s-]+", "-"), "^calloff$", "call-off")]
    place = lambda s, n: F.concat_ws("-", s, F.replace(n, F.lit("."), F.lit("-")))
    spaces = namespaces(nodes).select(F.col("path").alias("parent_path"), "ns")
    p = pointers.join(spaces, "parent_path", "left").join(parts, "part", "left")
    is_core = (F.col("part") == CORE) | (F.col("family_of_part") == "core_terms")
    is_schedule = F.coalesce(F.col("family_of_part").contains("schedule"), F.lit(False)) | F.col("part").contains("schedule")
    context = F.when(F.col("ctx_unit").startswith("schedule") & F.col("ctx_family").isNotNull() & F.col("ctx_number").isNotNull(), place(stem(F.col("ctx_family")), F.col("ctx_number"))).when(F.col("ctx_unit").startswith("schedule") & F.col("ctx_this") & is_schedule, F.col("part")).when(F.col("ctx_unit") == "core terms", F.lit(CORE))
    p = p.withColumn("ctx_part", context)
    p = p.withColumn("want", F.when(F.col("ref_kind") == "clause", F.coalesce("ctx_part", F.lit(CORE))).when(F.col("ref_kind") == "paragraph", F.coalesce(F.col("ctx_part"), F.when(is_schedule, F.col("part")))).when(F.col("ref_kind").isin("annex", "part"), F.coalesce("ctx_part", "part")))
    p = p.withColumn("want_ns", F.when(F.col("want") == F.col("part"), F.col("ns")))
    p = _lookup(p, labels, items, "want", "want_ns", "there")
    p = _lookup(p, labels, items, "part", "ns", "here")
    own = divisions.select(F.col("part").alias("__p"), F.col("ns").alias("__s"), F.col("division").alias("__d"), F.col("path").alias("__own_div"))
    whole = own.where("__s = '*'").select(F.col("__p").alias("__q"), F.col("__d").alias("__e"), F.col("__own_div").alias("__any_div"))
    name = F.concat_ws(" ", F.when(F.lower("unit").startswith("annex"), "annex").otherwise(F.regexp_replace(F.lower("unit"), "s$", "")), F.lower("number"))
    p = p.withColumn("division", name).join(own, (F.col("want") == F.col("__p")) & (F.col("want_ns") == F.col("__s")) & (F.col("division") == F.col("__d")), "left").join(whole, (F.col("want") == F.col("__q")) & (F.col("division") == F.col("__e")), "left")
    p = p.withColumn("div_path", F.coalesce("__own_div", "__any_div")).drop("__p", "__s", "__d", "__q", "__e", "__own_div", "__any_div")
    p = p.withColumn("title_key", title_form("title_paren")).join(title_matches(nodes, pointers), "title_key", "left")
    # the deepest existing dotted prefix of a number that is not there
    cut = F.split("number", r"\.")
    tries = p.select("want", "number").where("number is not null and want is not null").distinct().select("want", "number", F.posexplode(F.transform(F.sequence(F.lit(1), F.size(cut)), lambda i: F.array_join(F.slice(cut, F.lit(1), i), "."))).alias("k", "prefix")).where("prefix <> number")
    up = tries.join(labels.where("ns = '*'").select(F.col("part").alias("want"), F.col("label").alias("prefix"), F.col("path").alias("up_path")), ["want", "prefix"]).groupBy("want", "number").agg(F.max_by("up_path", "k").alias("up_path"))
    p = p.join(up, ["want", "number"], "left")
    named = F.when(F.col("family").isNotNull(), place(stem(F.col("family")), F.col("number")))
    p = with_held(with_held(p, F.col("want"), "held_want"), named, "held_named")
    for i, s in enumerate(FAMILIES.values()):
        p = with_held(p, place(F.lit(s), F.col("number")), f"held_{i}")
    local = F.when((F.col("want") != F.col("part")) & ~is_core, F.col("here"))
    clause = (
        F.when(F.col("there").isNotNull() & local.isNotNull(), _outcome("ambiguous", CLAUSE_RULE, F.col("there"), _candidates(_candidate(F.col("there"), STIPULATED, "the stipulated reading"), _candidate(local, LOCAL, "the local provision of the same number"))))
        .when(F.col("there").isNotNull(), _outcome("resolved", CLAUSE_RULE, F.col("there"), None))
        .when(~F.col("held_want"), _outcome("unresolved", CLAUSE_RULE, None, _candidates(_candidate(F.col("want"), CONVENTIONAL, "the part is not held"))))
        .otherwise(_outcome("unresolved", CLAUSE_RULE, None, _candidates(_candidate(F.col("up_path"), ANCESTOR, "deepest numbered ancestor"), _candidate(local, LOCAL, "a provision of that number in the citing part"))))
    )
    titled = F.when(F.col("title_paren").isNotNull(), "title_paren")
    bare = [(place(F.lit(s), F.col("number")), F.when(F.col(f"held_{i}"), HELD).otherwise(CONVENTIONAL) + F.when(F.replace(F.col("family_of_part"), F.lit("_"), F.lit("-")) == s, FAMILY_HINT).otherwise(0.0)) for i, s in enumerate(FAMILIES.values())]
    if registry is not None:
        known = registry.select(F.col("part_id").alias("reg_part"), title_form("title").alias("reg_title"), F.element_at(F.split("part_id", "-"), -1).alias("number"))
        asked = p.where("title_key is not null").select("title_key", "number").distinct()
        hits = asked.join(known, "number").where(F.col("reg_title").contains(F.col("title_key")) & (F.col("reg_part") != F.col("number"))).groupBy("title_key", "number").agg(F.count("*").alias("n_reg"), F.min("reg_part").alias("reg_part")).where("n_reg = 1")
        p = p.join(hits, ["title_key", "number"], "left")
    else:
        p = p.withColumn("reg_part", F.lit(None).cast("string"))
    p = with_held(p, F.col("reg_part"), "held_reg")
    schedule = (
        F.when(F.col("title_part").isNotNull(), _outcome("resolved", "title_paren", F.col("title_part"), None))
        .when(named.isNotNull() & F.col("held_named"), _outcome("resolved", F.coalesce(titled, F.lit(CLAUSE_RULE)), named, None))
        .when(named.isNotNull(), _outcome("unresolved", F.coalesce(titled, F.lit(CLAUSE_RULE)), None, _candidates(_candidate(named, TITLED, "the family is named; the part is not held"))))
        .when(F.col("reg_part").isNotNull() & ~F.col("held_reg"), _outcome("unresolved", "title_paren", None, _candidates(_candidate(F.col("reg_part"), REGISTERED, "the title is known; the part is not held"))))
        .otherwise(_outcome("ambiguous", F.coalesce(titled, F.lit("none")), None, _candidates(*(_candidate(path, F.least(score, F.lit(1.0)), "a bare number: every family may use it") for path, score in bare))))
    )
    paragraph = (
        F.when(F.col("want").isNull(), _outcome("ambiguous", PARAGRAPH_RULE, None, _candidates(_candidate(F.col("here"), LOCAL, "a provision of that number in the citing part"))))
        .when(~F.col("held_want"), _outcome("unresolved", PARAGRAPH_RULE, None, _candidates(_candidate(F.col("want"), CONVENTIONAL, "the schedule is not held"))))
        .when(F.col("there").isNotNull(), _outcome("resolved", PARAGRAPH_RULE, F.col("there"), None))
        .otherwise(_outcome("unresolved", PARAGRAPH_RULE, None, _candidates(_candidate(F.col("up_path"), ANCESTOR, "deepest numbered ancestor"))))
    )
    inside = F.when(is_schedule, CLAUSE_RULE).otherwise("same_part")
    within = (
        F.when(~F.col("held_want"), _outcome("unresolved", inside, None, _candidates(_candidate(F.col("want"), CONVENTIONAL, "the part is not held"))))
        .when(F.coalesce("div_path", "there").isNotNull(), _outcome("resolved", inside, F.coalesce("div_path", "there"), None))
        .otherwise(_outcome("unresolved", inside, None, None))
    )
    key = ids.legislation_key("leg_title", "leg_year", "leg_kind", "provision")
    law = F.when(F.col("leg_title").isNull(), _outcome("unresolved", "none", None, None)).otherwise(_outcome("external", "none", key, None, "grammar"))
    numbered = F.col("number").isNotNull()
    outcome = (
        F.when(F.col("ref_kind") == "legislation", law)
        .when(F.col("anaphoric"), _outcome("ambiguous", "none", None, _candidates(_candidate(F.col("part"), HELD, "the enclosing part"))))
        .when(numbered & (F.col("ref_kind") == "clause"), clause)
        .when(numbered & (F.col("ref_kind") == "schedule"), schedule)
        .when(numbered & (F.col("ref_kind") == "paragraph"), paragraph)
        .when(numbered & F.col("ref_kind").isin("annex", "part"), within)
        .otherwise(_outcome("unresolved", "none", None, None))
    )
    return p.withColumn("r", outcome).select(*pointers.columns, "ns", "r.*")


def references(nodes: DataFrame, resolved: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Reference rows: equal targets of one span kept once, others told apart by an ordinal, text checked against its parent."""
    keyed = resolved.select("*", F.coalesce("target_path", "number", "surface").alias("__t"))
    once = keyed.withColumn("__d", F.row_number().over(Window.partitionBy("parent_path", "start", "end", "__t", "ref_kind").orderBy("member"))).where("__d = 1")
    nth = F.row_number().over(Window.partitionBy("parent_path", "start", "end").orderBy("member", "__t")) - 1
    first = F.min("start").over(Window.partitionBy("parent_path", "phrase_start"))
    rows = once.withColumn("n", nth).withColumn("path", ids.ref_path("parent_path", "start", "end", "n"))
    group = F.when(F.col("members") > 1, F.concat_ws("-", F.lit("g"), "part", F.col("parent_path"), first.cast("string")))
    parents = nodes.select(F.col("path").alias("parent_path"), "document", "version", F.col("text").alias("__text"))
    checked = rows.join(parents, "parent_path", "left").withColumn("span_ok", F.expr("substring(__text, start + 1, end - start) = surface"))
    return checked.select(
        ids.node_id("document", "version", "path").alias("id"), "path", "parent_path", "part", F.col("surface").alias("text"), F.struct("start", "end").alias("char_span"), group.alias("group_id"),
        "ref_kind", "scope_rule", "status", "target_path", "candidates", F.lit(None).cast("double").alias("confidence"), "resolver", F.lit(batch_id).cast("string").alias("batch_id"), "span_ok",
    )


def crossings(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Resolved references whose target lies in another sub-part than they do."""
    ns = namespaces(nodes)
    a, b = ns.select(F.col("path").alias("parent_path"), F.col("ns").alias("from_ns")), ns.select(F.col("path").alias("target_path"), F.col("ns").alias("to_ns"))
    same = refs.where(F.col("target_path").isNotNull() & (part_of("target_path") == F.col("part")))
    return same.join(a, "parent_path").join(b, "target_path").where("from_ns <> '' and from_ns <> to_ns").select("path", "from_ns", "to_ns", "target_path")


def infer_identity(nodes: DataFrame, documents: list[str], versions: list[str]) -> DataFrame:
    """(document, version, n): the given names that reproduce most of the ids, best first."""
    spark = nodes.sparkSession
    names = spark.createDataFrame([(d, v) for d in documents for v in versions], "d string, v string")
    tried = nodes.crossJoin(F.broadcast(names)).where(ids.node_id("d", "v", "path") == F.col("id"))
    return tried.groupBy(F.col("d").alias("document"), F.col("v").alias("version")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "document", "version").limit(1)


def residue(refs: DataFrame) -> DataFrame:
    """References left to a later chooser: ambiguous ones, and unresolved ones with candidates."""
    return refs.where("status = 'ambiguous' or (status = 'unresolved' and size(candidates) > 0)")


def apply_choices(refs: DataFrame, choices: DataFrame, held: DataFrame) -> DataFrame:
    """choices (path, chosen, confidence) taken where chosen is a candidate: held targets resolve, others gain 0.05."""
    c = choices.select(F.col("path").alias("__path"), "chosen", F.col("confidence").alias("__conf"))
    h = held.select(F.col("path").alias("__held")).distinct()
    rows = refs.join(c, F.col("path") == F.col("__path"), "left").join(h, F.col("chosen") == F.col("__held"), "left")
    valid = F.col("chosen").isNotNull() & F.exists("candidates", lambda x: x["path"] == F.col("chosen"))
    lands = valid & F.col("__held").isNotNull()
    raised = F.transform("candidates", lambda x: F.struct(x["path"].alias("path"), F.when(x["path"] == F.col("chosen"), F.least(x["score"] + 0.05, F.lit(1.0))).otherwise(x["score"]).alias("score"), x["reason"].alias("reason")))
    return rows.withColumns({"status": F.when(lands, "resolved").when(valid, "unresolved").otherwise(F.col("status")), "target_path": F.when(lands, F.col("chosen")).otherwise(F.col("target_path")), "confidence": F.when(lands, F.col("__conf")).otherwise(F.col("confidence")), "resolver": F.when(lands, "llm").otherwise(F.col("resolver")), "candidates": F.when(valid & ~lands, raised).otherwise(F.col("candidates"))}).select(*refs.columns)


def transitions(before: DataFrame, now: DataFrame) -> DataFrame:
    """(before, now, n) over (path, status) snapshots; a side that is missing is (new) or (gone)."""
    b, n = before.select("path", F.col("status").alias("b")), now.select("path", F.col("status").alias("a"))
    both = b.join(n, "path", "full_outer")
    return both.groupBy(F.coalesce("b", F.lit("(new)")).alias("before"), F.coalesce("a", F.lit("(gone)")).alias("now")).agg(F.count("*").alias("n"))


def status_counts(refs: DataFrame) -> DataFrame:
    """Counts by status, kind, resolver, scope, and kind with status, in one pass."""
    refs.createOrReplaceTempView("__lexweave_refs")
    return refs.sparkSession.sql("SELECT status, ref_kind, resolver, scope_rule, count(*) AS n FROM __lexweave_refs GROUP BY GROUPING SETS ((status), (ref_kind), (resolver), (scope_rule), (ref_kind, status), ())")


def near_miss_keys(keys: DataFrame, threshold: float = 0.86) -> DataFrame:
    """Pairs of statute keys whose similarity, rounded to four places, reaches the threshold.

    Where both lengths together allow one character of difference, the shorter key is the longer one with a character
    left out, and they meet on that by equality. Longer pairs meet by length classes and a bounded edit distance, which is
    at most the characters that differ; these are as many as the pairs of keys of like length.
    """
    from lexweave.functions.fuzzy import similarity

    apart = 1 - threshold + ROUNDING  # the share of both lengths that may differ
    least = (1 - apart) / (1 + apart)  # of the shorter to the longer length, at this ratio
    two = 2 / apart  # both lengths from which two characters may differ
    one = keys.select(F.col("key").alias("a"), F.length("key").alias("la")).distinct()
    without = F.transform(F.sequence(F.lit(1), F.col("la")), lambda i: F.concat(F.left("a", i - 1), F.substr("a", i + 1)))
    cuts = one.where((F.col("la") > 0) & (2 * F.col("la") - 1 < two)).select(F.col("a").alias("longer"), F.explode(F.array_distinct(without)).alias("a"))
    near = one.select("a").join(cuts.hint("merge"), "a").select(F.least("a", "longer").alias("a"), F.greatest("a", "longer").alias("b"))
    # lengths fall in classes whose width is the ratio, so that partners are in the same or the next class
    size = lambda c: F.floor(F.log(F.col(c).cast("double")) / F.lit(-math.log(least)))
    long = one.where(F.col("la") * (1 + 1 / least) >= two)
    left = long.withColumn("k", size("la")).withColumn("c", F.explode(F.array(F.col("k"), F.col("k") + 1, F.col("k") - 1)))
    right = long.select(F.col("a").alias("b"), F.col("la").alias("lb"), size("la").alias("c"))
    both = F.col("la") + F.col("lb")
    close = left.join(right, "c").where((F.col("a") < F.col("b")) & (both >= two) & (F.least("la", "lb") >= F.greatest("la", "lb") * least)).where(F.expr(f"levenshtein(a, b, int(floor((la + lb) * {apart!r}D))) >= 0"))
    pairs = near.unionByName(close.select("a", "b"))
    return pairs.withColumn("similarity", F.round(similarity("a", "b") / 100, 4)).where(F.col("similarity") >= threshold).select("a", "b", "similarity")
