"""Structural checks, scoring against labels, deterministic sampling, calibration, gates."""

from __future__ import annotations

import hashlib
import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexweave.functions import text as tx
from lexweave.functions.ids import content_hash
from lexweave.operators.layout import upper_median
from lexweave.operators.tree import closure, extents, part_of

# Tolerances, costs, gates, caps.
INDENT, VERTICAL, OVERLAP, MAD_LIMIT, MIN_GROUPS = 2.0, 1.0, 0.2, 3.5, 4
SYSTEMATIC_SHARE, SYSTEMATIC_LEAST = 0.8, 3
COSTS = {"false_positive": 1.0, "false_negative": 3.0}
GATES = {"reference_precision_min": (">=", 0.90), "wrongly_resolved_unresolvables_max": ("<=", 0.0), "structural_violations_unexplained_max": ("<=", 0.0), "detection_recall_min": (">=", 0.95), "stratified_audit_agreement_min": (">=", 0.90)}
CAP, OVERCONFIDENT, OUTLINE_AGREE, DUPLICATE = 25, 0.10, 85.0, 90.0
ROUND_TRIP, NEAR_KEY = 0.9, 0.9


def rate(count: Column | str, of: Column | str) -> Column:
    """A share that is null, not 0, over nothing."""
    c, o = (F.col(x) if isinstance(x, str) else x for x in (count, of))
    return F.try_divide(c, o)


def boxes_by_page(nodes: DataFrame, own: bool = True) -> DataFrame:
    """(path, page, x0, y0, x1, y1): the union of a node's own boxes a page, or of its extent where it has none."""
    first, other = ("bboxes_own", "bboxes_extent") if own else ("bboxes_extent", "bboxes_own")
    have = F.when(F.size(first) > 0, F.col(first)).otherwise(F.col(other))
    return nodes.select("path", F.inline(have)).groupBy("path", "page").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def ordinal(label: Column, roman: Column | bool = False) -> Column:
    """What a sibling counts: the last number of a dotted label, a letter, or a roman numeral where the first sibling is one."""
    bare = F.regexp_replace(label, r"[()\s]|\.$", "")
    last = F.element_at(F.split(bare, r"\."), -1)
    by_letter = F.when(F.lit(roman) if isinstance(roman, bool) else roman, tx.roman_value(last)).otherwise(tx.letter_ordinal(last))
    return F.when(last.rlike("^[0-9]+$"), last.cast("int")).otherwise(by_letter)


def sibling_gaps(nodes: DataFrame) -> DataFrame:
    """(path, before, here): labelled siblings whose ordinal is not the one before plus one."""
    own = Window.partitionBy("parent_path", "kind").orderBy("sib_no", "path")
    rows = nodes.where("label is not null and kind not in ('part', 'ref', 'cell')")
    first = F.regexp_replace(F.first("label").over(own), r"[()\s]", "")
    n = ordinal(F.col("label"), F.lower(first) == "i")
    rows = rows.withColumn("here", n).withColumn("before", F.lag("here").over(own))
    return rows.where("before is not null and here is not null and here <> before + 1").select("path", "before", "here")


def check_tree(nodes: DataFrame) -> DataFrame:
    """(check, path, against, detail) of every broken structural or geometric rule."""
    anatomy = nodes.where("kind <> 'ref'")
    pair = anatomy.alias("c").join(anatomy.alias("p"), F.col("c.parent_path") == F.col("p.path"))
    found = lambda df, check, path="path", against=None, detail="": df.select(F.lit(check).alias("check"), F.col(path).alias("path"), (F.col(against) if against else F.lit(None).cast("string")).alias("against"), F.lit(detail).alias("detail"))
    kids = anatomy.select(F.col("parent_path").alias("path")).where("path is not null").distinct()
    out = [
        found(anatomy.join(kids, "path", "left_semi").where("text is not null"), "branch_or_leaf", detail="children and text"),
        found(nodes.where("kind in ('intro', 'ref') and citable"), "citable_flags"),
        found(nodes.where("text is not null and content_hash is not null").where(content_hash("text") != F.col("content_hash")), "content_hash"),
        found(nodes.where("page_start > page_end"), "page_range", detail="start after end"),
        found(pair.where("c.page_start < p.page_start or c.page_end > p.page_end").select(F.col("c.path").alias("path"), F.col("p.path").alias("against")), "page_range", against="against", detail="outside the parent"),
        found(anatomy.where(F.col("parent_path").isNotNull() & ~F.col("path").startswith(F.concat("parent_path", F.lit("/")))), "path_parent"),
        found(pair.where(F.col("c.label").rlike(r"^\d+(\.\d+)+\.?$") & F.col("p.label").rlike(r"^\d+(\.\d+)*\.?$") & ~F.col("c.label").startswith(F.concat(F.regexp_replace(F.col("p.label"), r"\.$", ""), F.lit(".")))).select(F.col("c.path").alias("path"), F.col("p.path").alias("against")), "label_nesting", against="against"),
        found(sibling_gaps(nodes), "numbering_gap"),
    ]
    order = Window.partitionBy(part_of("path")).orderBy("walk", "path")
    walk = closure(anatomy).join(anatomy.select(F.col("path").alias("top"), "sib_no", F.size(F.split("path", "/")).alias("level")), "top").groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("level", "sib_no"))), lambda x: F.coalesce(x["sib_no"], F.lit(0))).alias("walk"))
    steps = anatomy.join(walk, "path").withColumn("last", F.lag("ord").over(order))
    out.append(found(steps.where("last is not null and ord <= last"), "order_preorder"))
    twice = nodes.select("path", F.inline("bboxes_own")).groupBy("path", "page").agg(F.count("*").alias("n")).where("n > 1")
    out.append(found(twice, "one_box_per_page"))
    out += geometry_checks(nodes)
    result = out[0]
    for df in out[1:]:
        result = result.unionByName(df)
    return result


def geometry_checks(nodes: DataFrame) -> list[DataFrame]:
    """Left edges, first children, reading order, stacking and nesting of boxes, page by page."""
    anatomy = nodes.where("kind <> 'ref'")
    own, whole = boxes_by_page(anatomy), boxes_by_page(anatomy, own=False)
    meta = anatomy.select("path", "parent_path", "sib_no", "kind")
    o = own.join(meta, "path")
    parents = own.select(F.col("path").alias("parent_path"), "page", *(F.col(c).alias(f"p{c}") for c in ("x0", "y0", "x1", "y1")))
    under = o.join(parents, ["parent_path", "page"])
    found = lambda df, check, against="parent_path": df.select(F.lit(check).alias("check"), "path", F.col(against).alias("against"), F.lit("").alias("detail"))
    near = Window.partitionBy("parent_path", "page").orderBy("sib_no", "path")
    sib = o.withColumns({"before": F.lag("path").over(near), "by0": F.lag("y0").over(near), "by1": F.lag("y1").over(near), "bx1": F.lag("x1").over(near), "bx0": F.lag("x0").over(near)}).where("before is not null")
    stacked = (F.col("x0") < F.col("bx1")) & (F.col("bx0") < F.col("x1"))
    slack = F.greatest(F.lit(VERTICAL), F.lit(OVERLAP) * F.least(F.col("y1") - F.col("y0"), F.col("by1") - F.col("by0")))
    first = o.withColumn("n", F.row_number().over(near)).where("n = 1").join(parents, ["parent_path", "page"])
    ext = whole.join(meta, "path").join(whole.select(F.col("path").alias("parent_path"), "page", *(F.col(c).alias(f"p{c}") for c in ("x0", "y0", "x1", "y1"))), ["parent_path", "page"])
    spans = extents(anatomy).select("path", "page", *(F.col(c).alias(f"p{c}") for c in ("x0", "y0", "x1", "y1")))
    cover = anatomy.select("path", F.inline("bboxes_extent")).join(spans, ["path", "page"]).withColumn("against", F.col("path"))
    eps = 0.5
    return [
        found(under.where((F.col("x0") < F.col("px0") - INDENT) & (F.col("kind") != "cell")), "child_left_edge"),
        found(first.where(F.col("py0") > F.col("y0") + VERTICAL), "own_box_above_first_child"),
        found(sib.where((F.col("y0") < F.col("by0") - VERTICAL) & (F.col("kind") != "cell")), "siblings_ascend", "before"),
        found(sib.where(stacked & (F.col("by1") - F.col("y0") > slack) & (F.col("kind") != "cell")), "sibling_overlap", "before"),
        found(ext.where((F.col("x0") < F.col("px0") - eps) | (F.col("y0") < F.col("py0") - eps) | (F.col("x1") > F.col("px1") + eps) | (F.col("y1") > F.col("py1") + eps)), "extent_nests"),
        found(cover.where((F.col("px0") < F.col("x0") - eps) | (F.col("py0") < F.col("y0") - eps) | (F.col("px1") > F.col("x1") + eps) | (F.col("py1") > F.col("y1") + eps)), "extent_covers_own", "against"),
    ]


def box_round_trip(nodes: DataFrame, words: DataFrame, agree: float = ROUND_TRIP) -> DataFrame:
    """(path, status, similarity): whether a node's text is what stands in its own boxes.

    words (page, x0, y0, x1, y1, text) lie in a box that holds their centre; they are read in lines of
    rounded tops from left to right. A node with a box on a page without words cannot be told.
    """
    from lexweave.functions.fuzzy import similarity

    own = nodes.where("text is not null and size(bboxes_own) > 0").select("path", "text", F.posexplode("bboxes_own").alias("nr", "b")).select("path", "text", "nr", F.col("b.page").alias("page"), *(F.col(f"b.{c}").alias(f"b{c}") for c in ("x0", "y0", "x1", "y1")))
    pages = words.select("page").distinct().withColumn("known", F.lit(True))
    mid = words.select("page", F.col("text").alias("word"), ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"), F.round("y0").alias("top"), "x0")
    inside = F.col("cx").between(F.col("bx0"), F.col("bx1")) & F.col("cy").between(F.col("by0"), F.col("by1"))
    hit = own.join(mid, "page").where(inside).groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nr", "top", "x0", "word"))), lambda w: w["word"]), " ").alias("got"))
    lost = own.join(pages, "page", "left_anti").select("path").distinct().withColumn("lost", F.lit(True))
    rows = own.select("path", "text").distinct().join(hit, "path", "left").join(lost, "path", "left")
    score = F.round(similarity(F.coalesce("got", F.lit("")), tx.collapse("text")) / 100, 4)
    rows = rows.withColumn("similarity", F.when(F.col("lost").isNull(), score))
    return rows.select("path", F.when(F.col("lost"), "no_such_page").when(F.col("similarity") >= agree, "agrees").otherwise("differs").alias("status"), "similarity")


def legislation_routing(refs: DataFrame, near: float = NEAR_KEY) -> tuple[DataFrame, DataFrame]:
    """(references, keys, routed, share) of references to statutes, and the pairs of keys that may be misspellings."""
    from lexweave.operators.resolution import near_miss_keys

    own = refs.where("ref_kind = 'legislation'")
    t = own.agg(F.count("*").alias("references"), F.count_distinct("target_path").alias("keys"), F.count_if(F.col("resolver").isin("llm", "human")).alias("routed"))
    pairs = near_miss_keys(own.where("target_path is not null").select(F.col("target_path").alias("key")).distinct(), near)
    return t.withColumn("share", rate("routed", "references")), pairs


def ref_span_integrity(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    parents = nodes.select(F.col("path").alias("parent_path"), F.coalesce("text", "title").alias("own"))
    both = refs.join(parents, "parent_path", "left")
    return both.where(F.col("own").isNull() | (F.substring("own", F.col("char_span.start") + 1, F.col("char_span.end") - F.col("char_span.start")) != F.col("text"))).select(F.lit("ref_span_integrity").alias("check"), "path", F.col("parent_path").alias("against"), F.lit("").alias("detail"))


# Which recorded anomalies may explain a check.
EXPLAINS = {"numbering_gap": ("numbering_gap", "duplicate_number", "recovered_heading"), "siblings_ascend": ("reading_order",), "sibling_overlap": ("overlap",), "child_left_edge": ("indent",), "label_nesting": ("duplicate_number", "label"), "own_box_above_first_child": ("reading_order",)}


def claimed(violations: DataFrame, nodes: DataFrame) -> DataFrame:
    """Violations with the anomaly that explains them, each anomaly used once, in document order.

    Which anomaly is taken depends on the ones before, so a part is one group; parts are small.
    """
    notes = nodes.select(part_of("path").alias("part"), "ord", "path", F.posexplode(F.coalesce("anomalies", F.array().cast("array<string>"))).alias("nr", "note"))
    v = violations.join(nodes.select("path", "ord"), "path", "left").withColumn("part", part_of("path"))
    ddl = "check string, path string, against string, detail string, explained_by string"

    def run(key, vs: pd.DataFrame, ns: pd.DataFrame) -> pd.DataFrame:
        used, out = set(), []
        ns = ns.sort_values(["ord", "nr"])
        for r in vs.sort_values(["ord", "check", "path"]).itertuples():
            hit = None
            for a in ns.itertuples():
                if a.path in (r.path, r.against) and (a.path, a.nr) not in used and a.note.startswith(EXPLAINS.get(r.check, ())):
                    hit = a.note
                    used.add((a.path, a.nr))
                    break
            out.append((r.check, r.path, r.against, r.detail, hit))
        return pd.DataFrame(out, columns=["check", "path", "against", "detail", "explained_by"])

    return v.groupBy("part").cogroup(notes.groupBy("part")).applyInPandas(run, ddl)


def systematic(violations: DataFrame, tested: DataFrame, nodes: DataFrame) -> DataFrame:
    """Violations with systematic true where, for a check and pair of kinds, three or more and 80 per cent of the tested pairs break it."""
    kinds = nodes.select("path", "kind", "parent_path")
    v = violations.join(kinds, "path").join(kinds.select(F.col("path").alias("parent_path"), F.col("kind").alias("parent_kind")), "parent_path")
    n = F.count("*").over(Window.partitionBy("check", "parent_kind", "kind"))
    both = v.withColumn("hits", n).join(tested, ["check", "parent_kind", "kind"], "left")
    return both.withColumn("systematic", (F.col("hits") >= SYSTEMATIC_LEAST) & (F.col("hits") >= SYSTEMATIC_SHARE * F.col("tested")))


def with_ledger(violations: DataFrame, ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Violations with their verified exception, and ledger entries that match nothing."""
    e = ledger.select("check", "path", "reason")
    return violations.join(e, ["check", "path"], "left"), e.join(violations.select("check", "path").distinct(), ["check", "path"], "left_anti")


def mad_outliers(metrics: DataFrame, limit: float = MAD_LIMIT, least: int = MIN_GROUPS) -> DataFrame:
    """(name, part, value, median, mad, z, outlier) of metrics (name, part, value): upper medians, 0.6745 (v - m) / MAD, from four parts on."""
    med = metrics.groupBy("name").agg(upper_median(F.col("value")).alias("median"), F.count("*").alias("n"))
    dev = metrics.join(F.broadcast(med), "name").withColumn("dev", F.abs(F.col("value") - F.col("median")))
    mad = dev.groupBy("name").agg(upper_median(F.col("dev")).alias("mad"))
    rows = dev.join(F.broadcast(mad), "name")
    z = F.when(F.col("mad") > 0, F.round(0.6745 * (F.col("value") - F.col("median")) / F.col("mad"), 6))
    return rows.select("name", "part", "value", "median", "mad", z.alias("z"), ((F.col("n") >= least) & (F.abs(F.coalesce(z, F.lit(0.0))) > limit)).alias("outlier"))


def distributions(nodes: DataFrame) -> DataFrame:
    """(name, part, value): what a part looks like, for outliers among parts."""
    own = nodes.where("kind <> 'ref'").groupBy("part").agg(F.count("*").cast("double").alias("nodes"), F.max("depth").cast("double").alias("depth"), F.avg(F.length("text")).alias("text_length"), F.sum(F.size(F.coalesce("anomalies", F.array().cast("array<string>")))).cast("double").alias("anomalies"))
    return own.selectExpr("part", "stack(4, 'nodes', nodes, 'depth', depth, 'text_length', text_length, 'anomalies', anomalies) as (name, value)").where("value is not null").select("name", "part", "value")


def page_map_diff(found: DataFrame, given: DataFrame) -> DataFrame:
    """(given_id, found_id, how, start_delta, end_delta): by id, else by the only part whose pages overlap."""
    a, b = given.select(F.col("part_id").alias("given_id"), F.col("page_start").alias("gs"), F.col("page_end").alias("ge")), found.select(F.col("part_id").alias("found_id"), F.col("page_start").alias("fs"), F.col("page_end").alias("fe"))
    same = a.join(b, a["given_id"] == b["found_id"]).withColumn("how", F.lit("id"))
    rest, free = a.join(same.select("given_id"), "given_id", "left_anti"), b.join(same.select("found_id"), "found_id", "left_anti")
    page = lambda df, s, e: df.select("*", F.explode(F.sequence(F.col(s), F.col(e))).alias("page"))
    over = page(rest, "gs", "ge").join(page(free, "fs", "fe"), "page").drop("page").distinct()
    only = over.withColumn("n", F.count("*").over(Window.partitionBy("given_id"))).where("n = 1").drop("n").withColumn("how", F.lit("overlap"))
    hit = same.unionByName(only)
    return a.join(hit.drop("gs", "ge"), "given_id", "left").select("given_id", "found_id", F.coalesce("how", F.lit("missing")).alias("how"), (F.col("fs") - F.col("gs")).alias("start_delta"), (F.col("fe") - F.col("ge")).alias("end_delta"))


def outline_triage(entries: DataFrame, nodes: DataFrame, agree: float = OUTLINE_AGREE) -> DataFrame:
    """(part, entry, path, how): outline entries by unique label, then, in order, by the most similar free title."""
    from lexweave.functions.fuzzy import ratio

    titled = nodes.where("title is not null").select("part", "ord", "path", "label", "title")
    ddl = "part string, entry string, path string, how string"

    def run(key, es: pd.DataFrame, ns: pd.DataFrame) -> pd.DataFrame:
        free, out = ns.sort_values("ord").to_dict("records"), []
        for e in es.sort_values("nr").to_dict("records"):
            by_label = [n for n in free if e["label"] and n["label"] == e["label"]]
            hit, how = (by_label[0], "label") if len(by_label) == 1 else (None, None)
            if hit is None:
                scored = sorted(((-ratio(e["title"].lower(), n["title"].lower()), n["ord"], i) for i, n in enumerate(free)))
                if scored and -scored[0][0] >= agree:
                    hit, how = free[scored[0][2]], "title"
            if hit:
                free = [n for n in free if n["path"] != hit["path"]]
            out.append((key[0], e["title"], hit and hit["path"], how or "outline_only"))
        out += [(key[0], None, n["path"], "tree_only") for n in free]
        return pd.DataFrame(out, columns=["part", "entry", "path", "how"])

    return entries.groupBy("part").cogroup(titled.groupBy("part")).applyInPandas(run, ddl)


def precision_recall(found: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    a, b = found.select(*keys).distinct().withColumn("f", F.lit(1)), wanted.select(*keys).distinct().withColumn("w", F.lit(1))
    both = a.join(b, list(keys), "full_outer")
    t = both.agg(F.sum(F.coalesce(F.col("f") * F.col("w"), F.lit(0))).alias("tp"), F.count("f").alias("n_found"), F.count("w").alias("n_wanted"))
    return t.select("tp", "n_found", "n_wanted", rate("tp", "n_found").alias("precision"), rate("tp", "n_wanted").alias("recall"))


def capitalised_never_defined(nodes: DataFrame, sites: DataFrame, top: int = CAP) -> DataFrame:
    """(run, n, verdict) of the most frequent capitalised runs that are no defined surface."""
    runs = nodes.where("kind <> 'ref' and text is not null").select(F.explode(tx.title_case_runs("text")).alias("run")).groupBy("run").agg(F.count("*").alias("n"))
    surfaces = sites.select(F.explode(F.array_union(F.array("term"), "aliases")).alias("s")).distinct()
    free = runs.join(surfaces, F.col("run") == F.col("s"), "left_anti")
    words = lambda df, c: df.select(c, F.explode(F.array_distinct(F.split(c, r"\s+"))).alias("w"))
    near = words(free, "run").join(words(surfaces, "s"), "w").select("run", "s").distinct()
    tagged = near.groupBy("run").agg(F.bool_or(F.col("run").contains(F.col("s"))).alias("holds"), F.bool_or(F.col("s").contains(F.col("run"))).alias("held"))
    verdict = F.when(F.coalesce("holds", F.lit(False)), "contains_a_term").when(F.coalesce("held", F.lit(False)), "part_of_a_term").otherwise("unknown")
    return free.join(tagged, "run", "left").select("run", "n", verdict.alias("verdict")).orderBy(F.desc("n"), "run").limit(top)


def cycles_and_depth(edges: DataFrame) -> dict:
    """Strong components, cycles and the longest chain of DEFINED_USING: terms of one document, so the driver walks them."""
    graph: dict[str, set[str]] = {}
    for r in edges.select("src", "dst").distinct().collect():
        graph.setdefault(r["src"], set()).add(r["dst"])
        graph.setdefault(r["dst"], set())
    index, low, stack, on, parts = {}, {}, [], set(), []
    for start in sorted(graph):
        todo = [(start, iter(sorted(graph[start])))] if start not in index else []
        if todo:
            index[start] = low[start] = len(index)
            stack.append(start)
            on.add(start)
        while todo:
            node, nexts = todo[-1]
            for n in nexts:
                if n not in index:
                    index[n] = low[n] = len(index)
                    stack.append(n)
                    on.add(n)
                    todo.append((n, iter(sorted(graph[n]))))
                    break
                if n in on:
                    low[node] = min(low[node], index[n])
            else:
                todo.pop()
                if todo:
                    low[todo[-1][0]] = min(low[todo[-1][0]], low[node])
                if low[node] == index[node]:
                    part = []
                    while True:
                        part.append(x := stack.pop())
                        on.discard(x)
                        if x == node:
                            break
                    parts.append(sorted(part))
    of = {n: i for i, p in enumerate(parts) for n in p}
    depth: list[int] = []
    for i, p in enumerate(parts):  # successors come first
        depth.append(1 + max((depth[of[n]] for x in p for n in graph[x] if of[n] != i), default=0))
    loops = [p for p in parts if len(p) > 1 or p[0] in graph[p[0]]]
    return {"components": len(parts), "cyclic": sorted(loops), "longest_chain": max(depth, default=0)}


def overlapping_best(labels: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Labels (keys, start, end) with the found span (keys, start, end, ...) of the same place that overlaps most; exact ones first by nature."""
    f = found.select(*keys, F.col("start").alias("fs"), F.col("end").alias("fe"), *(c for c in found.columns if c not in (*keys, "start", "end")))
    hit = labels.join(f, keys, "left").where((F.col("fs") < F.col("end")) & (F.col("start") < F.col("fe")))
    size = F.least("end", "fe") - F.greatest("start", "fs")
    best = hit.withColumn("n", F.row_number().over(Window.partitionBy(*keys, "start", "end").orderBy(F.desc(size), "fs", "fe"))).where("n = 1").drop("n")
    return labels.join(best.select(*keys, "start", "end", *(c for c in best.columns if c not in labels.columns)), [*keys, "start", "end"], "left")


def confusion(scored: DataFrame, by: str) -> DataFrame:
    """(by, tp, fp, fn, cost) of rows (by, wanted, found): a wrong value counts on both sides."""
    tp = F.count_if(F.col("wanted").isNotNull() & (F.col("wanted") == F.col("found")))
    fp = F.count_if(F.col("found").isNotNull() & ~F.col("found").eqNullSafe(F.col("wanted")))
    fn = F.count_if(F.col("wanted").isNotNull() & ~F.col("found").eqNullSafe(F.col("wanted")))
    t = scored.groupBy(by).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    return t.withColumn("cost", COSTS["false_positive"] * F.col("fp") + COSTS["false_negative"] * F.col("fn"))


def last_records(records: DataFrame, subject: list[str], order: list[str]) -> DataFrame:
    """The last record of each subject; null keys are equal."""
    return records.withColumn("__n", F.row_number().over(Window.partitionBy(*subject).orderBy(*(F.desc(c) for c in order)))).where("__n = 1").drop("__n")


def allocation(population: DataFrame, strata: list[str], size: int) -> DataFrame:
    """(strata, population, taken): shares by largest remainder, ties by the cells' names."""
    cells = population.groupBy(*strata).agg(F.count("*").alias("population"))
    total = cells.agg(F.sum("population").alias("total"))
    share = F.col("population") * F.least(F.lit(size).cast("long"), "total")
    rows = cells.crossJoin(F.broadcast(total)).withColumn("base", F.floor(share / F.col("total"))).withColumn("rest", share % F.col("total"))
    names = [F.coalesce(F.col(s).cast("string"), F.lit("")) for s in strata]
    every = Window.partitionBy(F.lit(0))
    left = F.least(F.lit(size).cast("long"), F.col("total")) - F.sum("base").over(every)
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("rest"), *names))
    return rows.withColumn("left", left).withColumn("rank", rank).select(*strata, "population", (F.col("base") + (F.col("rank") <= F.col("left")).cast("long")).alias("taken"))


def stratified_sample(population: DataFrame, strata: list[str], size: int, key: str, seed: str = "") -> DataFrame:
    """A sample of the given size: in each cell the rows with the least hash of seed, cell and key.

    A large cell is ranked in shards first, and the best of all shards once more, so that
    no task orders a whole cell.
    """
    cells = allocation(population, strata, size)
    names = [F.coalesce(F.col(s).cast("string"), F.lit("")) for s in strata]
    draw = F.sha1(F.concat_ws("|", F.lit(seed), *names, F.col(key).cast("string")))
    ranked = population.withColumn("__draw", draw)
    joined = ranked.join(F.broadcast(cells.select(*strata, "taken")), strata)  # a row a cell
    order = ["__draw", key]
    first = joined.withColumn("__shard", F.pmod(F.xxhash64("__draw"), F.lit(256)))
    first = first.withColumn("__n", F.row_number().over(Window.partitionBy(*strata, "__shard").orderBy(*order))).where("__n <= taken")
    n = F.row_number().over(Window.partitionBy(*strata).orderBy(*order))
    return first.withColumn("__n", n).where("__n <= taken").drop("__n", "__shard", "__draw", "taken")


def seeded_shuffle_sample(cells: dict[tuple, list[int]], size: int, material: str = "") -> list[int]:
    """Indexes drawn as a seeded shuffle of each cell draws them, for parity with samples drawn elsewhere."""
    total = sum(map(len, cells.values()))
    keys = sorted(cells, key=lambda k: tuple(map(str, k)))
    if size >= total:
        return sorted(i for c in cells.values() for i in c)
    seed = material + "|" + "|".join(f"{k}:{len(cells[k])}" for k in keys)
    exact = {k: size * len(cells[k]) / total for k in keys}
    take = {k: int(exact[k]) for k in keys}
    for k in sorted(keys, key=lambda k: (take[k] - exact[k], tuple(map(str, k))))[: size - sum(take.values())]:
        take[k] += 1
    out: list[int] = []
    for k in keys:
        own = list(cells[k])
        random.Random(int(hashlib.sha1(f"{seed}#{k}".encode()).hexdigest()[:16], 16)).shuffle(own)
        out += own[: take[k]]
    return sorted(out)


def agreement(verdicts: DataFrame, asked: DataFrame) -> DataFrame:
    """(asked, usable, agreed, duplicates, rate): the first verdict of each index counts."""
    first = verdicts.groupBy("index").agg(F.min_by("verdict", "nr").alias("verdict"), (F.count("*") - 1).alias("extra"))
    rows = asked.select("index").join(first, "index", "left")
    usable = F.col("verdict").isin("correct", "wrong")
    t = rows.agg(F.count("*").alias("asked"), F.count_if(usable).alias("usable"), F.count_if(F.col("verdict") == "correct").alias("agreed"), F.coalesce(F.sum("extra"), F.lit(0).cast("long")).alias("duplicates"))
    return t.withColumn("rate", rate("agreed", "usable"))


def group_contexts(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(group_id, phrase, n): the words that a list of references spans."""
    g = refs.where("group_id is not null").groupBy("group_id", "parent_path").agg(F.min("char_span.start").alias("s"), F.max("char_span.end").alias("e"), F.count("*").alias("n"))
    return g.join(nodes.select(F.col("path").alias("parent_path"), "text"), "parent_path").select("group_id", F.substring("text", F.col("s") + 1, F.col("e") - F.col("s")).alias("phrase"), "n")


def calibration(decisions: DataFrame) -> DataFrame:
    """(resolver, bucket, decisions, stated, observed, overconfident) of (resolver, confidence, correct)."""
    t = decisions.where("confidence is not null").withColumn("bucket", tx.confidence_bucket("confidence")).groupBy("resolver", "bucket").agg(F.count("*").alias("decisions"), F.round(F.avg("confidence"), 6).alias("stated"), F.round(F.avg(F.col("correct").cast("double")), 6).alias("observed"))
    return t.withColumn("overconfident", F.col("stated") - F.col("observed") > OVERCONFIDENT)


def status_matrix(before: DataFrame, now: DataFrame) -> DataFrame:
    b, n = before.select("path", F.col("status").alias("b")), now.select("path", F.col("status").alias("a"))
    both = b.join(n, "path", "full_outer").select(F.coalesce("b", F.lit("(new)")).alias("before"), F.coalesce("a", F.lit("(gone)")).alias("now"))
    return both.groupBy("before").pivot("now", ["resolved", "ambiguous", "unresolved", "external", "(gone)"]).count().fillna(0)


def snapshot(refs: DataFrame) -> DataFrame:
    return refs.select(F.col("path"), "status", "batch_id", "target_path", "resolver", "part")


def concept_hygiene(concepts: DataFrame, pairs: DataFrame, units: DataFrame, nodes: DataFrame, collisions: DataFrame) -> DataFrame:
    """(name, count, of): duplicates, units that no concept covers, collisions, concepts without members held."""
    from lexweave.operators.concepts import components

    clusters = components(pairs).groupBy("root").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("long")).alias("count"))
    total = concepts.agg(F.count("*").alias("of"))
    members = concepts.select("id", F.explode("member_node_ids").alias("node_id")).join(nodes.select(F.col("id").alias("node_id"), "path"), "node_id")
    covered = closure(nodes).join(members.select("path").distinct(), "path").select(F.col("top").alias("path")).distinct().join(units.select("path"), "path", "left_semi")
    orphan = concepts.join(members.select("id").distinct(), "id", "left_anti").agg(F.count("*").alias("count"))
    row = lambda name, c, o: c.crossJoin(o).select(F.lit(name).alias("name"), "count", "of")  # noqa: E731  one row each
    return row("duplicates", clusters, total).unionByName(row("covered_units", covered.agg(F.count("*").alias("count")), units.agg(F.count("*").alias("of")))).unionByName(row("collisions", collisions.agg(F.count_distinct("id").alias("count")), total)).unionByName(row("orphans", orphan, total))


def gates(metrics: DataFrame, limits: dict[str, tuple[str, float]] = GATES) -> DataFrame:
    """(name, threshold, value, status) of metrics (name, value): no value skips, an unknown gate fails."""
    spark = metrics.sparkSession
    g = spark.createDataFrame([(k, op, t) for k, (op, t) in limits.items()], "name string, op string, threshold double")
    known = F.lit(True) if set(limits) <= set(GATES) else F.col("name").isin(*GATES)
    both = g.join(metrics.select("name", "value"), "name", "left")
    ok = F.when(F.col("op") == ">=", F.col("value") >= F.col("threshold")).otherwise(F.col("value") <= F.col("threshold"))
    return both.select("name", "threshold", "value", F.when(~known, "unimplemented").when(F.col("value").isNull(), "skipped").when(ok, "pass").otherwise("fail").alias("status"))


def exit_code(results: DataFrame) -> int:
    bad = results.where("status in ('fail', 'unimplemented')").limit(1).count()
    return 2 if bad else 0


def fingerprint(*tables: DataFrame) -> str:
    """One hash over the rows of all tables, whatever their order."""
    parts = []
    for t in tables:
        r = t.select(F.xxhash64(*sorted(t.columns)).alias("h")).agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()
        parts.append(f"{r['n']}:{r['s']}")
    return hashlib.sha1("|".join(parts).encode()).hexdigest()


def capped(rows: DataFrame, order: list, limit: int = CAP) -> tuple[DataFrame, int]:
    """The first rows, and how many are hidden: a report's list."""
    return rows.orderBy(*order).limit(limit), max(0, rows.count() - limit)


def golden_subjects(golden: DataFrame, nodes: DataFrame) -> DataFrame:
    """Labels with path, start and end: a reference's path holds its span, others carry theirs."""
    at = r"/ref@(\d+)-(\d+)(?:\+\d+)?$"
    held = nodes.select(F.col("id").alias("node_id"), F.col("path").alias("node_path"))
    both = golden.join(held, "node_id", "left")
    is_ref = F.col("path").rlike(at)
    spot = F.when(is_ref, F.regexp_replace("path", at, "")).otherwise(F.coalesce("path", "node_path"))
    number = lambda i: F.nullif(F.regexp_extract("path", at, i), F.lit("")).cast("int")
    return both.withColumns({"subject": spot, "start": F.coalesce(number(1), "char_span.start"), "end": F.coalesce(number(2), "char_span.end")})


def report(sections: dict[str, DataFrame], limit: int = CAP) -> str:
    """A Markdown report of the sections' first rows, stable and without times."""
    out = []
    for name in sorted(sections):
        df = sections[name]
        rows = df.orderBy(*df.columns).limit(limit).collect()
        out += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + " - |" * len(df.columns), *("| " + " | ".join(str(v) for v in r) + " |" for r in rows), ""]
    return "\n".join(out)
