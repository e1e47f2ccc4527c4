"""The read-only lookups over a loaded graph, and the review queue."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexweave.functions.fuzzy import weighted_similarity
from lexweave.operators import tree
from lexweave.operators.vocabulary import governing_scopes

# Limits of the lookups.
FIND_LIMIT, CONCEPT_LEAST, ROOTS, CALLS = 8, 60.0, 12, 24
TAG = r"\[\[([^\]|]+)\|([^\]]*)\]\]"


@dataclass
class Graph:
    """The tables a graph is read from."""

    nodes: DataFrame
    refs: DataFrame
    sites: DataFrame
    uses: DataFrame
    concepts: DataFrame
    search_text: bool = True


def surfaces(g: Graph) -> DataFrame:
    """(path, surface, field) of all that a provision can be found by."""
    own = [("path", "path"), ("title", "title"), ("label", "label")] + ([("text", "text")] if g.search_text else [])
    rows = g.nodes.where("kind <> 'ref'").select("path", F.expr(f"stack({len(own)}, {', '.join(f'{c!r}, {c}' for c, _ in own)}) as (field, surface)"))
    held = g.nodes.select(F.col("id").alias("definition_node_id"), "path")
    terms = g.sites.join(held, "definition_node_id").select("path", F.lit("term").alias("field"), F.explode(F.array_union(F.array("term"), "aliases")).alias("surface"))
    return rows.where("surface is not null and surface <> ''").unionByName(terms)


def find_provision(g: Graph, question: str, limit: int = FIND_LIMIT) -> DataFrame:
    """(path, field, surface, score): the best surface of each path among the best surfaces of all."""
    asked = question.lower()
    scored = surfaces(g).withColumn("score", weighted_similarity(F.lower("surface"), F.lit(asked)))
    top = scored.orderBy(F.desc("score"), "path", "field", "surface").limit(max(limit * 6, 40))
    best = top.withColumn("n", F.row_number().over(Window.partitionBy("path").orderBy(F.desc("score"), "field", "surface"))).where("n = 1")
    return best.orderBy(F.desc("score"), "path").limit(limit).select("path", "field", "surface", F.round(F.col("score") / 100, 3).alias("score"))


def get_provision(g: Graph, path: str) -> DataFrame:
    """The node with its derived text, children in order and boxes; no row where the path is unknown."""
    own = g.nodes.where(F.col("path") == path)
    text = tree.derived_text(tree.descendants(g.nodes, path)).where(F.col("path") == path)
    kids = g.nodes.where((F.col("parent_path") == path) & (F.col("kind") != "ref")).agg(F.transform(F.array_sort(F.collect_list(F.struct("sib_no", "path"))), lambda x: x["path"]).alias("children"))
    return own.join(text, "path", "left").crossJoin(kids).select("path", "kind", "label", "title", "derived_text", "children", F.coalesce("printed_page", F.col("page_start").cast("string")).alias("page"), F.coalesce(F.when(F.size("bboxes_own") > 0, F.col("bboxes_own")), "bboxes_extent").alias("boxes"))


def follow_references(g: Graph, path: str, direction: str = "outbound") -> DataFrame:
    """References below a path, or those whose target is just this path."""
    rows = g.refs
    hit = (F.col("parent_path") == path) | F.col("parent_path").startswith(path + "/") if direction == "outbound" else F.col("target_path") == path
    return rows.where(hit).select("path", "parent_path", "text", "ref_kind", "status", "target_path", "candidates").orderBy("path")


def define(g: Graph, term: str) -> DataFrame:
    """Sites of a term by exact name, else by alias, else without regard to case, with the parts they govern."""
    rank = F.when(F.col("term") == term, 0).when(F.array_contains("aliases", term), 1).when(F.lower("term") == term.lower(), 2)
    hits = g.sites.withColumn("rank", rank).where("rank is not null")
    best = hits.join(F.broadcast(hits.agg(F.min("rank").alias("rank"))), "rank")  # one row
    parts = g.nodes.where("kind = 'part'").select(F.col("path"))
    ruled = governing_scopes(best.select("term").distinct().crossJoin(parts).select("term", "path"), best).groupBy("term", "scope").agg(F.array_sort(F.collect_list("path")).alias("governs"))
    held = g.nodes.select(F.col("id").alias("definition_node_id"), "path", "text")
    gap = F.when(F.col("path").isNull(), "definition_node_missing").when(F.col("pointer").isNotNull(), "delegated")
    return best.join(held, "definition_node_id", "left").join(ruled, ["term", "scope"], "left").select("term", "scope", "source", "aliases", "path", "text", "pointer", "governs", gap.alias("gap"))


def find_by_concept(g: Graph, label: str, least: float = CONCEPT_LEAST) -> DataFrame:
    """Concepts of similar labels with their members' paths and relations; never citable."""
    hit = g.concepts.withColumn("score", weighted_similarity(F.lower("label"), F.lit(label.lower()))).where(F.col("score") >= least)
    members = hit.select("id", F.explode("member_node_ids").alias("node_id")).join(g.nodes.select(F.col("id").alias("node_id"), "path"), "node_id").groupBy("id").agg(F.array_sort(F.collect_set("path")).alias("members"))
    return hit.join(members, "id", "left").select("id", "label", "scope_path", "members", "relations", F.round(F.col("score") / 100, 3).alias("score"), F.lit(False).alias("citable")).orderBy(F.desc("score"), "id")


def history(nodes: DataFrame, lineage: str) -> DataFrame:
    return nodes.where(F.col("lineage_key") == lineage).select("id", "path", "version", "content_hash").orderBy(F.coalesce("version", F.lit("")), "path")


def cite(g: Graph, path: str) -> DataFrame:
    """The page and first box of a provision, its own before its extent."""
    box = F.element_at(F.coalesce(F.when(F.size("bboxes_own") > 0, F.col("bboxes_own")), F.when(F.size("bboxes_extent") > 0, F.col("bboxes_extent"))), 1)
    return g.nodes.where((F.col("path") == path) & F.col("citable")).select("path", box["page"].alias("page"), box.alias("box"))


BOX = "struct<page:int,bbox:array<double>>"


def decoded_boxes(own: Column, extent: Column, page: Column) -> Column:
    """The boxes (page, bbox) of texts in any stored form: a JSON list of boxes, a JSON list of JSON texts, or one flat box.

    The first of own and extent boxes that gives any counts; a flat box of four numbers takes the given page.
    """

    def decode(raw: Column) -> Column:
        whole = lambda boxes: F.filter(boxes, lambda b: b.isNotNull() & b["bbox"].isNotNull())
        listed = whole(F.from_json(raw, f"array<{BOX}>"))
        texts = whole(F.transform(F.from_json(raw, "array<string>"), lambda t: F.from_json(t, BOX)))
        flat = F.from_json(raw, "array<double>")
        one = F.when((F.size(flat) == 4) & F.forall(flat, lambda v: v.isNotNull()) & page.isNotNull(), F.array(F.struct(page.cast("int").alias("page"), flat.alias("bbox"))))
        some = lambda boxes: F.when(F.size(boxes) > 0, boxes)
        return F.coalesce(some(listed), some(texts), one)

    return F.coalesce(decode(own), decode(extent), F.array().cast(f"array<{BOX}>"))


def verify_citations(answers: DataFrame, facts: DataFrame) -> DataFrame:
    """(answer_id, path, page, status): tags [[path|page]] of texts against the (path, page) pairs that were returned."""
    tags = answers.select("answer_id", F.explode(F.regexp_extract_all("text", F.lit(r"\[\[[^\]|]+\|[^\]]*\]\]"), F.lit(0))).alias("tag"))
    rows = tags.select("answer_id", F.regexp_extract("tag", TAG, 1).alias("path"), F.trim(F.regexp_extract("tag", TAG, 2)).alias("page"))
    known = facts.select("path").distinct().withColumn("known", F.lit(True))
    pairs = facts.select("path", F.col("page").cast("string").alias("page")).distinct().withColumn("paired", F.lit(True))
    both = rows.join(known, "path", "left").join(pairs, ["path", "page"], "left")
    status = F.when(F.col("known").isNull(), "unknown_path").when(F.col("page").try_cast("int").isNull(), "page_unparseable").when(F.col("paired"), "ok").otherwise("page_mismatch")
    return both.select("answer_id", "path", "page", status.alias("status"))


def answer_graph(g: Graph, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Nodes and outgoing edges of up to twelve provisions."""
    roots = paths[:ROOTS]
    out = g.refs.where(F.col("parent_path").isin(roots))
    state = F.when(F.col("status") == "external", "external").when(F.col("status") == "resolved", "settled").otherwise("unsettled")
    edges = out.select(F.col("parent_path").alias("src"), F.coalesce("target_path", F.element_at("candidates", 1)["path"]).alias("dst"), state.alias("state")).where("dst is not null").distinct()
    ends = edges.select(F.col("dst").alias("path")).unionByName(g.nodes.where(F.col("path").isin(roots)).select("path")).distinct()
    return ends.join(g.nodes.select("path", "kind", "label", "title"), "path", "left"), edges


def review_queue(g: Graph, decisions: DataFrame | None = None) -> DataFrame:
    """(kind, part, page, id, question, verdict): unsettled references, ambiguous uses and anomalies, with their last decision."""
    pages = g.nodes.select("path", F.col("id").alias("node_id"), "page_start")
    refs = g.refs.where("status in ('ambiguous', 'unresolved')").join(pages.select(F.col("path").alias("parent_path"), "page_start"), "parent_path", "left").select(F.lit("ref").alias("kind"), "part", F.col("page_start").alias("page"), F.col("path").alias("id"), F.col("text").alias("question"))
    terms = g.uses.where("status = 'ambiguous'").select("term", "node_id", "char_span", "ambiguity_kind").join(pages, "node_id").select(F.lit("term").alias("kind"), tree.part_of("path").alias("part"), F.col("page_start").alias("page"), F.concat_ws("#", "path", "term", F.col("char_span.start").cast("string")).alias("id"), F.concat_ws(": ", "ambiguity_kind", "term").alias("question"))
    odd = g.nodes.select("path", "page_start", F.posexplode("anomalies").alias("nr", "note")).select(F.lit("anomaly").alias("kind"), tree.part_of("path").alias("part"), F.col("page_start").alias("page"), F.concat_ws("#", "path", F.col("nr").cast("string")).alias("id"), F.col("note").alias("question"))
    rows = refs.unionByName(terms).unionByName(odd)
    if decisions is None:
        return rows.withColumn("verdict", F.lit(None).cast("string")).orderBy("kind", "part", "page", "id")
    last = decisions.groupBy("kind", "id").agg(F.max_by("verdict", F.struct("ts", "nr")).alias("verdict"))
    return rows.join(last, ["kind", "id"], "left").orderBy("kind", "part", "page", "id")


def queue_counts(queue: DataFrame) -> DataFrame:
    return queue.groupBy("kind", "part").agg(F.count("*").alias("n"), F.count("verdict").alias("decided"))


def citing_parts(refs: DataFrame) -> DataFrame:
    """(statute, parts, n): which parts cite each statute."""
    return refs.where("status = 'external'").groupBy(F.col("target_path").alias("statute")).agg(F.array_sort(F.collect_set("part")).alias("parts"), F.count("*").alias("n"))


@dataclass
class ToolRunner:
    """Named lookups with a budget of calls; failures are rows of data, not exceptions."""

    graph: Graph
    budget: int = CALLS
    calls: list[tuple[str, dict, str]] = field(default_factory=list)

    def run(self, name: str, **args) -> DataFrame | dict:
        table: dict[str, Callable] = {"find_provision": find_provision, "get_provision": get_provision, "follow_references": follow_references, "define": define, "find_by_concept": find_by_concept, "cite": cite}
        if len(self.calls) >= self.budget:
            return {"error": "budget_exhausted"}
        if name not in table:
            self.calls.append((name, args, "unknown_tool"))
            return {"error": "unknown_tool"}
        try:
            out = table[name](self.graph, **args)
            self.calls.append((name, args, "ok"))
            return out
        except (TypeError, ValueError) as e:
            self.calls.append((name, args, "failed"))
            return {"error": str(e)}


def shown_part(path: Column) -> Column:
    return F.initcap(F.replace(tree.part_of(path), F.lit("-"), F.lit(" ")))
