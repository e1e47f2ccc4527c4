"""The property graph: rows and edges, idempotent loads by snapshots, rollback, sweep, salience."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexweave.functions import ids
from lexweave.operators.concepts import shared_folder
from lexweave.operators.tree import part_of

# Thresholds of salience, associations and furniture.
SIGMA, SHARE, REPEATS, PARTS, MIN_KIND = 4.0, 0.25, 3, 2, 3
PLACEHOLDER = r"^\s*\[[^\]]{1,80}\]\s*$"
EDGE_TYPES = ("CONTAINS", "NEXT", "RESOLVES_TO", "CANDIDATE", "DEFINED_IN", "USES_TERM", "DEFINED_USING", "ABOUT", "CONCEPT_REL", "ASSOCIATED_TERM", "SUPERSEDES")


def edge(kind: str, src: Column | str, dst: Column | str, **props: Column | str) -> list[Column]:
    """Columns of an edge row; props become a map of texts."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    pairs = F.create_map(*(y for k, v in props.items() for y in (F.lit(k), c(v).cast("string")))) if props else F.create_map().cast("map<string,string>")
    return [F.lit(kind).alias("type"), c(src).alias("src"), c(dst).alias("dst"), F.map_filter(pairs, lambda k, v: v.isNotNull()).alias("props")]


def contains_edges(nodes: DataFrame) -> DataFrame:
    parents = nodes.select(F.col("path").alias("parent_path"), F.col("id").alias("parent_id"))
    return nodes.join(parents, "parent_path").select(*edge("CONTAINS", "parent_id", "id"))


def next_edges(nodes: DataFrame) -> DataFrame:
    """Consecutive anatomy siblings."""
    after = F.lead("id").over(Window.partitionBy("parent_path").orderBy("sib_no", "path"))
    return nodes.where("kind <> 'ref' and parent_path is not null").withColumn("after", after).where("after is not null").select(*edge("NEXT", "id", "after"))


def resolves_edges(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Settled references to held nodes by id, to others by path (to be deferred), to statutes by key."""
    held = nodes.select(F.col("path").alias("target_path"), F.col("id").alias("target_id"))
    rows = refs.where("status in ('resolved', 'external') and target_path is not null").join(held, "target_path", "left")
    return rows.select(*edge("RESOLVES_TO", "id", F.coalesce("target_id", "target_path"), scope_rule="scope_rule", resolver="resolver", status="status"))


def candidate_edges(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    held = nodes.select("path", F.col("id").alias("target_id"))
    return refs.select("id", F.inline("candidates")).join(held, "path").select(*edge("CANDIDATE", "id", "target_id", score="score", reason="reason"))


def legislation_rows(refs: DataFrame, records: DataFrame) -> DataFrame:
    """(key, title, year, instrument_kind, provision, derived): every cited key, with its record or what its key says."""
    cited = refs.where("status = 'external'").select(F.col("target_path").alias("key")).distinct()
    own = records.select("key", "title", "year", "instrument_kind", "provision").dropDuplicates(["key"])
    bare = F.initcap(F.replace(F.split_part("key", F.lit("/"), F.lit(2)), F.lit("-"), F.lit(" ")))
    year = F.nullif(F.regexp_extract("key", r"-(\d{4})(?:/|$)", 1), F.lit("")).cast("int")
    return cited.join(own, "key", "left").select("key", F.coalesce("title", bare).alias("title"), F.coalesce(F.nullif("year", F.lit(0)), year).alias("year"), "instrument_kind", "provision", F.col("title").isNull().alias("derived"))


def term_rows(sites: DataFrame) -> DataFrame:
    return sites.groupBy(F.col("term").alias("name")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("aliases")))).alias("aliases"))


def definition_edges(sites: DataFrame, nodes: DataFrame) -> DataFrame:
    held = nodes.select(F.col("id").alias("definition_node_id"))
    return sites.join(held, "definition_node_id", "left_semi").dropDuplicates(["term", "definition_node_id"]).select(*edge("DEFINED_IN", "term", "definition_node_id", scope="scope", source="source"))


def use_edges(uses: DataFrame, nodes: DataFrame) -> DataFrame:
    held = nodes.select(F.col("id").alias("node_id"))
    span = F.concat_ws("-", F.col("char_span.start").cast("string"), F.col("char_span.end").cast("string"))
    return uses.join(held, "node_id", "left_semi").select(*edge("USES_TERM", "node_id", "term", char_span=span, status="status", method="method"))


def defined_using_edges(uses: DataFrame, sites: DataFrame) -> DataFrame:
    """A use inside another term's definition; a node that defines several terms keeps them all."""
    own = sites.select(F.col("definition_node_id").alias("node_id"), F.col("term").alias("defined")).distinct()
    return uses.select("term", "node_id").distinct().join(own, "node_id").where("term <> defined").select("defined", "term").distinct().select(*edge("DEFINED_USING", "defined", "term"))


def about_edges(concepts: DataFrame, nodes: DataFrame) -> DataFrame:
    held = nodes.select(F.col("id").alias("node_id"))
    return concepts.select("id", F.explode("member_node_ids").alias("node_id")).join(held, "node_id", "left_semi").select(*edge("ABOUT", "id", "node_id"))


def concept_edges(concepts: DataFrame) -> DataFrame:
    known = concepts.select(F.col("id").alias("k"))
    rels = concepts.select(F.inline("relations"))
    return rels.join(known, rels["src"] == known["k"], "left_semi").join(known, rels["dst"] == known["k"], "left_semi").select(*edge("CONCEPT_REL", "src", "dst", label="label"))


def associated_terms(members: DataFrame, uses: DataFrame, least: float = SHARE) -> DataFrame:
    """(concept, term, n_using, n_held, share): the share of a concept's members that use a term, from 0.25 on.

    members (concept, node) hold only nodes that exist; uses (node, term) count once a node.
    """
    m = members.distinct()
    held = m.groupBy("concept").agg(F.count("*").alias("n_held"))
    using = m.join(uses.select("node", "term").distinct(), "node").groupBy("concept", "term").agg(F.count("*").alias("n_using"))
    return using.join(held, "concept").withColumn("share", F.round(F.col("n_using") / F.col("n_held"), 4)).where(F.col("share") >= least)


def deduplicated(edges: DataFrame) -> DataFrame:
    """One edge a merge key; later props overlay earlier ones; n says how many there were."""
    span = F.coalesce(F.element_at("props", "char_span"), F.lit(""))
    keyed = edges.withColumn("__k", F.when(F.col("type") == "USES_TERM", span).otherwise(F.lit("")))
    numbered = keyed if "nr" in edges.columns else keyed.withColumn("nr", F.lit(0))
    keys = ["type", "src", "dst", "__k"]
    # the last value of each property, so that an edge with many copies is never gathered
    last = numbered.select(*keys, "nr", F.explode("props").alias("p", "v")).groupBy(*keys, "p").agg(F.max_by("v", F.struct("nr", "v")).alias("v"))
    props = last.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("p", "v")))).alias("props"))
    counted = numbered.groupBy(*keys).agg(F.count("*").alias("n"))
    return counted.join(props, keys, "left").select("type", "src", "dst", F.coalesce("props", F.create_map().cast("map<string,string>")).alias("props"), "n")


def dangling(edges: DataFrame, keys: DataFrame) -> DataFrame:
    """(type, side, key, n): ends of edges without a row among keys (key)."""
    ends = edges.select("type", F.expr("stack(2, 'src', src, 'dst', dst) as (side, key)"))
    return ends.join(keys.select("key"), "key", "left_anti").groupBy("type", "side", "key").agg(F.count("*").alias("n"))


def writable_and_deferred(edges: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges with both ends known, and the others with the sides they miss."""
    k = keys.select("key").distinct()
    s, d = k.select(F.col("key").alias("src")).withColumn("has_src", F.lit(True)), k.select(F.col("key").alias("dst")).withColumn("has_dst", F.lit(True))
    both = edges.join(s, "src", "left").join(d, "dst", "left")
    ok = F.col("has_src").isNotNull() & F.col("has_dst").isNotNull()
    missing = F.array_join(F.filter(F.array(F.when(F.col("has_src").isNull(), "src"), F.when(F.col("has_dst").isNull(), "dst")), lambda x: x.isNotNull()), "+")
    return both.where(ok).select(*edges.columns), both.where(~ok).select(*edges.columns, missing.alias("missing"))


def load_id(batch_id: str, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: a hash of the batch and of all asserted keys, whatever their order.

    Keys are hashed one by one and the hashes are summed in 64 buckets, so that no task
    holds all keys.
    """
    keys = nodes.select(F.concat(F.lit("n|"), "id").alias("k")).unionByName(edges.select(F.concat_ws("|", F.lit("e"), "type", "src", "dst", F.coalesce(F.element_at("props", "char_span"), F.lit(""))).alias("k"))).distinct()
    parts = keys.groupBy(F.pmod(F.xxhash64("k"), F.lit(64)).alias("b")).agg(F.count("*").alias("n"), F.sum(F.xxhash64("k").cast("decimal(38,0)")).alias("s"))
    return parts.agg(F.sha1(F.concat_ws("\n", F.lit(batch_id), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "n", "s"))), lambda x: F.concat_ws(":", x["b"].cast("string"), x["n"].cast("string"), x["s"].cast("string"))), "\n"))).alias("load_id"))


def overlay(old: DataFrame, new: DataFrame, keys: list[str], batch_id: str, load: str) -> DataFrame:
    """Upsert: new values overlay old ones, absent ones never clear, first_batch_id stays as created."""
    stamped = new.withColumns({"batch_id": F.lit(batch_id), "first_batch_id": F.lit(batch_id), "load_id": F.lit(load)})
    columns = [*dict.fromkeys([*old.columns, *stamped.columns])]
    a, b = old.alias("a"), stamped.alias("b")
    on = reduce(lambda x, y: x & y, (F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys))

    def value(c: str) -> Column:
        sides = [F.col(f"{s}.{c}") for s, df in (("b", stamped), ("a", old)) if c in df.columns]
        return F.coalesce(*(reversed(sides) if c == "first_batch_id" else sides)).alias(c)

    return a.join(b, on, "full_outer").select(*map(value, columns))


def rollback(nodes: DataFrame, edges: DataFrame, batch_id: str, referents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, edges and kept referents after a batch is taken back.

    The batch's edges go, then its nodes and what hangs on them; referents (terms, statutes,
    concepts) that other edges still touch stay.
    """
    left = edges.where(F.col("batch_id") != batch_id)
    own = nodes.where(F.col("batch_id") == batch_id)
    touched = left.select(F.col("src").alias("id")).unionByName(left.select(F.col("dst").alias("id"))).distinct()
    kept = own.join(referents.select("id").distinct(), "id", "left_semi").join(touched, "id", "left_semi")
    gone = own.join(kept.select("id"), "id", "left_anti").select("id")
    rest = nodes.join(gone, "id", "left_anti")
    return rest, _detached(left, gone), kept


def _detached(edges: DataFrame, gone: DataFrame) -> DataFrame:
    return edges.join(gone.select(F.col("id").alias("src")), "src", "left_anti").join(gone.select(F.col("id").alias("dst")), "dst", "left_anti").select(*edges.columns)


def sweep(nodes: DataFrame, edges: DataFrame, scope: list[str], load: str, referents: DataFrame, skip_types: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """What stays after a load of the scope: edges of the scope that it did not assert go, then such nodes, then its referents without edges."""
    inside = reduce(lambda a, b: a | b, ((F.col("path") == p) | F.col("path").startswith(f"{p}/") for p in scope), F.lit(False))
    scoped = nodes.where(inside).select("id", "load_id")
    stale = F.coalesce("load_id", F.lit("")) != load
    doomed = edges.join(scoped.select(F.col("id").alias("src")), "src", "left_semi").where(stale & ~F.col("type").isin(*skip_types)).select("type", "src", "dst").distinct()
    kept_edges = edges.join(doomed, ["type", "src", "dst"], "left_anti").unionByName(edges.join(doomed, ["type", "src", "dst"], "left_semi").where(~stale)).select(*edges.columns)
    gone = scoped.where(stale).select("id")
    kept_edges = _detached(kept_edges, gone)
    touched = kept_edges.select(F.col("src").alias("id")).unionByName(kept_edges.select(F.col("dst").alias("id"))).distinct()
    orphans = referents.select("id").distinct().join(nodes.where(~stale).select("id"), "id", "left_semi").join(touched, "id", "left_anti")
    return nodes.join(gone, "id", "left_anti").join(orphans, "id", "left_anti"), kept_edges


def furniture(nodes: DataFrame, repeats: int = REPEATS, parts: int = PARTS) -> DataFrame:
    """(id) of nodes whose text stands on many nodes of several parts, or is a bare placeholder."""
    same = nodes.where("content_hash is not null").groupBy("content_hash").agg(F.count("*").alias("n"), F.count_distinct(part_of("path")).alias("p")).where((F.col("n") >= repeats) & (F.col("p") >= parts))
    return nodes.join(same, "content_hash", "left_semi").select("id").unionByName(nodes.where(F.col("text").rlike(PLACEHOLDER)).select("id")).distinct()


def salience(citations: DataFrame, targets: DataFrame, sigma: float = SIGMA) -> DataFrame:
    """(target, kind, frequency, breadth, salience, flagged) of all targets.

    citations (target, citing_part) without furniture; salience is breadth * ln(1 + frequency).
    An outlier lies over the mean of its kind's cited targets by so many deviations.
    """
    cited = citations.groupBy("target").agg(F.count("*").alias("frequency"), F.count_distinct("citing_part").alias("breadth"))
    kinds = cited.join(targets.select("target", "kind"), "target").groupBy("kind").agg(F.avg("frequency").alias("mu"), F.stddev_pop("frequency").alias("sd"), F.count("*").alias("n"))
    rows = targets.join(cited, "target", "left").join(F.broadcast(kinds), "kind", "left")  # a row a kind
    high = (F.col("n") >= MIN_KIND) & (F.col("sd") > 0) & (F.col("frequency") > F.col("mu") + sigma * F.col("sd"))
    zero = F.lit(0).cast("long")
    return rows.select("target", "kind", F.coalesce("frequency", zero).alias("frequency"), F.coalesce("breadth", zero).alias("breadth"), F.coalesce(F.round(F.col("breadth") * F.log1p("frequency"), 6), F.lit(0.0)).alias("salience"), F.coalesce(high, F.lit(False)).alias("flagged"))


def node_salience(nodes: DataFrame, refs: DataFrame, sigma: float = SIGMA) -> DataFrame:
    rooms = furniture(nodes)
    plain = nodes.join(rooms, "id", "left_anti").select(F.col("path").alias("parent_path"))
    held = nodes.select(F.col("path").alias("target_path"), F.col("id").alias("target"))
    cites = refs.where("status = 'resolved'").join(plain, "parent_path", "left_semi").join(held, "target_path").select("target", part_of("path").alias("citing_part"))
    return salience(cites, nodes.select(F.col("id").alias("target"), "kind"), sigma)


def term_salience(uses: DataFrame, nodes: DataFrame, sites: DataFrame, sigma: float = SIGMA) -> DataFrame:
    rooms = furniture(nodes)
    spots = nodes.join(rooms, "id", "left_anti").select(F.col("id").alias("node_id"), part_of("path").alias("citing_part"))
    return salience(uses.join(spots, "node_id").select(F.col("term").alias("target"), "citing_part"), sites.select(F.col("term").alias("target")).distinct().withColumn("kind", F.lit("term")), sigma)


def boosted(scored: DataFrame, weights: DataFrame, weight: float = 0.02) -> DataFrame:
    return scored.join(weights, "id", "left").withColumn("score", F.col("score") + weight * F.log1p(F.coalesce("salience", F.lit(0.0)))).drop("salience")


def with_salience(nodes: DataFrame, values: DataFrame) -> DataFrame:
    v = values.select(F.col("target").alias("id"), F.col("salience").alias("__s"), "flagged")
    return nodes.drop("salience", "flagged").join(v, "id", "left").withColumn("salience", F.coalesce("__s", F.lit(0.0))).withColumn("flagged", F.coalesce("flagged", F.lit(False))).drop("__s")


def graph_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(what, name, n): totals, nodes by kind, edges by type."""
    by = lambda df, c, what: df.groupBy(F.col(c).alias("name")).agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "name", "n")
    total = lambda df, what: df.agg(F.count("*").alias("n")).select(F.lit("total").alias("what"), F.lit(what).alias("name"), "n")
    return total(nodes, "nodes").unionByName(total(edges, "edges")).unionByName(by(nodes, "kind", "node")).unionByName(by(edges, "type", "edge"))


def reconciled(expected: DataFrame, written: DataFrame) -> DataFrame:
    """(name, expected, written, ok) over (name, n); deferred edges are not among the expected."""
    a, b = expected.select("name", F.col("n").alias("expected")), written.select("name", F.col("n").alias("written"))
    zero = F.lit(0).cast("long")
    return a.join(b, "name", "full_outer").select("name", F.coalesce("expected", zero).alias("expected"), F.coalesce("written", zero).alias("written")).withColumn("ok", F.col("expected") == F.col("written"))


def document_root(nodes: DataFrame, document: str, version: str = "as-bound") -> DataFrame:
    """The root over all parts."""
    parts = nodes.where("kind = 'part'")
    return parts.agg(F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), F.count("*").alias("n_parts")).select(ids.node_id(F.lit(document), F.lit(version), F.lit(document)).alias("id"), F.lit(document).alias("path"), F.lit("document").alias("kind"), F.lit(version).alias("version"), "page_start", "page_end", "n_parts")


def version_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(lineage_key, change): added, removed, changed or unchanged, by lineage and content."""
    a, b = old.select("lineage_key", F.col("content_hash").alias("h0"), F.lit(True).alias("i0")), new.select("lineage_key", F.col("content_hash").alias("h1"), F.lit(True).alias("i1"))
    both = a.join(b, "lineage_key", "full_outer")
    return both.select("lineage_key", F.when(F.col("i0").isNull(), "added").when(F.col("i1").isNull(), "removed").when(F.col("h0").eqNullSafe(F.col("h1")), "unchanged").otherwise("changed").alias("change"))


def supersedes_edges(old: DataFrame, new: DataFrame) -> DataFrame:
    a, b = old.select("lineage_key", F.col("id").alias("old_id")), new.select("lineage_key", F.col("id").alias("new_id"))
    return a.join(b, "lineage_key").where("old_id <> new_id").select(*edge("SUPERSEDES", "new_id", "old_id"))


def key_violations(rows: DataFrame, *keys: str) -> DataFrame:
    """Key values that stand more than once: the constraint of a table without constraints."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def impact(edges: DataFrame, start: str, most: int = 50) -> DataFrame:
    """(id, hops): all that depends on a node, by hops against the direction of references; rounds are written out."""
    back = edges.where(F.col("type").isin("RESOLVES_TO", "CONTAINS")).select("src", "dst")
    spark = edges.sparkSession
    shared_folder(spark)
    seen = spark.createDataFrame([(start, 0)], "id string, hops int")
    front = seen
    for hop in range(1, most + 1):
        step = back.join(front.select(F.col("id").alias("dst")), "dst").select(F.col("src").alias("id")).distinct().join(seen, "id", "left_anti").withColumn("hops", F.lit(hop)).checkpoint()
        if not step.limit(1).count():
            break
        seen, front = seen.unionByName(step).checkpoint(), step
    return seen
