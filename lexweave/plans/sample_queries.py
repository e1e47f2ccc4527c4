"""Queries over the sample contract, for operators that the driver's prose never exercises."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.operators import detection, embeddings, evaluation, graph, layout, resolution, tools, tree, vocabulary
from lexweave.operators.concepts import shared_folder
from lexweave.plans import sample_expected as expected
from lexweave.plans.catalog import query
from lexweave.sources import samples


def _rows(table: tuple[list[tuple[str, str]], list[tuple]]) -> str:
    """SQL for fixed rows."""

    def one(v: object) -> str:
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else repr(v)

    columns, rows = table
    typed = ", ".join(f'CAST("{c}" AS {t}) AS "{c}"' for c, t in columns)
    return f"SELECT {typed} FROM (VALUES {', '.join('(' + ', '.join(map(one, r)) + ')' for r in rows)}) t({', '.join(f'\"{c}\"' for c, _ in columns)})"


def _cut(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint()


def _references(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    nodes = samples.nodes(spark)
    pointers = _cut(detection.pointers(nodes))
    return nodes, _cut(resolution.references(nodes, resolution.resolve(nodes, pointers, samples.registry(spark)), "B1"))


def _sites(nodes: DataFrame) -> DataFrame:
    merged = _cut(vocabulary.merged_sites(vocabulary.declared_sites(nodes), vocabulary.discovered_sites(nodes)))
    return _cut(vocabulary.attach_aliases(merged, vocabulary.bracket_aliases(nodes))[0])


def sample_graph(spark: SparkSession) -> tools.Graph:
    nodes, refs = _references(spark)
    sites = _sites(nodes)
    concepts = spark.createDataFrame([("concept-1", "widget supply", "core-terms", [samples.node_rows()[5]["id"]], [], True, 0.8)], "id string, label string, scope_path string, member_node_ids array<string>, relations array<struct<src:string,label:string,dst:string>>, llm_derived boolean, confidence double")
    return tools.Graph(nodes, refs, sites, _cut(vocabulary.term_uses(nodes, sites)), concepts)


@query(_rows(expected.REFERENCES))
def sample_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _references(spark)[1].select("path", "text", "ref_kind", "status", "scope_rule", "target_path", "resolver")


@query("SELECT status, CAST(n AS BIGINT) AS n FROM (VALUES ('resolved', 10), ('ambiguous', 5), ('unresolved', 3), ('external', 2)) t(status, n)")
def sample_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _references(spark)[1].groupBy("status").agg(F.count("*").alias("n"))


@query(_rows(expected.ORPHANS))
def sample_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detection.orphan_keywords(samples.nodes(spark))


@query("SELECT * FROM (VALUES ('Supplier', 'both'), ('Charges', 'both'), ('Key Performance Indicator', 'both'), ('Widget', 'both'), ('Breach', 'both')) t(term, source)")
def sample_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sites(samples.nodes(spark)).select("term", "source")


@query(_rows(expected.TERM_USES))
def sample_term_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = samples.nodes(spark)
    return vocabulary.term_uses(nodes, _sites(nodes)).select("term", "path", "field", "surface", "status", "ambiguity_kind")


@query("SELECT * FROM (VALUES ('core-terms', 14), ('joint-schedule-1', 11), ('call-off-schedule-9', 9), ('form-1', 3)) t(part, n)")
def sample_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.kind_counts(samples.nodes(spark)).groupBy("part").agg(F.sum("n").cast("int").alias("n"))


@query(_rows(expected.NAMES))
def sample_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.human_names(tree.unit_labels(samples.nodes(spark)))


@query(_rows(expected.CHECKS))
def sample_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = samples.nodes(spark)
    return evaluation.claimed(evaluation.check_tree(nodes), nodes).select("check", "path", "against", "explained_by")


@query(_rows(expected.EMBEDDING_PLAN))
def sample_embedding_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.plan(samples.nodes(spark)).select("path", "level")


@query("""
SELECT * FROM (VALUES ('call-off-schedule-9/b/annex-1', 1, 1, 0.693147), ('call-off-schedule-9/a/3/3.4', 2, 2, 2.197225), ('call-off-schedule-9/b/3/3.4', 1, 1, 0.693147), ('core-terms/1/1.2', 1, 1, 0.693147), ('joint-schedule-1', 1, 1, 0.693147),
 ('core-terms/2/2.1/a', 1, 1, 0.693147), ('core-terms/2/2.1', 1, 1, 0.693147), ('core-terms/2/2.3', 1, 1, 0.693147), ('call-off-schedule-9', 1, 1, 0.693147)) t(path, frequency, breadth, salience)
""")
def sample_salience(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The provisions that others cite; all else has no salience."""
    nodes, refs = _references(spark)
    rows = graph.node_salience(nodes, refs).where("frequency > 0 or salience > 0 or flagged")
    return rows.join(nodes.select(F.col("id").alias("target"), "path"), "target").select("path", F.col("frequency").cast("int").alias("frequency"), F.col("breadth").cast("int").alias("breadth"), F.col("salience").cast("decimal(7,6)").alias("salience"))


@query(_rows(expected.EDGES))
def sample_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, refs = _references(spark)
    edges = graph.contains_edges(nodes).unionByName(graph.next_edges(nodes)).unionByName(graph.resolves_edges(refs, nodes)).unionByName(graph.candidate_edges(refs, nodes))
    return edges.groupBy("type").agg(F.count("*").alias("n"))


@query("SELECT * FROM (VALUES ('core-terms', 1, 2), ('joint-schedule-1-definitions', 3, 4)) t(part_id, page_start, page_end)")
def sample_layout_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = layout.split_furniture(samples.lines(spark), samples.pages(spark))
    return layout.detect_parts(layout.page_signatures(split)).select("part_id", "page_start", "page_end")


@query(_rows(expected.BLOCKS))
def sample_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = layout.split_furniture(samples.lines(spark), samples.pages(spark)).where("not is_furniture").select(*samples.lines(spark).columns)
    return tree.build(layout.build_blocks(split)).drop("anomalies")


@query(_rows(expected.FIND))
def sample_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.find_provision(sample_graph(spark), "withhold charges")


@query(_rows(expected.DEFINE))
def sample_define(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.define(sample_graph(spark), "KPI").select("term", "scope", "path", "gap", F.array_join("governs", ",").alias("governs"))


@query(_rows(expected.REVIEW))
def sample_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.review_queue(sample_graph(spark)).select("kind", "part", "page", "id", "question")
