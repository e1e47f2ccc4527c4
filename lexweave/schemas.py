"""Tables of a document graph, as schemas and one validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The kinds of nodes, references and statuses.
KINDS = ("document", "part", "heading", "preamble", "clause", "subclause", "item", "intro", "form_row", "table", "cell", "ref")
STATUSES = ("resolved", "ambiguous", "unresolved", "external")
NEVER_CITABLE = ("intro", "ref")

BOXES = "array<struct<page:int,x0:double,y0:double,x1:double,y1:double>>"
NODES = (
    "id string, lineage_key string, content_hash string, document string, version string, part string, path string, parent_path string, kind string, "
    "unit_label string, unit_label_source string, label string, title string, text string, printed_page string, citable boolean, page_start int, page_end int, "
    f"ord int, sib_no int, depth int, bboxes_own {BOXES}, bboxes_extent {BOXES}, anomalies array<string>, batch_id string, part_family string, template_version string, "
    "n_rows int, n_cols int, row int, col int, cell_role string, role_confidence double"
)
CANDIDATES = "array<struct<path:string,score:double,reason:string>>"
REFS = (
    "id string, path string, parent_path string, part string, text string, char_span struct<start:int,end:int>, group_id string, ref_kind string, scope_rule string, "
    f"status string, target_path string, candidates {CANDIDATES}, confidence double, resolver string, batch_id string"
)
LINES = "part string, page int, line_no int, x0 double, y0 double, x1 double, y1 double, text string, size_max double, bold boolean"
DEFINITION_SITES = "term string, definition_node_id string, source string, scope string, aliases array<string>, pointer string"
TERM_USES = "term string, node_id string, char_span struct<start:int,end:int>, status string, ambiguity_kind string, method string, definition_used string"
CONCEPTS = "id string, label string, scope_path string, member_node_ids array<string>, relations array<struct<src:string,label:string,dst:string>>, llm_derived boolean, confidence double"
EDGES = "type string, src string, dst string, props map<string,string>, batch_id string"
GOLDEN = "kind string, path string, node_id string, char_span struct<start:int,end:int>, verdict string, chosen_candidate string, anomaly_index int, reviewer string, ts string, file_no int, line_no int"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def empty(spark, ddl: str) -> DataFrame:
    return spark.createDataFrame([], struct(ddl))


def validate_nodes(nodes: DataFrame) -> DataFrame:
    """(id, path, rule) for every broken rule of a node: fields of another kind, branch and leaf at once, and so on."""
    kids = nodes.where("kind <> 'ref'").groupBy(F.col("parent_path").alias("path")).agg(F.count("*").alias("n_kids"))
    n = nodes.join(kids, "path", "left").withColumn("n_kids", F.coalesce("n_kids", F.lit(0)))
    has = lambda c: F.col(c).isNotNull()
    rules = {
        "unknown_kind": ~F.col("kind").isin(*KINDS),
        "branch_or_leaf": (F.col("n_kids") > 0) & has("text"),
        "citable_intro_or_ref": F.col("kind").isin(*NEVER_CITABLE) & F.col("citable"),
        "intro_without_text": (F.col("kind") == "intro") & ~has("text"),
        "intro_with_label": (F.col("kind") == "intro") & has("label"),
        "cell_without_place": (F.col("kind") == "cell") & ~(has("row") & has("col")),
        "place_outside_cell": (F.col("kind") != "cell") & (has("row") | has("col") | has("cell_role") | has("role_confidence")),
        "table_without_size": (F.col("kind") == "table") & ~(has("n_rows") & has("n_cols")),
        "size_outside_table": (F.col("kind") != "table") & (has("n_rows") | has("n_cols")),
        "part_field_outside_part": (F.col("kind") != "part") & (has("part_family") | has("template_version")),
        "hash_without_text": has("content_hash") & ~has("text"),
        "document_below_root": (F.col("kind") == "document") & has("parent_path"),
        "page_range": F.col("page_start") > F.col("page_end"),
    }
    return n.select("id", "path", F.explode(F.filter(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules.items())), lambda r: r.isNotNull())).alias("rule"))
