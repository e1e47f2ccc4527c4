"""Trees of provisions as flat rows: hierarchy without recursion.

A node's ancestors are the prefixes of its path, so that every step up or down is an
equality join on exploded prefixes and never a comparison of all pairs of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexweave.functions import ids

# What a part's clauses are called, by its family.
UNIT_BY_FAMILY = {"core_terms": "Clause", "framework_schedule": "Paragraph", "joint_schedule": "Paragraph", "call_off_schedule": "Paragraph", "form": "Row"}


def prefixes(path: Column | str, own: bool = False) -> Column:
    """All proper prefixes of a path by whole segments, shortest first; with the path itself if own."""
    parts = F.split(F.col(path) if isinstance(path, str) else path, "/")
    last = F.size(parts) if own else F.size(parts) - 1
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))).otherwise(F.array().cast("array<string>"))


def part_of(path: Column | str) -> Column:
    return F.split_part(F.col(path) if isinstance(path, str) else path, F.lit("/"), F.lit(1))


def section_of(path: Column | str) -> Column:
    """The child of the part under which a node stands, or the part."""
    c = F.col(path) if isinstance(path, str) else path
    return F.array_join(F.slice(F.split(c, "/"), 1, 2), "/")


def ancestors(nodes: DataFrame) -> DataFrame:
    """(path, ancestor, up): every existing ancestor of every node; up is 1 for the parent's level."""
    size = F.size(F.split("path", "/"))
    up = nodes.select("path", size.alias("n"), F.posexplode(prefixes("path")).alias("i", "ancestor"))
    return up.join(nodes.select(F.col("path").alias("ancestor")).distinct(), "ancestor", "left_semi").select("path", "ancestor", (F.col("n") - F.col("i") - 1).alias("up"))


def descendants(nodes: DataFrame, path: str) -> DataFrame:
    """The node of a path and all below it."""
    return nodes.where((F.col("path") == path) | F.col("path").startswith(path + "/"))


def closure(nodes: DataFrame) -> DataFrame:
    """(top, path): each node with itself and with each of its ancestors."""
    return nodes.select(F.explode(prefixes("path", own=True)).alias("top"), "path").join(nodes.select(F.col("path").alias("top")).distinct(), "top", "left_semi")


def children(nodes: DataFrame) -> DataFrame:
    return nodes.where("kind <> 'ref'")


def leaves(nodes: DataFrame) -> DataFrame:
    """Nodes without anatomy children."""
    own = children(nodes)
    return own.join(own.select(F.col("parent_path").alias("path")).where("path is not null").distinct(), "path", "left_anti")


def _gathered(nodes: DataFrame, item: Column, separator: str, name: str) -> DataFrame:
    down = closure(children(nodes)).join(children(nodes).select("path", "ord", item.alias("piece")), "path").where("piece is not null and piece <> ''")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("ord", "path", "piece"))), lambda x: x["piece"])
    return down.groupBy(F.col("top").alias("path")).agg(F.array_join(texts, separator).alias(name))


def subtree_text(nodes: DataFrame) -> DataFrame:
    """(path, subtree_text): titles and texts in preorder, joined by a space."""
    return _gathered(nodes, F.concat_ws(" ", F.nullif("title", F.lit("")), F.nullif("text", F.lit(""))), " ", "subtree_text")


def derived_text(nodes: DataFrame) -> DataFrame:
    """(path, derived_text): texts alone, joined by a line feed."""
    return _gathered(nodes, F.col("text"), "\n", "derived_text")


def scan_units(nodes: DataFrame) -> DataFrame:
    """Parts and their direct children."""
    return children(nodes).where(F.size(F.split("path", "/")) <= 2)


def provisions_of(nodes: DataFrame, unit: str) -> DataFrame:
    return descendants(children(nodes), unit).where("citable and (text is not null or title is not null)")


def preorder(nodes: DataFrame) -> DataFrame:
    """The nodes with ord, their place in a walk of their part; siblings stand by sib_no."""
    order = closure(nodes).join(nodes.select(F.col("path").alias("top"), F.col("sib_no").alias("place"), F.size(F.split("path", "/")).alias("level")), "top")
    walk = order.groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("level", "place"))), lambda x: F.coalesce(x["place"], F.lit(0))).alias("walk"))
    own = Window.partitionBy(part_of("path")).orderBy("walk", "path")
    return nodes.drop("ord").join(walk, "path").withColumn("ord", F.row_number().over(own) - 1).drop("walk")


def extents(nodes: DataFrame) -> DataFrame:
    """(path, page, x0, y0, x1, y1): the union of the boxes of a node and all below it, page by page."""
    boxes = nodes.where("kind <> 'ref'").select("path", F.inline("bboxes_own"))
    down = closure(nodes).join(boxes, "path")
    return down.groupBy(F.col("top").alias("path"), "page").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def page_ranges(nodes: DataFrame) -> DataFrame:
    return closure(nodes).join(nodes.select("path", "page_start", "page_end"), "path").groupBy(F.col("top").alias("path")).agg(F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"))


def kind_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("part", "kind").agg(F.count("*").alias("n"), F.sum(F.coalesce(F.size("anomalies"), F.lit(0))).alias("n_anomalies"))


def stem_names(nodes: DataFrame, stem: str = "stem") -> DataFrame:
    """Sibling names of equal stems: intro, intro-2, intro-3."""
    n = F.row_number().over(Window.partitionBy("parent_path", stem).orderBy("ord"))
    return nodes.withColumn("name", F.when(n == 1, F.col(stem)).otherwise(F.concat_ws("-", F.col(stem), n.cast("string"))))


def unit_labels(nodes: DataFrame) -> DataFrame:
    """unit_label by the part's family and where it came from."""
    table = F.create_map(*(F.lit(x) for pair in UNIT_BY_FAMILY.items() for x in pair))
    families = nodes.where("kind = 'part'").select(F.col("path").alias("part"), F.col("part_family").alias("family"))
    named = nodes.drop("unit_label", "unit_label_source").join(families, "part", "left")
    label = F.when(F.col("kind").isin("clause", "subclause"), table[F.col("family")])
    return named.withColumn("unit_label", label).withColumn("unit_label_source", F.when(label.isNotNull(), "family")).drop("family")


def human_names(nodes: DataFrame) -> DataFrame:
    """(path, name): the part's title and the deepest label at or above the node; items carry their clause's."""
    labelled = nodes.select(F.col("path").alias("top"), "kind", "unit_label", "label", "title", F.size(F.split("path", "/")).alias("level")).withColumnRenamed("kind", "k")
    up = closure(children(nodes)).join(labelled, "top")
    shown = F.when(F.col("k") == "item", F.col("label")).otherwise(F.concat_ws(" ", "unit_label", "label"))
    marks = up.groupBy("path").agg(
        F.max(F.when(F.col("k") == "part", F.coalesce("title", "top"))).alias("part_title"),
        F.max_by(shown, F.when(F.col("label").isNotNull() & ~F.col("k").isin("part", "item", "cell", "intro"), F.col("level"))).alias("clause"),
        F.max_by(shown, F.when((F.col("k") == "item") & F.col("label").isNotNull(), F.col("level"))).alias("item"),
    )
    return marks.select("path", F.concat_ws(", ", "part_title", F.nullif(F.trim(F.concat(F.coalesce("clause", F.lit("")), F.coalesce("item", F.lit("")))), F.lit(""))).alias("name"))


def stamped(nodes: DataFrame, violations: DataFrame) -> DataFrame:
    """Violations noted on their nodes: explained ones by their reason, others as unresolved."""
    note = F.when(F.col("reason").isNotNull(), F.concat_ws("_", "check", "reason")).otherwise(F.concat(F.lit("unresolved_"), "check"))
    notes = violations.groupBy("path").agg(F.array_sort(F.collect_list(F.concat(note, F.lit(": "), F.coalesce("detail", F.lit(""))))).alias("notes"))
    none = F.array().cast("array<string>")
    return nodes.join(notes, "path", "left").withColumn("anomalies", F.concat(F.coalesce("anomalies", none), F.coalesce("notes", none))).drop("notes")


def to_json(nodes: DataFrame) -> DataFrame:
    """One JSON text a node, without nulls and empty lists."""
    cleared = [F.when(F.size(c) > 0, F.col(c)).alias(c) if t.startswith("array") else F.col(c) for c, t in nodes.dtypes]
    return nodes.select("path", F.to_json(F.struct(*cleared)).alias("json"))


def table_nodes(cells: DataFrame) -> DataFrame:
    """Nodes of tables and their cells from (parent_path, table_no, row, col, text, role, confidence)."""
    table = F.concat_ws("/", "parent_path", F.concat(F.lit("table-"), F.col("table_no").cast("string")))
    rows = cells.select(table.alias("parent"), "parent_path", "row", "col", "text", "role", "confidence")
    own = rows.groupBy("parent", "parent_path").agg((F.max("row") + 1).alias("n_rows"), (F.max("col") + 1).alias("n_cols"))
    tables = own.select(F.col("parent").alias("path"), "parent_path", F.lit("table").alias("kind"), F.lit(None).cast("string").alias("text"), "n_rows", "n_cols", *(F.lit(None).cast(t).alias(c) for c, t in (("row", "int"), ("col", "int"), ("cell_role", "string"), ("role_confidence", "double"))))
    inner = rows.select(F.concat_ws("/", "parent", F.col("row").cast("string"), F.col("col").cast("string")).alias("path"), F.col("parent").alias("parent_path"), F.lit("cell").alias("kind"), "text", F.lit(None).cast("int").alias("n_rows"), F.lit(None).cast("int").alias("n_cols"), "row", "col", F.col("role").alias("cell_role"), F.col("confidence").alias("role_confidence"))
    return tables.unionByName(inner)


BUILT = "part string, path string, parent_path string, kind string, label string, title string, text string, depth int, ord int, sib_no int, page_start int, page_end int, anomalies array<string>"


def _assembled(part: str, blocks: pd.DataFrame) -> list[tuple]:
    """One part's nodes from its blocks in order.

    An open branch takes blocks of greater depth; a top number that does not grow opens a
    new scope; prose is a preamble before any number and joins the open leaf after one.
    """
    levels = {1: "clause", 2: "subclause"}
    nodes: list[dict] = [{"path": part, "parent": None, "kind": "part", "label": None, "title": None, "text": None, "depth": 0, "notes": [], "first": None, "last": None}]
    stack, scope, scopes, last_top = [nodes[0]], nodes[0], 0, 0

    def add(parent: dict, name: str, **kw) -> dict:
        taken = {n["path"] for n in nodes}
        path, k = f"{parent['path']}/{name}", 2
        while path in taken:
            path, k = f"{parent['path']}/{name}-{k}", k + 1
        nodes.append({"path": path, "parent": parent, "label": None, "title": None, "text": None, "notes": [], "first": kw.pop("page"), "last": None} | kw)
        nodes[-1]["last"] = nodes[-1]["first"]
        return nodes[-1]

    for b in blocks.sort_values("idx").itertuples():
        page, text = int(b.page_start), b.text if isinstance(b.text, str) else ""
        if b.block_kind == "number":
            depth, number = int(b.depth), str(b.number)
            if depth == 1 and number.split(".")[0].isdigit():
                top = int(number.split(".")[0])
                if top <= last_top:
                    scopes += 1
                    scope = add(nodes[0], f"part-{scopes + 1}", kind="heading", depth=0, page=page)
                    stack = [nodes[0], scope]
                last_top = top
            while len(stack) > 1 and stack[-1]["depth"] >= depth and stack[-1] is not scope:
                stack.pop()
            parent = stack[-1]
            if parent["text"]:
                add(parent, "intro", kind="intro", depth=parent["depth"] + 1, text=parent["text"], page=parent["first"])
                parent["text"] = None
            name = number.strip("()") if depth > 2 else number
            node = add(parent, name, kind="item" if depth > 2 else levels.get(depth, "clause"), depth=depth, label=number, page=page, **({"title": text} if b.heading_like else {"text": text}))
            stack.append(node)
        elif b.block_kind == "title":
            nodes[0]["title"] = nodes[0]["title"] or text
        elif len(stack) == 1:
            add(nodes[0], "preamble", kind="preamble", depth=1, text=text, page=page)
        else:
            stack[-1]["text"] = f"{stack[-1]['text']} {text}" if stack[-1]["text"] else text
            stack[-1]["last"] = page
    kids: dict[str, int] = {}
    index = {n["path"]: n for n in nodes}
    children_of: dict[str, list[str]] = {}
    for n in nodes[1:]:
        children_of.setdefault(n["parent"]["path"], []).append(n["path"])
    for n in nodes:  # lead-in text of a branch moves to an intro
        if n["text"] and children_of.get(n["path"]):
            intro = {"path": f"{n['path']}/intro", "parent": n, "kind": "intro", "label": None, "title": None, "text": n["text"], "depth": n["depth"] + 1, "notes": [], "first": n["first"], "last": n["last"]}
            n["text"] = None
            if intro["path"] not in index:
                index[intro["path"]] = intro
                children_of[n["path"]].insert(0, intro["path"])
    out, todo = [], [part]
    while todo:
        path = todo.pop()
        n = index[path]
        up = n["parent"]["path"] if n["parent"] else None
        kids[up] = kids.get(up, -1) + 1
        out.append((part, path, up, n["kind"], n["label"], n["title"], n["text"], n["depth"], len(out), kids[up], n["first"], n["last"], n["notes"]))
        todo += reversed(children_of.get(path, []))
    return out


def build(blocks: DataFrame) -> DataFrame:
    """Nodes of every part from its blocks (part, idx, block_kind, number, depth, heading_like, text, page_start).

    The order of blocks decides, so a part is one group; parts are independent and small.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_assembled(pdf["part"].iloc[0], pdf), columns=[c.split()[0] for c in BUILT.split(", ")])

    return blocks.groupBy("part").applyInPandas(run, BUILT)


def identified(nodes: DataFrame, document: str, version: str) -> DataFrame:
    """Nodes with id, lineage key and content hash."""
    rows = nodes.withColumn("document", F.lit(document)).withColumn("version", F.lit(version))
    return rows.withColumns({"id": ids.node_id("document", "version", "path"), "lineage_key": ids.lineage_key("document", "path"), "content_hash": F.when(F.col("text").isNotNull(), ids.content_hash("text"))})


def flatten(texts: DataFrame) -> DataFrame:
    """Node rows of nested JSON trees, one text a row; children nest under 'children'."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        columns = [c.split()[0] for c in BUILT.split(", ")]
        for pdf in batches:
            rows = []
            for value in pdf["value"]:
                try:
                    root = json.loads(value)
                except ValueError:
                    continue
                todo, n = [(root, None, 0, 0)], 0
                while todo:
                    node, parent, depth, place = todo.pop()
                    part = node["path"].split("/")[0]
                    rows.append((part, node["path"], parent, node["kind"], node.get("label"), node.get("title"), node.get("text"), depth, n, place, node.get("page_start"), node.get("page_end"), node.get("anomalies", [])))
                    n += 1
                    todo += [(c, node["path"], depth + 1, i) for i, c in reversed(list(enumerate(node.get("children", []))))]
            yield pd.DataFrame(rows, columns=columns).astype({"page_start": "Int32", "page_end": "Int32"})

    return texts.select("value").mapInPandas(run, BUILT)
