"""A small invented contract as tables: every structural case that the operators must cover."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

from lexweave import schemas

DOCUMENT, VERSION = "sample-deed", "v1.0"

#: path, kind, label, title, text; more fields by name.
ROWS: list[tuple] = [
    ("core-terms", "part", None, "Core Terms", None, {"part_family": "core_terms", "template_version": "v1.0"}),
    ("core-terms/preamble", "preamble", None, None, "In each Contract the following words shall have the following meanings unless stated."),
    ("core-terms/1", "heading", "1.", "Supply of widgets", None),
    ("core-terms/1/1.1", "clause", "1.1", None, None),
    ("core-terms/1/1.1/intro", "intro", None, None, "The Supplier must, subject to Clauses 2.1 to 2.3 and Schedule 6:"),
    ("core-terms/1/1.1/a", "item", "(a)", None, "deliver every Widget under Joint Schedule 1 (Definitions) and Clause 2.1(a);"),
    ("core-terms/1/1.1/b", "item", "(b)", None, "comply with Law. Section 55 of the Patents Act 1977 and Regulation (EU) 2016/679 apply."),
    ("core-terms/1/1.2", "clause", "1.2", None, "This Clause and that Schedule bind the Supplier under Paragraph 3.4 of Call-Off Schedule 9."),
    ("core-terms/2", "heading", "2.", "Price", None),
    ("core-terms/2/2.1", "clause", "2.1", None, None),
    ("core-terms/2/2.1/a", "item", "(a)", None, "The Buyer pays the Charges within thirty days."),
    ("core-terms/2/2.1/b", "item", "(b)", None, "No schedule of rates applies; see Clause 9.9 of the Core Terms."),
    ("core-terms/2/2.3", "clause", "2.3", None, "The Buyer may withhold Charges under Framework Schedule 4.", {"anomalies": ["numbering_gap: 2.2 is not printed"]}),
    ("core-terms/3", "heading", "3.", "General", "[Insert name of the agent]"),
    ("joint-schedule-1", "part", None, "Joint Schedule 1 (Definitions)", None, {"part_family": "joint_schedule", "template_version": "v1.0"}),
    ("joint-schedule-1/1", "clause", "1", None, "In each Contract the following definitions apply:"),
    ("joint-schedule-1/table-0", "table", None, None, None, {"n_rows": 4, "n_cols": 2}),
    *[
        (f"joint-schedule-1/table-0/{r}/{c}", "cell", None, None, text, {"row": r, "col": c, "cell_role": ("label", "value")[c], "role_confidence": 0.7})
        for r, pair in enumerate([
            ('"Supplier"', "means the person named in the Order Form;"),
            ('"Charges"', "has the meaning given in Schedule 4;"),
            ('"Key Performance Indicator" ("KPI")', "means a measure of the Supplier;"),
            ('"Widget"', "means a part that the Supplier makes;"),
        ])
        for c, text in enumerate(pair)
    ],
    ("call-off-schedule-9", "part", None, "Call-Off Schedule 9 (Security)", None, {"part_family": "call_off_schedule", "template_version": "v1.0"}),
    ("call-off-schedule-9/a", "heading", None, "Part A: Short form", None),
    ("call-off-schedule-9/a/3", "clause", "3", None, None),
    ("call-off-schedule-9/a/3/3.4", "subclause", "3.4", None, "See paragraph 3.4 and Annex 1 of this Schedule. Confidential text stays confidential."),
    ("call-off-schedule-9/b", "heading", None, "Part B: Long form", None),
    ("call-off-schedule-9/b/2", "clause", "2", None, 'In this Schedule "Breach" means a loss of data of the Supplier.'),
    ("call-off-schedule-9/b/3", "clause", "3", None, None),
    ("call-off-schedule-9/b/3/3.4", "subclause", "3.4", None, "Every Breach is told under Paragraph 3.4 and Clause 1.2. KPIs and Widgets count. Supplier staff must act."),
    ("call-off-schedule-9/b/annex-1", "heading", None, "Annex 1: Baseline", "Confidential text stays confidential."),
    ("form-1", "part", None, "Order Form", None, {"part_family": "form", "template_version": "v1.0"}),
    ("form-1/1", "form_row", "1", "Agent", "[Insert agent]"),
    ("form-1/2", "form_row", "2", "Notes", "Confidential text stays confidential.", {"anomalies": ["stray_character: 'nsert' for 'Insert'"]}),
]

REGISTRY = [("framework-schedule-4", "Framework Schedule 4 (Charges)"), ("call-off-schedule-6", "Call-Off Schedule 6 (Exit)")]


def _sha(*parts: str) -> str:
    return hashlib.sha1("|".join(parts).encode()).hexdigest()


def node_rows() -> list[dict]:
    fields = [c.name for c in schemas.struct(schemas.NODES)]
    rows, siblings, order = [], {}, {}
    for i, (path, kind, label, title, text, *more) in enumerate(ROWS):
        parent = path.rsplit("/", 1)[0] if "/" in path else None
        while parent is not None and parent not in {r[0] for r in ROWS}:
            parent = parent.rsplit("/", 1)[0]
        part = path.split("/")[0]
        row = dict.fromkeys(fields) | {"document": DOCUMENT, "version": VERSION, "path": path, "parent_path": parent, "part": part, "kind": kind, "label": label, "title": title, "text": text}
        order[part] = order.get(part, -1) + 1
        siblings[parent] = siblings.get(parent, -1) + 1
        depth = path.count("/")
        box = {"page": 1 + list(dict.fromkeys(r[0].split("/")[0] for r in ROWS)).index(part), "x0": 50.0 + 10 * depth, "y0": 60.0 + 20 * order[part], "x1": 500.0, "y1": 75.0 + 20 * order[part]}
        clean = None if text is None else "\n".join(re.sub(r"\s+", " ", line).strip() for line in text.split("\n")).strip()
        row |= {
            "id": _sha(DOCUMENT, VERSION, path), "lineage_key": _sha(DOCUMENT, path), "content_hash": None if text is None else hashlib.sha1(clean.encode()).hexdigest(),
            "citable": kind not in ("intro", "ref", "part"), "page_start": box["page"], "page_end": box["page"], "printed_page": str(box["page"]), "ord": order[part], "sib_no": siblings[parent], "depth": depth,
            "bboxes_own": [] if kind == "part" else [box], "bboxes_extent": [], "anomalies": [], "batch_id": "B1" if i % 2 else "B2",
        }
        rows.append(row | (more[0] if more else {}))
    return rows


def nodes(spark: SparkSession) -> DataFrame:
    schema = schemas.struct(schemas.NODES)
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in node_rows()], schema)


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGISTRY, "part_id string, title string")


def lines(spark: SparkSession) -> DataFrame:
    """Four pages of lines: running headers and footers, numbered blocks, wrapped prose, a misnumbered clause."""
    out = []
    body = {
        1: ["1. Supply", "1.1 The Supplier delivers widgets", "in good time.", "(a) by road; or", "(b) by rail."],
        2: ["1.2 Delivery is free.", "2. Price", "2.1 The Buyer pays.", "§ 2.2 odd"],
        3: ["1. Meanings", "1.1 A widget is a part.", "1.1.1.1 deep number"],
        4: ["1.2 A part is a thing.", "12) stray", "2. Last"],
    }
    for page, texts in body.items():
        title = "Core Terms" if page < 3 else "Joint Schedule 1 (Definitions)"
        out.append((title, page, 0, 50.0, 20.0, 200.0, 32.0, title, 9.0, False))
        out.append((title, page, 1, 50.0, 36.0, 200.0, 46.0, "Version: 3.0", 9.0, False))
        for i, t in enumerate(texts):
            top = re.match(r"^\d+\. ", t) is not None
            out.append((title, page, 2 + i, 50.0 if top else 70.0 if re.match(r"^\d+\.\d", t) else 90.0, 100.0 + 20 * i, 400.0, 112.0 + 20 * i, t, 12.0 if top else 10.0, top))
        out.append((title, page, 20, 280.0, 780.0, 300.0, 790.0, str(page), 9.0, False))
    return spark.createDataFrame([("core-terms" if o[0] == "Core Terms" else "joint-schedule-1", *o[1:]) for o in out], schemas.LINES)


def pages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p, 595.0, 842.0) for p in (1, 2, 3, 4)], "page int, width double, height double")
