"""From lines on pages to blocks: furniture, parts, numbering, tables, and the checks that a rulebook fits."""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Bands, slots and repetitions of furniture; numbering of the default rulebook; thresholds.
HEADER, FOOTER, SLOT, REPEATS = 0.09, 0.89, 6.0, 3
BOILERPLATE = r"(?i)^\s*(?:Crown Copyright|Version\s*:|Model Version\s*:|Project Version\s*:|Framework Ref\s*:|Call-Off Ref\s*:|Order Ref\s*:|\d+)\s*"
VERSIONS = {"model": r"^\s*Model Version\s*:\s*(\S.*?)\s*$", "header": r"^\s*Version\s*:\s*(\S.*?)\s*$", "project": r"^\s*Project Version\s*:\s*(\S.*?)\s*$"}
RULES = {
    "heading": (1, r"^\s{0,4}(\d{1,2})\.\s+(?=[A-Z\[])"),
    "clause": (2, r"^\s{0,10}(\d{1,2}\.\d{1,2})\.?\s+"),
    "subclause": (3, r"^\s{0,12}(\d{1,2}\.\d{1,2}\.\d{1,2})\.?\s+"),
    "item_dotted": (4, r"^\s{0,14}(\d{1,2}\.\d{1,2}\.\d{1,2}\.\d{1,2})\.?\s+"),
    "item": (4, r"^\s*\(?([a-z]{1,2}|(?:x{0,3})(?:ix|iv|v?i{0,3}))\)\s"),
    "item_upper": (4, r"^\s*\(([A-Z])\)\s"),
}
HEADING_BARE = r"^\s{0,4}(\d{1,2})\.\s*$"
NUMBERED = r"^\s*(?:\(?(?:[a-z]{1,3}|[A-Z]|[ivxlcdm]{1,6})\)|\d{1,3}(?:\.\d{1,3})*\.?)\s+\S"
OVERLAP, INDENT, SUPPORT, MIN_STEP, GAP, MAX_DEPTH = 0.5, 3.0, 0.05, 6.0, 1.8, 4
LIMITS = {"unmatched_rate": 0.05, "orphan_ink_share": 0.10, "indent_disagreement": 0.05, "depth_out_of_range": 0.0}


def band(height: str = "height") -> Column:
    return F.when(F.col("y1") <= HEADER * F.col(height), "header").when(F.col("y0") >= FOOTER * F.col(height), "footer")


def repetitions(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(key, pages): distinct pages of each text form (digits as #) and of each 6-point slot in the bands."""
    rows = lines.join(pages.select("page", "height"), "page").withColumn("band", band()).where("band is not null")
    form = F.regexp_replace(F.trim(F.regexp_replace("text", r"\s+", " ")), r"\d+", "#")
    slot = F.concat_ws(":", "band", F.floor(F.col("x0") / SLOT).cast("string"), F.floor(F.col("y0") / SLOT).cast("string"))
    return rows.select("page", F.explode(F.array(form, slot)).alias("key")).where("key <> ''").groupBy("key").agg(F.count_distinct("page").alias("pages"))


def split_furniture(lines: DataFrame, pages: DataFrame, least: int = REPEATS) -> DataFrame:
    """The lines with band and is_furniture: in a band and repeated as text, or, in a header that has such a text, as a slot."""
    rows = lines.join(pages.select("page", "height"), "page").withColumn("band", band())
    form = F.regexp_replace(F.trim(F.regexp_replace("text", r"\s+", " ")), r"\d+", "#")
    slot = F.concat_ws(":", "band", F.floor(F.col("x0") / SLOT).cast("string"), F.floor(F.col("y0") / SLOT).cast("string"))
    often = repetitions(lines, pages).where(F.col("pages") >= least).select("key")
    rows = rows.withColumns({"form": form, "slot": slot})
    rows = rows.join(often.select(F.col("key").alias("form"), F.lit(True).alias("by_text")), "form", "left").join(often.select(F.col("key").alias("slot"), F.lit(True).alias("by_slot")), "slot", "left")
    text = F.col("band").isNotNull() & F.coalesce("by_text", F.lit(False))
    running = F.max(text.cast("int")).over(Window.partitionBy("page")) == 1
    return rows.withColumn("is_furniture", text | ((F.col("band") == "header") & F.coalesce("by_slot", F.lit(False)) & running)).fillna(False, ["is_furniture"]).drop("form", "slot", "by_text", "by_slot")


def page_signatures(split: DataFrame) -> DataFrame:
    """(page, title, printed_page, versions): what a page's furniture says."""
    own = split.where("is_furniture")
    shown = F.when((F.col("band") == "header") & ~F.col("text").rlike(BOILERPLATE) & (F.trim("text") != ""), F.trim("text"))
    named = {f"{k}_version": F.max(F.nullif(F.regexp_extract("text", p, 1), F.lit(""))) for k, p in VERSIONS.items()}
    return split.select("page").distinct().join(own.groupBy("page").agg(F.min_by(shown, F.when(shown.isNotNull(), F.struct(F.round("y0", 2), F.round("x0", 2)))).alias("title"), F.max(F.nullif(F.regexp_extract("text", r"^\s*(\d{1,4})\s*$", 1), F.lit(""))).alias("printed_page"), *(v.alias(k) for k, v in named.items())), "page", "left")


def version_key(raw: Column | str) -> Column:
    """v-prefixed and without spaces; v0 for none."""
    c = F.regexp_replace(F.col(raw) if isinstance(raw, str) else raw, r"\s+", "")
    return F.when(c.isNull() | (c == ""), "v0").otherwise(F.concat(F.lit("v"), F.regexp_replace(c, "^[vV]", "")))


def slugged(title: Column | str) -> Column:
    c = F.col(title) if isinstance(title, str) else title
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))


def detect_parts(signatures: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(part_id, title, page_start, page_end, version): runs of pages with one title; no title continues, repeats get -2.

    keys tell documents apart; the pages of a document are ordered by a window over their signatures, a short
    row a page.
    """
    order = Window.partitionBy(*(keys or (F.lit(0),))).orderBy("page")
    filled = signatures.withColumn("t", F.last("title", True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    isle = filled.withColumn("new", F.coalesce(~F.col("t").eqNullSafe(F.lag("t").over(order)), F.lit(True)).cast("int")).withColumn("isle", F.sum("new").over(order))
    runs = isle.where("t is not null").groupBy(*keys, "isle").agg(F.first("t").alias("title"), F.min("page").alias("page_start"), F.max("page").alias("page_end"), F.min(F.coalesce("header_version", "model_version")).alias("raw"), (F.count_distinct("header_version") > 1).alias("version_change"))
    slug = slugged("title")
    n = F.row_number().over(Window.partitionBy(*keys, "slug").orderBy("page_start"))
    return runs.withColumn("slug", slug).withColumn("n", n).select(*keys, F.when(F.col("n") == 1, F.col("slug")).otherwise(F.concat_ws("-", "slug", "n")).alias("part_id"), "title", family_of(F.col("title")).alias("family"), "page_start", "page_end", version_key("raw").alias("template_version"), "version_change")


def family_of(title: Column) -> Column:
    return F.when(title.rlike(r"(?i)^core terms"), "core_terms").when(title.rlike(r"(?i)framework schedule"), "framework_schedule").when(title.rlike(r"(?i)joint schedule"), "joint_schedule").when(title.rlike(r"(?i)call-off schedule"), "call_off_schedule").when(title.rlike(r"(?i)form"), "form").otherwise("other")


def number_match(text: Column | str, rules: dict[str, tuple[int, str]] = RULES) -> Column:
    """The deepest rule that a line's start matches, as (depth, own, key, level, number); own names beat variants."""
    c = F.col(text) if isinstance(text, str) else text
    hits = [F.when(c.rlike(p), F.struct(F.lit(d).alias("depth"), F.lit(int("_" not in k)).alias("own"), F.lit(k).alias("key"), F.lit(k.split("_")[0]).alias("level"), F.regexp_extract(c, p, 1).alias("number"))) for k, (d, p) in rules.items()]
    return F.array_max(F.filter(F.array(*hits), lambda h: h.isNotNull()))


def looks_numbered(text: Column | str) -> Column:
    return (F.col(text) if isinstance(text, str) else text).rlike(NUMBERED)


def rulebook_scores(lines: DataFrame, rulebooks: dict[str, dict[str, tuple[int, str]]]) -> DataFrame:
    """(rulebook, numbered, matched, coverage), best first; the books are few and each is a pair of columns."""
    counts = [F.count_if(looks_numbered("text")).alias("numbered"), *(F.count_if(looks_numbered("text") & number_match("text", r).isNotNull()).alias(n) for n, r in rulebooks.items())]
    names = ", ".join(f"'{n}', `{n}`" for n in rulebooks)
    rows = lines.agg(*counts).selectExpr("numbered", f"stack({len(rulebooks)}, {names}) as (rulebook, matched)")
    return rows.withColumn("coverage", F.round(F.try_divide("matched", "numbered"), 6)).orderBy(F.desc("coverage"), F.desc("matched"), "rulebook")


def numbering_coverage(lines: DataFrame, examples: int = 5) -> DataFrame:
    """(part, numbered, unmatched, rate, examples): lines that look numbered and match no rule."""
    rows = lines.where(looks_numbered("text")).withColumn("missed", number_match("text").isNull())
    n = F.row_number().over(Window.partitionBy("part", "missed").orderBy("page", "line_no"))
    shown = rows.withColumn("n", n).where(F.col("missed") & (F.col("n") <= examples)).groupBy("part").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda x: x["text"]).alias("examples"))
    t = rows.groupBy("part").agg(F.count("*").alias("numbered"), F.count_if("missed").alias("unmatched"))
    return t.join(shown, "part", "left").withColumn("rate", F.round(F.col("unmatched") / F.col("numbered"), 6))


def number_styles(lines: DataFrame) -> DataFrame:
    style = F.when(F.col("text").rlike(r"^\s*\d+(\.\d+)+"), "dotted").when(F.col("text").rlike(r"^\s*\d+\."), "top").when(F.col("text").rlike(r"^\s*\("), "bracketed").when(F.col("text").rlike(r"^\s*[a-z]+\)"), "half_bracketed").otherwise("other")
    return lines.where(looks_numbered("text")).groupBy(style.alias("style")).agg(F.count("*").alias("n"))


def find_interpretation(lines: DataFrame, cues: list[str], known_units: list[str]) -> DataFrame:
    """(what, value, n): lines with a cue, and quoted unit names that the rulebook does not know."""
    hits = lines.where(F.col("text").rlike("|".join(cues))).agg(F.count("*").alias("n")).select(F.lit("cue_lines").alias("what"), F.lit("").alias("value"), "n")
    units = lines.select(F.explode(F.regexp_extract_all("text", F.lit("[\"“]((?:Clause|Paragraph|Schedule|Annex|Part|Section|Article|Rule)s?)[\"”]"), F.lit(1))).alias("value"))
    odd = units.where(~F.regexp_replace(F.lower("value"), "s$", "").isin([u.lower() for u in known_units])).groupBy("value").agg(F.count("*").alias("n"))
    return hits.unionByName(odd.select(F.lit("unknown_unit").alias("what"), "value", "n"))


def modal_size(lines: DataFrame) -> DataFrame:
    """(part, size): the font size with the most characters, the smaller of equals."""
    return lines.groupBy("part", F.col("size_max").alias("size")).agg(F.sum(F.length("text")).alias("n")).groupBy("part").agg(F.max_by("size", F.struct("n", -F.col("size"))).alias("size"))


def font_histogram(lines: DataFrame) -> DataFrame:
    return lines.groupBy("part", F.round("size_max", 1).alias("size")).agg(F.count("*").alias("n"))


def page_profile(lines: DataFrame, pages: DataFrame) -> DataFrame:
    own = lines.groupBy("page").agg(F.sum(F.length(F.regexp_replace("text", r"\s+", ""))).alias("chars"))
    return pages.select("page").join(own, "page", "left").select("page", F.coalesce("chars", F.lit(0).cast("long")).alias("chars"), F.when(F.coalesce("chars", F.lit(0)) > 0, "layout_text").otherwise("no_text_layer").alias("route"))


def orphan_ink(body: DataFrame, placed: DataFrame) -> DataFrame:
    """(part, body, placed, residual): characters on the pages less characters in blocks."""
    ink = lambda df, name: df.groupBy("part").agg(F.sum(F.length(F.regexp_replace("text", r"\s+", ""))).alias(name))
    zero = F.lit(0).cast("long")
    both = ink(body, "body").join(ink(placed, "placed"), "part", "full_outer")
    return both.select("part", F.coalesce("body", zero).alias("body"), F.coalesce("placed", zero).alias("placed")).withColumn("residual", F.col("body") - F.col("placed"))


def depth_out_of_range(blocks: DataFrame, most: int = MAX_DEPTH) -> DataFrame:
    return blocks.where(F.col("number").rlike(r"^\d+(\.\d+)*$")).withColumn("dots", F.size(F.split("number", r"\."))).where(F.col("dots") > most)


def lower_median(values: Column) -> Column:
    s = F.array_sort(F.collect_list(values))
    return F.element_at(s, (F.floor((F.size(s) - 1) / 2) + 1).cast("int"))


def upper_median(values: Column) -> Column:
    s = F.array_sort(F.collect_list(values))
    return F.element_at(s, (F.floor(F.size(s) / 2) + 1).cast("int"))


def indent_disagreement(blocks: DataFrame) -> DataFrame:
    """(part, depth, left, above, tested, disagrees): median left edges of adjoining depths at least 6 points apart must grow."""
    edges = blocks.where("block_kind = 'number'").groupBy("part", "depth").agg(lower_median(F.col("left")).alias("left"), F.count("*").alias("n"))
    up = edges.select("part", (F.col("depth") + 1).alias("depth"), F.col("left").alias("above"))
    both = edges.join(up, ["part", "depth"])
    return both.withColumn("tested", F.abs(F.col("left") - F.col("above")) >= MIN_STEP).withColumn("disagrees", F.col("tested") & (F.col("left") < F.col("above")))


def fit_alarms(metrics: DataFrame, limits: dict[str, float] = LIMITS) -> DataFrame:
    """(part, name, value, threshold) of the metrics (part, name, value) over their limits."""
    table = F.create_map(*(F.lit(x) for pair in limits.items() for x in pair))
    return metrics.withColumn("threshold", table[F.col("name")]).where(F.col("value") > F.col("threshold"))


def admitted(parts: DataFrame, alarms: DataFrame) -> DataFrame:
    """Parts with refused: those with an alarm are kept in the index and never parsed."""
    bad = alarms.select(F.col("part").alias("part_id")).distinct().withColumn("refused", F.lit(True))
    return parts.join(bad, "part_id", "left").withColumn("refused", F.coalesce("refused", F.lit(False)))


def visual_lines(lines: DataFrame) -> DataFrame:
    """Lines of a page merged where they overlap by over half of the shorter, against the growing box."""
    ddl = "part string, page int, line_no int, x0 double, y0 double, x1 double, y1 double, text string, size_max double, bold boolean"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        groups: list[dict] = []
        for r in pdf.sort_values(["y0", "x0", "line_no"]).itertuples():
            for g in groups:
                over = min(g["y1"], r.y1) - max(g["y0"], r.y0)
                if over > OVERLAP * min(g["y1"] - g["y0"], r.y1 - r.y0):
                    g["rows"].append(r)
                    g["y0"], g["y1"] = min(g["y0"], r.y0), max(g["y1"], r.y1)
                    break
            else:
                groups.append({"y0": r.y0, "y1": r.y1, "rows": [r]})
        out = []
        for i, g in enumerate(sorted(groups, key=lambda g: (g["y0"], min(r.x0 for r in g["rows"])))):
            rows = sorted(g["rows"], key=lambda r: r.x0)
            out.append((rows[0].part, rows[0].page, i, rows[0].x0, g["y0"], max(r.x1 for r in rows), g["y1"], " ".join(r.text for r in rows), max(r.size_max for r in rows), all(r.bold for r in rows)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in ddl.split(", ")])

    return lines.groupBy("part", "page").applyInPandas(run, ddl)


def indent_clusters(candidates: DataFrame) -> DataFrame:
    """(part, level, edge, n, supported): left edges (part, level, left) in clusters of 3 points; supported from 5 per cent on."""
    ddl = "part string, level string, edge double, n long, supported boolean"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        clusters: list[list[float]] = []
        for x in sorted(pdf["left"]):
            if clusters and x - clusters[-1][0] <= INDENT:
                clusters[-1].append(x)
            else:
                clusters.append([x])
        need = max(1, math.ceil(SUPPORT * len(pdf)))
        return pd.DataFrame([(pdf["part"].iloc[0], pdf["level"].iloc[0], c[0], len(c), len(c) >= need) for c in clusters], columns=["part", "level", "edge", "n", "supported"])

    return candidates.groupBy("part", "level").applyInPandas(run, ddl)


def heading_like(size: Column, body: Column, bold: Column, depth: Column, text: Column) -> Column:
    """Larger than the body, or bold at the top level, or bold, short and without a full stop."""
    return (size > body + 0.5) | (bold & (depth == 1)) | (bold & (F.length(text) <= 80) & ~text.rlike(r"[.;:,]\s*$"))


BLOCKS = "part string, idx int, block_kind string, number string, level string, depth int, left double, size_max double, bold boolean, heading_like boolean, text string, page_start int, page_end int, anomalies array<string>"


def _blocks(pdf: pd.DataFrame) -> list[tuple]:
    """One part's blocks: a numbered line opens a block, other lines continue it unless a gap or style parts them."""
    rules = [(k, d, re.compile(p)) for k, (d, p) in RULES.items()]
    sizes = pdf.assign(n=pdf["text"].str.len()).groupby("size_max")["n"].sum()
    body = min(sizes[sizes == sizes.max()].index) if len(sizes) else 0.0
    out: list[dict] = []
    last_top, style, seen = 0, None, set()
    for r in pdf.sort_values(["page", "y0", "x0", "line_no"]).itertuples():
        hits = [(d, "_" not in k, k, m) for k, d, p in rules if (m := p.match(r.text))]
        notes = []
        if not hits and (m := re.match(HEADING_BARE, r.text)) and int(m[1]) == last_top + 1:
            hits = [(1, True, "heading", m)]
        if not hits and r.bold and style == (r.size_max, r.bold) and (m := re.match(r"^\s*(\d{1,2})\s+(?=[A-Z])", r.text)) and int(m[1]) == last_top + 1:
            hits, notes = [(1, True, "heading", m)], ["recovered_heading: matched by style and next number"]
        if hits:
            depth, _, key, m = max(hits, key=lambda h: (h[0], h[1], h[2]))
            text, number = r.text[m.end() :].strip(), m[1]
            if depth == 1:
                last_top, style = int(number) if number.isdigit() else last_top, (r.size_max, r.bold)
            if (number, depth) in seen and depth > 1 and "." in number:
                notes.append("duplicate_number: the number stands twice")
            seen.add((number, depth))
            big = r.size_max > body + 0.5 or r.bold and (depth == 1 or len(text) <= 80 and not re.search(r"[.;:,]\s*$", text))
            out.append({"kind": "number", "number": number, "level": key.split("_")[0], "depth": depth, "row": r, "big": big, "text": text, "end": r.page, "notes": notes})
        elif out and out[-1]["end"] >= r.page - 1 and out[-1]["kind"] != "title":
            out[-1]["text"] = f"{out[-1]['text']} {r.text.strip()}".strip()
            out[-1]["end"] = r.page
        else:
            kind = "title" if not out and (r.size_max > body or r.bold) else "prose"
            out.append({"kind": kind, "number": None, "level": None, "depth": 0, "row": r, "big": kind == "title", "text": r.text.strip(), "end": r.page, "notes": []})
    return [(b["row"].part, i, b["kind"], b["number"], b["level"], b["depth"], b["row"].x0, b["row"].size_max, b["row"].bold, bool(b["big"]), b["text"], b["row"].page, b["end"], b["notes"]) for i, b in enumerate(out)]


def build_blocks(lines: DataFrame) -> DataFrame:
    """Blocks of each part's body lines; the state machine runs over one part, parts are independent."""
    return lines.groupBy("part").applyInPandas(lambda pdf: pd.DataFrame(_blocks(pdf), columns=[c.split()[0] for c in BLOCKS.split(", ")]), BLOCKS)


def grids(rules: DataFrame, snap: float = 1.5) -> DataFrame:
    """(page, grid, axis, place): columns and rows of ruled grids from rule segments (page, x0, y0, x1, y1).

    Vertical extents that overlap make one grid: gaps and islands over a running maximum.
    """
    flat = rules.withColumn("axis", F.when(F.abs(F.col("y1") - F.col("y0")) <= F.abs(F.col("x1") - F.col("x0")), "row").otherwise("col"))
    order = Window.partitionBy("page").orderBy("y0", "y1", "x0", "x1")
    before = F.max("y1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    isle = F.sum(F.coalesce((F.col("y0") > before + snap).cast("int"), F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = flat.withColumn("grid", isle).withColumn("at", F.when(F.col("axis") == "row", F.col("y0")).otherwise(F.col("x0")))
    near = Window.partitionBy("page", "grid", "axis").orderBy("at")
    new = F.coalesce((F.col("at") - F.lag("at").over(near) > snap).cast("int"), F.lit(0))
    return placed.withColumn("new", new).withColumn("slot", F.sum("new").over(near.rowsBetween(Window.unboundedPreceding, 0))).groupBy("page", "grid", "axis", "slot").agg(F.round(F.avg("at"), 3).alias("place"))


def fill_cells(slots: DataFrame, lines: DataFrame) -> DataFrame:
    """(page, grid, row, col, text): lines in the slots that hold their centres; slots (page, grid, axis, slot, lo, hi)."""
    mid = lines.select("page", "line_no", "text", "x0", "y0", ((F.col("x0") + F.col("x1")) / 2).alias("cx"), ((F.col("y0") + F.col("y1")) / 2).alias("cy"))
    rows = slots.where("axis = 'row'").select("page", "grid", F.col("slot").alias("row"), F.col("lo").alias("rlo"), F.col("hi").alias("rhi"))
    cols = slots.where("axis = 'col'").select("page", "grid", F.col("slot").alias("col"), F.col("lo").alias("clo"), F.col("hi").alias("chi"))
    hit = mid.join(rows, "page").where("rlo <= cy and cy < rhi").join(cols, ["page", "grid"]).where("clo <= cx and cx < chi")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("y0", "x0", "line_no", "text"))), lambda x: x["text"])
    return hit.groupBy("page", "grid", "row", "col").agg(F.array_join(texts, " ").alias("text"))


def intervals(places: DataFrame) -> DataFrame:
    """Slots between neighbouring rules of a grid."""
    nxt = F.lead("place").over(Window.partitionBy("page", "grid", "axis").orderBy("place"))
    return places.withColumn("hi", nxt).where("hi is not null").select("page", "grid", "axis", (F.row_number().over(Window.partitionBy("page", "grid", "axis").orderBy("place")) - 1).alias("slot"), F.col("place").alias("lo"), "hi")


def cell_roles(cells: DataFrame) -> DataFrame:
    """Cells (page, grid, row, col, text, bold) with role and confidence: header rows are bold throughout, number columns half numeric."""
    heads = cells.groupBy("page", "grid", "row").agg(F.bool_and("bold").alias("all_bold"))
    first = heads.where("all_bold").groupBy("page", "grid").agg(F.min("row").alias("header_row"))
    numeric = F.col("text").rlike(r"^\s*\d+(\.\d+)*\.?\s*$")
    cols = cells.groupBy("page", "grid", "col").agg((F.count_if(numeric) / F.count("*") >= 0.5).alias("is_number")).where("is_number").groupBy("page", "grid").agg(F.min("col").alias("number_col"))
    rows = cells.join(first, ["page", "grid"], "left").join(cols, ["page", "grid"], "left")
    lead = F.coalesce(F.col("number_col") + 1, F.lit(0))
    role = F.when(F.col("row") == F.col("header_row"), "header").when(F.col("col") == F.col("number_col"), "number").when(F.col("col") == lead, "label").otherwise("value")
    return rows.withColumn("role", role).withColumn("confidence", F.when(role.isin("header", "number"), 0.9).otherwise(0.7))


def undrawn_gaps(lines: DataFrame) -> DataFrame:
    """(page, grid, row, col, gap): cells whose lines lie over 1.8 median heights apart."""
    own = Window.partitionBy("page", "grid", "row", "col").orderBy("y0")
    g = lines.withColumn("gap", F.lead("y0").over(own) - F.col("y1"))
    return g.groupBy("page", "grid", "row", "col").agg(F.max("gap").alias("gap"), upper_median(F.col("y1") - F.col("y0")).alias("height")).where(F.col("gap") > GAP * F.col("height"))


def stitched_tables(tables: DataFrame) -> DataFrame:
    """Tables (part, idx, page_start, page_end, n_cols, n_rows) with their chain and row offset: next page, same columns."""
    order = Window.partitionBy("part").orderBy("idx")
    joins = (F.col("page_start") == F.lag("page_end").over(order) + 1) & (F.col("n_cols") == F.lag("n_cols").over(order))
    chain = F.sum(F.coalesce(~joins, F.lit(True)).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = tables.withColumn("chain", chain)
    offset = F.coalesce(F.sum("n_rows").over(Window.partitionBy("part", "chain").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("row_offset", offset)


def token_boxes(words: DataFrame, lines: DataFrame) -> DataFrame:
    """(page, line_no, token, x0, y0, x1, y1): the leftmost word of a line that is its number."""
    w = words.select("page", F.col("text").alias("token"), F.struct("x0", "y0", "x1", "y1").alias("box"))
    l = lines.select("page", "line_no", "token", F.col("y0").alias("top"), F.col("y1").alias("bottom"))
    hit = l.join(w, ["page", "token"]).where("box.y0 < bottom and top < box.y1")
    return hit.groupBy("page", "line_no", "token").agg(F.min("box").alias("box")).select("page", "line_no", "token", "box.*")
