"""Scalar text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What may stand in lower case inside a capitalised phrase, quote marks, dashes.
JOINERS = ("of", "and", "the", "for", "to", "in", "on", "or", "a", "an", "by", "with")
QUOTES = "\"'“”‘’"
DASHES = "‐‑‒–—"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def collapse(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(_c(text), r"(?U)\s+", " "))


def comparison_form(text: Column | str) -> Column:
    """Straight quotes and dashes, one space, no marks at the ends, lower case."""
    plain = F.translate(_c(text), "“”‘’" + DASHES, "\"\"''" + "-" * len(DASHES))
    return F.lower(F.trim(F.regexp_replace(collapse(plain), r"^[ .:;,]+|[ .:;,]+$", "")))


def title_form(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.lower(_c(text)), "[^a-z0-9]+", " "))


def term_key(raw: Column | str) -> Column:
    """One space, no trailing ; or , and one quote mark less at either side."""
    flat = F.regexp_replace(collapse(raw), "[;,]+$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(flat), "^[\"'“”‘’]", ""), "[\"'“”‘’]$", ""))


def quote_shape(raw: Column | str) -> Column:
    flat = F.trim(F.regexp_replace(collapse(raw), "[;,]+$", ""))
    opens, closes = flat.rlike("^[\"'“‘]"), flat.rlike("[\"'”’]$")
    return F.when(opens & closes, "both").when(closes, "closing_only").when(opens, "opening_only").otherwise("none")


def words(text: Column | str) -> Column:
    """Letters with inner apostrophes and hyphens."""
    return F.regexp_extract_all(_c(text), F.lit(r"[A-Za-z]+(?:['’-][A-Za-z]+)*"), F.lit(0))


def estimated_tokens(text: Column | str) -> Column:
    """A quarter of the letters of each run, rounded up, and one for each mark."""
    pieces = F.regexp_extract_all(_c(text), F.lit(r"(?U)\w+|[^\w\s]"), F.lit(0))
    return F.aggregate(pieces, F.lit(0).cast("long"), lambda n, p: n + F.when(p.rlike(r"^(?U)[^\W_]+$"), F.ceil(F.length(p) / 4)).otherwise(1).cast("long"))


def word_count_bucket(text: Column | str) -> Column:
    n = F.size(F.filter(F.split(F.trim(_c(text)), r"\s+"), lambda w: w != ""))
    return F.when(n <= 1, "1").when(n == 2, "2").otherwise("3+")


def position_bucket(order: Column | str, total: Column | str) -> Column:
    """Thirds of order / max(total - 1, 1)."""
    share = _c(order) / F.greatest(_c(total) - 1, F.lit(1))
    return F.when(_c(total) <= 1, "only").when(share < 1 / 3, "early").when(share < 2 / 3, "middle").otherwise("late")


def clip(text: Column | str, limit: int) -> Column:
    return F.when(F.length(_c(text)) > limit, F.concat(F.substring(_c(text), 1, limit), F.lit(" […truncated]"))).otherwise(F.coalesce(_c(text), F.lit("")))


def confidence_bucket(score: Column | str) -> Column:
    """0 to 9: the half-open tenth, compared with literal bounds."""
    return sum((F.when(_c(score) >= F.lit(i / 10), 1).otherwise(0) for i in range(1, 10)), F.lit(0))


def initials(phrase: Column | str) -> Column:
    kept = F.filter(F.split(F.trim(_c(phrase)), r"[\s-]+"), lambda w: ~F.lower(w).isin(*JOINERS) & (w != ""))
    return F.array_join(F.transform(kept, lambda w: F.upper(F.substring(w, 1, 1))), "")


def is_initialism(short: Column | str, phrase: Column | str) -> Column:
    """Whether the initials of a phrase, with or without its joining words, are the short form."""
    every = F.array_join(F.transform(F.split(F.trim(_c(phrase)), r"[\s-]+"), lambda w: F.upper(F.substring(w, 1, 1))), "")
    wanted = F.upper(F.regexp_replace(_c(short), "[^A-Za-z0-9]", ""))
    return (wanted == initials(phrase)) | (wanted == every)


def is_capitalised_phrase(text: Column | str) -> Column:
    parts = F.split(F.trim(_c(text)), r"\s+")
    return F.trim(_c(text)).rlike("^[A-Z]") & F.forall(parts, lambda w: w.rlike("^[A-Z0-9(&]") | F.lower(w).isin(*JOINERS))


def looks_like_term(key: Column | str) -> Column:
    n = F.size(F.split(F.trim(_c(key)), r"\s+"))
    return F.length(_c(key)).between(2, 110) & (n <= 12) & _c(key).rlike("^[A-Z0-9]") & _c(key).rlike("[A-Za-z]") & ~_c(key).rlike("[.;:]$")


def sentence_initial(field: Column, start: Column) -> Column:
    """Whether a span starts its field or follows a sentence's end."""
    before = F.substring(field, F.lit(1), start)
    return (F.trim(before) == "") | before.rlike(r"[.;:!?]\s*$")


def title_case_runs(text: Column | str) -> Column:
    """Runs of capitalised words with nothing but other marks than letters between them."""
    runs = F.regexp_extract_all(_c(text), F.lit(r"[A-Z][A-Za-z'\-]*(?:[^A-Za-z.;:!?\n()]+[A-Z][A-Za-z'\-]*)*"), F.lit(0))
    return F.filter(runs, lambda r: F.length(r) > 1)


def inflections(surface: Column | str) -> Column:
    """Plural and singular forms of a surface of three letters or more, itself left out."""
    s = _c(surface)
    n = F.length(s)
    forms = F.array(
        F.when(n >= 3, F.concat(s, F.lit("s"))),
        F.when(n >= 3, F.concat(s, F.lit("es"))),
        F.when((n >= 3) & s.rlike("[^aeiouAEIOU]y$"), F.regexp_replace(s, "y$", "ies")),
        F.when((n > 4) & s.rlike("ies$"), F.regexp_replace(s, "ies$", "y")),
        F.when((n > 4) & s.rlike("es$"), F.regexp_replace(s, "es$", "")),
        F.when((n > 3) & s.rlike("[^s]s$"), F.regexp_replace(s, "s$", "")),
    )
    return F.array_distinct(F.filter(forms, lambda f: f.isNotNull() & (f != s)))


def sentences(text: Column | str) -> Column:
    """(start, end, sentence) in code points: cut after [.;:!?] and white space."""
    t = _c(text)
    gaps = F.regexp_extract_all(t, F.lit(r"(?<=[.;:!?])\s+"), F.lit(0))
    parts = F.split(t, r"(?<=[.;:!?])\s+", -1)
    zero = F.expr("struct(0 as pos, cast(array() as array<struct<start:int,end:int,sentence:string>>) as found)")

    def step(a: Column, x: Column) -> Column:
        end = a["pos"] + F.length(x["part"])
        here = F.struct(a["pos"].alias("start"), end.alias("end"), x["part"].alias("sentence"))
        return F.struct((end + F.coalesce(F.length(x["gap"]), F.lit(0))).alias("pos"), F.concat(a["found"], F.array(here)).alias("found"))

    zipped = F.zip_with(parts, gaps, lambda p, g: F.struct(p.alias("part"), g.alias("gap")))
    return F.filter(F.aggregate(zipped, zero, step, lambda a: a["found"]), lambda s: s["sentence"] != "")


def roman_value(text: Column | str) -> Column:
    """The number of a lower- or upper-case roman numeral under 40, else null."""
    tens, units = ["", "x", "xx", "xxx"], ["", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix"]
    table = F.create_map(*(F.lit(v) for t, ten in enumerate(tens) for u, unit in enumerate(units) if t + u for v in (ten + unit, 10 * t + u)))
    return table[F.lower(F.regexp_replace(_c(text), r"[()\s.]", ""))]


def letter_ordinal(text: Column | str) -> Column:
    """a is 1, z 26, aa 27, ab 28; null for other text."""
    bare = F.lower(F.regexp_replace(_c(text), r"[()\s.]", ""))
    return F.when(bare.rlike("^[a-z]{1,3}$"), F.aggregate(F.split(bare, ""), F.lit(0), lambda n, c: F.when(c == "", n).otherwise(n * 26 + F.ascii(c) - 96)))


def strip_fence(raw: Column | str) -> Column:
    """What a code fence holds, or the outermost JSON value, or the text."""
    fenced = F.regexp_extract(_c(raw), r"(?s)```[a-zA-Z]*\s*(.*?)\s*```", 1)
    outer = F.regexp_extract(_c(raw), r"(?s)([\[{].*[\]}])", 1)
    return F.when(fenced != "", fenced).when(outer != "", outer).otherwise(F.trim(_c(raw)))


def anomaly_parts(text: Column | str) -> Column:
    """code, detail and the proposed replacement of `code: 'x' for 'y'`."""
    detail = F.trim(F.regexp_extract(_c(text), r"(?s)^[^:]*:(.*)$", 1))
    return F.struct(F.trim(F.split_part(_c(text), F.lit(":"), F.lit(1))).alias("code"), detail.alias("detail"), F.nullif(F.regexp_extract(detail, "'([^']+)' for '[^']+'", 1), F.lit("")).alias("found"), F.nullif(F.regexp_extract(detail, "'[^']+' for '([^']+)'", 1), F.lit("")).alias("proposed"))


def scrub(text: Column | str, secrets: list[str]) -> Column:
    """The text with every known secret blotted out, longest first."""
    out = _c(text)
    for secret in sorted(filter(None, secrets), key=len, reverse=True):
        out = F.replace(out, F.lit(secret), F.lit("[redacted]"))
    return out


def anchor_text(text: Column | str, title: Column | str) -> Column:
    return F.coalesce(_c(text), _c(title), F.lit(""))


def cosine(a: Column | str, b: Column | str) -> Column:
    """0 where a norm is 0."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    x, y = _c(a), _c(b)
    norms = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    return F.when(norms == 0, 0.0).otherwise(dot(x, y) / norms)
