"""Identities of nodes, concepts, vectors and loads, as Column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Unicode NFC, for which SQL has no function."""
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def node_id(document: Column | str, version: Column | str, path: Column | str) -> Column:
    return F.sha1(F.concat_ws("|", _c(document), _c(version), _c(path)))


def lineage_key(document: Column | str, path: Column | str) -> Column:
    return F.sha1(F.concat_ws("|", _c(document), _c(path)))


def normalised_lines(text: Column | str) -> Column:
    """Line ends as line feeds, white space runs of a line as one space, lines and the whole trimmed; no NFC."""
    unix = F.regexp_replace(F.regexp_replace(_c(text), "\r\n", "\n"), "\r", "\n")
    lines = F.transform(F.split(unix, "\n"), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))
    return F.regexp_replace(F.array_join(lines, "\n"), r"^\s+|\s+$", "")


def content_hash(text: Column | str, normalise: bool = True) -> Column:
    """sha1 of the normalised text; normalise=False for text that is NFC already, which spares Python."""
    return F.sha1(normalised_lines(nfc(_c(text)) if normalise else _c(text)))


def concept_id(scope: Column | str, label: Column | str) -> Column:
    """The first 16 hex digits over scope and label, the label in one space and lower case."""
    return F.concat(F.lit("concept-"), F.substring(F.sha1(F.concat_ws("|", _c(scope), F.lower(F.trim(F.regexp_replace(_c(label), r"\s+", " "))))), 1, 16))


def slug(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.lower(_c(text)), "[^a-z0-9]+", "-"), F.lit("-"))


def legislation_key(title: Column | str, year: Column | str, kind: Column | str, provision: Column | str) -> Column:
    """legislation/<slug>[/<provision>]; EU instruments carry their year in the number."""
    named = F.when((_c(kind) == "eu_regulation") | _c(year).isNull(), _c(title)).otherwise(F.concat_ws(" ", _c(title), _c(year).cast("string")))
    return F.concat(F.lit("legislation/"), slug(named), F.when(_c(provision).isNull(), "").otherwise(F.concat(F.lit("/"), _c(provision))))


def vector_key(model: Column | str, text: Column | str) -> Column:
    return F.sha1(F.concat_ws("|", _c(model), _c(text)))


def ref_path(parent: Column | str, start: Column | str, end: Column | str, ordinal: Column | str) -> Column:
    """<parent>/ref@<start>-<end>[+n]; the first of a span has no ordinal."""
    return F.concat(_c(parent), F.lit("/ref@"), _c(start).cast("string"), F.lit("-"), _c(end).cast("string"), F.when(_c(ordinal) > 0, F.concat(F.lit("+"), _c(ordinal).cast("string"))).otherwise(""))
