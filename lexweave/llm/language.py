"""Language identification by nearest centroid.

A text becomes hashed counts of character 1-, 2- and 3-grams of its letters (lower
case, other runs as one space), damped, weighted by inverse document frequency and
normalised. Spherical k-means gives every language ``CENTROIDS`` centroids; the language
of the nearest one by cosine is predicted, and the cosine is the score. A text whose
cosine lies under the least that ``REJECT`` of the language's own training texts reach
is marked as rejected: it is far from all that was learnt. It keeps its nearest language.

The model is fitted on a bounded sample: per language the ``SAMPLE`` texts with the
least hash of their id, whole, among rows where crc32(id as text) mod ``FOLDS`` is not 0
and the language is known (of rows that repeat an id, the one with the least hash of its text). Tasks count
the n-grams and find the centroids of a language; the driver gets document frequencies and
centroids, 2 ** ``BITS`` numbers each, and no text. Predictions read the text alone.

Edge cases: a null text, or one without letters, is ``und`` with score 0 and is rejected;
so is every text if nothing could be learnt. Ties go to the first language in order.
Repeated rows are predicted each for itself; very long texts count whole, in pieces; an empty table gives no
rows. Columns other than id, text and language are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexweave.llm.common import batch_of, cut, lean

SAMPLE, CENTROIDS, FOLDS, BITS, REJECT = 600, 3, 5, 14, 0.001
UNKNOWN = "und"
_CHUNK = 1 << 20


def _letters(text: str) -> np.ndarray:
    """Code points of the letters in lower case, each other run as one space; empty if there is no letter."""
    low = text.lower()
    code = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    ascii_letter = (code >= 97) & (code <= 122)
    letter = ascii_letter.copy()
    beyond = np.flatnonzero(code >= 128)
    if len(beyond):
        kinds, where = np.unique(code[beyond], return_inverse=True)
        letter[beyond] = np.array([chr(c).isalpha() for c in kinds.tolist()])[where]
    if not letter.any():
        return np.zeros(0, np.uint32)
    code = np.where(letter, code, 32).astype(np.uint32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of others
    code = code[keep]
    return np.concatenate([[32], code, [32]]).astype(np.uint32) if code[-1] != 32 else np.concatenate([[32], code]).astype(np.uint32)


def grams(text: str | None) -> np.ndarray | None:
    """Hashed n-gram counts of the whole text, or None without letters."""
    code = _letters(text or "")
    if not len(code):
        return None
    out, size = np.zeros(1 << BITS), 1 << BITS
    for at in range(0, len(code), _CHUNK):
        c = code[at : at + _CHUNK + 2].astype(np.uint32)
        one, last = c * np.uint32(0x9E3779B1), min(_CHUNK, len(code) - at)
        two = (one[:-1] ^ (c[1:] * np.uint32(0x85EBCA6B) + np.uint32(0x7F4A7C15))) * np.uint32(0xC2B2AE35)
        three = (two[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F) + np.uint32(0x165667B1))) * np.uint32(0x9E3779B1)
        for h in (one[:last], two[:last], three[:last]):
            out += np.bincount(h >> np.uint32(32 - BITS), minlength=size)
    return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # a row each
    owner: np.ndarray  # the language's index of each centroid
    least: np.ndarray  # per language, the cosine under which a text is rejected

    def vector(self, counts: np.ndarray) -> np.ndarray:
        v = np.sqrt(counts).astype(np.float32) * self.idf
        return v / max(float(np.sqrt(v @ v)), 1e-12)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        counts = grams(text) if self.languages else None
        if counts is None:
            return UNKNOWN, 0.0, True
        cosines = self.centroids @ self.vector(counts)
        best = int(cosines.argmax())
        score = float(min(max(cosines[best], 0.0), 1.0))
        return self.languages[self.owner[best]], score, bool(score < self.least[self.owner[best]])


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the row nearest the mean and then from the farthest rows."""
    chosen = [int((x @ x.mean(0)).argmax())]
    while len(chosen) < min(k, len(x)):
        chosen.append(int((x @ x[chosen].T).max(1).argmin()))
    centers = x[chosen]
    for _ in range(rounds):
        own = (x @ centers.T).argmax(1)
        sums = np.array([x[own == j].sum(0) if (own == j).any() else centers[j] for j in range(len(centers))])
        centers = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centers.astype(np.float32)


def _idf(seen: np.ndarray, n: int) -> np.ndarray:
    return (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)


def _centroids(counts: list[np.ndarray], idf: np.ndarray, k: int) -> tuple[np.ndarray, float]:
    """The centroids of a language's texts, and the cosine under which a text is rejected."""
    bare = Model([], idf, np.zeros((0, 0)), np.zeros(0, int), np.zeros(0))
    x = np.array([bare.vector(g) for g in counts], np.float32)
    centers = _clusters(x, k)
    return centers, float(np.quantile((x @ centers.T).max(1), REJECT))


def _model(found: list[tuple[str, np.ndarray, float]], idf: np.ndarray) -> Model:
    found = sorted(found, key=lambda f: f[0])
    owner = np.repeat(np.arange(len(found)), [len(c) for _, c, _ in found])
    return Model([lang for lang, _, _ in found], idf, np.concatenate([c for _, c, _ in found]), owner, np.array([least for _, _, least in found]))


NOTHING = Model([], np.zeros(0), np.zeros((0, 0)), np.zeros(0, int), np.zeros(0))


def learn(rows: list[tuple[str, str]], k: int = CENTROIDS) -> Model:
    """The model of (language, text) rows, without Spark."""
    counted = [(lang, g) for lang, g in ((lang, grams(text)) for lang, text in rows) if g is not None]
    if not counted:
        return NOTHING
    idf = _idf(np.sum([g > 0 for _, g in counted], axis=0), len(counted))
    return _model([(lang, *_centroids([g for own, g in counted if own == lang], idf, k)) for lang in {lang for lang, _ in counted}], idf)


def _packed(counts: np.ndarray) -> bytes:
    at = np.flatnonzero(counts)
    return at.astype(np.uint16).tobytes() + counts[at].astype(np.float64).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    n, out = len(data) // 10, np.zeros(1 << BITS)
    out[np.frombuffer(data, np.uint16, n)] = np.frombuffer(data, np.float64, n, 2 * n)
    return out


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bound: int = SAMPLE) -> Model:
    """Learns from at most bound texts a language of the rows that are not held out."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    able = slim.where(F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out())
    ids = able.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    sizes = {r["lang"]: r["n"] for r in ids.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()}  # a row a language
    if not sizes:
        return NOTHING
    # ids with a small hash, twice as many as are needed, so that tasks hand on little
    most = {lang: -(2**63) + int(2**64 * 2.0 * bound / n) if n > 3 * bound else 2**63 - 1 for lang, n in sizes.items()}
    limit = F.create_map(*(F.lit(x) for item in most.items() for x in item))
    near = ids.where(F.col("h") <= limit[F.col("lang")]).distinct()
    chosen = near.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).where(F.col("n") <= bound).select("doc_id", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [grams(t) for t in batch.column(2).to_pylist()]
            rows = [(d, lang, h, _packed(g)) for d, lang, h, g in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), found, strict=True) if g is not None]
            if rows:
                yield batch_of(_COUNTED, *zip(*rows, strict=True))

    texts = able.join(F.broadcast(chosen), ["doc_id", "lang"]).select("doc_id", "lang", "text", F.xxhash64("text").alias("h"))  # at most bound ids a language
    counted = texts.mapInArrow(lean(count), "doc_id long, lang string, h long, grams binary")
    counted = cut(counted.groupBy("doc_id", "lang").agg(F.min_by("grams", F.struct("h", "grams")).alias("grams")))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += _unpacked(data) > 0
                n += 1
        if n:
            at = np.flatnonzero(total)
            yield batch_of(_SEEN, [-1, *at], [n, *total[at]])

    sums = {r["gram"]: r["n"] for r in counted.select("grams").mapInArrow(lean(seen), "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    if not sums:
        return NOTHING
    n, frequency = sums.pop(-1), np.zeros(1 << BITS, np.int64)
    frequency[list(sums)] = list(sums.values())
    idf = _idf(frequency, n)

    def centers(pdf: pd.DataFrame) -> pd.DataFrame:
        own, least = _centroids([_unpacked(g) for g in pdf.sort_values("doc_id")["grams"]], idf, CENTROIDS)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centroid": [c.tobytes() for c in own], "least": least, "nr": range(len(own))})

    rows = counted.groupBy("lang").applyInPandas(centers, "lang string, centroid binary, least double, nr int").orderBy("lang", "nr").collect()
    found = {}
    for r in rows:
        found.setdefault((r["lang"], r["least"]), []).append(np.frombuffer(r["centroid"], np.float32))
    return _model([(lang, np.array(c), least) for (lang, least), c in found.items()], idf)


_COUNTED = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("h", pa.int64()), ("grams", pa.binary())])
_SEEN = pa.schema([("gram", pa.int32()), ("n", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # languages * CENTROIDS * 2 ** BITS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [held.value.predict(t) for t in batch.column(2).to_pylist()]
            yield batch_of(_OUT, batch.column(0).to_pylist(), batch.column(1).to_pylist(), *(zip(*found, strict=True) if found else ([], [], [])))

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(lean(run), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
