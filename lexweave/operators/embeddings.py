"""What to embed at which level, the cache split, and exact vector search."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexweave.functions import ids
from lexweave.functions.text import estimated_tokens
from lexweave.operators.concepts import shared_folder
from lexweave.operators.tree import children, leaves, subtree_text

BUDGET, BATCH, QUERIES = 512, 96, 20_000


def plan(nodes: DataFrame, budget: int = BUDGET, window: bool = False) -> DataFrame:
    """(node_id, path, level, text): documents and parts by summary, leaves by their text, others by their subtree up to the budget."""
    texts = subtree_text(nodes)
    leaf = leaves(nodes).select("path").withColumn("is_leaf", F.lit(True))
    rows = children(nodes).join(texts, "path", "left").join(leaf, "path", "left")
    near = Window.partitionBy("parent_path").orderBy("sib_no")
    around = F.concat_ws(" ", F.lag("subtree_text").over(near), "subtree_text", F.lead("subtree_text").over(near))
    rows = rows.withColumn("around", around).where("subtree_text is not null and trim(subtree_text) <> ''")
    big = F.col("kind").isin("document", "part")
    level = F.when(big, "summary").when(F.col("is_leaf"), "leaf_window" if window else "leaf").when(estimated_tokens("subtree_text") <= budget, "subtree").otherwise("summary")
    text = F.when(F.col("is_leaf") & ~big & F.lit(window), F.col("around")).otherwise(F.col("subtree_text"))
    return rows.select(F.col("id").alias("node_id"), "path", level.alias("level"), text.alias("text"))


def cache_split(texts: DataFrame, cache: DataFrame, model: str, batch: int = BATCH) -> tuple[DataFrame, DataFrame]:
    """Distinct texts with their vectors, and those still owed in batches."""
    distinct = texts.select("text").distinct().withColumn("vector_ref", ids.vector_key(F.lit(model), "text"))
    known = cache.select("vector_ref", "vector")
    owed = distinct.join(known, "vector_ref", "left_anti")
    # batches within shards of a hash, so that no task numbers all texts
    shard = F.pmod(F.xxhash64("vector_ref"), F.lit(64))
    n = F.row_number().over(Window.partitionBy("shard").orderBy("vector_ref"))
    return distinct.join(known, "vector_ref"), owed.withColumn("shard", shard).withColumn("batch", F.concat_ws("-", "shard", F.floor((n - 1) / batch).cast("string")))


def embed_owed(owed: DataFrame, provider: Callable[[list[str]], list[list[float]]]) -> DataFrame:
    """Vectors of owed texts by a provider that takes lists of texts."""
    import pandas as pd

    def run(batches):
        for pdf in batches:
            vectors = []
            for at in range(0, len(pdf), BATCH):
                vectors += provider(pdf["text"].iloc[at : at + BATCH].tolist())
            yield pd.DataFrame({"vector_ref": pdf["vector_ref"], "vector": vectors})

    return owed.select("vector_ref", "text").mapInPandas(run, "vector_ref string, vector array<float>")


def records(planned: DataFrame, cache: DataFrame, model: str) -> tuple[DataFrame, DataFrame]:
    """Records of planned texts that have a vector, and the pending rest with its reason."""
    keyed = planned.withColumn("vector_ref", ids.vector_key(F.lit(model), "text"))
    have = keyed.join(cache.select("vector_ref"), "vector_ref", "left_semi").withColumn("llm_derived", F.col("level") == "summary")
    pending = keyed.join(cache.select("vector_ref"), "vector_ref", "left_anti").select("node_id", "level", F.when(F.col("level") == "summary", "summary_owed").otherwise("vector_owed").alias("reason"))
    return have.select("node_id", "level", "text", "vector_ref", "llm_derived"), pending


def broken_records(recs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Records of absent nodes, unflagged summaries, and nodes with both leaf variants."""
    lost = recs.join(nodes.select(F.col("id").alias("node_id")), "node_id", "left_anti").select("node_id", F.lit("missing_node").alias("rule"))
    unflagged = recs.where("level = 'summary' and not llm_derived").select("node_id", F.lit("unflagged_summary").alias("rule"))
    both = recs.where("level in ('leaf', 'leaf_window')").groupBy("node_id").agg(F.count_distinct("level").alias("n")).where("n > 1").select("node_id", F.lit("two_leaf_levels").alias("rule"))
    return lost.unionByName(unflagged).unionByName(both)


def nearest(queries: DataFrame, vectors: DataFrame, k: int, exclude_self: bool = True) -> DataFrame:
    """(query, id, score, rank): the k nearest rows by cosine of a stated set of queries, exactly.

    queries (query, vector) go to the data, at most about ``QUERIES`` at a time; each task keeps the k
    best of what it reads, so that the shuffle holds k rows a query and task.
    """
    import numpy as np
    import pandas as pd

    n = -(-queries.count() // QUERIES)
    if n > 1:  # block after block: what is on the driver and sent has a bound
        shared_folder(queries.sparkSession)
        blocks = [queries.where(F.pmod(F.xxhash64("query"), F.lit(n)) == i) for i in range(n)]
        parts = [nearest(b, vectors, k, exclude_self).checkpoint() for b in blocks if b.limit(1).count()]
        return reduce(DataFrame.unionByName, parts)
    q = queries.orderBy("query").toPandas()
    names = q["query"].to_numpy()
    matrix = np.array(q["vector"].tolist(), np.float64).reshape(len(q), -1)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)
    held = queries.sparkSession.sparkContext.broadcast((names, matrix))
    kind = dict(vectors.dtypes)["id"]

    def run(batches):
        names, matrix = held.value
        best: pd.DataFrame | None = None
        for pdf in batches:
            if not len(names) or not len(pdf):
                continue
            x = np.array(pdf["vector"].tolist(), np.float64)
            x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
            own = pdf["id"].to_numpy()
            scores = matrix @ x.T
            if exclude_self:
                scores[names[:, None] == own[None, :]] = -np.inf
            m = min(k, scores.shape[1])
            top = np.argpartition(-scores, m - 1, axis=1)[:, :m]
            new = pd.DataFrame({"query": np.repeat(names, m), "id": own[top].ravel(), "score": np.take_along_axis(scores, top, 1).ravel()})
            new = new[np.isfinite(new["score"])]
            best = new if best is None else pd.concat([best, new]).sort_values(["query", "score", "id"], ascending=[True, False, True]).groupby("query").head(k)
        if best is not None:
            yield best

    part = vectors.select("id", "vector").mapInPandas(run, f"query {kind}, id {kind}, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc(F.round("score", 9)), "id"))
    return part.withColumn("rank", rank).where(F.col("rank") <= k)
