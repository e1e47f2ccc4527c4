"""The seam to outside services: a callable in front of a replay cache, with retries; no service is called here."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.sources.tables import replay_split

ATTEMPTS, MOST_FAILURES = 4, 5
REPLIES = "key string, reply string, error string"


def ask(owed: DataFrame, provider: Callable[[str, str], str], attempts: int = ATTEMPTS, wait: float = 0.0) -> DataFrame:
    """Replies to owed calls (key, task, payload); errors are data, and a task that only fails stops asking."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        failures = 0
        for pdf in batches:
            rows = []
            for key, task, payload in zip(pdf["key"], pdf["task"], pdf["payload"], strict=True):
                reply, error = None, "stopped after failures"
                for n in range(attempts if failures < MOST_FAILURES else 0):
                    try:
                        reply, error = provider(task, payload), None
                        failures = 0
                        break
                    except Exception as e:  # noqa: BLE001  whatever a service raises is its reply
                        error = f"{type(e).__name__}: {e}"
                        time.sleep(wait * 2**n)
                else:
                    failures += 1
                rows.append((key, reply, error))
            yield pd.DataFrame(rows, columns=["key", "reply", "error"])

    return owed.select("key", "task", "payload").mapInPandas(run, REPLIES)


def complete(calls: DataFrame, cache: DataFrame, provider: Callable[[str, str], str] | None) -> tuple[DataFrame, DataFrame]:
    """All known replies, and the new rows for the cache; without a provider what is owed stays pending."""
    known, owed = replay_split(calls, cache)
    once = owed.dropDuplicates(["key"])  # equal calls are one question
    if provider is None:
        new = once.select("key", F.lit(None).cast("string").alias("reply"), F.lit("pending").alias("error"))
    else:
        new = ask(once, provider)
    done = owed.join(new.where("error is null").select("key", "reply"), "key")
    return known.unionByName(done), new


def summaries(planned: DataFrame, cache: DataFrame, provider: Callable[[str, str], str] | None, version: str = "1") -> tuple[DataFrame, DataFrame]:
    """Summaries of the planned texts whose level asks for one: one call a text."""
    calls = planned.where("level = 'summary'").select(F.lit("summary").alias("task"), F.lit(version).alias("version"), F.col("text").alias("payload"), "node_id")
    return complete(calls, cache, provider)
