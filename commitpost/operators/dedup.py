"""What a first-in-first-out queue lets through."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from commitpost.plans.scan import Agg, count, running
from commitpost.plans.stage import stage

# Fixed value: how long a queue remembers a deduplication id.
DEDUP_WINDOW_MS = 300_000


def first_in_window(batches: Iterator[pd.DataFrame], window_ms: int) -> Iterator[pd.DataFrame]:
    """Keeps the sends the queue accepts, from rows sorted by ``(dedup_id, run, sent_ms)``."""
    stretch, accepted = None, 0
    for rows in batches:
        keep = []
        for dedup_id, run, sent in zip(rows["dedup_id"], rows["run"], rows["sent_ms"]):
            fresh = (dedup_id, run) != stretch or sent - accepted >= window_ms
            if fresh:
                stretch, accepted = (dedup_id, run), sent
            keep.append(fresh)
        yield rows[keep]


def fifo_dedup(sends: DataFrame, window_ms: int = DEDUP_WINDOW_MS, limit: int | None = None) -> DataFrame:
    """Sends ``(dedup_id, sent_ms)`` that are not within ``window_ms`` after an accepted one of their id.

    Copies of one millisecond are merged first. A pause as long as the window starts afresh, so an id is cut
    into runs without such a pause; runs are read in time order by different tasks, keeping one time in memory.
    """
    moments = stage(sends.select("dedup_id", "sent_ms").distinct(), "moments")
    hours = [[F.floor(F.col("sent_ms") / 3_600_000)], [F.col("sent_ms")]]
    previous = {"_last": Agg("last", F.col("sent_ms"))}
    spaced = running(moments, ["dedup_id"], ["sent_ms"], previous, hours, before=True, limit=limit)
    pause = F.when(F.col("sent_ms") - F.col("_last") >= window_ms, True)
    runs = running(spaced, ["dedup_id"], ["sent_ms"], {"run": count(pause)}, hours, limit=limit).drop("_last")
    in_order = runs.repartition("dedup_id", "run").sortWithinPartitions("dedup_id", "run", "sent_ms")
    accepted = in_order.select("dedup_id", "run", "sent_ms").mapInPandas(
        lambda batches: first_in_window(batches, window_ms), "dedup_id string, run bigint, sent_ms bigint"
    )
    return accepted.drop("run")
