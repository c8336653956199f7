"""Publish batches and the calls they are cut into."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .scan import HOT_ROWS, count, log_levels, running
from .stage import stage

# The default batch, and the limits of one broker call.
MAX_EVENTS = 10
CALL_ENTRIES = 10
CALL_BYTES = 262_144

KEY = ("source", "aggregate_type", "aggregate_id")


def lane_of(lanes: int) -> Column:
    """Publishing lane of a key; a key never changes lanes, so lanes can publish at the same time."""
    digest = F.md5(F.concat_ws(":", *KEY))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % lanes).cast("bigint")


def plan_batches(
    events: DataFrame,
    max_events: int = MAX_EVENTS,
    lanes: int = 1,
    carry: Sequence[str] = (),
    limit: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Batches of at most ``max_events``, oldest first, never two events of one key.

    The n-th event of every key of a lane belongs to round n; a round is cut into batches in commit order.
    Batches run in the order ``(round, batch)``, so a key's events stay in commit order. ``carry`` names short
    columns to keep; payloads are better joined to the plan by ``(source, id)``. ``rows`` as in ``running``.
    """
    narrow = events.select(*KEY, "id", "commit_lsn", "row_seq", *carry)
    order = ["commit_lsn", "row_seq"]
    rounds = running(narrow, KEY, order, {"round": count()}, log_levels(), limit=limit, rows=rows)
    rounds = rounds.select("source", lane_of(lanes).alias("lane"), "round", *KEY[1:], "id", *order, *carry)
    if rows is None or rows > (limit or HOT_ROWS):
        rounds = stage(rounds, "rounds")
    placed = running(rounds, ["source", "lane", "round"], order, {"_n": count()}, log_levels(), limit=limit, rows=rows)
    return placed.select(
        "source", "lane", "round",
        F.floor((F.col("_n") - 1) / max_events).alias("batch"),
        ((F.col("_n") - 1) % max_events).alias("position"),
        *KEY[1:], "id", *order, *carry,
    )


def plan_in_lanes(entries: DataFrame, max_events: int = MAX_EVENTS) -> DataFrame:
    """``plan_batches`` and ``split_calls`` for entries that lie in partitions by ``(source, lane)`` already, without another
    shuffle. Adds ``round``, ``batch``, ``position``, ``call`` and ``index``; a row folds the sizes of its batch if that
    takes more than one call."""
    order = ["commit_lsn", "row_seq"]
    of_key = Window.partitionBy("source", "lane", *KEY[1:]).orderBy(*order)
    rounds = entries.withColumn("round", F.row_number().over(of_key).cast("bigint"))
    place = F.row_number().over(Window.partitionBy("source", "lane", "round").orderBy(*order)).cast("bigint") - 1
    placed = rounds.withColumn("_n", place).withColumns({"batch": F.floor(F.col("_n") / max_events), "position": F.col("_n") % max_events})
    so_far = Window.partitionBy("source", "lane", "round", "batch").orderBy("position")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = placed.withColumns({"_bytes": F.sum("size").over(so_far), "_sizes": F.collect_list("size").over(so_far)})
    zero = F.lit(0).cast("bigint")

    def put(state: Column, size: Column) -> Column:
        opens = (state["index"] + 1 == CALL_ENTRIES) | (state["bytes"] + size > CALL_BYTES)
        return F.struct(
            (state["call"] + F.when(opens, 1).otherwise(0)).cast("bigint").alias("call"),
            F.when(opens, zero).otherwise(state["index"] + 1).alias("index"),
            F.when(opens, size).otherwise(state["bytes"] + size).alias("bytes"),
        )

    start = F.struct(zero.alias("call"), zero.alias("index"), F.element_at("_sizes", 1).alias("bytes"))
    folded = F.aggregate(F.slice("_sizes", F.lit(2), F.size("_sizes")), start, put)
    first = (F.col("_bytes") <= CALL_BYTES) & (F.col("position") < CALL_ENTRIES)
    cut = sized.withColumns({
        "call": F.when(first, zero).otherwise(folded["call"]),
        "index": F.when(first, F.col("position")).otherwise(folded["index"]),
    })
    return cut.drop("_n", "_bytes", "_sizes")


def plan_buffers(events: DataFrame, max_events: int, buffer: int) -> DataFrame:
    """Oldest-first batches out of a bounded buffer: fill it, empty it batch by batch, fill it again.

    Each batch takes the oldest events left whose key it does not hold yet. A buffer is at most ``buffer``
    rows, whatever the size of the source or of a key. No batch spans two buffers, so ``buffer`` is a choice of the
    caller that changes the batches: what its publisher holds in memory.
    """
    narrow = events.select(*KEY, "id", "commit_lsn", "row_seq")
    placed = running(narrow, ["source"], ["commit_lsn", "row_seq"], {"_n": count()}, log_levels())
    buffers = placed.withColumn("buffer", F.floor((F.col("_n") - 1) / buffer))

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_n")
        taken: list[int] = []  # events in each batch so far
        next_batch: dict[tuple[str, str], int] = {}  # the first batch a key may enter
        first_open = 0
        batches = []
        for key in zip(rows["aggregate_type"], rows["aggregate_id"]):
            number = max(next_batch.get(key, 0), first_open)
            while number < len(taken) and taken[number] == max_events:
                number += 1
            if number == len(taken):
                taken.append(0)
            taken[number] += 1
            next_batch[key] = number + 1
            while first_open < len(taken) and taken[first_open] == max_events:
                first_open += 1
            batches.append(number)
        return rows.assign(batch=batches)[["source", "buffer", "batch", "id", "commit_lsn", "row_seq"]]

    return buffers.groupBy("source", "buffer").applyInPandas(
        fill, "source string, buffer bigint, batch bigint, id string, commit_lsn bigint, row_seq bigint"
    )


def split_calls(
    entries: DataFrame,
    by: Sequence[str],
    id: str = "id",
    position: str = "position",
    size: str = "size",
    max_entries: int = CALL_ENTRIES,
    max_bytes: int = CALL_BYTES,
) -> DataFrame:
    """Cuts each batch, in order, into calls within both limits. An entry too large for any call is alone.

    ``by`` names one batch, so the folded array holds at most one batch of (position, size, id).
    Returns ``by``, the id, and ``call`` and ``index`` counted from 0 in the batch and in the call.
    """
    entry_of = F.struct(F.col(position).alias("at"), F.col(size).cast("bigint").alias("size"), F.col(id).alias("id"))
    lists = entries.groupBy(*by).agg(F.array_sort(F.collect_list(entry_of)).alias("_entries"))
    start = F.struct(
        F.lit(-1).cast("bigint").alias("call"),
        F.lit(0).cast("bigint").alias("entries"),
        F.lit(0).cast("bigint").alias("bytes"),
        F.expr("cast(array() as array<struct<id:string,call:bigint,index:bigint>>)").alias("out"),
    )

    def place(state: Column, entry: Column) -> Column:
        opens = (
            (state["call"] < 0)
            | (state["entries"] == max_entries)
            | (state["bytes"] + entry["size"] > max_bytes)
        )
        call = F.when(opens, state["call"] + 1).otherwise(state["call"])
        index = F.when(opens, F.lit(0).cast("bigint")).otherwise(state["entries"])
        placed = F.struct(entry["id"].alias("id"), call.alias("call"), index.alias("index"))
        return F.struct(
            call.alias("call"),
            (index + 1).alias("entries"),
            F.when(opens, entry["size"]).otherwise(state["bytes"] + entry["size"]).alias("bytes"),
            F.concat(state["out"], F.array(placed)).alias("out"),
        )

    calls = F.inline(F.aggregate("_entries", start, place, lambda state: state["out"]))
    return lists.select(*by, calls).withColumnRenamed("id", id)
