"""Running aggregates over ordered groups of any size.

A window function puts a whole group into one task. Here a group with more than ``limit`` rows is cut into
consecutive chunks along its order: each chunk is scanned by itself, one row of totals per chunk is scanned
across the group, and the total of everything before a chunk is added to its rows. Small groups take the plain
window. Chunk bounds are expressions of the rows, so a recomputed task gives the same chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .lookup import lookup_join

HOT_ROWS = 1_000_000
"""A group above this is split. At most rows / HOT_ROWS groups can be."""


@dataclass(frozen=True)
class Agg:
    kind: str  # count, sum, max, min or last (the latest value that is not null)
    value: Column

    def over(self, window) -> Column:
        if self.kind == "last":
            return F.last(self.value, ignorenulls=True).over(window)
        return getattr(F, self.kind)(self.value).over(window)

    def total(self, order: Sequence[str], descending: bool) -> Column:
        if self.kind == "last":
            latest = F.min_by if descending else F.max_by
            return latest(self.value, F.when(self.value.isNotNull(), F.struct(*order)))
        return getattr(F, self.kind)(self.value)

    def carried(self, total: str, window) -> Column:
        if self.kind == "last":
            return F.last(total, ignorenulls=True).over(window)
        return getattr(F, "sum" if self.kind == "count" else self.kind)(total).over(window)

    def combined(self, here: Column, before: Column) -> Column:
        if self.kind == "count":
            return here + F.coalesce(before, F.lit(0))
        if self.kind == "sum":
            return F.when(here.isNull(), before).otherwise(here + F.coalesce(before, F.lit(0)))
        if self.kind == "last":
            return F.coalesce(here, before)
        return (F.greatest if self.kind == "max" else F.least)(here, before)


def count(value: Column | None = None) -> Agg:
    return Agg("count", F.lit(1) if value is None else value)


def log_levels(position: str = "commit_lsn", seq: str | None = "row_seq") -> list[list[Column]]:
    """Chunks along a log: 16 MiB of log, then one position and a million rows within it."""
    coarse = [F.shiftright(F.col(position), 24)]
    if seq is None:
        return [coarse]
    return [coarse, [F.col(position), F.shiftright(F.col(seq), 20)]]


def time_levels(micros: str) -> list[list[Column]]:
    """Chunks along a time in microseconds: an hour, then a second, then one instant."""
    at = F.col(micros)
    return [[F.floor(at / 3_600_000_000)], [F.floor(at / 1_000_000)], [at]]


def split_hot(
    df: DataFrame, by: Sequence[str], order: Sequence[str], levels: Sequence[Sequence[Column]], limit: int
) -> tuple[DataFrame, list[str]]:
    """Adds chunk columns that cut every group above ``limit`` rows; none if there is no such group."""
    chunk: list[str] = []
    for depth, level in enumerate(levels):
        keys = [*by, *chunk]
        candidates = df.where(F.col("_split")) if chunk else df
        hot = candidates.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
        hot = hot.select(*keys, F.lit(True).alias("_hot"))
        if hot.isEmpty():
            break
        df = lookup_join(df, hot, keys, F.struct(*order))
        for i, bound in enumerate(level):
            name = f"_chunk_{depth}_{i}"
            df = df.withColumn(name, F.when(F.col("_hot"), bound).otherwise(F.lit(-1)).cast("bigint"))
            chunk.append(name)
        df = df.withColumn("_split", F.col("_hot").isNotNull()).drop("_hot")
    return df, chunk


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    aggs: Mapping[str, Agg],
    levels: Sequence[Sequence[Column]],
    before: bool = False,
    descending: bool = False,
    limit: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Adds each aggregate of the rows of its group up to the row (or, with ``before``, up to the one before).

    ``order`` must be total within a group. ``levels`` are bounds that never decrease along it, coarse to
    fine; each level is used only inside chunks the one before it left above ``limit`` rows. A caller that
    knows there are at most ``rows`` rows saves the search for large groups.
    """
    limit = limit or HOT_ROWS
    if rows is not None and rows <= limit:
        levels = []
    frame_end = -1 if before else Window.currentRow
    direction = [F.desc(c) if descending else F.asc(c) for c in order]
    chunked, chunk = split_hot(df, by, order, levels, limit)
    local = Window.partitionBy(*by, *chunk).orderBy(*direction).rowsBetween(Window.unboundedPreceding, frame_end)
    if not chunk:
        return df.select("*", *(agg.over(local).alias(name) for name, agg in aggs.items()))

    keys = [*by, *chunk]
    along = Window.partitionBy(*by).orderBy(*[F.desc(c) if descending else F.asc(c) for c in chunk])
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        chunked.where(F.col(chunk[0]) >= 0)
        .groupBy(*keys)
        .agg(*(agg.total(order, descending).alias(f"_total_{name}") for name, agg in aggs.items()))
    )
    carry = totals.select(
        *keys, *(agg.carried(f"_total_{name}", earlier).alias(f"_before_{name}") for name, agg in aggs.items())
    )
    joined = chunked.join(carry, keys, "left")
    values = (
        agg.combined(agg.over(local), F.col(f"_before_{name}")).alias(name) for name, agg in aggs.items()
    )
    return joined.select(*df.columns, *values)
