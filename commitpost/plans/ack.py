"""The highest position that is safe to acknowledge.

Input is a log of steps ``(source, seq, action, lsn)``: an event committed at ``lsn`` was tracked, the source
reported everything up to ``lsn`` (progress), or an event of ``lsn`` was confirmed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .lookup import lookup_join
from .scan import Agg, log_levels, running
from .stage import stage

NEVER = 2**62
"""Later than any ``seq``."""


def unconfirmed(log: DataFrame) -> DataFrame:
    """One row per position: events tracked and confirmed, and when it was first reported and last confirmed."""

    def seq_of(action):
        return F.when(F.col("action") == action, F.col("seq"))

    return log.groupBy("source", "lsn").agg(
        F.count_if(F.col("action") == "track").alias("tracked"),
        F.count_if(F.col("action") == "confirm").alias("confirmed"),
        F.max(seq_of("confirm")).alias("done_at"),
        F.min(seq_of("progress")).alias("reported_at"),
    )


def ack_frontier(log: DataFrame) -> DataFrame:
    """The last safe position of each source, by aggregates only: the highest one below the first blocked."""
    entries = stage(unconfirmed(log), "entries")
    seen = entries.groupBy("source").agg(
        F.max(F.when(F.col("reported_at").isNotNull(), F.col("lsn"))).alias("observed")
    )
    spread = F.col("lsn")
    known = lookup_join(entries, seen, ["source"], spread)
    open_here = (F.col("tracked") > F.col("confirmed")) | (F.col("lsn") > F.coalesce("observed", F.lit(0)))
    blocked = known.groupBy("source").agg(F.min(F.when(open_here, F.col("lsn"))).alias("blocked"))
    below = lookup_join(entries, blocked, ["source"], spread).groupBy("source")
    safe = F.when(F.col("blocked").isNull() | (F.col("lsn") < F.col("blocked")), F.col("lsn"))
    return below.agg(F.coalesce(F.max(safe), F.lit(0)).alias("acked"))


def released(log: DataFrame, limit: int | None = None) -> DataFrame:
    """When each position became acknowledgeable: ``NEVER`` while something at or below it is open."""
    levels = log_levels("lsn", None)
    entries = running(
        stage(unconfirmed(log), "entries"), ["source"], ["lsn"], {"observed_at": Agg("min", F.col("reported_at"))}, levels,
        descending=True, limit=limit,
    )
    # A position without events that is reported after a higher one does not hold the others back.
    late = (F.col("tracked") == 0) & (F.col("observed_at") < F.col("reported_at"))
    open_still = F.col("observed_at").isNull() | (F.col("confirmed") < F.col("tracked"))
    ready_at = (
        F.when(open_still, F.lit(NEVER))
        .when(F.col("tracked") == 0, F.col("reported_at"))
        .otherwise(F.greatest("observed_at", "done_at"))
    )
    ready = stage(entries.select("source", "lsn", late.alias("late"), ready_at.alias("ready_at")), "ready")
    holds = Agg("max", F.when(~F.col("late"), F.col("ready_at")))
    held = running(ready, ["source"], ["lsn"], {"held_until": holds}, levels, limit=limit)
    return held.select("source", "lsn", F.greatest("ready_at", "held_until").alias("released_at"))


def ack_timeline(log: DataFrame, limit: int | None = None) -> DataFrame:
    """The safe position of a source after each step of its log."""
    steps = log.select("source", "seq", F.lit(None).cast("bigint").alias("lsn"))
    pops = released(log, limit).where(F.col("released_at") < NEVER)
    moments = stage(
        steps.unionByName(pops.select("source", F.col("released_at").alias("seq"), "lsn"))
        .groupBy("source", "seq")
        .agg(F.max("lsn").alias("lsn")),
        "moments",
    )
    levels = [[F.floor(F.col("seq") / 14_400_000_000)], [F.floor(F.col("seq") / 4_000_000)], [F.col("seq")]]
    acked = running(moments, ["source"], ["seq"], {"acked": Agg("max", F.col("lsn"))}, levels, limit=limit)
    return acked.select("source", "seq", F.coalesce("acked", F.lit(0)).alias("acked"))


def backlog_depth(log: DataFrame, limit: int | None = None) -> DataFrame:
    """Events read but neither published nor given up, after each step of a source."""
    change = F.when(F.col("action") == "track", 1).when(F.col("action") == "confirm", -1).otherwise(0)
    moments = stage(log.groupBy("source", "seq").agg(F.sum(change).alias("change")), "moments")
    levels = [[F.floor(F.col("seq") / 14_400_000_000)], [F.floor(F.col("seq") / 4_000_000)], [F.col("seq")]]
    depth = running(moments, ["source"], ["seq"], {"depth": Agg("sum", F.col("change"))}, levels, limit=limit)
    return depth.select("source", "seq", "depth")
