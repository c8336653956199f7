"""Alert rules over metric samples ``(at_us, replica, metric, source, sink, kind, value)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from commitpost.plans.scan import Agg, count, running
from commitpost.plans.stage import stage

from .reports import MINUTE_US, counter_steps, series, source_up, trailing_sums

# Thresholds and hold times of the rules, and how old a sample may get before its series is gone.
SLOT_LAG_BYTES = 512 * 1024 * 1024
SLOT_LAG_MINUTES = 10
DOWN_MINUTES = 5
STALL_MINUTES = 5
POISON_MINUTES = 15
STALE_MINUTES = 5


def held(rows: DataFrame, by: list[str], condition: Column, minutes: int, limit: int | None = None) -> DataFrame:
    """Stretches where ``condition`` stayed true for at least ``minutes``; a gap in the samples ends one."""
    marked = stage(rows.select(*by, "at_us", condition.alias("_on")), "condition")
    days = [[F.floor(F.col("at_us") / (1_440 * MINUTE_US))], [F.col("at_us")]]
    timed = running(marked, by, ["at_us"], {"_last": Agg("last", F.col("at_us"))}, days, before=True, limit=limit)
    gap = F.coalesce(F.col("at_us") - F.col("_last") > STALE_MINUTES * MINUTE_US, F.lit(True))
    broken = timed.withColumn("_break", F.when(~F.col("_on") | gap, True)).drop("_last")
    islands = running(broken, by, ["at_us"], {"_island": count(F.col("_break"))}, days, limit=limit)
    stretches = islands.where("_on").groupBy(*by, "_island").agg(
        F.min("at_us").alias("since_us"), F.max("at_us").alias("until_us")
    )
    fired = stretches.where(F.col("until_us") - F.col("since_us") >= minutes * MINUTE_US)
    return fired.select(*by, "since_us", (F.col("since_us") + minutes * MINUTE_US).alias("fired_us"), "until_us")


def gauge(samples: DataFrame, metric: str) -> DataFrame:
    return samples.where(F.col("metric") == metric)


def slot_lag_high(samples: DataFrame, threshold: int = SLOT_LAG_BYTES) -> DataFrame:
    lag = gauge(samples, "slot_lag_bytes")
    return held(lag, ["replica", "source"], F.col("value") > threshold, SLOT_LAG_MINUTES)


def relay_down(samples: DataFrame) -> DataFrame:
    return held(gauge(samples, "up"), ["replica"], F.col("value") == 0, DOWN_MINUTES)


def source_down(samples: DataFrame) -> DataFrame:
    return held(source_up(samples), ["source"], F.col("up") == 0, DOWN_MINUTES)


def publish_stalled(samples: DataFrame, minutes: int = STALL_MINUTES) -> DataFrame:
    """Retryable failures grew while nothing was published, for as long."""
    failing = (F.col("metric") == "publish_errors_total") & (F.col("kind") == "retryable")
    published = F.col("metric") == "events_published_total"
    gains = counter_steps(samples.where(failing | published))
    per_source = gains.groupBy("source", "at_us").agg(
        F.sum(F.when(failing, F.col("gain")).otherwise(0.0)).alias("failed"),
        F.sum(F.when(published, F.col("gain")).otherwise(0.0)).alias("published"),
    )
    recent = trailing_sums(per_source, ["source"], "failed", {"failed_recently": minutes})
    recent = trailing_sums(recent, ["source"], "published", {"published_recently": minutes})
    stalled = (F.col("failed_recently") > 0) & (F.col("published_recently") == 0)
    return held(recent, ["source"], stalled, minutes)


def poison_events(samples: DataFrame, minutes: int = POISON_MINUTES) -> DataFrame:
    """Stretches in which a dead letter was counted within the last minutes."""
    gains = counter_steps(gauge(samples, "dead_letters_total"))
    recent = trailing_sums(gains, series(gains), "gain", {"recent": minutes})
    return held(recent, ["replica", "source"], F.col("recent") > 0, 0)
