"""Totals, latencies, rates and health, from attempts, deliveries and metric samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from commitpost.functions import text
from commitpost.plans.lookup import lookup_join
from commitpost.plans.scan import Agg, running
from commitpost.plans.stage import stage

# Upper bounds of the latency buckets, in seconds; above the last is +Inf.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0)

MINUTE_US = 60_000_000


def delivery_totals(attempts: DataFrame, sources: DataFrame, sink: str) -> DataFrame:
    """Published, failed (by kind) and dead-lettered counts of every source, zeros included."""
    kinds = ("ok", "retryable", "permanent")
    counted = attempts.groupBy("source").agg(*(F.count_if(F.col("outcome") == k).alias(k) for k in kinds))
    zeros = sources.select("source", *(F.lit(0).cast("bigint").alias(k) for k in kinds))
    totals = counted.unionByName(zeros).groupBy("source").agg(*(F.sum(k).alias(k) for k in kinds))
    rows = [
        ("events_published", "", "ok"),
        ("publish_errors", "retryable", "retryable"),
        ("publish_errors", "permanent", "permanent"),
        ("dead_letters", "", "permanent"),
    ]
    line = F.inline(
        F.array(*(F.struct(F.lit(m).alias("metric"), F.lit(k).alias("kind"), F.col(c).alias("total")) for m, k, c in rows))
    )
    return totals.select(F.lit(sink).alias("sink"), "source", line)


def latency_us(since: str = "committed_at", until: str = "sent_at") -> Column:
    return F.greatest(F.unix_micros(until) - F.unix_micros(since), F.lit(0))


def latency_histogram(delivered: DataFrame, bounds=LATENCY_BOUNDS, by=("source",)) -> DataFrame:
    """Deliveries per source within each bound, cumulative; ``le`` is the bound, or +Inf for all."""
    latency = delivered.select(*by, latency_us().alias("us"))
    limits = [(str(b), int(b * 1_000_000)) for b in bounds]
    within = [F.count_if(F.col("us") <= us).alias(f"b{i}") for i, (_, us) in enumerate(limits)]
    counted = latency.groupBy(*by).agg(*within, F.count(F.lit(1)).alias("all"))
    buckets = [
        F.struct(F.lit(i).alias("bucket"), F.lit(le).alias("le"), F.col(f"b{i}").alias("deliveries"))
        for i, (le, _) in enumerate(limits)
    ]
    last = F.struct(F.lit(len(limits)).alias("bucket"), F.lit("+Inf").alias("le"), F.col("all").alias("deliveries"))
    return counted.select(*by, F.inline(F.array(*buckets, last)))


def histogram_quantiles(histogram: DataFrame, quantiles=(0.5, 0.99), by=("source",)) -> DataFrame:
    """Quantiles interpolated inside the bucket they fall in; above the last bound they are that bound."""
    along = Window.partitionBy(*by).orderBy("bucket")
    whole = Window.partitionBy(*by)
    bounds = histogram.withColumn("upper", F.expr("try_cast(nullif(le, '+Inf') as double)"))
    steps = bounds.select(
        *by, "upper", "deliveries",
        F.coalesce(F.lag("upper").over(along), F.lit(0.0)).alias("lower"),
        F.coalesce(F.lag("deliveries").over(along), F.lit(0)).alias("below"),
        F.max("deliveries").over(whole).alias("n"),
    )
    each = steps.withColumn("q", F.explode(F.array(*(F.lit(q) for q in quantiles))))
    rank = F.col("q") * F.col("n")
    hit = each.where((F.col("deliveries") >= rank) & (F.col("below") < rank))
    inside = F.col("lower") + (F.col("upper") - F.col("lower")) * (rank - F.col("below")) / (
        F.col("deliveries") - F.col("below")
    )
    return hit.select(*by, "q", F.coalesce(inside, "lower").alias("seconds"))


def ranked_values(values: DataFrame, by: list[str], value: str, limit: int | None = None) -> DataFrame:
    """Distinct values of each group with ``n`` (group size) and ``upto`` (rows up to and with the value)."""
    counts = stage(values.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c")), "values")
    sizes = counts.groupBy(*by).agg(F.sum("_c").alias("n"))
    levels = [[F.floor(F.col(value) / 65_536)], [F.col(value)]]
    summed = running(counts, by, [value], {"upto": Agg("sum", F.col("_c"))}, levels, limit=limit)
    return lookup_join(summed.drop("_c"), sizes, by, F.col(value))


def latency_percentiles(delivered: DataFrame, limit: int | None = None) -> DataFrame:
    """Exact nearest-rank p50, p99 and maximum in ms per source, from counts per distinct value."""
    latency = delivered.select("source", F.floor(latency_us() / 1000).alias("ms"))
    ranked = ranked_values(latency, ["source"], "ms", limit)

    def nearest(percent):
        # ceil(percent / 100 * n) in whole numbers
        rank = F.floor((F.col("n") * percent + 99) / 100)
        return F.min(F.when(F.col("upto") >= rank, F.col("ms")))

    return ranked.groupBy("source").agg(
        nearest(50).alias("p50_ms"), nearest(99).alias("p99_ms"), F.max("ms").alias("max_ms")
    )


def upper_median(values: DataFrame, by: list[str], value: str, limit: int | None = None) -> DataFrame:
    """The middle value of each group, the higher one of an even number."""
    ranked = ranked_values(values, by, value, limit)
    rank = F.floor(F.col("n") / 2) + 1
    return ranked.groupBy(*by).agg(F.min(F.when(F.col("upto") >= rank, F.col(value))).alias("median"))


def drain_rate(depth: DataFrame, total: DataFrame) -> DataFrame:
    """Events per second from the first look that saw any queued to the first that saw all.

    ``depth`` is ``(source, at_us, queued)``, ``total`` the events expected per source.
    """
    looks = lookup_join(depth, total.select("source", "total"), ["source"], F.col("at_us"), "inner")
    look = F.struct("at_us", "queued")
    ends = looks.groupBy("source").agg(
        F.min(F.when(F.col("queued") > 0, look)).alias("first"),
        F.min(F.when(F.col("queued") >= F.col("total"), look)).alias("done"),
    )
    seconds = (F.col("done.at_us") - F.col("first.at_us")) / 1_000_000
    return ends.where((F.col("done.at_us") > F.col("first.at_us"))).select(
        "source", ((F.col("done.queued") - F.col("first.queued")) / seconds).alias("events_per_second")
    )


def readiness(flags: DataFrame, by: list[str]) -> DataFrame:
    """Ready when any source streams and every source's last publish succeeded."""
    return flags.groupBy(*by).agg(
        (F.bool_or("source_ready") & F.bool_and("sink_ready")).alias("ready")
    )


def source_up(samples: DataFrame) -> DataFrame:
    """Replicas streaming each source, per sample time."""
    ups = samples.where(F.col("metric") == "source_up")
    return ups.groupBy("source", "at_us").agg(F.sum("value").cast("bigint").alias("up"))


def slot_lag(slots: DataFrame) -> DataFrame:
    """Log bytes each source's slots hold back; a slot nobody streams reports 0."""
    behind = text.lsn_value(F.col("current_lsn")) - text.lsn_value(F.col("confirmed_lsn"))
    lag = F.when(F.col("active"), behind).otherwise(F.lit(0))
    return slots.groupBy("source").agg(F.max(lag).alias("lag_bytes"))


def series(samples: DataFrame) -> list[str]:
    """What names a counter; one of each sink, if samples tell sinks apart."""
    return [c for c in ("replica", "metric", "source", "sink", "kind") if c in samples.columns]


def counter_steps(samples: DataFrame, limit: int | None = None) -> DataFrame:
    """What each counter gained since its sample before; after a reset it gained all it shows."""
    day = [[F.floor(F.col("at_us") / (1_440 * MINUTE_US))], [F.col("at_us")]]
    before = {"previous": Agg("last", F.col("value"))}
    seen = running(samples, series(samples), ["at_us"], before, day, before=True, limit=limit)
    gain = F.when(F.col("value") >= F.col("previous"), F.col("value") - F.col("previous")).otherwise(F.col("value"))
    return seen.where(F.col("previous").isNotNull()).withColumn("gain", gain).drop("previous")


def trailing_sums(rows: DataFrame, by: list[str], value: str, minutes: dict[str, int], chunk_minutes: int = 1_440) -> DataFrame:
    """Sums of ``value`` over the last so many minutes of each row's ``at_us``.

    A group is cut into days; a row is also repeated as the run-up of the next day if a window reaches it,
    so a window never needs a whole group in one task.
    """
    if max(minutes.values()) > chunk_minutes:
        raise ValueError("a window is longer than a chunk")
    chunk_us = chunk_minutes * MINUTE_US
    own = F.floor(F.col("at_us") / chunk_us)
    reach = F.floor((F.col("at_us") + max(minutes.values()) * MINUTE_US - 1) / chunk_us)
    spread = rows.withColumn("_own", own).withColumn("_chunk", F.explode(F.sequence(own, reach)))
    along = Window.partitionBy(*by, "_chunk").orderBy("at_us")
    sums = {
        name: F.sum(value).over(along.rangeBetween(-(width * MINUTE_US - 1), 0)) for name, width in minutes.items()
    }
    windowed = spread.select("*", *(total.alias(name) for name, total in sums.items()))
    return windowed.where(F.col("_chunk") == F.col("_own")).drop("_own", "_chunk")


def counter_increase(samples: DataFrame, minutes: dict[str, int]) -> DataFrame:
    """Increase of every counter over trailing windows: plain sums of gains, nothing extrapolated."""
    return trailing_sums(counter_steps(samples), series(samples), "gain", minutes)


def rate_per_minute(delivered: DataFrame) -> DataFrame:
    minute = F.floor(F.unix_micros("sent_at") / MINUTE_US)
    return delivered.groupBy("source", minute.alias("minute")).agg(F.count(F.lit(1)).alias("deliveries"))


def overview(samples: DataFrame, delivered: DataFrame, window_minutes: int = 1_440) -> DataFrame:
    """Dashboard figures of each window: ``(at_us, panel, label, value)``, ``at_us`` being its start."""
    width = window_minutes * MINUTE_US
    start = (F.floor(F.col("at_us") / width) * width).alias("at_us")
    gains = counter_steps(samples.where(F.col("metric").endswith("_total")))
    per_second = F.sum("gain") / (window_minutes * 60)

    def panel(rows: DataFrame, name: str, label: Column | str, value: Column) -> DataFrame:
        by = F.lit("") if isinstance(label, str) and not label else F.col(label) if isinstance(label, str) else label
        grouped = rows.groupBy(start, by.alias("label")).agg(value.cast("double").alias("value"))
        return grouped.select("at_us", F.lit(name).alias("panel"), "label", "value")

    def of(rows, metric):
        return rows.where(F.col("metric") == metric)

    figures = (
        panel(of(samples, "up"), "replicas_up", "replica", F.min("value"))
        .unionByName(panel(of(gains, "events_published_total"), "published_per_second", "", per_second))
        .unionByName(panel(of(gains, "events_published_total"), "published_per_second_by_source", "source", per_second))
        .unionByName(panel(of(gains, "publish_errors_total"), "errors_per_second", "kind", per_second))
        .unionByName(panel(of(gains, "dead_letters_total"), "dead_letters", "", F.sum("gain")))
        .unionByName(panel(of(samples, "slot_lag_bytes"), "slot_lag", "", F.max("value")))
        .unionByName(panel(of(samples, "slot_lag_bytes"), "slot_lag_by_source", "source", F.max("value")))
    )
    sent = delivered.withColumn("at_us", F.floor(F.unix_micros("sent_at") / width) * width)
    quantiles = histogram_quantiles(latency_histogram(sent, by=("at_us",)), by=("at_us",))
    latency = quantiles.select(
        "at_us", F.lit("latency_seconds").alias("panel"), F.col("q").cast("string").alias("label"),
        F.col("seconds").alias("value"),
    )
    return figures.unionByName(latency)
