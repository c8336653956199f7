"""Metric samples a running relay writes: one sample of every series after each step.

Counters are carried from step to step, so each sample is a total since the relay's first step, and a step that is
repeated counts once. Series: ``events_published_total``, ``publish_errors_total`` by kind, ``dead_letters_total``,
``publish_latency_bucket`` by upper bound (cumulative, as ``latency_histogram``) and the gauge ``pending_events``. Sources
start at zero when their first event or mark arrives. A sample has one row for each source and series: a few dozen rows a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from commitpost.operators.reports import LATENCY_BOUNDS, latency_histogram

SAMPLES = "at_us bigint, replica string, metric string, source string, sink string, kind string, value double"

COUNTERS = (
    ("events_published_total", "", "ok"),
    ("publish_errors_total", "retryable", "retryable"),
    ("publish_errors_total", "permanent", "permanent"),
    ("dead_letters_total", "", "permanent"),
)
LATENCY = "publish_latency_bucket"
PENDING = "pending_events"


def _lines(rows: list[tuple[str, str, Column]]) -> Column:
    structs = (F.struct(F.lit(m).alias("metric"), F.lit(k).alias("kind"), v.cast("double").alias("value")) for m, k, v in rows)
    return F.inline(F.array(*structs))


def step_samples(
    before: DataFrame, seen: DataFrame, outcomes: DataFrame, sent: DataFrame, waiting: DataFrame, replica: str, sink: str, at: float
) -> DataFrame:
    """The sample after a step: ``before`` is the one of the step before, the others are what this step took and made.

    Every part is summed up per source before the parts meet; ``outcomes`` has a row for each attempt, ``sent`` one for
    each event delivered, ``waiting`` one for each that is pending now."""
    zero = F.lit(0)
    bounds = [str(b) for b in LATENCY_BOUNDS] + ["+Inf"]
    started = seen.where("source is not null").select("source").distinct()
    zeros = [(m, k, zero) for m, k, _ in COUNTERS] + [(LATENCY, le, zero) for le in bounds] + [(PENDING, "", zero)]
    kinds = [F.count_if(F.col("outcome") == k).alias(k) for k in ("ok", "retryable", "permanent")]
    tried = outcomes.groupBy("source").agg(*kinds)
    delays = latency_histogram(sent.select("source", "committed_at", "sent_at"))
    now = waiting.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    parts = [
        before.where(F.col("metric") != PENDING).select("source", "metric", "kind", "value"),
        before.where(F.col("metric") == PENDING).select("source", "metric", "kind", F.lit(0.0).alias("value")),
        started.select("source", _lines(zeros)),
        tried.select("source", _lines([(m, k, F.col(c)) for m, k, c in COUNTERS])),
        delays.select("source", F.lit(LATENCY).alias("metric"), F.col("le").alias("kind"), F.col("deliveries").cast("double").alias("value")),
        now.select("source", _lines([(PENDING, "", F.col("n"))])),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    summed = rows.groupBy("metric", "source", "kind").agg(F.sum("value").alias("value"))
    named = (F.lit(int(at * 1_000_000)).alias("at_us"), F.lit(replica).alias("replica"), "metric", "source", F.lit(sink).alias("sink"))
    return summed.select(*named, "kind", "value")
