"""Events as broker messages and stream entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from commitpost.functions import text
from commitpost.plans.batches import KEY, MAX_EVENTS, lane_of, plan_batches, plan_in_lanes, split_calls

STREAM_PREFIX = "outbox:"


def attributes() -> Column:
    """Lets consumers deduplicate and filter without parsing the body; an empty event type is left out."""
    always = F.create_map(F.lit("id"), F.col("id"), F.lit("source"), F.col("source"))
    typed = F.map_concat(always, F.create_map(F.lit("event_type"), F.col("event_type")))
    return F.when(F.col("event_type") != "", typed).otherwise(always)


def messages(events: DataFrame, target: str, keep: Sequence[str] = ()) -> DataFrame:
    """Queue or topic messages. A target named ``*.fifo`` gets group and deduplication ids, others get none.

    ``keep`` names further columns of the events to pass on.
    """
    fifo = text.is_fifo(F.lit(target))
    shaped = events.withColumn("body", text.envelope())
    return shaped.select(
        "source", "id", "commit_lsn", "row_seq", "body",
        attributes().alias("attributes"),
        F.when(fifo, text.broker_id(text.ordering_key())).alias("group_id"),
        F.when(fifo, text.broker_id(text.dedup_key())).alias("dedup_id"),
        text.entry_size(F.col("body")).alias("size"),
        *keep,
    )


def stream_entries(events: DataFrame, prefix: str = STREAM_PREFIX) -> DataFrame:
    """One entry per event, in the stream of its aggregate type."""
    return events.select(
        F.concat(F.lit(prefix), "aggregate_type").alias("stream"),
        "source", "id", "event_type", text.envelope().alias("envelope"), "commit_lsn", "row_seq",
    )


def write_streams(entries: DataFrame, path: str) -> None:
    """Appends entries under ``stream=...`` folders. A file holds a stretch of one source's log, in commit order."""
    stretch = F.shiftright("commit_lsn", 24).alias("stretch")
    (
        entries.repartition("stream", "source", stretch)
        .sortWithinPartitions("stream", "source", "commit_lsn", "row_seq")
        .write.partitionBy("stream")
        .mode("append")
        .parquet(path)
    )


def publish_requests(
    events: DataFrame,
    target: str,
    max_events: int = MAX_EVENTS,
    lanes: int = 1,
    keep: Sequence[str] = (),
    rows: int | None = None,
    in_lanes: bool = False,
) -> DataFrame:
    """The entries of every broker call: which batch, which call of it, which index, and the message.

    With ``in_lanes`` a lane is planned by the task that holds it: for those who then send it from there. The messages
    are shuffled once and stay in the order of the calls; ``position`` and the columns of the key are kept.
    """
    if in_lanes:
        shaped = messages(events, target, [*KEY[1:], *keep]).withColumn("lane", lane_of(lanes))
        return plan_in_lanes(shaped.repartition("source", "lane"), max_events)
    shaped = messages(events, target, keep)
    sized = events.withColumn("size", text.entry_size(text.envelope()))
    plan = plan_batches(sized, max_events, lanes, carry=["size"], rows=rows)
    calls = split_calls(plan, ["source", "lane", "round", "batch"])
    return calls.join(shaped, ["source", "id"])
