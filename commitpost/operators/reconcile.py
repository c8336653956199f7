"""Checks of what was delivered against what was committed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from commitpost.functions import text
from commitpost.plans.batches import KEY, MAX_EVENTS
from commitpost.plans.scan import Agg, count, log_levels, running, time_levels
from commitpost.plans.stage import stage

ID = ["source", "id"]


def missing_events(committed: DataFrame, delivered: DataFrame, dead: DataFrame) -> DataFrame:
    """Committed events that were neither delivered nor dead-lettered."""
    settled = delivered.select(*ID).unionByName(dead.select(*ID)).distinct()
    return committed.join(settled, ID, "left_anti")


def republish_gap(events: DataFrame, delivered: DataFrame, after: int) -> DataFrame:
    """Outbox rows after a position that were never delivered."""
    return events.where(F.col("commit_lsn") > after).join(delivered.select(*ID).distinct(), ID, "left_anti")


def tenant_mismatches(events: DataFrame, received: DataFrame) -> DataFrame:
    """Messages whose source or group is not that of the tenant that wrote the event.

    ``received`` has ``id``, ``source`` and ``group_id``; copies of a message are counted before the join.
    """
    written = events.select(
        "id",
        F.col("source").alias("written_by"),
        text.broker_id(text.ordering_key()).alias("expected_group"),
    )
    copies = received.groupBy("id", "source", "group_id").agg(F.count(F.lit(1)).alias("messages"))
    wrong = (F.col("source") != F.col("written_by")) | (F.col("group_id") != F.col("expected_group"))
    return copies.join(written, "id").where(wrong)


def consume_once(received: DataFrame, processed: DataFrame) -> DataFrame:
    """The first delivery of every event a consumer has not processed before; of several at one time, the least by all
    columns."""
    rest = [c for c in received.columns if c not in ID]
    first = received.groupBy(*ID).agg(F.min_by(F.struct(*rest), F.struct("sent_at", *rest)).alias("_row"))
    return first.select(*ID, "_row.*").join(processed.select(*ID).distinct(), ID, "left_anti")


def duplicate_deliveries(delivered: DataFrame) -> DataFrame:
    return delivered.groupBy(*ID).agg(F.count(F.lit(1)).alias("deliveries")).where(F.col("deliveries") > 1)


def ids_lost(expected: DataFrame, got: DataFrame) -> DataFrame:
    return expected.select(*ID).subtract(got.select(*ID))


def ids_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Id rows on one side only, copies counted; empty when both hold the same."""
    side = F.sum(F.when(F.col("_left"), 1).otherwise(-1))
    rows = left.select(*ID, F.lit(True).alias("_left")).unionByName(right.select(*ID, F.lit(False).alias("_left")))
    extra = rows.groupBy(*ID).agg(side.alias("_extra")).where(F.col("_extra") != 0)
    return extra.select(
        *ID, F.when(F.col("_extra") > 0, "left").otherwise("right").alias("side"), F.abs("_extra").alias("copies")
    )


def order_violations(delivered: DataFrame, limit: int | None = None) -> DataFrame:
    """First deliveries that did not come after the key's previous one in commit order."""
    first = delivered.groupBy(*KEY, "id", "commit_lsn", "row_seq").agg(F.min(F.unix_micros("sent_at")).alias("sent_us"))
    previous = {"previous_lsn": Agg("last", F.col("commit_lsn"))}
    levels = time_levels("sent_us")
    by_time = running(
        first, KEY, ["sent_us", "commit_lsn", "row_seq"], previous, [*levels, *log_levels()], before=True, limit=limit
    )
    return by_time.where(F.col("commit_lsn") <= F.col("previous_lsn"))


def batch_violations(plan: DataFrame, batch: list[str], max_events: int = MAX_EVENTS) -> DataFrame:
    """Batches that are too large or hold a key twice."""
    keys = plan.groupBy(*batch, *[c for c in KEY if c not in batch]).agg(F.count(F.lit(1)).alias("_n"))
    per_batch = keys.groupBy(*batch).agg(
        F.sum("_n").alias("events"),
        F.max("_n").alias("most_of_one_key"),
    )
    return per_batch.where((F.col("events") > max_events) | (F.col("most_of_one_key") > 1))


def poll_inversions(events: DataFrame, limit: int | None = None) -> DataFrame:
    """Events a poller ordered by ``(created_at, id)`` would send before an earlier commit of their key."""
    timed = events.select(*KEY, "id", "commit_lsn", "row_seq", F.struct("created_at", "id").alias("polled"))
    latest = {"latest": Agg("max", F.col("polled"))}
    seen = running(timed, KEY, ["commit_lsn", "row_seq"], latest, log_levels(), before=True, limit=limit)
    return seen.where(F.col("polled") < F.col("latest")).drop("polled", "latest")


def commit_order(events: DataFrame, limit: int | None = None) -> DataFrame:
    """Each event's place in its source. Nothing is sorted across sources; ``events`` are read once, however often the
    scan looks for large groups."""
    narrow = stage(events.select("source", "id", "commit_lsn", "row_seq"), "positions")
    return running(narrow, ["source"], ["commit_lsn", "row_seq"], {"place": count()}, log_levels(), limit=limit)


def write_in_commit_order(events: DataFrame, path: str) -> None:
    """Stores events so that every file is a stretch of one source's log, in commit order."""
    stretch = F.shiftright("commit_lsn", 24).alias("stretch")
    sorted_rows = events.repartition("source", stretch).sortWithinPartitions("source", "commit_lsn", "row_seq")
    sorted_rows.write.partitionBy("source").parquet(path)


def retention_candidates(events: DataFrame, settled: DataFrame, before) -> DataFrame:
    """Published rows old enough to delete."""
    return events.where(F.col("created_at") < before).join(settled.select(*ID).distinct(), ID, "left_semi")


def retention_plan(events: DataFrame, settled: DataFrame, before, day: Column) -> DataFrame:
    """What to do with each day's partition: ``drop`` it if every event in it may go, ``rewrite`` it if some may."""
    done = settled.select(*ID).distinct().withColumn("_done", F.lit(True))
    expired = F.coalesce(F.col("created_at") < before, F.lit(False)) & F.col("_done").isNotNull()
    marked = events.select(*ID, "created_at", day.alias("day")).join(done, ID, "left")
    days = marked.groupBy("day").agg(F.count(F.lit(1)).alias("events"), F.count_if(expired).alias("expired"))
    verdict = F.when(F.col("expired") == F.col("events"), "drop").when(F.col("expired") > 0, "rewrite").otherwise("keep")
    return days.withColumn("verdict", verdict)


def trim_points(groups: DataFrame) -> DataFrame:
    """The entry up to which every consumer group of a stream has read."""
    return groups.groupBy("stream").agg(F.min("last_delivered").alias("trim_below"))
