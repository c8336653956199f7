"""The relay as a streaming job: events in, broker calls out, and tables of what became of them.

Every step writes, in this order: rejects, outcomes, dead letters, deliveries, the pending table, metric samples,
acknowledgements. A failure anywhere runs the micro-batch again: duplicates with the same ids, never a loss. Tables live under one folder,
one ``batch=``/``retry=`` partition per step: retry 0 is the micro-batch itself, later ones send again what is due. A
repeated step replaces its own partition, except in ``deliveries``, where copies stay visible as they would in a queue.
A micro-batch that brings nothing while nothing is due is no step and writes nothing; what a step stages is deleted at
its end. Dead letters are a ``KeyedStore``: a step opens the live runs of the buckets it adds to.

A row of the stream is an event, or, with ``progress`` set, a mark: its source has sent everything up to
``commit_lsn`` (true), or nothing but a wake-up call (false).
"""

from __future__ import annotations

import datetime
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from commitpost.functions import outcome, text
from commitpost.operators.dedup import DEDUP_WINDOW_MS
from commitpost.operators.messages import publish_requests
from commitpost.operators.outcomes import new_dead_letters
from commitpost.plans.batches import MAX_EVENTS
from commitpost.plans.stage import scope, stage
from commitpost.sources.schema import EVENT_COLUMNS, problem

from .metrics import SAMPLES, step_samples
from .send import OUTCOMES, Send, send_in_order
from .store import KeyedStore

EVENT_SCHEMA = (
    "source string, id string, aggregate_type string, aggregate_id string, event_type string, payload string, "
    "headers string, created_at timestamp, occurred_at string, commit_lsn bigint, row_seq bigint, committed_at timestamp"
)
STREAM_SCHEMA = f"{EVENT_SCHEMA}, progress boolean"
DEAD_LETTERS = "slot string, id string, envelope string, reason string, failed_at timestamp"

TABLES = {
    "rejects": "source string, id string, commit_lsn bigint, row_seq bigint, problem string",
    "outcomes": OUTCOMES,
    "deliveries": "source string, id string, aggregate_type string, aggregate_id string, attempt int, commit_lsn bigint, "
    "row_seq bigint, committed_at timestamp, sent_at timestamp, dedup_id string, body string",
    "pending": f"{EVENT_SCHEMA}, attempt int, retry_at timestamp",
    "acks": "source string, acked bigint, seen bigint",
    "metric_samples": SAMPLES,
}

DEDUP_PARTS = 1_024
"""Parts of a deduplication's state; fixed for the life of a checkpoint."""

Step = tuple[int, int]
"""(micro-batch, retry)"""


def _earlier(step: Step) -> Column:
    batch, retry = step
    return (F.col("batch") < batch) | (F.col("batch") == batch) & (F.col("retry") < retry)


def read_events(
    spark: SparkSession, path: str, format: str = "parquet", per_trigger: int | None = None, **options
) -> DataFrame:
    """Events from files as a stream, oldest files first; ``per_trigger`` files are taken at a time at most."""
    reader = spark.readStream.schema(STREAM_SCHEMA).format(format).options(**options)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(path)


def with_ticks(events: DataFrame, rows_per_second: int = 1) -> DataFrame:
    """``events`` and wake-up calls: due events are sent again although nothing new arrives."""
    ticks = events.sparkSession.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema.fields if f.name != "progress"]
    return events.unionByName(ticks.select(*empty, F.lit(False).alias("progress")))


@dataclass
class Relay:
    """Publishes a stream of events through ``send`` and keeps its tables under ``path``.

    A step needs only what the step before it wrote to ``pending`` and ``acks``: older partitions of these can be
    dropped. Failed events wait as ``backoff_ms`` says, ``initial_ms`` first and ``max_ms`` at most, and later events
    of their keys wait with them. ``patience`` is how many seconds a task of ``retry_pending`` may sleep until failed
    events are due again; what is due later is left to the next step. ``replica`` and ``sink`` name this job and its
    broker in the metric samples, whose time is that of ``clock``.
    """

    spark: SparkSession
    path: str
    send: Send
    target: str = "events.fifo"
    max_events: int = MAX_EVENTS
    lanes: int = 16
    retries: int = 0
    initial_ms: int = outcome.INITIAL_BACKOFF_MS
    max_ms: int = outcome.MAX_BACKOFF_MS
    replica: str = "r0"
    sink: str = "queue"
    clock: Callable[[], float] = time.time
    patience: float = 300.0
    finished: Step | None = None

    def __post_init__(self) -> None:
        self.dead_letters = KeyedStore(self.spark, f"{self.path}/dead_letters", DEAD_LETTERS, ("slot", "id"))

    def table(self, name: str) -> DataFrame:
        """A table over all steps, with their ``batch`` and ``retry``; dead letters as they are after the last step."""
        if name == "dead_letters":
            return self.dead_letters.read(self.last_step())
        schema = f"{TABLES[name]}, batch bigint, retry bigint"
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def at_step(self, name: str, step: Step) -> DataFrame:
        """What one step wrote; the other steps are not listed."""
        return self.spark.read.schema(TABLES[name]).parquet(self._folder(name, step))

    def _folder(self, name: str, step: Step) -> str:
        return f"{self.path}/{name}/batch={step[0]}/retry={step[1]}"

    def write(self, name: str, rows: DataFrame, step: Step, mode: str = "overwrite") -> DataFrame:
        rows.write.mode(mode).parquet(self._folder(name, step))
        return self.at_step(name, step)

    def last_step(self, before: Step | None = None) -> Step:
        """The last finished step; acknowledgements are written last. Looked up once, then remembered."""
        if self.finished is not None and (before is None or self.finished < before):
            return self.finished
        steps = self.table("acks").select("batch", "retry").distinct()
        if before is not None:
            steps = steps.where(_earlier(before))
        last = steps.agg(F.max(F.struct("batch", "retry"))).first()[0]
        return (-1, 0) if last is None else (last["batch"], last["retry"])

    def prepare(self) -> None:
        """Empty tables, so that the first micro-batch has something to read."""
        for name, schema in TABLES.items():
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(self._folder(name, (-1, 0)))
        self.dead_letters.prepare()

    def publish(self, new: DataFrame, batch: int) -> None:
        """One micro-batch of the stream."""
        self.run_step(new, (batch, 0))

    def run_step(self, new: DataFrame, step: Step, linger: bool = False) -> None:
        """Everything due and everything new, in commit order per key; no step if there is neither. With ``linger`` also
        what becomes due while the step runs, as far as ``patience`` goes."""
        with scope(self.spark):
            self._run_step(new, step, linger)

    def _run_step(self, new: DataFrame, step: Step, linger: bool) -> None:
        previous = self.last_step(before=step)
        now = F.lit(datetime.datetime.now(datetime.timezone.utc))
        if "progress" not in new.columns:
            new = new.withColumn("progress", F.lit(None).cast("boolean"))
        pending = self.at_step("pending", previous)
        checked = new.withColumn("problem", F.when(F.col("progress").isNull(), problem(EVENT_COLUMNS)))
        taken = stage(checked.select(*EVENT_COLUMNS, "progress", "problem"), "taken")  # the stream is read once
        if taken.where("progress is null or progress").isEmpty() and self._nothing_due(pending, now):
            return
        self.write("rejects", taken.where("problem is not null").select("source", "id", "commit_lsn", "row_seq", "problem"), step)

        # Copies of an event in one micro-batch: the one that was committed first. Few events have any or are pending
        # already, and only those are grouped with their payloads.
        id = ["source", "id"]
        earliest = F.min_by(F.struct(*EVENT_COLUMNS), F.struct("commit_lsn", "row_seq")).alias("e")
        fresh = taken.where("progress is null and problem is null").select(*EVENT_COLUMNS)
        both = fresh.select(*id, F.lit(0).alias("open")).unionByName(pending.select(*id, F.lit(1).alias("open")))
        copied = both.groupBy(*id).agg(F.max("open").alias("open"), F.count(F.lit(1)).alias("n")).where("n > 1")
        copied = stage(copied.select(*id, "open"), "copied")
        if not copied.isEmpty():
            first = fresh.join(copied.where("open = 0"), id, "left_semi").groupBy(*id).agg(earliest).select("e.*")
            fresh = fresh.join(copied, id, "left_anti").unionByName(stage(first, "first"))
        fresh = fresh.withColumn("attempt", F.lit(0)).withColumn("retry_at", F.lit(None).cast("timestamp"))
        work = pending.unionByName(fresh).withColumns({"order_key": text.ordering_key(), "committed_us": F.unix_micros("committed_at")})
        early = stage(pending.where(F.col("retry_at") > now).select(text.ordering_key().alias("order_key")).distinct(), "early")

        due = work if early.isEmpty() else work.join(early, "order_key", "left_anti")
        requests = publish_requests(due, self.target, self.max_events, self.lanes, keep=["attempt", "order_key", "committed_us"], in_lanes=True)
        carry = ["aggregate_type", "aggregate_id", "commit_lsn", "row_seq", "committed_us", "body"]
        backoff = {"initial_ms": self.initial_ms, "max_ms": self.max_ms}
        tries = stage(send_in_order(requests, self.send, self.retries, carry, self.patience if linger else 0.0, **backoff), "tries")
        outcomes = self.write("outcomes", tries.select(*id, "attempt", "outcome", "reason", "sent_at"), step)

        rejected = tries.where("outcome = 'permanent'").select(
            F.concat(F.lit("outbox_"), "source").alias("slot"), "id", F.col("body").alias("envelope"), "reason",
            F.col("sent_at").alias("failed_at"),
        )
        self.store_dead_letters(rejected, previous, step)

        sent = tries.where("outcome = 'ok'").select(
            "source", "id", "aggregate_type", "aggregate_id", "attempt", "commit_lsn", "row_seq",
            F.timestamp_micros("committed_us").alias("committed_at"), "sent_at",
            text.broker_id(text.dedup_key()).alias("dedup_id"), "body",
        )
        self.write("deliveries", sent, step, "append")

        # An event has one final outcome at most, so if there are as many of these as events, nothing is left.
        if work.count() == outcomes.where("outcome in ('ok', 'permanent')").count():
            waiting = self.spark.createDataFrame([], TABLES["pending"])
        else:
            last = F.max_by(F.struct("outcome", "sent_at", F.col("attempt").alias("attempts")), "attempt").alias("last")
            state = work.join(outcomes.groupBy(*id).agg(last), id, "left")
            attempt = F.coalesce("last.attempts", "attempt")
            jitter = outcome.jitter(F.col("source"), F.col("id"), attempt.cast("string"))
            delay = outcome.backoff_ms(attempt - 1, jitter, self.initial_ms, self.max_ms)
            again = F.timestamp_micros(F.unix_micros("last.sent_at") + delay * 1000)
            waiting = state.where(F.coalesce(F.col("last.outcome") == "retryable", F.lit(True))).withColumns({
                "retry_at": F.when(F.col("last").isNull(), F.col("retry_at")).otherwise(again), "attempt": attempt,
            })
        waiting = self.write("pending", waiting.select(*EVENT_COLUMNS, "attempt", "retry_at"), step)
        before, named = self.at_step("metric_samples", previous), (self.replica, self.sink)
        seen = taken.where("problem is null").select("source")
        self.write("metric_samples", step_samples(before, seen, outcomes, sent, waiting, *named, self.clock()), step)
        self.acknowledge(taken, waiting, previous, step)
        self.finished = step

    def _nothing_due(self, pending: DataFrame, now: Column) -> bool:
        """True if some event of every pending key has to wait still."""
        keys = pending.groupBy(text.ordering_key().alias("key")).agg(F.bool_or(F.coalesce(F.col("retry_at") > now, F.lit(False))).alias("early"))
        return keys.where(~F.col("early")).isEmpty()

    def store_dead_letters(self, rejected: DataFrame, previous: Step, step: Step) -> None:
        """Adds the dead letters that no earlier step has stored."""
        rejected = stage(rejected, "rejected")
        buckets = self.dead_letters.buckets_of(rejected)
        new = new_dead_letters(rejected, self.dead_letters.read(previous, buckets)) if buckets else rejected
        self.dead_letters.add(new, buckets, previous, step)

    def acknowledge(self, taken: DataFrame, waiting: DataFrame, previous: Step, step: Step) -> None:
        """Moves each source's safe position: as far as it is known to be complete, and below its first open event.

        A source is complete up to its latest mark, and below the highest position seen: more events of that one
        may still come. ``seen`` carries this from step to step, one row for each source.
        """
        complete = F.when(F.col("progress"), F.col("commit_lsn")).when(F.col("progress").isNull(), F.col("commit_lsn") - 1)
        reached = taken.where("source is not null").select("source", complete.alias("seen")).where("seen is not null")
        carried = self.at_step("acks", previous)
        known = carried.select("source", "acked", "seen").unionByName(reached.withColumn("acked", F.lit(None).cast("bigint")))
        known = known.groupBy("source").agg(F.max("acked").alias("before"), F.max("seen").alias("seen"))
        first_open = waiting.groupBy("source").agg(F.min("commit_lsn").alias("open"))
        safe = F.greatest("before", F.least("seen", F.col("open") - 1))  # nulls are left out
        self.write("acks", known.join(first_open, "source", "left").select("source", safe.alias("acked"), "seen"), step)

    def start(self, events: DataFrame, checkpoint: str, **trigger):
        """Starts the stream; ``trigger`` as in ``DataStreamWriter.trigger`` (default: what is there, then stop)."""
        self.prepare()
        writer = events.writeStream.foreachBatch(self.publish).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def retry_pending(self, wait: bool = True) -> bool:
        """Sends again what is due, without new events; with ``wait``, first waits for the earliest to be due, and goes on
        with what becomes due meanwhile: a key that fails again and again is not planned anew for each failure. True if
        something is pending still. It makes steps of its own, so no stream of this relay may run meanwhile; a
        running stream retries by itself if it has ticks."""
        last = self.last_step()
        earliest = self.at_step("pending", last).agg(F.min("retry_at")).select(F.unix_micros("min(retry_at)")).first()[0]
        if wait and earliest is not None:
            time.sleep(max(0.0, earliest / 1e6 - time.time()))
        step = (last[0], last[1] + 1)
        self.run_step(self.spark.createDataFrame([], STREAM_SCHEMA), step, linger=wait)
        return not self.at_step("pending", self.last_step()).isEmpty()


def dedup_stream(deliveries: DataFrame, minutes: int = 5) -> DataFrame:
    """Drops copies of a dedup id sent within the window; late copies may be dropped after it too."""
    marked = deliveries.withWatermark("sent_at", f"{minutes} minutes")
    return marked.dropDuplicatesWithinWatermark(["dedup_id"])


def exact_dedup_stream(
    sends: DataFrame, window_ms: int = DEDUP_WINDOW_MS, lateness: str = "5 minutes", parts: int = DEDUP_PARTS
) -> DataFrame:
    """``(dedup_id, sent_ms)`` that a queue accepts: not within the window after an accepted one of the same id.

    The last accepted time of an id is its state, and the window is measured from that, not from copies. Event time
    evicts it: once the watermark has passed the end of its window, no copy can fall inside. Sends of an id must arrive
    in time order from one micro-batch to the next, as a delivery log does; those of one micro-batch may be mixed. Ids
    share state by hash in ``parts`` parts: most ids are sent once, and a call of Python for each would cost far more than
    its work."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def accept(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:  # all its ids have
            state.remove()
            return
        accepted: dict = dict(zip(*state.get)) if state.exists else {}
        rows = pd.concat([batch[["dedup_id", "sent_ms"]] for batch in batches]).sort_values("sent_ms")
        kept = []
        for row in zip(rows["dedup_id"], rows["sent_ms"].tolist()):
            last = accepted.get(row[0])
            if last is None or row[1] - last >= window_ms:
                accepted[row[0]] = row[1]
                kept.append(row)
        watermark = state.getCurrentWatermarkMs()
        live = {id: ms for id, ms in accepted.items() if ms + window_ms >= watermark}
        if live:
            state.update((list(live), list(live.values())))
            state.setTimeoutTimestamp(max(max(live.values()) + window_ms, watermark + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(kept, columns=["dedup_id", "sent_ms"])

    marked = sends.select("dedup_id", F.unix_millis("sent_at").alias("sent_ms"), "sent_at").withWatermark("sent_at", lateness)
    dealt = marked.withColumn("part", F.pmod(F.xxhash64("dedup_id"), F.lit(parts)))
    return dealt.groupBy("part").applyInPandasWithState(
        accept, "dedup_id string, sent_ms bigint", "ids array<string>, accepted array<bigint>", "append",
        GroupStateTimeout.EventTimeTimeout,
    )


def rate_stream(deliveries: DataFrame, lateness: str = "5 minutes") -> DataFrame:
    """Deliveries per source and minute; a minute is final once ``lateness`` has passed."""
    marked = deliveries.withWatermark("sent_at", lateness)
    counted = marked.groupBy("source", F.window("sent_at", "1 minute")).agg(F.count(F.lit(1)).alias("deliveries"))
    return counted.select("source", F.col("window.start").alias("minute"), "deliveries")
