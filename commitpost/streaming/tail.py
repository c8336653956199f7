"""A change log as a stream: messages in, events and progress marks out, whatever the log is cut into.

A micro-batch may end inside a transaction, or between a relation message and the inserts that need it. What the next
one needs is kept as two tables, written anew by each step: the messages of the transactions still open, and the latest
relation message of each table. Both are small; committed messages are never kept. A step reads the state of the step
before it only, and older state is deleted.

A step writes events, then marks, then rejects, then state, all under its batch id: a step that runs again replaces its
own output. ``events`` has the relay's schema, marks included and after the events they vouch for, so a relay can read
the folder as its stream.

Cases: messages that arrive twice within a step or after being kept count once; a source that resends an older,
finished stretch gives its events again, as at-least-once delivery allows; messages outside any transaction are rejects;
a transaction whose begin is followed by another begin is dropped; an empty micro-batch carries the state on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from commitpost.plans.stage import drop, scope, stage
from commitpost.sources import changelog
from commitpost.sources.schema import EVENT_COLUMNS

from .relay import STREAM_SCHEMA

LOG_SCHEMA = (
    "source string, wal_pos bigint, kind string, relation_oid bigint, data binary, end_lsn bigint, commit_micros bigint"
)
LOG_COLUMNS = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
TABLES = {"events": STREAM_SCHEMA, "rejects": "source string, wal_pos bigint, error string", "state": LOG_SCHEMA}


@dataclass
class LogTail:
    """Decodes a stream of log messages and keeps its tables under ``path``."""

    spark: SparkSession
    path: str
    finished: int | None = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.path}/{name}")

    def _folder(self, name: str, batch: int) -> str:
        return f"{self.path}/{name}/batch={batch}"

    def last_step(self, before: int) -> int | None:
        """The step whose state the next one starts from: state is written last."""
        if self.finished is not None and self.finished < before:
            return self.finished
        steps = self.spark.read.schema("batch bigint").parquet(f"{self.path}/state").select("batch").distinct()
        return steps.where(F.col("batch") < before).agg(F.max("batch")).first()[0]

    def prepare(self) -> None:
        for name, schema in TABLES.items():
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(self._folder(name, -1))

    def step(self, new: DataFrame, batch: int) -> None:
        """One micro-batch of the log; what it stages is deleted at its end."""
        with scope(self.spark):
            self._step(new, batch)

    def _step(self, new: DataFrame, batch: int) -> None:
        previous = self.last_step(batch)
        kept = self.spark.createDataFrame([], LOG_SCHEMA)
        if previous is not None:
            kept = self.spark.read.schema(LOG_SCHEMA).parquet(self._folder("state", previous))
        log = kept.unionByName(new.select(*LOG_COLUMNS)).dropDuplicates(["source", "wal_pos"])
        log = stage(log, "log")
        bounds = stage(changelog.boundaries(log), "bounds")
        found = stage(changelog.located(log, bounds), "inserts")

        committed = found.where(F.col("state") == changelog.COMMITTED).drop("state")
        events, rejects = changelog.read_inserts(committed, once=True)
        events = events.select(*EVENT_COLUMNS).withColumn("progress", F.lit(None).cast("boolean"))
        events.write.mode("overwrite").parquet(self._folder("events", batch))
        marks = changelog.progress_marks(log).select("source", F.col("lsn").alias("commit_lsn"), F.lit(True).alias("progress"))
        empty = self.spark.createDataFrame([], STREAM_SCHEMA)
        empty.unionByName(marks, allowMissingColumns=True).write.mode("append").parquet(self._folder("events", batch))
        rejects = rejects.unionByName(changelog.strays(found, bounds))
        rejects.write.mode("overwrite").parquet(self._folder("rejects", batch))

        latest = log.where(F.col("kind") == "R").groupBy("source", "relation_oid").agg(
            F.max_by(F.struct("wal_pos", "kind", "data"), "wal_pos").alias("r")
        )
        begins = bounds.where((F.col("kind") == "B") & F.col("after").isNull()).select("source", "wal_pos", "kind")
        inserts = found.where(F.col("state") == changelog.OPEN).select(
            "source", "wal_pos", F.lit("I").alias("kind"), "relation_oid", "data"
        )
        state = latest.select("source", "relation_oid", "r.*")
        for rows in (begins, inserts):
            state = state.unionByName(rows, allowMissingColumns=True)
        state = self.spark.createDataFrame([], LOG_SCHEMA).unionByName(state, allowMissingColumns=True)
        state.write.mode("overwrite").parquet(self._folder("state", batch))
        if previous is not None and previous >= 0:
            drop(self.spark, self._folder("state", previous - 1))
        self.finished = batch

    def start(self, log: DataFrame, checkpoint: str, **trigger):
        """Starts the stream; ``trigger`` as in ``DataStreamWriter.trigger`` (default: what is there, then stop)."""
        self.prepare()
        writer = log.writeStream.foreachBatch(self.step).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()
