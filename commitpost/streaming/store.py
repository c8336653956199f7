"""A table of rows by key that grows step by step and stays cheap to look into.

Rows lie in buckets by a hash of their key. A step adds one run to each bucket it touches. As soon as a bucket has ``fan``
runs of one level, the step writes them and its own rows as one run of the next level, so a row is rewritten once per
level, and a bucket of n runs has at most ``(fan - 1) * log(n)`` live ones. A manifest for each step names the live
runs; nothing else is listed, whatever the number of steps.

Cases: a step that is repeated replaces its own runs and manifest; what an unfinished step has written is in no
manifest that is read; runs that a step has merged are deleted by the step after it, when it cannot be repeated any more, so
a reader should hold a manifest for one step at most; a step without rows only hands the manifest on.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from commitpost.plans.stage import drop

MANIFEST = "bucket int, level int, run string, live boolean"
START = (-1, 0)

Step = tuple[int, int]
Run = tuple[int, int, str]
"""(bucket, level, folder)"""


def place(runs: list[Run], touched: list[int], folder: str, fan: int) -> tuple[list[Run], list[Run]]:
    """The live runs after a step that adds to the buckets ``touched``, and those of the old ones it merges."""
    by_level: dict[tuple[int, int], list[Run]] = defaultdict(list)
    for run in runs:
        by_level[run[:2]].append(run)
    merged: list[Run] = []
    added: list[Run] = []
    for bucket in touched:
        level = 0
        while len(by_level[bucket, level]) >= fan - 1:
            merged += by_level[bucket, level]
            level += 1
        added.append((bucket, level, f"{folder}/bucket={bucket}"))
    gone = set(merged)
    return [run for run in runs if run not in gone] + added, merged


@dataclass
class KeyedStore:
    """Rows of ``schema``, unique or not, in ``buckets`` by a hash of ``keys``."""

    spark: SparkSession
    path: str
    schema: str
    keys: tuple[str, ...]
    buckets: int = 64
    fan: int = 8

    def _folder(self, name: str, step: Step) -> str:
        return f"{self.path}/{name}/batch={step[0]}/retry={step[1]}"

    def _publish(self, live: list[Run], gone: list[Run], step: Step, mode: str = "overwrite") -> None:
        rows = [(*run, True) for run in live] + [(*run, False) for run in gone]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode(mode).parquet(self._folder("manifest", step))

    def prepare(self) -> None:
        self._publish([], [], START, "ignore")

    def manifest(self, step: Step, live: bool = True) -> list[Run]:
        """The live runs after a step, or those it has merged: at most ``buckets * (fan - 1)`` for each level."""
        rows = self.spark.read.schema(MANIFEST).parquet(self._folder("manifest", step)).where(F.col("live") == live)
        return sorted((r["bucket"], r["level"], r["run"]) for r in rows.collect())

    def _read(self, runs: list[Run]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(run for _, _, run in runs))

    def read(self, step: Step, buckets: list[int] | None = None) -> DataFrame:
        """The rows after a step, of some buckets or of all."""
        return self._read([r for r in self.manifest(step) if buckets is None or r[0] in buckets])

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that some rows belong to; at most ``buckets`` numbers."""
        return sorted(r["bucket"] for r in rows.select(self.bucket().alias("bucket")).distinct().collect())

    def add(self, rows: DataFrame, touched: list[int], previous: Step, step: Step) -> None:
        """Adds ``rows``, all of them in the buckets ``touched``, to what there was after the step ``previous``."""
        for _, _, run in self.manifest(previous, live=False):
            drop(self.spark, run)
        folder = self._folder("runs", step)
        live, merged = place(self.manifest(previous), touched, folder, self.fan)
        if touched:
            written = rows.unionByName(self._read(merged)).withColumn("bucket", self.bucket())
            written.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
            stored = self.spark.read.schema("bucket int").parquet(folder).select("bucket").distinct()
            filled = {r["bucket"] for r in stored.collect()}
            live = [r for r in live if not r[2].startswith(f"{folder}/") or r[0] in filled]
        self._publish(live, merged, step)
