"""An outbox stored by day, whose old, settled events are dropped by whole days where that is possible.

The folders that make up the table are named by a manifest, a small table with one row for each day and folder. Expiring
writes anew only the days that hold both settled and open events, then a manifest of the next version: readers see all
of a version or nothing of it, since the version counts from the moment its ``_SUCCESS`` mark is there. A crash before
that leaves the table as it was, and the repeated run overwrites what the broken one left. Folders that no manifest
names any more are deleted by ``vacuum``, after readers of the older version have finished.

Cases: events without ``created_at`` belong to the day ``none`` and never expire; a day without a settled event keeps
its folder; an empty table has an empty manifest; one writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from commitpost.operators.reconcile import retention_plan
from commitpost.plans.stage import drop

MANIFEST = "day string, folder string"
NO_DAY = "none"


def day_of(created_at: str = "created_at") -> Column:
    return F.coalesce(F.date_format(created_at, "yyyy-MM-dd"), F.lit(NO_DAY))


@dataclass
class DatedOutbox:
    spark: SparkSession
    path: str
    schema: StructType | str

    def _exists(self, path: str) -> bool:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)

    def version(self) -> int:
        """The last published version, -1 if there is none."""
        version = -1
        while self._exists(f"{self.path}/manifest/version={version + 1}/_SUCCESS"):
            version += 1
        return version

    def folders(self, version: int | None = None) -> dict[str, str]:
        """Folder of each day: as many rows as the table has days."""
        at = self.version() if version is None else version
        if at < 0:
            return {}
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/version={at}").collect()
        return {r["day"]: r["folder"] for r in rows}

    def read(self, days: list[str] | None = None) -> DataFrame:
        """The events of the last version, or of some days of it: other folders are not listed."""
        folders = [f for day, f in self.folders().items() if days is None or day in days]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in sorted(folders)))

    def _write(self, events: DataFrame, version: int, days: list[str]) -> dict[str, str]:
        events.withColumn("day", day_of()).write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/data/version={version}")
        return {day: f"data/version={version}/day={day}" for day in days}

    def publish(self, folders: dict[str, str], version: int) -> None:
        """The swap: all of the new version becomes visible at once."""
        rows = self.spark.createDataFrame(sorted(folders.items()), MANIFEST)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")

    def create(self, events: DataFrame) -> None:
        days = [r["day"] for r in events.select(day_of().alias("day")).distinct().collect()]
        self.publish(self._write(events, 0, days), 0)

    def expire(self, settled: DataFrame, before) -> DataFrame:
        """Publishes a version without the settled events created before ``before``; returns the verdicts by day."""
        version = self.version() + 1
        plan = retention_plan(self.read(), settled, before, day_of())
        verdicts = {r["day"]: r["verdict"] for r in plan.select("day", "verdict").collect()}  # one row a day
        folders = {day: f for day, f in self.folders().items() if verdicts.get(day) == "keep"}
        mixed = [day for day, verdict in verdicts.items() if verdict == "rewrite"]
        if mixed:
            gone = settled.select("source", "id").distinct().withColumn("_settled", F.lit(True))
            old = F.coalesce(F.col("created_at") < before, F.lit(False))
            marked = self.read(mixed).join(gone, ["source", "id"], "left")
            rest = marked.where(~old | F.col("_settled").isNull()).drop("_settled")
            folders |= self._write(rest, version, mixed)
        if len(folders) < len(verdicts) or mixed:
            self.publish(folders, version)
        return plan

    def vacuum(self) -> list[str]:
        """Deletes the folders of earlier versions that the last one does not name."""
        last = self.version()
        live = set(self.folders(last).values())
        gone = sorted({f for v in range(last) for f in self.folders(v).values()} - live)
        for folder in gone:
            drop(self.spark, f"{self.path}/{folder}")
        return gone
