"""An outbox table as a stream of pages, with positions as offsets.

A page is what comes next of each source in commit order, at most ``per_source`` events of each, so no step is larger
than the number of sources times that, whatever has piled up. Its end positions are written before it is handed on
and the page is marked when it is done: a restart hands on an unfinished page again with the same number and the same
events, and continues by position. Nothing is listed or kept but one row for each source and page; files of events may
be compacted or rewritten in between.

Cases: a transaction larger than a page is cut by ``row_seq`` (the relay acknowledges it once all of it is settled);
several sources advance side by side, and one without new events keeps its position; events at or before a position
that has been passed are not read again; rows without source or position are in no page (``contract_violations`` finds
them).

What has piled up need not go out page by page: with ``together``, a step hands on several pages at once, one first, then
twice as many each time up to that number. Their ends are planned and written in one pass, and a ``page`` column says which
page a row belongs to. Pages and positions are the same either way, and a restart repeats the step with the same pages.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from commitpost.plans.stage import scope, stage
from commitpost.sources.outbox import past

POSITIONS = "source string, commit_lsn bigint, row_seq bigint"
PLANNED = f"{POSITIONS}, page int"
SALTS = 64
"""The first events of a source are sought in so many parts of it, so that no task sorts a whole source."""

Position = tuple[str, int, int]


@dataclass
class PagedOutbox:
    """Pages of ``events``; ``path`` holds the positions (``planned/step=``) and what is done (``done/step=``), where a step
    is named by its last page.

    ``events`` is read anew for each page; a function that gives it sees what has been added since."""

    spark: SparkSession
    events: DataFrame | Callable[[], DataFrame]
    path: str
    per_source: int = 10_000
    done: int = -1
    start: list[Position] = field(default_factory=list)
    planned: int | None = None
    together: int = 1
    ahead: int = 1

    def _rows(self) -> DataFrame:
        return self.events() if callable(self.events) else self.events

    def _last(self, name: str) -> int | None:
        return self.spark.read.schema("step int").parquet(f"{self.path}/{name}").agg(F.max("step")).first()[0]

    def _planned(self, last: int) -> DataFrame:
        """Where each source stood at the end of the pages of a step that it has events in."""
        return self.spark.read.schema(PLANNED).parquet(f"{self.path}/planned/step={last}")

    def positions(self, last: int) -> list[Position]:
        """Where each source stood at the end of a step: one row for each source."""
        ends = self._planned(last).groupBy("source").agg(F.max(F.struct("commit_lsn", "row_seq")).alias("end"))
        return [tuple(r) for r in ends.select("source", "end.*").orderBy("source").collect()]

    def prepare(self) -> None:
        """The start of all sources, unless there are positions already. One row keeps the folder's partition."""
        nothing = self.spark.createDataFrame([("", 0, 0, -1)], PLANNED).coalesce(1)
        for name in ("planned", "done"):
            nothing.write.mode("ignore").parquet(f"{self.path}/{name}/step=-1")

    def plan(self, start: list[Position], first: int, pages: int) -> int | None:
        """Writes the ends of at most so many next pages, and returns the last of them; None if there are no new events."""
        ahead = self._rows().select("source", "commit_lsn", "row_seq").where("source is not null and commit_lsn is not null and row_seq is not null")
        ahead = ahead.where(past(start)).withColumn("salt", F.pmod(F.xxhash64("commit_lsn", "row_seq"), F.lit(SALTS)))
        for by in (["source", "salt"], ["source"]):
            turn = F.row_number().over(Window.partitionBy(*by).orderBy("commit_lsn", "row_seq"))
            ahead = ahead.withColumn("turn", turn).where(F.col("turn") <= self.per_source * pages)
        page = (F.lit(first) + F.floor((F.col("turn") - 1) / self.per_source)).cast("int").alias("page")
        ends = ahead.groupBy("source", page).agg(F.max(F.struct("commit_lsn", "row_seq")).alias("end"))
        with scope(self.spark):
            ends = stage(ends.select("source", "end.*", "page"), "ends")
            last = ends.agg(F.max("page")).first()[0]
            if last is not None:
                carried = self.spark.createDataFrame([(*p, first - 1) for p in start], PLANNED)
                rows = ends.unionByName(carried).coalesce(1)
                rows.write.mode("overwrite").parquet(f"{self.path}/planned/step={last}")
        return last

    def between(self, start: list[Position], end: list[Position]) -> DataFrame:
        """The events after ``start`` up to ``end``."""
        moved = sorted(set(end) - set(start))
        rows = self._rows().where(F.col("source").isin([source for source, _, _ in moved]) & past(start))
        return rows.where(~past(moved))

    def numbered(self, rows: DataFrame, first: int, last: int) -> DataFrame:
        """The rows of a step with their ``page``: as many planned ends of their source lie before them. A source has at most
        ``per_source * together`` rows in a step."""
        ends = self._planned(last).where(F.col("page") >= first).drop("page").withColumn("_end", F.lit(1))
        marked = rows.withColumn("_end", F.lit(0)).unionByName(ends, allowMissingColumns=True)
        so_far = Window.partitionBy("source").orderBy("commit_lsn", "row_seq", "_end").rowsBetween(Window.unboundedPreceding, 0)
        page = (F.lit(first) + F.sum("_end").over(so_far)).cast("int")
        return marked.withColumn("page", page).where("_end = 0").drop("_end")

    def load(self) -> None:
        """What an earlier run has written: its last finished step, and one it had planned."""
        self.prepare()
        self.done = self._last("done")
        self.start = self.positions(self.done)
        planned = self._last("planned")
        self.planned, self.ahead = planned if planned > self.done else None, 1

    def step(self, take: Callable[[DataFrame, int], None]) -> bool:
        """Hands on the unfinished step if there is one, else the next; False if there are no new events. ``take`` gets the
        rows and the number of their first page."""
        first = self.done + 1
        last = self.plan(self.start, first, self.ahead) if self.planned is None else self.planned
        if last is None:
            self.ahead = 1
            return False
        self.planned = last
        ends = self.positions(last)
        rows = self.between(self.start, ends)
        take(self.numbered(rows, first, last) if self.together > 1 else rows, first)
        self.spark.createDataFrame([("",)], "source string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/done/step={last}")
        self.done, self.start, self.planned = last, ends, None
        self.ahead = min(self.ahead * 2, self.together)
        return True

    def run(self, take: Callable[[DataFrame, int], None], idle_seconds: float | None = None) -> None:
        """Pages until there are no new events; with ``idle_seconds``, looks again after so long, for ever."""
        self.load()
        while True:
            while self.step(take):
                pass
            if idle_seconds is None:
                return
            time.sleep(idle_seconds)
