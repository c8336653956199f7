"""Outbox tables as events: read, resume, poll, unite tenants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from commitpost.functions import text
from commitpost.plans.lookup import lookup_join

from .schema import EVENT_COLUMNS, REQUIRED, require_columns


def outbox_scan(df: DataFrame) -> DataFrame:
    """The outbox columns by name; other columns are not read."""
    require_columns(df)
    return df.select(*REQUIRED)


def read_outbox(spark: SparkSession, path: str, format: str = "parquet", **options) -> DataFrame:
    return outbox_scan(spark.read.format(format).options(**options).load(path))


def read_outbox_jdbc(
    spark: SparkSession, url: str, since: str, until: str, partitions: int, table: str = "outbox", **options
) -> DataFrame:
    """An outbox table over JDBC, read in ``partitions`` ranges of ``created_at`` between the two times."""
    return outbox_scan(
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn="created_at", lowerBound=since, upperBound=until)
        .options(numPartitions=partitions, **options)
        .load()
    )


def outbox_events(df: DataFrame) -> DataFrame:
    """Adds the time text of the envelope and puts the event columns in order."""
    if "occurred_at" not in df.columns:
        df = df.withColumn("occurred_at", text.rfc3339(text.database_time_text(F.col("created_at"))))
    return df.select(*EVENT_COLUMNS)


def tenant_union(tables: Mapping[str, DataFrame] | list[tuple[str, DataFrame]]) -> DataFrame:
    """One stream of rows from a table per database, each row tagged with its database."""
    pairs = tables.items() if isinstance(tables, Mapping) else tables
    named = [(name.strip(), df) for name, df in pairs]
    named = [(name, df) for name, df in named if name]
    names = [name for name, _ in named]
    for name in names:
        if names.count(name) > 1:
            raise ValueError(f"database {name} is listed twice")
    tagged = [df.withColumn("source", F.lit(name)) for name, df in named]
    return reduce(lambda left, right: left.unionByName(right), tagged)


def read_tenants(spark: SparkSession, root: str, databases: list[str]) -> DataFrame:
    """The listed databases of a table stored as ``source=<database>`` folders; other folders are not listed."""
    names = [name.strip() for name in databases if name.strip()]
    if len(set(names)) < len(names):
        raise ValueError("a database is listed twice")
    return spark.read.option("basePath", root).parquet(*(f"{root}/source={name}" for name in names))


LITERAL_SOURCES = 1_000
"""Up to so many positions become literals of the filter, which prune files and row groups; more are joined."""


def past(positions: Sequence[tuple[str, int, int | None]]) -> Column:
    """True for events after the position ``(source, commit_lsn, row_seq)`` of their source, and for sources without one.

    A ``row_seq`` of None stands for the whole of ``commit_lsn``. The filter has a bound for each listed source, so a
    scan reads the row groups behind it only."""
    ahead = ~F.col("source").isin([source for source, _, _ in positions]) if positions else F.lit(True)
    for source, lsn, seq in positions:
        later = F.col("commit_lsn") > lsn
        if seq is not None:
            later = later | (F.col("commit_lsn") == lsn) & (F.col("row_seq") > seq)
        ahead = ahead | (F.col("source") == source) & later
    if positions:
        # Implied by the above for listed sources; stated alone it reaches the scan's statistics.
        lowest = min(lsn for _, lsn, _ in positions)
        ahead = ahead & ((F.col("commit_lsn") >= lowest) | ~F.col("source").isin([source for source, _, _ in positions]))
    return ahead


def resume_after(events: DataFrame, acks: DataFrame, literals: int = LITERAL_SOURCES) -> DataFrame:
    """Events after the acknowledged position of their source; a source without one starts from the beginning."""
    acked = acks.groupBy("source").agg(F.max("acked").alias("_acked")).where("source is not null and _acked is not null")
    known = acked.limit(literals + 1).collect()
    if len(known) <= literals:
        return events.where(past([(r["source"], r["_acked"], None) for r in known]))
    spread = F.concat_ws(":", "commit_lsn", "row_seq")
    joined = lookup_join(events, acked, ["source"], spread)
    return joined.where(F.col("commit_lsn") > F.coalesce("_acked", F.lit(0))).drop("_acked")


def after_position(events: DataFrame, lsn: int | Column) -> DataFrame:
    """Events after one position: a literal bound that reaches the scan."""
    return events.where(F.col("commit_lsn") > lsn)


def poll_oldest(events: DataFrame, published: DataFrame, limit: int = 10) -> DataFrame:
    """The oldest rows not published yet, as a polling worker takes them."""
    done = published.select("source", "id").distinct()
    return events.join(done, ["source", "id"], "left_anti").orderBy("created_at", "id", "source").limit(limit)
