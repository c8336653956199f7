"""The fixed columns of outbox tables and events, and the audit of what breaks them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from commitpost.functions import text

REQUIRED = ("id", "aggregate_type", "aggregate_id", "event_type", "payload", "headers", "created_at")
JSON_COLUMNS = ("payload", "headers")
POSITION = ("commit_lsn", "row_seq")
EVENT_COLUMNS = (
    "source", "id", "aggregate_type", "aggregate_id", "event_type", "payload", "headers", "created_at",
    "occurred_at", "commit_lsn", "row_seq", "committed_at",
)


class ContractError(ValueError):
    """The table lacks a column every event needs."""


def require_columns(df: DataFrame, columns=REQUIRED) -> None:
    for name in columns:
        if name not in df.columns:
            raise ContractError(f"outbox table has no `{name}` column")


def problem(columns=()) -> Column:
    """The first column that keeps a row from being an event, or null. Of ``columns``, those that place an event in
    its source are checked too."""
    placed = [c for c in ("source", *POSITION) if c in columns]
    absent = {c: F.col(c).isNull() for c in (*REQUIRED, *placed)}
    if "occurred_at" in columns:  # the text of a time that no timestamp can hold is enough
        absent["created_at"] &= F.col("occurred_at").isNull()
    checks = [F.when(missing, F.lit(f"{c}: missing")) for c, missing in absent.items()]
    checks += [F.when(~text.is_json(F.col(c)), F.lit(f"{c}: not JSON")) for c in JSON_COLUMNS]
    return F.coalesce(*checks)


def contract_violations(df: DataFrame) -> DataFrame:
    require_columns(df)
    return df.withColumn("problem", problem(df.columns)).where(F.col("problem").isNotNull())


def valid_rows(df: DataFrame, strict: bool = False) -> DataFrame:
    """Rows that can be events. Others are left to ``contract_violations``; with ``strict`` one fails the job."""
    require_columns(df)
    checked = df.withColumn("_problem", problem(df.columns))
    if strict:
        checked = checked.withColumn(
            "_problem",
            F.when(F.col("_problem").isNotNull(), F.raise_error(F.concat(F.lit("outbox row: "), "_problem"))),
        )
    return checked.where(F.col("_problem").isNull()).drop("_problem")
