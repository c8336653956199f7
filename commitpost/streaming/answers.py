"""Requests and broker answers as two streams, matched within a deadline.

Requests wait for answers in the state of a left outer join that event time bounds: once both streams have passed a
request's deadline by ``lateness``, it is settled and leaves the state, so what is kept is what was sent within the
deadline, however long the job runs. An answer after the deadline counts as none: its request has become retryable.

Cases: answers whose index is no number, or was never sent, are ignored; of several answers to one request a failure
wins; a request that arrives twice in time is settled once; requests later than ``lateness`` behind their stream are
dropped by Spark, so ``lateness`` must cover the delay of the request log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from commitpost.functions import outcome

REQUEST_SCHEMA = "call string, index bigint, source string, id string, sent_at timestamp"
ANSWER_SCHEMA = (
    "call string, index string, ok boolean, sender_fault boolean, code string, message string, answered_at timestamp"
)


def outcome_stream(
    requests: DataFrame,
    answers: DataFrame,
    deadline: str = "30 seconds",
    lateness: str = "1 minute",
    keep: Sequence[str] = ("source", "id"),
) -> DataFrame:
    """One row for each request ``(call, index)`` once its answers are in or its deadline is over."""
    failed = ~F.col("ok")
    verdict = F.struct(
        outcome.entry_failure(F.col("sender_fault"), F.col("code")).alias("outcome"),
        outcome.failure_reason(F.col("code"), F.col("message")).alias("reason"),
    )
    judged = answers.withWatermark("answered_at", lateness).select(
        F.col("call").alias("_call"), F.expr("try_cast(index as bigint)").alias("_index"), "answered_at",
        failed.alias("_failed"), F.when(failed, verdict).alias("_verdict"),
    )
    sent = requests.withWatermark("sent_at", lateness).select("call", "index", *keep, "sent_at")
    in_time = F.expr(f"answered_at >= sent_at and answered_at <= sent_at + interval {deadline}")
    same = (F.col("call") == F.col("_call")) & (F.col("index") == F.col("_index"))
    matched = sent.join(judged.where("_index is not null"), same & in_time, "left")
    settled = matched.groupBy("call", "index", *keep, "sent_at").agg(
        F.bool_or("_failed").alias("_failed"), F.max("_verdict").alias("_verdict")
    )
    missing = F.col("_failed").isNull()
    return settled.select(
        "call", "index", *keep, "sent_at",
        F.when(missing, "retryable").when(F.col("_failed"), F.col("_verdict.outcome")).otherwise("ok").alias("outcome"),
        F.when(missing, outcome.NOT_REPORTED).when(F.col("_failed"), F.col("_verdict.reason")).alias("reason"),
    )
