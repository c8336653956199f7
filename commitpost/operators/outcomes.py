"""What became of published entries: answers, failures, retries, dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from commitpost.functions import outcome
from commitpost.plans.batches import KEY
from commitpost.plans.scan import Agg, count, log_levels, running, time_levels


def publish_outcomes(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """One outcome per request ``(call, index)``. A request without an answer is retryable.

    Answers whose index is not a number or was never sent are ignored; a failure wins over a success.
    """
    failed = ~F.col("ok")
    verdict = F.struct(
        outcome.entry_failure(F.col("sender_fault"), F.col("code")).alias("outcome"),
        outcome.failure_reason(F.col("code"), F.col("message")).alias("reason"),
    )
    answers = (
        responses.withColumn("index", F.expr("try_cast(index as bigint)"))
        .where(F.col("index").isNotNull())
        .groupBy("call", "index")
        .agg(F.bool_or(failed).alias("_failed"), F.max(F.when(failed, verdict)).alias("_verdict"))
    )
    joined = requests.join(answers, ["call", "index"], "left")
    return joined.withColumn(
        "outcome",
        F.when(F.col("_failed").isNull(), "retryable").when(F.col("_failed"), F.col("_verdict.outcome")).otherwise("ok"),
    ).withColumn(
        "reason",
        F.when(F.col("_failed").isNull(), outcome.NOT_REPORTED).when(F.col("_failed"), F.col("_verdict.reason")),
    ).drop("_failed", "_verdict")


def answer_audit(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Answers that match no request, and requests answered more than once."""
    answers = responses.groupBy("call", "index").agg(F.count(F.lit(1)).alias("answers"))
    sent = requests.select("call", F.col("index").cast("string").alias("index"), F.lit(True).alias("_sent"))
    joined = answers.join(sent, ["call", "index"], "left")
    problem = F.when(F.col("_sent").isNull(), "unknown").when(F.col("answers") > 1, "repeated")
    return joined.withColumn("problem", problem).where(F.col("problem").isNotNull()).drop("_sent")


def call_failures(requests: DataFrame, failed_calls: DataFrame) -> DataFrame:
    """Outcomes of the entries of calls that failed as a whole."""
    sizes = requests.groupBy("call").agg(F.count(F.lit(1)).alias("entries"))
    judged = failed_calls.join(sizes, "call").select(
        "call",
        outcome.call_failure(F.col("entries"), F.col("error")).alias("outcome"),
        F.col("error").alias("reason"),
    )
    return requests.join(judged, "call")


def retry_schedule(
    attempts: DataFrame,
    initial_ms: int = outcome.INITIAL_BACKOFF_MS,
    max_ms: int = outcome.MAX_BACKOFF_MS,
) -> DataFrame:
    """When each retryable failure is sent again. ``attempt`` counts from 1."""
    again = attempts.where(F.col("outcome") == "retryable")
    scale = outcome.jitter(F.col("source"), F.col("id"), F.col("attempt").cast("string"))
    delay = outcome.backoff_ms(F.col("attempt") - 1, scale, initial_ms, max_ms)
    return again.withColumn("delay_ms", delay).withColumn(
        "retry_at", F.timestamp_micros(F.unix_micros("sent_at") + F.col("delay_ms") * 1000)
    )


def number_attempts(sends: DataFrame, limit: int | None = None) -> DataFrame:
    """Counts the sends of each event in time order, from 1."""
    timed = sends.withColumn("_us", F.unix_micros("sent_at"))
    return running(timed, ["source", "id"], ["_us"], {"attempt": count()}, time_levels("_us"), limit=limit).drop("_us")


def held_events(events: DataFrame, pending: DataFrame, limit: int | None = None) -> DataFrame:
    """Marks events that must wait because an earlier event of their key is pending.

    ``blocked_by`` is the position of the first such event. Other keys of the source go on.
    """
    waiting = pending.select("source", "id", F.lit(True).alias("pending")).distinct()
    marked = events.select(*KEY, "id", "commit_lsn", "row_seq").join(waiting, ["source", "id"], "left")
    marked = marked.withColumn("pending", F.coalesce("pending", F.lit(False)))
    first = Agg("min", F.when(F.col("pending"), F.col("commit_lsn")))
    held = running(marked, KEY, ["commit_lsn", "row_seq"], {"blocked_by": first}, log_levels(), before=True, limit=limit)
    return held.withColumn("held", F.col("blocked_by").isNotNull())


def publishable(events: DataFrame, pending: DataFrame) -> DataFrame:
    return held_events(events, pending).where(~F.col("held"))


def new_dead_letters(failed: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows to append to the dead-letter table: the first per ``(slot, id)`` that it does not hold yet."""
    rest = [c for c in failed.columns if c not in ("slot", "id")]
    first = failed.groupBy("slot", "id").agg(
        F.min_by(F.struct(*rest), F.struct("failed_at", "reason")).alias("_row")
    )
    kept = first.select("slot", "id", "_row.*")
    return kept.join(stored.select("slot", "id"), ["slot", "id"], "left_anti")


def republish_dead_letters(dead: DataFrame, corrections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Corrected rows under new ids, and the dead letters that remain once they are in the outbox."""
    fixed = dead.join(corrections, ["slot", "id"])
    digest = F.md5(F.concat_ws(":", F.lit("republished"), "slot", "id"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    new_id = F.concat_ws("-", *(F.substring(digest, start, size) for start, size in cuts))
    rows = fixed.withColumn("replaces", F.col("id")).withColumn("id", new_id)
    return rows, dead.join(corrections.select("slot", "id"), ["slot", "id"], "left_anti")
