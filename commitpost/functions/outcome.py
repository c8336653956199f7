"""What a publish answer means, and when to try again."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, functions as F

# The broker error codes that mean content it will never accept, and the default delays.
CONTENT_ERRORS = (
    "InvalidParameterValue",
    "InvalidMessageContents",
    "InvalidAttributeValue",
    "MessageTooLong",
    "InvalidParameter",
)
CALL_TOO_LONG = "BatchRequestTooLong"
INITIAL_BACKOFF_MS = 100
MAX_BACKOFF_MS = 30_000
RESTART_INITIAL_MS = 1_000
RESTART_MAX_MS = 60_000
NOT_REPORTED = "missing from the broker response"


def entry_failure(sender_fault: Column, code: Column) -> Column:
    """Permanent if the broker blames the content; anything else is worth another try."""
    content = code.rlike(f"({'|'.join(CONTENT_ERRORS)})$")
    return F.when(sender_fault & content, "permanent").otherwise("retryable")


def failure_reason(code: Column, message: Column) -> Column:
    return F.concat(code, F.lit(": "), F.coalesce(message, F.lit("")))


def call_failure(entries: Column, error: Column) -> Column:
    """A failed call judged nothing on its content, except a lone entry too long for any call."""
    lone = (entries == 1) & (error == CALL_TOO_LONG)
    return F.when(lone, "permanent").otherwise("retryable")


def jitter(*seed: Column) -> Column:
    """A number in [0, 1) that a replay of the same attempt repeats."""
    text = F.md5(F.concat_ws(":", *seed))
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("double") / 4_294_967_296


def backoff_ms(
    attempt: Column,
    jitter: Column,
    initial_ms: int = INITIAL_BACKOFF_MS,
    max_ms: int = MAX_BACKOFF_MS,
) -> Column:
    """Delay before retry ``attempt`` (from 0): doubled each time, capped, then scaled by the jitter."""
    doubled = F.lit(initial_ms) * F.pow(F.lit(2.0), F.least(attempt, F.lit(30)))
    return F.floor(F.least(doubled, F.lit(float(max_ms))) * jitter).cast("bigint")


def backoff_of(source: str, id: str, attempt: int, initial_ms: int = INITIAL_BACKOFF_MS, max_ms: int = MAX_BACKOFF_MS) -> int:
    """What ``backoff_ms`` and ``jitter`` give after attempt ``attempt`` (from 1) of an event, for the task that sends it."""
    digest = hashlib.md5(f"{source}:{id}:{attempt}".encode()).hexdigest()
    doubled = initial_ms * 2.0 ** min(attempt - 1, 30)
    return math.floor(min(doubled, float(max_ms)) * (int(digest[:8], 16) / 4_294_967_296))
