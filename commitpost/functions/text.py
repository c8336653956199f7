"""Column expressions for positions, times, keys, envelopes and broker limits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Consumers, brokers and the database define these formats.
ENVELOPE_TEXT_KEYS = ("id", "source", "aggregate_type", "aggregate_id", "event_type", "occurred_at")
ENVELOPE_JSON_KEYS = ("headers", "payload")
DATABASE_EPOCH_MICROS = 946_684_800_000_000  # 2000-01-01 UTC
BROKER_ID_CHARS = 128
ATTRIBUTE_BYTES = 64  # names and types of the attributes of one entry
FIFO_SUFFIX = ".fifo"
SLOT_NAME = "^[a-z0-9_]{1,63}$"

ESCAPED_WITH_LETTERS = ("0b", "0e", "0f", "1a", "1b", "1c", "1d", "1e", "1f")
"""Control characters whose JSON escape has hex letters; consumers get them in lower case."""


def ordering_key() -> Column:
    """The unit of order: one aggregate of one source."""
    return F.concat_ws(":", "source", "aggregate_type", "aggregate_id")


def dedup_key() -> Column:
    """An id is unique only within its source."""
    return F.concat_ws(":", "source", "id")


def json_object(*columns: str) -> Column:
    """Text columns as a compact JSON object."""
    text = F.to_json(F.struct(*columns))
    fixed = text
    for code in ESCAPED_WITH_LETTERS:
        fixed = F.regexp_replace(fixed, rf"(?<!\\)((?:\\\\)*)\\u00{code.upper()}", rf"$1\\u00{code}")
    return F.when(text.contains("\\u00"), fixed).otherwise(text)


def envelope() -> Column:
    """The document consumers receive: six escaped texts, then headers and payload exactly as stored."""
    texts = F.rtrim(json_object(*ENVELOPE_TEXT_KEYS), F.lit("}"))  # it ends in a quote and one brace
    raw = [part for key in ENVELOPE_JSON_KEYS for part in (F.lit(f',"{key}":'), F.col(key))]
    return F.concat(texts, *raw, F.lit("}"))


def lsn_text(lsn: Column) -> Column:
    low = F.lit(4_294_967_295).cast("bigint")
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(lsn.bitwiseAND(low)))


def lsn_value(text: Column) -> Column:
    parts = F.split(text, "/")
    high = F.conv(parts.getItem(0), 16, 10).cast("bigint")
    low = F.conv(parts.getItem(1), 16, 10).cast("bigint")
    return F.shiftleft(high, 32) + low


def commit_time(micros: Column) -> Column:
    """The log's commit time; anything before its epoch is taken as the epoch."""
    return F.timestamp_micros(F.lit(DATABASE_EPOCH_MICROS) + F.greatest(micros, F.lit(0)))


def database_time_text(timestamp: Column) -> Column:
    """A UTC timestamp as the database prints it."""
    return F.concat(timestamp.cast("string"), F.lit("+00"))


def rfc3339(text: Column) -> Column:
    """A database time in UTC as RFC 3339; other texts (``infinity``) stay as they are."""
    end = F.length(text) - 3
    gap = F.instr(text, " ")
    day = F.substring(text, F.lit(1), F.when(gap > 0, gap - 1).otherwise(end))
    clock = F.when(gap > 0, F.concat(F.lit("T"), F.substring(text, gap + 1, end - gap))).otherwise("")
    return F.when(text.endswith("+00"), F.concat(day, clock, F.lit("Z"))).otherwise(text)


def broker_id(value: Column) -> Column:
    """The key in the alphabet and length of broker ids. Keys that become equal share a group, which keeps their order."""
    return F.left(F.regexp_replace(value, r"[^\x21-\x7E]", "_"), F.lit(BROKER_ID_CHARS))


def entry_size(body: Column) -> Column:
    """Bytes a broker counts for one entry."""
    parts = [body, F.col("id"), F.col("event_type"), F.col("source")]
    return (sum((F.octet_length(p) for p in parts), F.lit(ATTRIBUTE_BYTES))).cast("bigint")


def is_fifo(target: Column) -> Column:
    return target.endswith(FIFO_SUFFIX)


def is_slot_name(slot: Column) -> Column:
    return slot.rlike(SLOT_NAME)


def percent_encoded(text: Column) -> Column:
    """Every byte that is not an ASCII letter or digit as ``%XX``."""
    encoded = F.url_encode(text)
    for char, code in (("+", "%20"), ("_", "%5F"), ("-", "%2D"), (".", "%2E"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(char), F.lit(code))
    return encoded


def is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def micros(timestamp: Column) -> Column:
    return F.unix_micros(timestamp)


def millis(timestamp: Column) -> Column:
    return F.unix_millis(timestamp)
