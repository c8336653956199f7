"""Handing broker calls to a client, from the tasks that hold them."""

from __future__ import annotations

import heapq
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from commitpost.functions.outcome import CALL_TOO_LONG, CONTENT_ERRORS, INITIAL_BACKOFF_MS, MAX_BACKOFF_MS, NOT_REPORTED, backoff_of
from commitpost.plans.batches import CALL_BYTES, CALL_ENTRIES

CALL = ["source", "lane", "round", "batch", "call"]
OUTCOMES = "source string, id string, attempt int, outcome string, reason string, sent_at timestamp"
ROWS_OUT = 10_000
HELD_BYTES = 32 * 1024 * 1024
"""Entries a task keeps for later, by size and ``ENTRY_BYTES`` each; beyond that it waits before it reads on."""
ENTRY_BYTES = 1_024

Send = Callable[[list[dict]], Iterable[tuple]]
"""Sends the entries of one call. Answers ``(index, ok, sender_fault, code, message)`` per entry it knows of;
raises ``CallError`` if the call failed as a whole; any other exception stops its source until the next step."""


class CallError(Exception):
    """The whole call failed; ``args[0]`` is the broker's error code."""


def judged(entries: list[dict], send: Send) -> dict[int, tuple[str, str]]:
    """Outcome and reason of every entry of a call. What is not reported is retried, as is all of a call that raises."""
    return answered(entries, send)[0]


def answered(entries: list[dict], send: Send) -> tuple[dict[int, tuple[str, str]], bool]:
    """``judged``, and whether the broker is out of reach: the client broke, or refused a call of several entries."""
    try:
        answers = list(send(entries))
    except CallError as error:
        code = str(error.args[0])
        kind = "permanent" if len(entries) == 1 and code == CALL_TOO_LONG else "retryable"
        return {entry["index"]: (kind, code) for entry in entries}, len(entries) > 1
    except Exception as error:  # the client itself broke: its source waits, the others go on
        return {entry["index"]: ("retryable", f"{type(error).__name__}: {error}") for entry in entries}, True
    found = {entry["index"]: ("retryable", NOT_REPORTED) for entry in entries}
    for index, ok, sender_fault, code, message in sorted(answers, key=lambda answer: not answer[1]):
        if index in found:
            content = sender_fault and code.endswith(CONTENT_ERRORS)
            kind = "permanent" if content else "retryable"
            found[index] = ("ok", "") if ok else (kind, f"{code}: {message}")
    return found, False


class Line:
    """What one task knows of the keys it sends: which are stopped for the rest of the step, and which wait to be due.

    A key waits only if it is due again within ``patience``, the seconds the task may sleep in all; its later entries wait
    behind its failed one, in order.
    """

    def __init__(self, send: Send, retries: int, patience: float, initial_ms: int, max_ms: int):
        self.send, self.retries, self.patience, self.backoff = send, retries, patience, (initial_ms, max_ms)
        self.stopped: set[str] = set()
        self.down: set[str] = set()
        self.waiting: dict[str, deque[dict]] = {}
        self.due: list[tuple[float, str]] = []
        self.held = 0

    def tries(self, entries: list[dict]) -> Iterator[tuple]:
        """Sends the entries of one call, of different keys, and yields a row for each attempt; then puts off what failed."""
        source = entries[0]["source"]
        unreachable, at = False, 0.0
        for _ in range(self.retries + 1):
            if not entries:
                break
            for entry in entries:
                entry["attempt"] += 1
            found, unreachable = answered(entries, self.send)
            at = time.time()
            for entry in entries:
                yield entry, entry["attempt"], *found[entry["index"]], int(at * 1_000_000)
            entries = [entry for entry in entries if found[entry["index"]][0] == "retryable"]
        if unreachable:  # still, after the last try
            self.down.add(source)
        for entry in entries:
            key = entry["order_key"]
            delay = backoff_of(source, entry["id"], entry["attempt"], *self.backoff) / 1000
            if unreachable or delay > self.patience or self.patience <= 0:
                self.stop(key)
            else:
                self.hold(entry).rotate(1)  # to the front
                heapq.heappush(self.due, (at + delay, key))

    def hold(self, entry: dict) -> deque[dict]:
        line = self.waiting.setdefault(entry["order_key"], deque())
        line.append(entry)
        self.held += entry.get("size", 0) + ENTRY_BYTES
        return line

    def release(self, key: str, index: int) -> dict:
        entry = self.waiting[key].popleft()
        self.held -= entry.get("size", 0) + ENTRY_BYTES
        return entry | {"index": index}

    def stop(self, key: str) -> None:
        self.stopped.add(key)
        for entry in self.waiting.pop(key, ()):
            self.held -= entry.get("size", 0) + ENTRY_BYTES

    def call(self, entries: list[dict]) -> Iterator[tuple]:
        """A planned call, without entries whose key is stopped or waits."""
        ready = []
        for entry in entries:
            if entry["source"] in self.down or entry["order_key"] in self.stopped:
                continue
            if entry["order_key"] in self.waiting:
                self.hold(entry)
            else:
                ready.append(entry)
        if ready:
            yield from self.tries(ready)

    def serve(self) -> Iterator[tuple]:
        """Sends what is due and waits behind it, one entry of a key in a call, until each key has caught up or failed again."""
        awake: dict[str, list[str]] = {}
        while self.due and self.due[0][0] <= time.time():
            _, key = heapq.heappop(self.due)
            awake.setdefault(self.waiting[key][0]["source"], []).append(key)
        for source, keys in awake.items():
            keys = deque(keys)
            while keys and source not in self.down:
                taken, size = [], 0
                while keys and len(taken) < CALL_ENTRIES:
                    size += self.waiting[keys[0]][0].get("size", 0)
                    if taken and size > CALL_BYTES:
                        break
                    taken.append(keys.popleft())
                failed = set()
                for row in self.tries([self.release(key, index) for index, key in enumerate(taken)]):
                    failed.discard(row[0]["order_key"])
                    if row[2] == "retryable":
                        failed.add(row[0]["order_key"])
                    yield row
                for key in taken:
                    if key in failed:
                        continue
                    if self.waiting[key]:
                        keys.append(key)
                    else:
                        del self.waiting[key]
            for key in keys:
                self.stop(key)

    def sleep(self) -> bool:
        """Until the next key is due; false if none waits. What is due after the patience is stopped."""
        if not self.due:
            return False
        pause = max(0.01, self.due[0][0] - time.time())
        if pause > self.patience:
            for _, key in self.due:
                self.stop(key)
            self.due = []
            return False
        time.sleep(pause)
        self.patience -= pause
        return True


def send_in_order(
    requests: DataFrame,
    send: Send,
    retries: int = 0,
    carry: Sequence[str] = (),
    patience: float = 0.0,
    initial_ms: int = INITIAL_BACKOFF_MS,
    max_ms: int = MAX_BACKOFF_MS,
) -> DataFrame:
    """Sends every call of every lane in order, and returns an outcome row per attempt made.

    A retryable failure is sent again up to ``retries`` times; then later events of its key are not sent, so
    none overtakes it. With ``patience`` a task keeps them, up to ``HELD_BYTES``, and goes on with them when
    the failed one is due again as ``backoff_ms`` says; it sleeps so many seconds for that at most. Lanes are shared among
    tasks; only keys that failed are remembered. If the broker is out of reach for a source, the task sends nothing more of
    that source, whose other events wait untried, and goes on with the others: a failing source holds back itself only.
    ``requests`` has ``order_key`` and ``attempt``, the attempts made before.
    ``carry`` names columns of ``requests`` to hand on with outcomes that are final; they are null in other rows.
    """
    types = {f.name: f.dataType.simpleString() for f in requests.schema.fields}
    schema = OUTCOMES.replace("sent_at timestamp", "sent_us bigint") + "".join(f", {c} {types[c]}" for c in carry)
    names = [column.split()[0] for column in schema.split(", ")]
    kinds = [{"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}[column.split()[1]] for column in schema.split(", ")]

    def attempts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        line = Line(send, retries, patience, initial_ms, max_ms)
        for _, call in groupby((row for batch in batches for row in entries_of(batch)), key=itemgetter(*CALL)):
            yield from line.serve()
            yield from line.call(list(call))
            while line.held > HELD_BYTES and line.sleep():
                yield from line.serve()
        while line.sleep():
            yield from line.serve()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(made: list[tuple]) -> pa.RecordBatch:
            columns = zip(*made) if made else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds)], names)

        made: list[tuple] = []
        for entry, attempt, kind, reason, at in attempts(batches):
            more = (None if kind == "retryable" else entry[c] for c in carry)
            made.append((entry["source"], entry["id"], attempt, kind, reason, at, *more))
            if len(made) == ROWS_OUT:
                yield packed(made)
                made = []
        yield packed(made)

    within = ["position"] if "position" in requests.columns else ["call", "index"]
    in_order = requests.repartition("source", "lane").sortWithinPartitions(*CALL[:-1], *within)
    sent = in_order.mapInArrow(run, schema)
    return sent.withColumn("sent_us", F.timestamp_micros("sent_us")).withColumnRenamed("sent_us", "sent_at")


def values(column: pa.Array) -> list:
    """The values of a column as Python has them, maps as dicts: whole columns at a time, as one by one takes far longer."""
    if pa.types.is_map(column.type):
        keys, items, ends = values(column.keys), values(column.items), values(column.offsets)
        return [dict(zip(keys[start:end], items[start:end])) for start, end in zip(ends, ends[1:])]
    if pa.types.is_string(column.type) or pa.types.is_integer(column.type) and not column.null_count:
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


def entries_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch."""
    names = batch.schema.names
    return (dict(zip(names, row)) for row in zip(*map(values, batch.columns)))
