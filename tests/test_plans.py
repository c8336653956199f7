"""Batches, calls, acknowledgement, lookups and deduplication against their definitions."""

import random
from collections import defaultdict

import pytest
from events import events
from pyspark.sql import functions as F

from commitpost.operators.dedup import fifo_dedup
from commitpost.plans import ack, batches
from commitpost.plans.lookup import lookup_join


@pytest.fixture(scope="module")
def backlog(spark):
    rng = random.Random(3)
    rows = []
    for n in range(1500):
        key = "hot" if rng.random() < 0.35 else str(rng.randrange(60))
        source = "big" if rng.random() < 0.7 else f"s{rng.randrange(4)}"
        rows.append({"id": str(n), "source": source, "aggregate_id": key, "commit_lsn": (n // 3) << 20, "row_seq": n})
    return events(spark, rows).cache()


@pytest.mark.parametrize("limit", [20, None])
def test_batches_keep_the_rules(backlog, limit):
    plan = batches.plan_batches(backlog, max_events=7, lanes=3, limit=limit).collect()
    assert len({r["id"] for r in plan}) == len(plan) == 1500
    by_batch, by_key = defaultdict(list), defaultdict(list)
    for r in plan:
        by_batch[r["source"], r["lane"], r["round"], r["batch"]].append(r)
        by_key[r["source"], r["aggregate_id"]].append(r)
    for rows in by_batch.values():
        assert len(rows) <= 7
        assert len({r["aggregate_id"] for r in rows}) == len(rows)
        assert sorted(r["position"] for r in rows) == list(range(len(rows)))
    for rows in by_key.values():
        assert len({r["lane"] for r in rows}) == 1
        rows.sort(key=lambda r: (r["round"], r["batch"]))
        assert [(r["commit_lsn"], r["row_seq"]) for r in rows] == sorted((r["commit_lsn"], r["row_seq"]) for r in rows)


def test_split_batches_are_the_plain_ones(backlog):
    key = ["source", "lane", "round", "batch", "position", "id"]
    hot, plain = (batches.plan_batches(backlog, 7, 3, limit=n).select(key).collect() for n in (20, None))
    assert sorted(map(tuple, hot)) == sorted(map(tuple, plain))


def test_buffers_leave_no_older_event_behind(backlog):
    """A batch an event could have joined, had there been room, is full of older ones."""
    size, buffer = 4, 100
    plan = batches.plan_buffers(backlog, size, buffer).collect()
    keys = {r["id"]: r["aggregate_id"] for r in backlog.collect()}
    buffers = defaultdict(list)
    for r in plan:
        buffers[r["source"], r["buffer"]].append((r["commit_lsn"], r["row_seq"], r["batch"], keys[r["id"]]))
    assert len(plan) == 1500 and max(map(len, buffers.values())) <= buffer
    for rows in buffers.values():
        rows.sort()
        members = defaultdict(list)
        for *at, number, key in rows:
            members[number].append((at, key))
        for number, inside in members.items():
            assert len({key for _, key in inside}) == len(inside) <= size
            for *at, own, key in rows:
                if own > number and key not in {k for _, k in inside}:
                    assert len(inside) == size and max(inside)[0] < at
        of_key = defaultdict(list)
        for *_, number, key in rows:
            of_key[key].append(number)
        assert all(a < b for numbers in of_key.values() for a, b in zip(numbers, numbers[1:]))


def call_sizes(spark, sizes, **limits):
    rows = [(0, i, size, str(i)) for i, size in enumerate(sizes)]
    df = spark.createDataFrame(rows, "batch int, position bigint, size bigint, id string")
    calls = defaultdict(int)
    for r in batches.split_calls(df, ["batch"], **limits).collect():
        calls[r["call"]] += 1
    return [calls[c] for c in sorted(calls)]


def test_calls_are_cut_by_entries_and_bytes(spark):
    assert call_sizes(spark, [7] * 32) == [10, 10, 10, 2]
    assert call_sizes(spark, [150_000, 130_000, 90_000, 42_144]) == [1, 3]
    assert call_sizes(spark, [5_000, 262_145, 4_000]) == [1, 1, 1]
    assert call_sizes(spark, []) == []
    assert call_sizes(spark, [3, 3, 3, 3], max_entries=3, max_bytes=6) == [2, 2]


def safe_positions(log):
    """By definition: the highest position that a mark has reached and at or below which nothing is open, so far."""
    out = {}
    for n, (seq, _, _) in enumerate(log, 1):
        past = log[:n]
        reached = max((lsn for _, action, lsn in past if action == "progress"), default=0)
        still = [lsn for _, action, lsn in past if action == "track"]
        for _, action, lsn in past:
            if action == "confirm":
                still.remove(lsn)
        known = {lsn for _, action, lsn in past if action != "confirm" and lsn <= reached}
        here = max((p for p in known if not any(lsn <= p for lsn in still)), default=0)
        out[seq] = max(here, *out.values()) if out else here
    return out


def random_log(rng):
    """Transactions of 1 to 3 events in commit order, their confirmations at any time after, some marks late."""
    steps, waiting, lsn = [], [], 0
    for _ in range(rng.randrange(4, 14)):
        lsn += rng.randrange(1, 4) * 10
        events_here = rng.randrange(0, 4)
        steps += [("track", lsn)] * events_here + [("progress", lsn)]
        waiting += [lsn] * events_here
        if rng.random() < 0.3:
            steps.append(("progress", lsn - rng.randrange(1, 15)))
        rng.shuffle(waiting)
        for _ in range(rng.randrange(0, 4)):
            if waiting:
                steps.append(("confirm", waiting.pop()))
    keep = rng.random()
    steps += [("confirm", position) for position in waiting if rng.random() < keep]
    return [(seq, action, position) for seq, (action, position) in enumerate(steps, 1) if position > 0]


@pytest.mark.parametrize("limit", [3, None])
def test_acknowledgement_is_the_safe_position(spark, limit):
    rng = random.Random(11)
    logs = {f"s{i}": random_log(rng) for i in range(120)}
    rows = [(source, *step) for source, log in logs.items() for step in log]
    df = spark.createDataFrame(rows, "source string, seq bigint, action string, lsn bigint").cache()
    expected = {source: safe_positions(log) for source, log in logs.items()}
    timeline = {(r["source"], r["seq"]): r["acked"] for r in ack.ack_timeline(df, limit).collect()}
    assert timeline == {(s, seq): acked for s, steps in expected.items() for seq, acked in steps.items()}
    final = {r["source"]: r["acked"] for r in ack.ack_frontier(df).collect()}
    assert final == {source: steps[max(steps)] for source, steps in expected.items()}


@pytest.mark.parametrize(
    ("steps", "acked"),
    [
        ([("track", 31), ("progress", 31), ("track", 47), ("progress", 47), ("confirm", 47)], 0),
        ([("track", 31), ("progress", 31), ("track", 47), ("progress", 47), ("confirm", 31)], 31),
        ([("track", 8), ("track", 8), ("confirm", 8), ("progress", 8), ("progress", 12)], 0),
        ([("track", 8), ("confirm", 8)], 0),
        ([("progress", 3), ("progress", 70)], 70),
        ([("progress", 65), ("progress", 64)], 65),
    ],
)
def test_acknowledgement_cases(spark, steps, acked):
    rows = [("s", i, *step) for i, step in enumerate(steps, 1)]
    log = spark.createDataFrame(rows, "source string, seq bigint, action string, lsn bigint")
    assert ack.ack_frontier(log).first()["acked"] == acked
    assert max(r["acked"] for r in ack.ack_timeline(log).collect()) == acked


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_lookup_is_the_same_broadcast_or_salted(spark, broadcast_rows):
    big = spark.range(500).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    small = spark.createDataFrame([("hot", 1), ("7", 2)], "k string, v int")
    got = lookup_join(big, small, ["k"], F.col("id"), broadcast_rows=broadcast_rows).collect()
    assert len(got) == 500
    assert all(r["v"] == (1 if r["k"] == "hot" else 2 if r["k"] == "7" else None) for r in got)


def test_a_large_lookup_is_not_broadcast_and_only_hot_keys_are_repeated(spark):
    big = spark.range(500).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    small = spark.range(-1, 400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = lookup_join(big, small, ["k"], F.col("id"), broadcast_rows=0, hot=100)
    assert {r["id"]: r["v"] for r in joined.collect()} == {i: -2 if i % 3 == 0 else i * 2 if i < 400 else None for i in range(500)}
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "_hot_key" in plan


@pytest.mark.parametrize("limit", [10, None])
def test_fifo_window(spark, limit):
    rng = random.Random(5)
    sends = [("hot", rng.randrange(40_000)) for _ in range(400)] + [
        (f"id{rng.randrange(50)}", rng.randrange(40_000)) for _ in range(200)
    ]
    sends += sends[:50]
    df = spark.createDataFrame(sends, "dedup_id string, sent_ms bigint")
    got = sorted(map(tuple, fifo_dedup(df, window_ms=300, limit=limit).collect()))
    expected, last = [], {}
    for dedup_id, at in sorted(set(sends)):
        if dedup_id not in last or at - last[dedup_id] >= 300:
            last[dedup_id] = at
            expected.append((dedup_id, at))
    assert got == expected
