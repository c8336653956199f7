import os
import random
from collections import Counter, defaultdict

import pytest
from events import events
from pyspark.sql import functions as F

from commitpost.operators.reports import LATENCY_BOUNDS
from commitpost.streaming.relay import STREAM_SCHEMA, Relay, dedup_stream, exact_dedup_stream, rate_stream, read_events
from commitpost.streaming.send import CallError, Line, judged, send_in_order
from commitpost.operators.messages import publish_requests
from commitpost.functions import outcome, text


@pytest.fixture(scope="module")
def backlog(spark):
    rng = random.Random(1)
    rows = [
        {"id": f"e{n}", "source": f"s{n % 2}", "aggregate_id": str(rng.randrange(12)), "commit_lsn": (n // 3 + 1) * 100, "row_seq": n}
        for n in range(120)
    ]
    return events(spark, rows).cache()


def requests(df, lanes=4):
    made = df.withColumn("attempt", F.lit(0)).withColumn("order_key", text.ordering_key())
    return publish_requests(made, "q.fifo", lanes=lanes, keep=["attempt", "order_key"])


def test_answers_are_judged_fail_safe():
    entries = [{"index": i} for i in range(4)]
    answers = [(0, True, False, "", ""), (1, False, True, "MessageTooLong", "m"), (2, True, False, "", ""), (2, False, False, "E", "m"), (9, True, False, "", "")]
    assert judged(entries, lambda _: answers) == {
        0: ("ok", ""), 1: ("permanent", "MessageTooLong: m"), 2: ("retryable", "E: m"),
        3: ("retryable", "missing from the broker response"),
    }

    def fail(_):
        raise CallError("BatchRequestTooLong")

    assert {k for k, _ in judged(entries, fail).values()} == {"retryable"}
    assert judged(entries[:1], fail) == {0: ("permanent", "BatchRequestTooLong")}


def test_nothing_overtakes_a_failed_event(backlog):
    def refuse(entries):
        return [(e["index"], e["id"] != "e7", False, "Throttled", "") for e in entries]

    outcomes = {r["id"]: r["outcome"] for r in send_in_order(requests(backlog), refuse).collect()}
    row = backlog.where("id = 'e7'").first()
    same_key = backlog.where((F.col("source") == row["source"]) & (F.col("aggregate_id") == row["aggregate_id"]))
    later = {r["id"] for r in same_key.where(F.col("row_seq") > 7).collect()}
    assert later and outcomes["e7"] == "retryable"
    assert later.isdisjoint(outcomes)
    assert set(outcomes) == {r["id"] for r in backlog.collect()} - later


def test_retries_in_place_count_attempts(backlog):
    def third_time(entries):
        return [(e["index"], e["attempt"] == 3, False, "Busy", "") for e in entries]

    tries = Counter(r["id"] for r in send_in_order(requests(backlog), third_time, retries=5).collect())
    assert set(tries.values()) == {3} and len(tries) == 120


def relay_run(spark, tmp_path, parts, send, **settings):
    relay = Relay(spark, str(tmp_path / "relay"), send, lanes=4, **settings)
    for part in parts:
        part.write.mode("append").parquet(str(tmp_path / "in"))
        relay.start(read_events(spark, str(tmp_path / "in")), str(tmp_path / "offsets")).awaitTermination()
    return relay


def test_relay_publishes_in_order_and_acknowledges(spark, backlog, tmp_path):
    failures = {"e10": 2, "e40": 1, "e41": 9}

    def send(entries):
        out = []
        for e in entries:
            if e["id"] == "e20":
                out.append((e["index"], False, True, "InvalidParameterValue", "no"))
            else:
                out.append((e["index"], e["attempt"] > failures.get(e["id"], 0), False, "Busy", ""))
        return out

    bad = events(spark, [{"id": "bad", "source": "s0", "payload": "{", "commit_lsn": 900, "row_seq": 900}])
    parts = [backlog.where("commit_lsn <= 2000").unionByName(bad), backlog.where("commit_lsn > 2000")]
    relay = relay_run(spark, tmp_path, parts, send)
    acks = {r["source"]: r["acked"] for r in relay.at_step("acks", relay.last_step()).collect()}
    stuck = backlog.where("id = 'e41'").first()
    assert acks[stuck["source"]] < stuck["commit_lsn"]
    while relay.retry_pending():
        pass
    delivered = relay.table("deliveries").collect()
    ids = Counter(r["id"] for r in delivered)
    assert set(ids) == {f"e{n}" for n in range(120)} - {"e20"} and set(ids.values()) == {1}
    assert [r["id"] for r in relay.table("dead_letters").collect()] == ["e20"]
    assert [(r["id"], r["problem"]) for r in relay.table("rejects").collect()] == [("bad", "payload: not JSON")]
    acks = {r["source"]: r["acked"] for r in relay.at_step("acks", relay.last_step()).collect()}
    highest = {r["source"]: r["m"] for r in backlog.groupBy("source").agg(F.max("commit_lsn").alias("m")).collect()}
    assert acks == {source: top - 1 for source, top in highest.items()}  # more events of that position may come
    key_of = {r["id"]: (r["source"], r["aggregate_id"]) for r in backlog.collect()}
    by_key = defaultdict(list)
    for r in delivered:
        by_key[key_of[r["id"]]].append(((r["batch"], r["retry"]), r["row_seq"]))
    for rows in by_key.values():
        steps = [step for step, _ in sorted(rows, key=lambda row: row[1])]
        assert steps == sorted(steps)


def test_a_crash_repeats_and_loses_nothing(spark, backlog, tmp_path):
    class Dying(Relay):
        armed = True

        def acknowledge(self, taken, waiting, previous, step):
            if Dying.armed:
                Dying.armed = False
                raise RuntimeError("crash")
            super().acknowledge(taken, waiting, previous, step)

    def accept(entries):
        return [(e["index"], True, False, "", "") for e in entries]

    relay = Dying(spark, str(tmp_path / "relay"), accept, lanes=4)
    backlog.write.parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="crash"):
        relay.start(read_events(spark, str(tmp_path / "in")), str(tmp_path / "offsets")).awaitTermination()
    assert relay.last_step() == (-1, 0)
    relay.start(read_events(spark, str(tmp_path / "in")), str(tmp_path / "offsets")).awaitTermination()
    copies = Counter(r["dedup_id"] for r in relay.table("deliveries").collect())
    assert len(copies) == 120 and set(copies.values()) == {2}
    relay.start(read_events(spark, str(tmp_path / "in")), str(tmp_path / "offsets")).awaitTermination()
    assert relay.table("deliveries").count() == 240


def test_admission_takes_few_files_at_a_time(spark, backlog, tmp_path):
    for n in range(4):
        backlog.where(F.col("row_seq") % 4 == n).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    sizes = []
    stream = read_events(spark, str(tmp_path / "in"), per_trigger=1).writeStream
    stream.foreachBatch(lambda rows, _: sizes.append(rows.count())).trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "offsets")
    ).start().awaitTermination()
    assert sizes == [30, 30, 30, 30]


def test_window_streams(spark, tmp_path):
    rows = [("a", "s", 0), ("a", "s", 100), ("b", "s", 130), ("c", "s", 7_200)]
    sends = spark.createDataFrame(rows, "dedup_id string, source string, t int")
    sends.select("dedup_id", "source", F.timestamp_seconds("t").alias("sent_at")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("dedup_id string, source string, sent_at timestamp").parquet(str(tmp_path / "in"))
    for name, made in (("dedup", dedup_stream(stream)), ("rate", rate_stream(stream))):
        writer = made.writeStream.format("parquet").option("path", str(tmp_path / name))
        writer = writer.option("checkpointLocation", str(tmp_path / f"{name}-offsets")).outputMode("append")
        writer.trigger(availableNow=True).start().awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "dedup"))
    assert sorted(r["dedup_id"] for r in kept.collect()) == ["a", "b", "c"]
    rates = spark.read.parquet(str(tmp_path / "rate")).select(F.unix_seconds("minute").alias("m"), "deliveries")
    assert sorted(map(tuple, rates.collect())) == [(0, 1), (60, 1), (120, 1)]


def test_a_source_whose_client_breaks_holds_back_itself_only(backlog):
    """Each task tries it once and leaves its other calls alone."""

    def broken_for_one(entries):
        if entries[0]["source"] == "s1":
            raise TimeoutError("no route")
        return [(e["index"], True, False, "", "") for e in entries]

    rows = send_in_order(requests(backlog, lanes=1), broken_for_one).collect()
    sent = {r["id"] for r in rows if r["outcome"] == "ok"}
    assert sent == {r["id"] for r in backlog.where("source = 's0'").collect()}
    failed = [r for r in rows if r["source"] == "s1"]
    assert {(r["outcome"], r["reason"]) for r in failed} == {("retryable", "TimeoutError: no route")} and len(failed) <= 10


def busy_for_one():
    """A function of this function's own, so that tasks get it by value."""

    def send(entries):
        return [(e["index"], e["id"] != "e3", False, "Busy", "") for e in entries]

    return send


def test_a_relay_at_rest_writes_nothing(spark, backlog, tmp_path, monkeypatch):
    """Wake-up calls without due events are no steps, and a step leaves nothing staged."""
    staged = tmp_path / "staged"
    monkeypatch.setattr("commitpost.plans.stage.shared_dir", lambda _: str(staged))
    relay = Relay(spark, str(tmp_path / "relay"), busy_for_one(), lanes=4, initial_ms=3_600_000, max_ms=3_600_000)
    relay.prepare()
    relay.publish(backlog, 0)
    names = lambda: sorted(os.path.join(r, n) for top in (tmp_path / "relay", staged) for r, _, ns in os.walk(top) for n in ns)
    before = names()
    assert not [n for n in before if n.startswith(str(staged))]
    tick = spark.createDataFrame([(*[None] * (len(STREAM_SCHEMA.split(", ")) - 1), False)], STREAM_SCHEMA)
    for batch in range(1, 21):
        relay.publish(tick, batch)
    assert names() == before and relay.last_step() == (0, 0)
    assert relay.retry_pending(wait=False) and names() == before
    held = {r["id"] for r in relay.at_step("pending", (0, 0)).collect()}
    assert "e3" in held and len(held) > 1  # later events of its key wait untried


def test_dead_letters_are_stored_once_over_many_steps(spark, tmp_path):
    def refuse(entries):
        return [(e["index"], False, True, "InvalidParameterValue", "no") for e in entries]

    relay = Relay(spark, str(tmp_path / "relay"), refuse, lanes=2)
    relay.dead_letters.buckets, relay.dead_letters.fan = 2, 3
    relay.prepare()
    for batch in range(6):
        rows = [{"id": f"d{batch // 2}", "commit_lsn": batch + 1}, {"id": f"x{batch}", "aggregate_id": "q", "commit_lsn": batch + 1}]
        relay.publish(events(spark, rows), batch)
    ids = Counter(r["id"] for r in relay.table("dead_letters").collect())
    assert ids == Counter([f"d{n}" for n in range(3)] + [f"x{n}" for n in range(6)])
    assert len(relay.dead_letters.manifest((5, 0))) <= 2 * 2 * 3


def test_samples_count_a_repeated_step_once(spark, backlog, tmp_path):
    class Dying(Relay):
        armed = True

        def acknowledge(self, *args):
            if Dying.armed:
                Dying.armed = False
                raise RuntimeError("crash")
            super().acknowledge(*args)

    relay = Dying(spark, str(tmp_path / "relay"), busy_for_one(), lanes=4, initial_ms=3_600_000, max_ms=3_600_000, replica="r7", sink="mirror", clock=lambda: 12.0)
    relay.prepare()
    with pytest.raises(RuntimeError):
        relay.publish(backlog, 0)
    relay.publish(backlog, 0)
    relay.publish(events(spark, [{"id": "late", "source": "s9", "commit_lsn": 9_000}]), 1)
    rows = relay.at_step("metric_samples", (1, 0)).collect()
    assert {(r["at_us"], r["replica"], r["sink"]) for r in rows} == {(12_000_000, "r7", "mirror")}
    assert len({(r["source"], r["metric"], r["kind"]) for r in rows}) == len(rows)
    value = {(r["source"], r["metric"], r["kind"]): r["value"] for r in rows}
    pending = Counter(r["source"] for r in relay.at_step("pending", (1, 0)).collect())
    stuck = backlog.where("id = 'e3'").first()["source"]
    for source, total in (("s0", 60), ("s1", 60), ("s9", 1)):
        published = value[source, "events_published_total", ""]
        assert published + value[source, "pending_events", ""] == total
        assert value[source, "pending_events", ""] == pending[source]
        assert value[source, "publish_errors_total", "retryable"] == (source == stuck)
        assert value[source, "dead_letters_total", ""] == 0
        buckets = [value[source, "publish_latency_bucket", le] for le in [str(b) for b in LATENCY_BOUNDS] + ["+Inf"]]
        assert buckets == sorted(buckets) and buckets[-1] == published


def test_dedup_ids_share_state_by_parts(spark, tmp_path):
    """Many ids in few parts, over micro-batches: what each accepts is its own, and expired ids leave the state."""
    minute = 60_000
    sends = [[(f"i{n}", n * 10 + late) for n in range(300) for late in (0, 2 * minute)], [(f"i{n}", 5 * minute + n * 10) for n in range(0, 300, 3)]]
    sends += [[("i0", 40 * minute)], [("i0", 44 * minute), (None, 44 * minute), ("i1", 44 * minute)], [("i0", 45 * minute), (None, 46 * minute)]]
    sends = [[(id, 1_000_000_000_000 + ms) for id, ms in rows] for rows in sends]
    box, out = str(tmp_path / "box"), str(tmp_path / "out")
    for rows in sends:
        part = spark.createDataFrame(rows, "dedup_id string, ms bigint").select("dedup_id", F.timestamp_millis("ms").alias("sent_at"))
        part.write.mode("append").parquet(box)
        stream = spark.readStream.schema("dedup_id string, sent_at timestamp").parquet(box)
        writer = exact_dedup_stream(stream, 5 * minute, parts=4).writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", str(tmp_path / "offsets")).trigger(availableNow=True).start().awaitTermination()
    last, expected = {}, []
    for id, ms in (row for rows in sends for row in sorted(rows, key=lambda row: row[1])):
        if id not in last or ms - last[id] >= 5 * minute:
            last[id] = ms
            expected.append((id, ms))
    assert sorted(map(str, map(tuple, spark.read.parquet(out).collect()))) == sorted(map(str, expected))


def test_copies_in_a_micro_batch_go_out_once_from_their_first_position(spark, tmp_path):
    rows = [{"id": f"e{n % 4}", "source": "s", "aggregate_id": "k", "commit_lsn": 1000 - n * 100, "row_seq": n} for n in range(6)]
    relay = Relay(spark, str(tmp_path), lambda entries: [(e["index"], True, False, "", "") for e in entries])
    relay.prepare()
    relay.publish(events(spark, rows), 0)
    sent = relay.table("deliveries").select("id", "commit_lsn").collect()
    assert sorted(map(tuple, sent)) == [("e0", 600), ("e1", 500), ("e2", 800), ("e3", 700)]


def fails_once():
    def send(entries):
        return [(e["index"], e["attempt"] > 1, False, "Busy", "") for e in entries]

    return send


def test_a_key_that_fails_again_and_again_takes_one_step(spark, tmp_path):
    """every event fails at first, and holds back the rest of its key; each failure took a step of its own before."""
    rows = [{"id": f"e{n}", "aggregate_id": f"k{n % 2}", "commit_lsn": n + 1, "row_seq": n} for n in range(24)]
    relay = Relay(spark, str(tmp_path), fails_once(), lanes=2, initial_ms=20, max_ms=50)
    relay.prepare()
    relay.publish(events(spark, rows), 0)
    assert {r["id"] for r in relay.table("outcomes").collect()} == {"e0", "e1"}
    assert not relay.retry_pending() and relay.last_step() == (0, 1)
    tried = Counter((r["id"], r["attempt"]) for r in relay.table("outcomes").collect())
    assert tried == Counter((f"e{n}", a) for n in range(24) for a in (1, 2))
    sent = sorted(relay.table("deliveries").collect(), key=lambda r: r["row_seq"])
    assert [r["id"] for r in sent] == [f"e{n}" for n in range(24)]
    for key in (0, 1):
        times = [r["sent_at"] for r in sent if r["row_seq"] % 2 == key]
        assert times == sorted(times)


def sent_by(line, calls):
    rows = []
    for call in calls:
        rows += [*line.serve(), *line.call(call)]
    while line.sleep():
        rows += line.serve()
    return rows


def entry(n, key, size=100):
    return {"source": "s", "id": f"{key}{n}", "order_key": key, "attempt": 0, "index": 0, "size": size}


def test_what_waits_in_a_task_keeps_its_order():
    rng = random.Random(4)
    fails = {f"{key}{n}": rng.randrange(3) for key in "abc" for n in range(40)}
    sizes = []

    def send(entries):
        sizes.append(sum(e["size"] for e in entries))
        assert len({e["order_key"] for e in entries}) == len(entries)
        return [(e["index"], e["attempt"] > fails[e["id"]], False, "Busy", "") for e in entries]

    line = Line(send, 0, 60.0, 1, 4)
    calls = [[entry(n, key, 150_000) | {"index": i} for i, key in enumerate("a" if n % 2 else "bc")] for n in range(40)]
    ok = [row[0]["id"] for row in sent_by(line, calls) if row[2] == "ok"]
    for key in "abc":
        assert [id for id in ok if id[0] == key] == [e["id"] for call in calls for e in call if e["order_key"] == key]
    assert not line.waiting and not line.stopped and line.held == 0
    assert max(sizes) <= 300_000  # the planned calls; those of what waited are cut at 262,144 bytes


def test_a_task_gives_up_what_never_gets_through():
    line = Line(lambda entries: [(e["index"], e["order_key"] == "b", False, "Busy", "") for e in entries], 0, 0.2, 10, 20)
    rows = sent_by(line, [[entry(n, "a"), entry(n, "b") | {"index": 1}] for n in range(5)])
    assert [r[0]["id"] for r in rows if r[2] == "ok"] == [f"b{n}" for n in range(5)]
    assert {r[0]["id"] for r in rows if r[2] != "ok"} == {"a0"}
    assert line.stopped == {"a"} and line.held == 0 and not line.waiting


def test_a_task_waits_as_the_pending_table_says(spark):
    rows = [(f"s{n % 3}", f"é{n}", n % 40 + 1) for n in range(200)]
    made = spark.createDataFrame(rows, "source string, id string, attempt int")
    delay = outcome.backoff_ms(F.col("attempt") - 1, outcome.jitter(F.col("source"), F.col("id"), F.col("attempt").cast("string")), 100, 30_000)
    for r in made.withColumn("ms", delay).collect():
        assert outcome.backoff_of(r["source"], r["id"], r["attempt"], 100, 30_000) == r["ms"]


def test_calls_planned_in_lanes_are_the_same(spark):
    rng = random.Random(9)
    rows = [
        {"id": f"e{n}", "source": f"s{n % 2}", "aggregate_id": str(rng.randrange(30)), "commit_lsn": n // 3 + 1, "row_seq": n,
         "payload": '"' + "x" * rng.choice([10, 60_000, 120_000, 270_000]) + '"'}
        for n in range(160)
    ]
    made = events(spark, rows)
    for most in (10, 25):
        plans = [publish_requests(made, "q.fifo", most, 3, in_lanes=i) for i in (False, True)]
        columns = ["source", "lane", "round", "batch", "id", "call", "index", "size"]
        want, got = (sorted(map(tuple, p.select(columns).collect())) for p in plans)
        assert got == want and max(r[5] for r in want) > 1
