"""The change log as a stream: state across micro-batches, strays, steps that run again, idle steps."""

import os

from pyspark.sql import functions as F
from test_operators import NAMES, VALUES, insert, log

from commitpost.plans import stage as stages
from commitpost.sources import changelog
from commitpost.streaming.relay import Relay, read_events
from commitpost.streaming.tail import LogTail
from workload import tables as t

ROWS = [
    (1, "I", insert(["early"] + VALUES[1:]), None, None), (2, "C", None, 20, 0), (3, "K", None, 25, None),
    (4, "B", None, None, None), (5, "R", t.relation_message(NAMES), None, None), (6, "I", insert(["a1"] + VALUES[1:]), None, None),
    (7, "K", None, 27, None), (8, "I", insert(["a2"] + VALUES[1:]), None, None), (9, "C", None, 90, 1_000_000),
    (10, "I", insert(["between"] + VALUES[1:]), None, None), (11, "B", None, None, None),
    (12, "I", insert(["rolled back"] + VALUES[1:]), None, None), (13, "B", None, None, None),
    (14, "I", insert(["b1"] + VALUES[1:]), None, None), (15, "C", None, 150, 2_000_000), (16, "K", None, 160, None),
    (17, "B", None, None, None), (18, "I", insert(["open"] + VALUES[1:]), None, None),
]
STRAYS = {1: "an insert outside of a transaction", 2: "a commit without its begin", 10: "an insert outside of a transaction"}


def results(tail):
    events = tail.table("events")
    return (
        sorted(r["id"] for r in events.where("progress is null").collect()),
        sorted(r["commit_lsn"] for r in events.where("progress").collect()),
        {r["wal_pos"]: r["error"] for r in tail.table("rejects").collect()},
    )


WANT = (["a1", "a2", "b1"], [25, 90, 150, 160], STRAYS)


def test_strays_are_rejects_of_a_whole_log(spark):
    events, rejects = changelog.decoded_events(log(spark, ROWS))
    assert sorted(r["id"] for r in events.collect()) == WANT[0]
    assert {r["wal_pos"]: r["error"] for r in rejects.collect()} == STRAYS
    assert sorted(r["lsn"] for r in changelog.progress_marks(log(spark, ROWS)).collect()) == WANT[1]


def test_cuts_anywhere_change_nothing(spark, tmp_path):
    for name, cuts in {"mid": [5, 6, 8, 14], "edges": [2, 9, 10, 17]}.items():
        tail = LogTail(spark, str(tmp_path / name))
        tail.prepare()
        for batch, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(ROWS)])):
            tail.step(log(spark, ROWS[low:high]), batch)
        assert results(tail) == WANT


def test_a_step_that_runs_again_and_an_empty_one(spark, tmp_path):
    tail = LogTail(spark, str(tmp_path))
    tail.prepare()
    tail.step(log(spark, ROWS[:8]), 0)
    tail.step(log(spark, ROWS[8:]), 1)
    again = LogTail(spark, str(tmp_path))  # a new driver, which has not heard of step 1
    again.step(log(spark, [*ROWS[6:8], *ROWS[8:]]), 1)  # and gets two kept messages a second time
    again.step(log(spark, ROWS[:0]), 2)
    assert results(again) == (WANT[0], [25, 90, 150, 160], STRAYS)
    state = again.spark.read.parquet(again._folder("state", 2)).collect()
    assert sorted((r["wal_pos"], r["kind"]) for r in state) == [(5, "R"), (17, "B"), (18, "I")]
    assert len(list((tmp_path / "state").glob("batch=*"))) <= 3


def test_a_step_decodes_each_insert_once_and_leaves_nothing_staged(spark, tmp_path, monkeypatch):
    decoded, staged = spark.sparkContext.accumulator(0), []

    def counted(data):
        decoded.add(1)
        return bytes(data)

    plain = changelog.decode
    count = F.udf(counted, "binary").asNondeterministic()
    monkeypatch.setattr(changelog, "decode", lambda found: plain(found.withColumn("data", count("data"))))
    monkeypatch.setattr(stages, "new_path", lambda _, name: staged.append(str(tmp_path / f"{len(staged)}-{name}")) or staged[-1])
    tail = LogTail(spark, str(tmp_path / "tail"))
    tail.prepare()
    tail.step(log(spark, ROWS), 0)
    assert results(tail) == WANT
    assert decoded.value == 3
    assert len(staged) >= 4 and not any(os.path.exists(path) for path in staged)


def test_an_insert_reads_the_head_of_a_field_once():
    text = changelog.insert_values(F.col("data"), F.col("names"))._jc.toString()
    assert text.count("conv(") <= 5  # the count of values four times, outside of the loop, and the length of a field


def test_a_relay_reads_the_tail(spark, tmp_path):
    tail = LogTail(spark, str(tmp_path / "tail"))
    tail.prepare()
    tail.step(log(spark, ROWS), 0)
    relay = Relay(spark, str(tmp_path / "relay"), lambda entries: [(e["index"], True, False, "", "") for e in entries])
    relay.start(read_events(spark, f"{tail.path}/events"), str(tmp_path / "offsets")).awaitTermination()
    assert sorted(r["id"] for r in relay.table("deliveries").collect()) == WANT[0]
    assert [r["acked"] for r in relay.at_step("acks", relay.last_step()).collect()] == [160]
