import random

import pytest
from events import events
from pyspark.sql import functions as F

from commitpost.operators import alerts, outcomes, reconcile, reports
from commitpost.sources import changelog, outbox, schema, tenants
from workload import tables as t


def test_outcomes_fail_safe(spark):
    requests = spark.createDataFrame([("c", i, str(i)) for i in range(5)], "call string, index bigint, id string")
    answers = spark.createDataFrame(
        [
            ("c", "0", True, False, "", ""),
            ("c", "1", False, True, "InvalidMessageContents", "bad"),
            ("c", "2", True, False, "", ""),
            ("c", "2", False, False, "InternalError", "late"),
            ("c", "x", True, False, "", ""),
            ("c", "9", True, False, "", ""),
            ("c", "3", False, True, "OverLimit", None),
        ],
        "call string, index string, ok boolean, sender_fault boolean, code string, message string",
    )
    got = {r["index"]: (r["outcome"], r["reason"]) for r in outcomes.publish_outcomes(requests, answers).collect()}
    assert got == {
        0: ("ok", None),
        1: ("permanent", "InvalidMessageContents: bad"),
        2: ("retryable", "InternalError: late"),
        3: ("retryable", "OverLimit: "),
        4: ("retryable", "missing from the broker response"),
    }
    audit = {(r["index"], r["problem"]) for r in outcomes.answer_audit(requests, answers).collect()}
    assert audit == {("x", "unknown"), ("9", "unknown"), ("2", "repeated")}


def test_a_failed_call_is_retried_unless_one_entry_is_too_long(spark):
    requests = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("c", 0)], "call string, index bigint")
    failed = spark.createDataFrame(
        [("a", "BatchRequestTooLong"), ("b", "BatchRequestTooLong"), ("c", "Throttled")], "call string, error string"
    )
    got = sorted((r["call"], r["outcome"]) for r in outcomes.call_failures(requests, failed).collect())
    assert got == [("a", "retryable"), ("a", "retryable"), ("b", "permanent"), ("c", "retryable")]


def test_dead_letters_are_stored_once(spark):
    shape = "slot string, id string, envelope string, reason string, failed_at timestamp"
    at = [f"2031-01-02 00:00:0{i}" for i in range(3)]
    failed = spark.sql(
        f"select * from values ('s','1','{{}}','late',timestamp'{at[2]}'),('s','1','{{}}','first',timestamp'{at[0]}'),"
        f"('s','2','{{}}','r',timestamp'{at[1]}') as v(slot, id, envelope, reason, failed_at)"
    )
    empty = spark.createDataFrame([], shape)
    stored = outcomes.new_dead_letters(failed, empty)
    assert sorted((r["id"], r["reason"]) for r in stored.collect()) == [("1", "first"), ("2", "r")]
    assert outcomes.new_dead_letters(failed, stored).count() == 0


@pytest.mark.parametrize("limit", [2, None])
def test_only_the_key_of_a_pending_event_waits(spark, limit):
    rows = [{"id": str(n), "aggregate_id": str(n % 2), "commit_lsn": n * 10} for n in range(8)]
    df = events(spark, rows)
    held = outcomes.held_events(df, df.where("id = '2'"), limit)
    assert sorted(r["id"] for r in held.where("held").collect()) == ["4", "6"]
    assert {r["blocked_by"] for r in held.where("held").collect()} == {20}


def test_contract(spark):
    raw = events(spark, [{"id": "1"}, {"id": "2", "payload": "{"}, {"id": "3", "headers": None}, {"id": None}])
    bad = {r["id"]: r["problem"] for r in schema.contract_violations(raw).collect()}
    assert bad == {"2": "payload: not JSON", "3": "headers: missing", None: "id: missing"}
    assert schema.valid_rows(raw).count() == 1
    with pytest.raises(Exception, match="payload: not JSON"):
        schema.valid_rows(raw.where("id = '2'"), strict=True).collect()
    with pytest.raises(schema.ContractError, match="event_type"):
        schema.require_columns(raw.drop("event_type"))
    assert outbox.outbox_scan(raw.withColumn("extra", F.lit(1))).columns == list(schema.REQUIRED)


def test_tenant_names(spark):
    rows = events(spark, [{"id": "1"}]).drop("source")
    assert {r["source"] for r in outbox.tenant_union([(" a", rows), ("", rows), ("b", rows)]).collect()} == {"a", "b"}
    with pytest.raises(ValueError, match="twice"):
        outbox.tenant_union([("a", rows), ("a ", rows)])


@pytest.mark.parametrize(
    ("row", "problem"),
    [
        (("north", "postgres://courier@pg7.test/{database}", "outbox_{database}", "pub"), None),
        (("north", "postgres://courier@pg7.test/ledger", "outbox_{database}", "pub"), "dsn is not a template"),
        (("north", "postgres://courier@pg7.test/{database}", "outbox_slot", "pub"), "slot is not a template"),
        (("north-2", "postgres://courier@pg7.test/{database}", "outbox_{database}", "pub"), "not a slot name"),
        (("north", "postgres://courier@pg7.test/{database}", "outbox_{database}", "pub_{database}"), "publication is a template"),
    ],
)
def test_tenant_registry(spark, row, problem):
    shape = "group_id int, database string, dsn_template string, slot_template string, publication string"
    rows = spark.createDataFrame([(1, *row), (1, "  ", *row[1:])], shape)
    got = tenants.expand_tenants(rows).collect()
    assert [r["problem"] for r in got] == [problem]
    if problem is None:
        assert (got[0]["dsn"], got[0]["slot"]) == ("postgres://courier@pg7.test/north", "outbox_north")


def test_without_databases_the_list_is_one_source(spark):
    shape = "group_id int, database string, dsn_template string, slot_template string, publication string"
    rows = [
        (1, "", "postgres://courier@pg7.test/ledger", "outbox_slot", "p"), (1, " ", "postgres://courier@pg7.test/ledger", "outbox_slot", "p"),
        (2, "", "postgres://courier@pg7.test/{database}", "outbox_slot", "p"),
    ]
    got = {r["group_id"]: r for r in tenants.expand_tenants(spark.createDataFrame(rows, shape)).collect()}
    assert (got[1]["source"], got[1]["slot"], got[1]["problem"]) == ("ledger", "outbox_slot", None)
    assert got[2]["problem"] == "no databases for the templates"


def test_tenants_need_names_of_their_own(spark):
    shape = "group_id int, database string, dsn_template string, slot_template string, publication string"
    same = "postgres://courier@{database}.pg.test/ledger"
    rows = [(1, "a", same, "o_{database}", "p"), (1, "b", same, "o_{database}", "p")]
    got = tenants.expand_tenants(spark.createDataFrame(rows, shape)).collect()
    assert {r["problem"] for r in got} == {"several sources of one name"}
    twice = [(1, "a", "postgres://r@h/{database}", "o_{database}", "p")] * 2
    got = tenants.expand_tenants(spark.createDataFrame(twice, shape)).collect()
    assert {r["problem"] for r in got} == {"listed twice"}


NAMES = ("id", "aggregate_type", "aggregate_id", "event_type", "payload", "headers", "created_at")


def insert(values, kinds=None):
    out = b"I" + t.RELATION_OID.to_bytes(4, "big") + b"N" + len(values).to_bytes(2, "big")
    for value in values:
        if value is None:
            out += b"n"
        else:
            data = value if isinstance(value, bytes) else value.encode()
            out += b"t" + len(data).to_bytes(4, "big") + data
    return out


def log(spark, rows):
    shape = "source string, wal_pos bigint, kind string, relation_oid bigint, data binary, end_lsn bigint, commit_micros bigint"
    full = [("north", pos, kind, t.RELATION_OID, data, end, at) for pos, kind, data, end, at in rows]
    return spark.createDataFrame(full, shape)


VALUES = ["e1", "parcel", "Żar", "parcel.weighed", '{"n": 1}', "{}", "2031-02-07 21:45:09.5+00"]


def test_change_log_gives_committed_events(spark):
    relation = t.relation_message(NAMES)
    extra = t.relation_message(("trace", *reversed(NAMES)))
    rows = [
        (1, "B", None, None, None), (2, "R", relation, None, None), (3, "I", insert(VALUES), None, None),
        (4, "K", None, 4, None), (5, "C", None, 50, 1_000_000), (6, "K", None, 60, None),
        (7, "B", None, None, None), (8, "I", insert(["rolled back"] + VALUES[1:]), None, None),
        (9, "B", None, None, None), (10, "R", extra, None, None),
        (11, "I", insert([None, *reversed(["e2"] + VALUES[1:6] + ["infinity"])]), None, None), (12, "U", b"Uignored", None, None),
        (13, "C", None, 130, 2_000_000), (14, "B", None, None, None), (15, "I", insert(["cut"] + VALUES[1:]), None, None),
    ]
    events_, rejects = changelog.decoded_events(log(spark, rows))
    got = {r["id"]: r for r in events_.collect()}
    assert set(got) == {"e1", "e2"} and rejects.count() == 0
    assert (got["e1"]["occurred_at"], got["e2"]["occurred_at"]) == ("2031-02-07T21:45:09.5Z", "infinity")
    assert (got["e1"]["aggregate_id"], got["e1"]["payload"], got["e1"]["commit_lsn"]) == ("Żar", '{"n": 1}', 50)
    assert got["e2"]["headers"] == "{}" and got["e2"]["commit_lsn"] == 130
    marks = [r["lsn"] for r in changelog.progress_marks(log(spark, rows)).orderBy("wal_pos").collect()]
    assert marks == [50, 60, 130]


@pytest.mark.parametrize(
    ("message", "error"),
    [
        (insert(VALUES)[:-3], "the message ends too early"),
        (insert(VALUES)[:6], "the message ends too early"),
        (insert(VALUES[:3]), "3 values for 7 columns"),
        (insert(VALUES).replace(b"N", b"K", 1), "no new row in the insert"),
        (insert(VALUES)[:8] + b"u" + insert(VALUES)[9:], "value kind not read in id"),
        (insert([b"\xff\xfe"] + VALUES[1:]), "value is not UTF-8"),
        (insert([None] + VALUES[1:]), "no value for `id`"),
    ],
)
def test_unreadable_inserts_say_why(spark, message, error):
    rows = [
        (1, "B", None, None, None), (2, "R", t.relation_message(NAMES), None, None),
        (3, "I", message, None, None), (4, "C", None, 50, 0),
    ]
    events_, rejects = changelog.decoded_events(log(spark, rows))
    assert events_.count() == 0
    assert [r["error"] for r in rejects.collect()] == [error]
    unknown = changelog.decoded_events(log(spark, [r for r in rows if r[1] != "R"]))[1]
    assert [r["error"] for r in unknown.collect()] == ["relation not seen yet"]


def test_reconciliation(spark):
    rows = events(spark, [{"id": str(n), "commit_lsn": n + 1} for n in range(6)])
    seen = rows.where("id < '4'").withColumn("sent_at", F.timestamp_seconds(F.col("id").cast("int")))
    dead = rows.where("id = '4'")
    assert [r["id"] for r in reconcile.missing_events(rows, seen, dead).collect()] == ["5"]
    twice = seen.unionByName(seen.where("id = '1'"))
    assert [(r["id"], r["deliveries"]) for r in reconcile.duplicate_deliveries(twice).collect()] == [("1", 2)]
    diff = {(r["id"], r["side"], r["copies"]) for r in reconcile.ids_diff(twice, rows).collect()}
    assert diff == {("1", "left", 1), ("4", "right", 1), ("5", "right", 1)}
    assert reconcile.order_violations(seen).count() == 0
    late = seen.withColumn("sent_at", F.when(F.col("id") == "2", F.timestamp_seconds(F.lit(99))).otherwise(F.col("sent_at")))
    for limit in (1, None):
        assert [r["id"] for r in reconcile.order_violations(late, limit).collect()] == ["2"]


def test_percentiles_and_medians_by_counts(spark):
    rng = random.Random(2)
    values = {f"s{i}": [rng.randrange(200_000) for _ in range(rng.randrange(1, 90))] for i in range(12)}
    df = spark.createDataFrame([(s, v) for s, vs in values.items() for v in vs], "source string, v bigint")
    at = df.select(
        "source", F.timestamp_millis(F.lit(0)).alias("committed_at"), F.timestamp_millis("v").alias("sent_at")
    )
    for limit in (5, None):
        got = {r["source"]: tuple(r)[1:] for r in reports.latency_percentiles(at, limit).collect()}
        for source, vs in values.items():
            vs = sorted(vs)
            rank = [-(-len(vs) * p // 100) for p in (50, 99)]
            assert got[source] == (vs[rank[0] - 1], vs[rank[1] - 1], vs[-1])
        medians = {r["source"]: r["median"] for r in reports.upper_median(df, ["source"], "v", limit).collect()}
        assert medians == {s: sorted(vs)[len(vs) // 2] for s, vs in values.items()}


def test_trailing_sums_cross_chunks(spark):
    rng = random.Random(9)
    minutes = sorted(rng.sample(range(300), 120))
    df = spark.createDataFrame([("s", m * 60_000_000, float(m % 7)) for m in minutes], "s string, at_us bigint, v double")
    got = {r["at_us"] // 60_000_000: (r["a"], r["b"]) for r in reports.trailing_sums(df, ["s"], "v", {"a": 5, "b": 15}, 20).collect()}
    for m in minutes:
        assert got[m] == tuple(sum(x % 7 for x in minutes if m - width < x <= m) for width in (5, 15))


def test_counters_survive_resets(spark):
    rows = [("r", "c_total", "s", "", i * 60_000_000, v) for i, v in enumerate([5.0, 8.0, 2.0, 2.0, 9.0])]
    df = spark.createDataFrame(rows, "replica string, metric string, source string, kind string, at_us bigint, value double")
    assert [r["gain"] for r in reports.counter_steps(df).orderBy("at_us").collect()] == [3.0, 2.0, 0.0, 7.0]


@pytest.mark.parametrize("limit", [3, None])
def test_an_alert_needs_its_condition_without_a_break(spark, limit):
    on = {0, 1, 2, 3, 4, 5, 7, 8, 9, 10, 20, 21, 22, 40, 41, 42, 43, 44, 45, 46}
    rows = [("s", m * 60_000_000, m in on) for m in range(50) if not 25 < m < 43]
    df = spark.createDataFrame(rows, "source string, at_us bigint, c boolean")
    fired = alerts.held(df, ["source"], F.col("c"), 3, limit)
    got = sorted((r["since_us"] // 60_000_000, r["until_us"] // 60_000_000) for r in fired.collect())
    assert got == [(0, 5), (7, 10), (43, 46)]


def test_readiness_is_any_source_and_all_sinks(spark):
    flags = [("a", True, True), ("a", False, True), ("b", False, True), ("c", True, True), ("c", True, False)]
    df = spark.createDataFrame(flags, "replica string, source_ready boolean, sink_ready boolean")
    got = {r["replica"]: r["ready"] for r in reports.readiness(df, ["replica"]).collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_counters_of_two_sinks_are_apart(spark):
    rows = [(minute * 60_000_000, "r", "sent", "s", sink, "", base + minute) for minute in range(5) for sink, base in (("queue", 10.0), ("log", 900.0))]
    samples = spark.createDataFrame(rows, "at_us bigint, replica string, metric string, source string, sink string, kind string, value double")
    got = reports.counter_increase(samples, {"up": 60}).where("at_us = 240000000").collect()
    assert sorted((r["sink"], r["up"]) for r in got) == [("log", 4.0), ("queue", 4.0)]


@pytest.mark.parametrize("length", [b"\xff\xff\xff\xff", b"\x7f\xff\xff\xff"])
def test_a_huge_length_is_one_reject(spark, length):
    bad = insert(VALUES)
    bad = bad[:10] + length + bad[14:]
    broken = insert([*VALUES[:4], "{", *VALUES[5:]])
    rows = [
        (1, "B", None, None, None), (2, "R", t.relation_message(NAMES), None, None), (3, "I", bad, None, None),
        (4, "I", insert(VALUES), None, None), (5, "I", broken, None, None), (6, "C", None, 50, 1_000_000),
    ]
    events_of, rejects = changelog.decoded_events(log(spark, rows))
    assert [r["row_seq"] for r in events_of.collect()] == [4]
    assert sorted((r["wal_pos"], r["error"]) for r in rejects.collect()) == [(3, "the message ends too early"), (5, "payload: not JSON")]
