"""The inputs of the queries, derived from the given tables by Spark. ``tables_sql`` has the same rules as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from commitpost.functions import text
from commitpost.sources.outbox import outbox_events

LSN_BASE = 96_636_764_160
LSN_STEP = 4_096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def uuid_from(value: Column) -> Column:
    m = F.md5(value)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *(F.substring(m, start, size) for start, size in cuts))


def hash16(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value), 1, 4), 16, 10).cast("bigint")


def hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n)


def plus_ms(at: Column, ms: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(at) + ms * 1000)


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the events of one tenant among 16 consecutive ones are a transaction."""
    same_tx = Window.partitionBy("source", "tx")
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("tenant_"), (F.col("user_id") % 5).cast("string")).alias("source"),
        uuid_from(F.concat(F.lit("event-"), F.col("event_id").cast("string"))).alias("id"),
        F.lit("user").alias("aggregate_type"),
        F.col("user_id").cast("string").alias("aggregate_id"),
        F.concat(F.lit("user."), "event_type").alias("event_type"),
        F.col("props").alias("payload"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.floor(F.col("event_id") / 16).alias("tx"),
        F.col("event_id").alias("row_seq"),
    )
    rows = events.select(
        "source", "id", "aggregate_type", "aggregate_id", "event_type", "payload",
        F.concat(F.lit('{"tenant": "'), "source", F.lit('"}')).alias("headers"),
        (F.min("ts").over(same_tx) - hours((F.col("tx") % 4 * 2).cast("int"))).alias("created_at"),
        (F.lit(LSN_BASE) + (F.max("row_seq").over(same_tx) + 1) * LSN_STEP).alias("commit_lsn"),
        "row_seq",
        F.max("ts").over(same_tx).alias("committed_at"),
    )
    return outbox_events(rows)


def outbox_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """whole texts as payloads."""
    day = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return outbox_events(
        table(spark, sf_dir, "documents").select(
            "source",
            uuid_from(F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))).alias("id"),
            F.lit("document").alias("aggregate_type"),
            F.col("doc_id").cast("string").alias("aggregate_id"),
            F.lit("document.added").alias("event_type"),
            F.to_json(F.struct("text")).alias("payload"),
            F.concat(F.lit('{"lang": "'), "lang", F.lit('"}')).alias("headers"),
            day.alias("created_at"),
            (F.lit(LSN_BASE) + (F.col("doc_id") + 1) * LSN_STEP).alias("commit_lsn"),
            F.lit(0).cast("bigint").alias("row_seq"),
            day.alias("committed_at"),
        )
    )


def outbox_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """short ordered keys whose rows interleave."""
    at = plus_ms(F.lit("2024-01-01 00:00:00").cast("timestamp"), F.col("turn") * 60_000)
    return outbox_events(
        table(spark, sf_dir, "conversations").select(
            F.lit("chat").alias("source"),
            uuid_from(
                F.concat_ws("-", F.lit("turn"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
            ).alias("id"),
            F.lit("conversation").alias("aggregate_type"),
            F.col("conv_id").cast("string").alias("aggregate_id"),
            F.concat(F.lit("turn."), "role").alias("event_type"),
            F.concat(
                F.lit('{"turn": '), F.col("turn").cast("string"), F.lit(', "chars": '),
                F.length("text").cast("string"), F.lit("}"),
            ).alias("payload"),
            F.lit("{}").alias("headers"),
            at.alias("created_at"),
            (F.lit(LSN_BASE) + (F.col("turn") * 100_000 + F.col("conv_id") + 1) * LSN_STEP).alias("commit_lsn"),
            F.lit(0).cast("bigint").alias("row_seq"),
            at.alias("committed_at"),
        )
    )


def outbox_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """an order and its lines as one transaction. Equal lines are one event."""
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"
    )
    head = orders.select(
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("source"),
        "o_orderkey",
        F.col("o_orderdate").cast("timestamp").alias("at"),
    )
    line = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    lines = table(spark, sf_dir, "lineitem").select(*line).distinct().withColumnRenamed("l_orderkey", "o_orderkey")
    rows = head.select(
        "source", "o_orderkey", "at", F.lit("order.created").alias("event_type"), F.lit("head").alias("part"),
        F.lit(0).cast("bigint").alias("row_seq"), F.lit("").alias("extra"),
    ).unionByName(
        head.join(lines, "o_orderkey").select(
            "source", "o_orderkey", "at", F.lit("order.line_added").alias("event_type"),
            F.concat_ws("-", *(F.col(c).cast("string") for c in line[1:3]), F.col("l_quantity").cast("int").cast("string")).alias("part"),
            (F.shiftleft(F.col("l_linenumber").cast("bigint"), 44)
             + F.col("l_partkey") * 64 + F.col("l_quantity").cast("bigint")).alias("row_seq"),
            F.concat(F.lit(', "part_id": '), F.col("l_partkey").cast("string")).alias("extra"),
        )
    )
    key = F.col("o_orderkey").cast("string")
    return outbox_events(
        rows.select(
            "source",
            uuid_from(F.concat_ws("-", F.lit("order"), key, "part")).alias("id"),
            F.lit("order").alias("aggregate_type"),
            key.alias("aggregate_id"),
            "event_type",
            F.concat(F.lit('{"order_id": '), key, "extra", F.lit("}")).alias("payload"),
            F.lit("{}").alias("headers"),
            F.col("at").alias("created_at"),
            (F.lit(LSN_BASE) + (F.col("o_orderkey") + 1) * LSN_STEP).alias("commit_lsn"),
            "row_seq",
            F.col("at").alias("committed_at"),
        )
    )


def raw_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 with faults: missing values and broken JSON in rows chosen by their id."""
    h = hash16(F.col("id"))
    rows = outbox(spark, sf_dir)
    faults = {
        "event_type": (89, None),
        "payload": (97, F.expr("left(payload, length(payload) - 1)")),
        "headers": (83, None),
        "aggregate_id": (79, None),
    }
    for name, (divisor, value) in faults.items():
        broken = F.lit(None).cast("string") if value is None else value
        rows = rows.withColumn(name, F.when(h % divisor == 3, broken).otherwise(F.col(name)))
    return rows


def attempts(spark: SparkSession, sf_dir: str, columns=()) -> DataFrame:
    """what each publish attempt of an event came to."""
    h = F.col("h")
    fails = F.when(h % 97 == 0, 0).when(h % 11 == 0, h % 3 + 1).otherwise(0)
    rows = outbox(spark, sf_dir).withColumn("h", hash16(F.col("id"))).withColumn("fails", fails)
    k = F.col("k")
    return rows.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("fails").cast("int") + 1))).select(
        "source", "id", "aggregate_type", "aggregate_id", "commit_lsn", "row_seq", "committed_at", *columns, "h",
        F.col("k").alias("attempt"),
        F.when(h % 97 == 0, "permanent").when(k <= F.col("fails"), "retryable").otherwise("ok").alias("outcome"),
        plus_ms(F.col("committed_at"), 12 + h % 50 + (k - 1) * 200).alias("sent_at"),
    )


def deliveries(spark: SparkSession, sf_dir: str, columns=()) -> DataFrame:
    """what consumers received, with copies 30 s and 10 min later, and some events lost."""
    h = F.col("h")
    ok = attempts(spark, sf_dir, columns).where((F.col("outcome") == "ok") & (h % 101 != 7))
    delays = F.when((h % 53 == 0) & (h % 2 == 0), F.array(F.lit(0), F.lit(30_000), F.lit(600_000))).when(
        h % 53 == 0, F.array(F.lit(0), F.lit(30_000))
    ).otherwise(F.array(F.lit(0)))
    return ok.withColumn("delay", F.explode(delays)).select(
        "source", "id", "aggregate_type", "aggregate_id", "commit_lsn", "row_seq", "committed_at", *columns, "h",
        plus_ms(F.col("sent_at"), F.col("delay").cast("bigint")).alias("sent_at"),
    )


def dead_letter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permanent failures of F5 as they are handed to the store; some are handed over twice."""
    h = F.col("h")
    failed = attempts(spark, sf_dir, ("event_type", "occurred_at", "headers", "payload")).where(F.col("outcome") == "permanent")
    return failed.select(
        F.concat(F.lit("outbox_"), "source").alias("slot"), "source", "id",
        text.envelope().alias("envelope"),
        F.concat(F.lit("InvalidMessageContents: "), F.lit("rejected "), (h % 7).cast("string")).alias("reason"),
        F.col("sent_at").alias("failed_at"), "h",
    ).withColumn("copy", F.explode(F.when(h % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).select(
        "slot", "source", "id", "envelope", "reason", "h",
        plus_ms(F.col("failed_at"), F.col("copy").cast("bigint") * 5_000).alias("failed_at"),
    )


def ack_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tracked events, reported progress and confirmations. ``seq`` orders the steps of a source."""
    rows = outbox(spark, sf_dir).select("source", "id", "commit_lsn", "committed_at")
    commits = rows.groupBy("source", "commit_lsn").agg(F.max("committed_at").alias("committed_at"))
    last = (
        attempts(spark, sf_dir).where(F.col("outcome") != "retryable").where(F.col("h") % 2003 != 7)
    )

    def log(df, action, at, phase):
        seq = F.unix_micros(at) * 4 + phase
        return df.select("source", seq.alias("seq"), F.lit(action).alias("action"), F.col("commit_lsn").alias("lsn"))

    idle = commits.where((F.col("commit_lsn") / LSN_STEP) % 7 == 0).select(
        "source", (F.col("commit_lsn") + 1024).alias("commit_lsn"), plus_ms(F.col("committed_at"), F.lit(1000)).alias("at")
    )
    return (
        log(rows, "track", F.col("committed_at"), 0)
        .unionByName(log(commits, "progress", F.col("committed_at"), 1))
        .unionByName(log(idle, "progress", F.col("at"), 1))
        .unionByName(log(last, "confirm", F.col("sent_at"), 2))
    )


def _message_field(value: Column) -> Column:
    size = F.unhex(F.lpad(F.hex(F.octet_length(value)), 8, "0"))
    return F.concat(F.encode(F.lit("t"), "UTF-8"), size, F.encode(value, "UTF-8"))


RELATION_OID = 16_385
LAYOUTS = (
    ("id", "aggregate_type", "aggregate_id", "event_type", "payload", "headers", "created_at"),
    ("trace", "payload", "headers", "created_at", "event_type", "aggregate_id", "aggregate_type", "id"),
)
"""Column orders of the outbox table before and after a column was added."""


def relation_message(columns) -> bytes:
    parts = [b"R", RELATION_OID.to_bytes(4, "big"), b"public\0outbox\0d", len(columns).to_bytes(2, "big")]
    for name in columns:
        parts += [b"\0", name.encode(), b"\0", (25).to_bytes(4, "big"), b"\xff\xff\xff\xff"]
    return b"".join(parts)


def insert_message(columns) -> Column:
    head = b"I" + RELATION_OID.to_bytes(4, "big") + b"N" + len(columns).to_bytes(2, "big")
    null = F.lit(b"n")
    fields = [null if name == "trace" else _message_field(F.col(name)) for name in columns]
    return F.concat(F.lit(head), *fields)


def wal_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the log that would have carried F1.

    Per transaction ending at L: begin L-4000, relation L-3990, keepalive L-3950, inserts from L-3900, commit
    L-100, keepalive L+50. The table layout changes every 50 blocks of 16 events; tenant_3 lacks its first
    relation message; every 13th block loses its commit; a few inserts are cut short or hold an unread kind.
    """
    events = outbox(spark, sf_dir).withColumn("tx", F.floor(F.col("row_seq") / 16))
    events = events.withColumn("period", F.floor(F.col("tx") / 50)).withColumn(
        "created_at", text.database_time_text(F.col("created_at"))
    )
    txs = events.groupBy("source", "commit_lsn", "tx", "period").agg(F.max("committed_at").alias("committed_at"))
    none = F.lit(None)
    lsn = F.col("commit_lsn")
    schema = ("bigint", "string", "bigint", "binary", "bigint", "bigint")
    names = ("wal_pos", "kind", "relation_oid", "data", "end_lsn", "commit_micros")

    def rows(df, *values):
        cells = (F.lit(v) if not isinstance(v, Column) else v for v in values)
        return df.select("source", *(v.cast(t).alias(n) for v, t, n in zip(cells, schema, names)))

    first = txs.groupBy("source", "period").agg(F.min("commit_lsn").alias("commit_lsn"))
    first = first.where(~((F.col("source") == "tenant_3") & (F.col("period") == 0)))
    layout = F.when(F.col("period") % 2 == 0, F.lit(relation_message(LAYOUTS[0]))).otherwise(
        F.lit(relation_message(LAYOUTS[1]))
    )
    h = hash16(F.col("id"))
    message = F.when(F.col("period") % 2 == 0, insert_message(LAYOUTS[0])).otherwise(insert_message(LAYOUTS[1]))
    whole = F.col("message")
    faulty = (
        F.when(h % 211 == 5, F.expr("substring(message, 1, length(message) - 3)"))
        .when(h % 223 == 5, F.concat(F.expr("substring(message, 1, 8)"), F.lit(b"u"), F.expr("substring(message, 10, length(message))")))
        .otherwise(whole)
    )
    committed_us = F.unix_micros("committed_at") - text.DATABASE_EPOCH_MICROS
    return (
        rows(txs, lsn - 4000, "B", none, none, none, none)
        .unionByName(rows(first, lsn - 3990, "R", RELATION_OID, layout, none, none))
        .unionByName(rows(txs.where(F.col("tx") % 7 == 0), lsn - 3950, "K", none, none, lsn - 3950, none))
        .unionByName(
            rows(
                events.withColumn("message", message),
                lsn - 3900 + F.col("row_seq") % 16 * 100, "I", RELATION_OID, faulty, none, none,
            )
        )
        .unionByName(rows(txs.where(F.col("tx") % 13 != 0), lsn - 100, "C", none, none, lsn, committed_us))
        .unionByName(rows(txs.where(F.col("tx") % 3 == 0), lsn + 50, "K", none, none, lsn + 50, none))
    )


MINUTE_US = 60_000_000
DAY_MINUTES = 1_440


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one sample a minute. Counters start over each day; two replicas report gauges with fixed gaps."""
    h = F.col("h")
    stuck = (h % 97 != 0) & (h % 11 == 0) & (h % 3 == 2)  # fails three times; here it is never published
    tried = attempts(spark, sf_dir).where(~(stuck & (F.col("outcome") == "ok")))
    minute = F.floor(F.unix_micros("sent_at") / MINUTE_US) + F.when(stuck, (F.col("attempt") - 1) * 2).otherwise(0)
    done = tried.withColumn("minute", minute).groupBy("source", "minute").agg(
        *(F.count_if(F.col("outcome") == k).alias(k) for k in ("ok", "retryable", "permanent"))
    )
    days = done.select("source", F.floor(F.col("minute") / DAY_MINUTES).alias("day")).distinct()
    grid = days.select(
        "source", "day", F.explode(F.sequence(F.col("day") * DAY_MINUTES, F.col("day") * DAY_MINUTES + DAY_MINUTES - 1)).alias("minute")
    )
    today = Window.partitionBy("source", "day").orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    counters = grid.join(done, ["source", "minute"], "left").select(
        "source", "minute",
        *(F.sum(F.coalesce(k, F.lit(0))).over(today).cast("double").alias(k) for k in ("ok", "retryable", "permanent")),
    )
    at = (F.col("minute") * MINUTE_US).alias("at_us")
    counter_rows = [
        ("events_published_total", "", "ok"),
        ("publish_errors_total", "retryable", "retryable"),
        ("publish_errors_total", "permanent", "permanent"),
        ("dead_letters_total", "", "permanent"),
    ]
    lines = F.array(
        *(F.struct(F.lit(m).alias("metric"), F.lit(k).alias("kind"), F.col(c).alias("value")) for m, k, c in counter_rows)
    )
    counted = counters.select(at, F.lit("r0").alias("replica"), "source", F.inline(lines))

    hour, past = F.floor(F.col("minute") / 60) % 24, F.col("minute") % 60
    gap = ((hour == 1) & (past < 4)) | ((hour == 3) & (past < 6)) | ((hour == 5) & (past < 12))
    replicas = grid.withColumn("replica", F.explode(F.array(F.lit("r0"), F.lit("r1"))))
    tenant = F.substring("source", 8, 10).cast("int")
    streams = F.when(gap, 0.0).when(F.col("replica") == F.concat(F.lit("r"), (tenant % 2).cast("string")), 1.0).otherwise(0.0)
    lag = F.when(gap & (hour >= 3), F.lit(600.0 * 1_048_576)).otherwise((F.col("minute") % 97 * 1_048_576).cast("double"))
    gauges = F.array(
        F.struct(F.lit("source_up").alias("metric"), F.lit("").alias("kind"), streams.alias("value")),
        F.struct(F.lit("slot_lag_bytes").alias("metric"), F.lit("").alias("kind"), lag.alias("value")),
    )
    gauged = replicas.select(at, "replica", "source", F.inline(gauges))
    up = grid.select("minute").distinct().withColumn("replica", F.explode(F.array(F.lit("r0"), F.lit("r1")))).select(
        at, "replica", F.lit("").alias("source"), F.lit("up").alias("metric"), F.lit("").alias("kind"),
        F.when(gap & (F.col("replica") == "r1"), 0.0).otherwise(1.0).alias("value"),
    )
    return counted.unionByName(gauged).unionByName(up)


ANSWER_CODES = (
    "InvalidParameterValue", "Queue.InvalidMessageContents", "InvalidAttributeValue", "MessageTooLong", "InvalidParameter",
    "ServiceUnavailable", "OverLimit",
)
"""Error codes of F8, one for each remainder of an id's hash; the queries' SQL takes them from here too."""


def responses(spark: SparkSession, sf_dir: str, requests: DataFrame) -> DataFrame:
    """F8: what the broker answered to each request ``(call, index, id)``."""
    h = F.col("h")
    code = F.element_at(F.array(*(F.lit(c) for c in ANSWER_CODES)), (h % len(ANSWER_CODES) + 1).cast("int"))
    hashed = requests.withColumn("h", hash16(F.col("id")))
    answered = hashed.where(h % 29 != 0)
    bad = h % 13 == 0
    answers = answered.select(
        "call", F.col("index").cast("string").alias("index"), (~bad).alias("ok"),
        (bad & (h % 2 == 0)).alias("sender_fault"),
        F.when(bad, code).otherwise("").alias("code"),
        F.when(bad, F.concat(F.lit("entry "), F.col("index").cast("string"))).otherwise("").alias("message"),
    )
    strays = answered.where(h % 31 == 0).select(
        "call", F.when(h % 2 == 0, "x1").otherwise("99").alias("index"), F.lit(True).alias("ok"),
        F.lit(False).alias("sender_fault"), F.lit("").alias("code"), F.lit("").alias("message"),
    )
    return answers.unionByName(strays)


def tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a registry per nation, with a database per customer and the mistakes such lists hold."""
    c = F.col("c_custkey")
    name = F.lower(F.replace("c_name", F.lit("#"), F.lit("_")))
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("bigint").alias("group_id"),
        F.when(c % 19 == 0, F.concat(F.lit(" "), name))
        .when(c % 23 == 0, F.lit("  "))
        .when(c % 29 == 0, F.replace(name, F.lit("_"), F.lit("-")))
        .when(c % 31 == 0, F.lit("customer_shared"))
        .otherwise(name).alias("database"),
        F.when(c % 37 == 0, "postgres://courier@pg7.test/ledger")
        .when(c % 41 == 0, "postgres://courier@{database}.pg.test/ledger")
        .otherwise("postgres://courier:s3@pg7.test:6432/{database}?application_name=mail").alias("dsn_template"),
        F.when(c % 43 == 0, "outbox_slot").otherwise("outbox_{database}").alias("slot_template"),
        F.when(c % 47 == 0, "outbox_pub_{database}").otherwise("outbox_pub").alias("publication"),
    )


def slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one look a day at each source's slot."""
    rows = outbox(spark, sf_dir).withColumn("day", F.floor(F.unix_micros("committed_at") / (DAY_MINUTES * MINUTE_US)))
    settled = hash16(F.col("id")) % 101 != 7
    daily = rows.groupBy("source", "day").agg(
        F.max(F.when(settled, F.col("commit_lsn"))).alias("confirmed"), F.max("commit_lsn").alias("written")
    )
    return daily.where(F.col("confirmed").isNotNull()).select(
        F.concat(F.lit("outbox_"), "source").alias("slot"), "source",
        text.lsn_text(F.col("confirmed")).alias("confirmed_lsn"),
        text.lsn_text(F.col("written") + 8192 + F.col("day") % 11 * 512).alias("current_lsn"),
        (F.col("day") % 5 != 0).alias("active"),
    )
