"""The streaming queries: the outbox arrives in slices, each a run of the job from its checkpoint."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from commitpost.functions import text
from commitpost.operators import alerts
from commitpost.plans.stage import new_path, stage
from commitpost.sources.schema import EVENT_COLUMNS
from commitpost.streaming.answers import ANSWER_SCHEMA, REQUEST_SCHEMA, outcome_stream
from commitpost.streaming.paged import PagedOutbox
from commitpost.streaming.relay import Relay, exact_dedup_stream, rate_stream, read_events
from commitpost.streaming.tail import LOG_SCHEMA, LogTail
from commitpost.streaming.watch import held_stream

from . import tables as t, tables_sql as q
from .queries import BATCHES_SQL, CODES_SQL, ORACLE, PERMANENT_SQL, planned, query

SLICES = 3


def broker(entries: list[dict]) -> list[tuple]:
    """Answers by the rule of F5: some ids fail up to three times, some for good."""
    answers = []
    for entry in entries:
        index, event_id, attempt = entry["index"], entry["id"], entry["attempt"]
        h = int(hashlib.md5(event_id.encode()).hexdigest()[:4], 16)
        fails = h % 3 + 1 if h % 11 == 0 and h % 97 else 0
        if h % 97 == 0:
            answers.append((index, False, True, "InvalidMessageContents", f"rejected {h % 7}"))
        elif attempt <= fails:
            answers.append((index, False, False, "InternalError", "busy"))
        else:
            answers.append((index, True, False, "", ""))
    return answers


def stubborn(entries: list[dict]) -> list[tuple]:
    """Some ids fail for ever, but for those of tenant_0."""
    hashes = [int(hashlib.md5(e["id"].encode()).hexdigest()[:4], 16) for e in entries]
    return [(e["index"], e["source"] == "tenant_0" or h % 41 != 5, False, "Busy", "") for e, h in zip(entries, hashes)]


def slices(events: DataFrame, count: int = SLICES) -> list[DataFrame]:
    """Events cut into stretches of the log; a transaction is in one of them."""
    low, high = events.agg(F.min("commit_lsn"), F.max("commit_lsn")).first()
    width = (high - low) // count + 1
    bounds = [low + i * width for i in range(count + 1)]
    return [
        events.where((F.col("commit_lsn") >= start) & (F.col("commit_lsn") < end))
        for start, end in zip(bounds, bounds[1:])
    ]


def arrive(part: DataFrame, path: str) -> None:
    part.write.mode("append").parquet(path)


_relays: dict[tuple, Relay] = {}


def once(run):
    """Queries that look at different tables of one job share its run in a session."""

    def shared(spark: SparkSession, sf_dir: str, **settings) -> Relay:
        key = (run.__name__, spark.sparkContext.applicationId, sf_dir, *sorted(settings.items()))
        if key not in _relays:
            _relays[key] = run(spark, sf_dir, **settings)
        return _relays[key]

    return shared


@once
def relayed(spark: SparkSession, sf_dir: str, **settings) -> Relay:
    """The relay after every slice has arrived."""
    relay = Relay(spark, new_path(spark, "relay"), broker, **settings)
    inbox, checkpoint = new_path(spark, "inbox"), new_path(spark, "offsets")
    for part in slices(stage(t.outbox(spark, sf_dir), "events")):
        arrive(part, inbox)
        relay.start(read_events(spark, inbox), checkpoint).awaitTermination()
    return relay


@once
def settled(spark: SparkSession, sf_dir: str, **settings) -> Relay:
    """The relay after everything it left pending has been sent again."""
    relay = relayed(spark, sf_dir, **settings)
    while relay.retry_pending():
        pass
    return relay


@query(q.with_(q.OUTBOX) + "select source, id, commit_lsn, row_seq, payload, occurred_at from outbox")
def stream_tail(spark, sf_dir):
    inbox, out = new_path(spark, "inbox"), new_path(spark, "tail")
    checkpoint = new_path(spark, "offsets")
    for part in slices(stage(t.outbox(spark, sf_dir), "events")):
        arrive(part, inbox)
        events = read_events(spark, inbox)
        writer = events.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("source", "id", "commit_lsn", "row_seq", "payload", "occurred_at")


@once
def tailed(spark: SparkSession, sf_dir: str) -> LogTail:
    """The decoder after the log has arrived in stretches cut where it hurts: between the inserts of a transaction, and
    between a relation message and the first insert that needs it."""
    log = stage(t.wal_log(spark, sf_dir), "log")
    ends = log.where("kind = 'R'").select(F.explode(F.array(F.col("wal_pos") + 40, F.col("wal_pos") + 390)).alias("cut"))
    cuts = ends.agg(F.percentile("cut", [0.2, 0.4, 0.6, 0.8]).alias("c")).first()["c"]  # between messages or at one
    cuts = [int(c) for c in cuts]
    tail = LogTail(spark, new_path(spark, "tail"))
    inbox, checkpoint = new_path(spark, "log"), new_path(spark, "offsets")
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = log.where(F.lit(True) if low is None else F.col("wal_pos") >= low)
        arrive(part.where(F.lit(True) if high is None else F.col("wal_pos") < high), inbox)
        tail.start(spark.readStream.schema(LOG_SCHEMA).parquet(inbox), checkpoint).awaitTermination()
    return tail


@query(ORACLE["wal_decode"])
def stream_wal(spark, sf_dir):
    """The events of ``wal_decode``, out of a log that arrives piece by piece."""
    events = tailed(spark, sf_dir).table("events").where("progress is null")
    micros = [F.unix_micros(c).alias(f"{c.removesuffix('_at')}_us") for c in ("created_at", "committed_at")]
    return events.select(*[c for c in EVENT_COLUMNS if c not in ("created_at", "committed_at")], *micros)


@query(ORACLE["wal_rejects"])
def stream_wal_rejects(spark, sf_dir):
    return tailed(spark, sf_dir).table("rejects").select("source", "wal_pos", "error")


@query(ORACLE["progress_marks"].replace("wal_pos, end_lsn lsn", "end_lsn lsn"))
def stream_wal_marks(spark, sf_dir):
    """The marks of ``progress_marks``, as the relay reads them."""
    return tailed(spark, sf_dir).table("events").where("progress").select("source", F.col("commit_lsn").alias("lsn"))


@query(
    q.with_(q.ATTEMPTS)
    + """select source, id, attempt, commit_lsn, concat_ws(':', source, id) dedup_id from attempts where outcome = 'ok'"""
)
def stream_relay(spark, sf_dir):
    """With three retries in place nothing stays pending."""
    relay = relayed(spark, sf_dir, retries=3)
    return relay.table("deliveries").select("source", "id", "attempt", "commit_lsn", "dedup_id")


@query(q.with_(q.ATTEMPTS) + "select source, id, attempt, outcome from attempts")
def stream_retry(spark, sf_dir):
    """Without retries in place, failed events and what they hold back go through the pending table."""
    relay = settled(spark, sf_dir, retries=2, sink="second")
    return relay.table("outcomes").select("source", "id", "attempt", "outcome")


@query(
    q.with_(q.DEAD)
    + "select distinct slot, id, envelope, concat('InvalidMessageContents: rejected ', cast(h % 7 as varchar)) reason from dead_rows"
)
def stream_dead_letters(spark, sf_dir):
    relay = relayed(spark, sf_dir, retries=3)
    return relay.table("dead_letters").select("slot", "id", "envelope", "reason")


@query(q.with_(q.OUTBOX) + "select source, max(commit_lsn) - 1 acked from outbox group by source")
def stream_ack(spark, sf_dir):
    """Without marks a source is complete below its highest position only."""
    relay = settled(spark, sf_dir, retries=2, sink="second")
    return relay.at_step("acks", relay.last_step()).select("source", "acked")


@query(
    q.with_(q.OUTBOX)
    + """, hashed as (select source, commit_lsn, ('0x' || substr(md5(id), 1, 4))::int h from outbox),
ends as (select source, max(commit_lsn) + 7 seen, min(case when h % 41 = 5 and source <> 'tenant_0' then commit_lsn end) stuck
    from hashed group by source)
select source, least(seen, stuck - 1) acked from ends"""
)
def stream_ack_open(spark, sf_dir):
    """Some events never go through, a transaction is split over two files, and marks run ahead of the events."""
    relay = Relay(spark, new_path(spark, "relay"), stubborn)
    inbox, checkpoint = new_path(spark, "inbox"), new_path(spark, "offsets")
    events = stage(t.outbox(spark, sf_dir), "events").withColumn("progress", F.lit(None).cast("boolean"))
    sizes = events.groupBy("commit_lsn").agg(F.count(F.lit(1)).alias("n"), F.min("row_seq").alias("row_seq"))
    cut = sizes.where("n > 1").agg(F.max(F.struct("commit_lsn", "row_seq"))).first()[0]
    first = (F.col("commit_lsn") < cut["commit_lsn"]) | (F.col("commit_lsn") == cut["commit_lsn"]) & (F.col("row_seq") == cut["row_seq"])
    for part in (events.where(first), events.where(~first)):
        arrive(part, inbox)
        relay.start(read_events(spark, inbox), checkpoint).awaitTermination()
    ends = events.groupBy("source").agg((F.max("commit_lsn") + 7).alias("commit_lsn")).withColumn("progress", F.lit(True))
    arrive(ends, inbox)
    relay.start(read_events(spark, inbox), checkpoint).awaitTermination()
    return relay.at_step("acks", relay.last_step()).select("source", "acked")


@query(
    q.with_(q.OUTBOX)
    + """, broken as (select *, ('0x' || substr(md5(id), 5, 4))::int % 5 k from outbox where ('0x' || substr(md5(id), 1, 4))::int % 37 = 3)
select case when k <> 1 then source end source, case when k <> 0 then id end id, case when k <> 3 then commit_lsn end commit_lsn,
    row_seq, case k when 0 then 'id: missing' when 1 then 'source: missing' when 2 then 'payload: not JSON'
        when 3 then 'commit_lsn: missing' else 'headers: missing' end problem
from broken"""
)
def stream_rejects(spark, sf_dir):
    """Every row that is no event, each by itself, however many of them look alike."""
    events = stage(t.outbox(spark, sf_dir), "events")
    h = F.conv(F.substring(F.md5("id"), 1, 4), 16, 10).cast("int")
    broken = events.where(h % 37 == 3).withColumn("k", F.conv(F.substring(F.md5("id"), 5, 4), 16, 10).cast("int") % 5)
    null = lambda k, c: F.when(F.col("k") != k, F.col(c))
    broken = broken.withColumns({
        "payload": F.when(F.col("k") == 2, F.lit("{")).otherwise(F.col("payload")), "headers": null(4, "headers"),
        "source": null(1, "source"), "id": null(0, "id"), "commit_lsn": null(3, "commit_lsn"),
    }).drop("k")
    relay = Relay(spark, new_path(spark, "relay"), broker, retries=3)
    inbox = new_path(spark, "inbox")
    arrive(events.where(h % 37 != 3).unionByName(broken), inbox)
    relay.start(read_events(spark, inbox), new_path(spark, "offsets")).awaitTermination()
    return relay.table("rejects").select("source", "id", "commit_lsn", "row_seq", "problem")


class Crash(Exception):
    pass


@query(
    q.with_(
        q.ATTEMPTS,
        f"bounds as (select min(commit_lsn) lo, (max(commit_lsn) - min(commit_lsn)) // {SLICES} + 1 width from outbox)",
    )
    + """select source, id, case when (commit_lsn - lo) // width = 1 then 2 else 1 end copies
from attempts, bounds where outcome = 'ok'"""
)
def stream_crash_replay(spark, sf_dir):
    """The job dies after delivering its second slice and before acknowledging it; the restart sends it again."""

    class Dying(Relay):
        armed = True

        def acknowledge(self, taken, waiting, previous, step):
            if step > (0, 0) and Dying.armed:
                Dying.armed = False
                raise Crash
            super().acknowledge(taken, waiting, previous, step)

    relay = Dying(spark, new_path(spark, "relay"), broker, retries=3)
    inbox, checkpoint = new_path(spark, "inbox"), new_path(spark, "offsets")
    for part in slices(stage(t.outbox(spark, sf_dir), "events")):
        arrive(part, inbox)
        for _ in range(2):
            try:
                relay.start(read_events(spark, inbox), checkpoint).awaitTermination()
                break
            except Exception as error:
                if "Crash" not in str(error):
                    raise
    return relay.table("deliveries").groupBy("source", "id").agg(F.count(F.lit(1)).cast("int").alias("copies"))


@query(q.with_(q.OUTBOX) + "select 'first' run, count(*) events from outbox union all select 'second', 0")
def stream_drain(spark, sf_dir):
    """A run to the end leaves nothing to the next one."""
    inbox, checkpoint, out = new_path(spark, "inbox"), new_path(spark, "offsets"), new_path(spark, "drained")
    arrive(t.outbox(spark, sf_dir), inbox)
    runs = []
    for run in ("first", "second"):
        path = f"{out}/run={run}"
        spark.createDataFrame([], "source string, id string").write.parquet(path)

        def keep(rows, _, path=path):
            rows.select("source", "id").write.mode("append").parquet(path)

        stream = read_events(spark, inbox).writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
        stream.trigger(availableNow=True).start().awaitTermination()
        drained = spark.read.schema("source string, id string").parquet(path)
        runs.append(drained.agg(F.lit(run).alias("run"), F.count(F.lit(1)).alias("events")))
    return runs[0].unionByName(runs[1])


def down_for_one(entries: list[dict]) -> list[tuple]:
    """The broker of F5, which tenant_2 cannot reach."""
    if entries[0]["source"] == "tenant_2":
        raise ConnectionError("tenant_2 has no broker")
    return broker(entries)


@once
def isolated(spark: SparkSession, sf_dir: str) -> Relay:
    """One job for all tenants; the sender raises for one of them."""
    relay = Relay(spark, new_path(spark, "relay"), down_for_one, retries=3)
    inbox = new_path(spark, "inbox")
    arrive(t.outbox(spark, sf_dir), inbox)
    relay.start(read_events(spark, inbox), new_path(spark, "offsets")).awaitTermination()
    return relay


@query(
    q.with_(q.ATTEMPTS)
    + "select source, id, attempt from attempts where outcome = 'ok' and source <> 'tenant_2'"
)
def stream_tenants(spark, sf_dir):
    """A failing tenant holds back no other."""
    return isolated(spark, sf_dir).table("deliveries").select("source", "id", "attempt")


@query(q.with_(q.OUTBOX) + "select source, id, commit_lsn from outbox where source = 'tenant_2'")
def stream_tenants_pending(spark, sf_dir):
    """All of the failing tenant's events wait, and nothing else does."""
    relay = isolated(spark, sf_dir)
    return relay.at_step("pending", relay.last_step()).select("source", "id", "commit_lsn")


PAGE = 400
PAGES_TOGETHER = 1_024


@query(
    q.with_(q.OUTBOX)
    + f"""select page, source, count(*) events, min(commit_lsn) first_lsn, max(commit_lsn) last_lsn, count(distinct id) ids
from (select *, cast((row_number() over (partition by source order by commit_lsn, row_seq) - 1) // {PAGE} as int) page from outbox) group by all"""
)
def stream_flush(spark, sf_dir):
    """Pages of at most so many events of each source, read by position; the job dies in its second page, whose restart
    reads the same events."""
    in_order = t.outbox(spark, sf_dir).repartitionByRange("commit_lsn", "row_seq").sortWithinPartitions("commit_lsn", "row_seq")
    events = stage(in_order, "events")
    store, out = new_path(spark, "positions"), new_path(spark, "pages")
    died: list[int] = []

    def keep(rows: DataFrame, page: int) -> None:
        rows.select("source", "id", "commit_lsn", "page").write.mode("overwrite").parquet(f"{out}/first={page}")
        if page == 1 and not died:
            died.append(page)
            raise Crash

    try:
        PagedOutbox(spark, events, store, PAGE, together=PAGES_TOGETHER).run(keep)
    except Crash:
        PagedOutbox(spark, events, store, PAGE, together=PAGES_TOGETHER).run(keep)
    pages = spark.read.parquet(out)
    return pages.groupBy("page", "source").agg(
        F.count(F.lit(1)).alias("events"), F.min("commit_lsn").alias("first_lsn"), F.max("commit_lsn").alias("last_lsn"),
        F.count_distinct("id").alias("ids"),
    )


@query(ORACLE["fifo_dedup"])
def stream_dedup(spark, sf_dir):
    """What ``fifo_dedup`` accepts, send by send: copies 30 s later are dropped, those 10 min later are not. The log
    arrives in slices of its time, and some copies in a later slice than their first send."""
    sends = stage(t.deliveries(spark, sf_dir), "sends").select(text.dedup_key().alias("dedup_id"), "sent_at")
    low, high = sends.agg(F.min(F.unix_millis("sent_at")), F.max(F.unix_millis("sent_at"))).first()
    width = (high - low) // SLICES + 1
    inbox, out, checkpoint = new_path(spark, "inbox"), new_path(spark, "dedup"), new_path(spark, "offsets")
    for i in range(SLICES):
        arrive(sends.where(F.floor((F.unix_millis("sent_at") - low) / width) == i), inbox)
        stream = spark.readStream.schema("dedup_id string, sent_at timestamp").parquet(inbox)
        writer = exact_dedup_stream(stream).writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


@query(ORACLE["rate_per_minute"])
def stream_rate(spark, sf_dir):
    """Counts of ``rate_per_minute`` as a stream; one send a day after the last closes every minute before it."""
    sends = stage(t.deliveries(spark, sf_dir), "sends").select("source", "sent_at")
    inbox, out, checkpoint = new_path(spark, "inbox"), new_path(spark, "rates"), new_path(spark, "offsets")
    closing = sends.agg(F.timestamp_micros(F.unix_micros(F.max("sent_at")) + 86_400_000_000).alias("sent_at"))
    for part in (sends, closing.select(F.lit("end").alias("source"), "sent_at")):
        arrive(part, inbox)
        stream = spark.readStream.schema("source string, sent_at timestamp").parquet(inbox)
        writer = rate_stream(stream).writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    rates = spark.read.parquet(out)
    minute = F.floor(F.unix_micros("minute") / 60_000_000).alias("minute")
    return rates.where("source <> 'end'").select("source", minute, "deliveries")


@query(
    q.with_(
        q.OUTBOX, BATCHES_SQL,
        f"""named as (select *, concat_ws('-', source, lane, "round", batch) c, {q.HASH} h from plan),
judged as (select c, "position" idx, source, id, h, h % 29 = 0 or cast(concat('0x', substr(md5(c), 1, 4)) as bigint) % 23 = 0 silent,
  h % 13 = 0 bad, h % 2 = 0 fault, {CODES_SQL}[h % 7 + 1] code from named)""",
    )
    + f"""select c as "call", idx as "index", source, id,
  case when silent then 'retryable' when not bad then 'ok' when fault and {PERMANENT_SQL} then 'permanent' else 'retryable' end outcome,
  case when silent then 'missing from the broker response' when not bad then '' else concat(code, ': entry ', idx) end reason from judged"""
)
def stream_outcomes(spark, sf_dir):
    """Calls go out and answers come back as two logs, cut at the same times; an answer may be in a later stretch than its
    request. Some are never answered, some calls only 45 s later, after the deadline of 30 s."""
    place = F.floor((F.max("commit_lsn") - t.LSN_BASE) / t.LSN_STEP)
    call = F.concat_ws("-", "source", "lane", "round", "batch").alias("call")
    plan = stage(planned(spark, sf_dir).select(call, F.col("position").alias("index"), "source", "id", "commit_lsn"), "plan")
    times = plan.groupBy("call").agg(F.timestamp_seconds(place).alias("sent_at"))
    requests = stage(plan.drop("commit_lsn").join(times, "call"), "requests")
    delay = F.when(t.hash16(F.col("call")) % 23 == 0, 45_000).otherwise(80 + t.hash16(F.col("call")) % 900)
    answers = t.responses(spark, sf_dir, requests).join(times, "call")
    answers = stage(answers.withColumn("answered_at", t.plus_ms(F.col("sent_at"), delay)).drop("sent_at"), "answers")
    low, high = times.agg(F.min(F.unix_seconds("sent_at")), F.max(F.unix_seconds("sent_at"))).first()
    width = (high - low) // SLICES + 1
    sent_box, answer_box = new_path(spark, "requests"), new_path(spark, "answers")
    out, checkpoint = new_path(spark, "outcomes"), new_path(spark, "offsets")
    day_later = F.timestamp_seconds(F.lit(high + 86_400))
    end = spark.range(1).select(
        F.lit("end").alias("call"), F.lit(0).alias("index"), day_later.alias("sent_at"), day_later.alias("answered_at")
    )  # moves time on: an answer without an index would be left out before its time counts
    for i in range(SLICES + 1):
        for rows, at, box, schema in ((requests, "sent_at", sent_box, REQUEST_SCHEMA), (answers, "answered_at", answer_box, ANSWER_SCHEMA)):
            part = F.least(F.floor((F.unix_seconds(at) - low) / width), F.lit(SLICES - 1))
            fresh = rows.where(part == i) if i < SLICES else rows.limit(0).unionByName(end.select("call", "index", at), allowMissingColumns=True)
            arrive(fresh.select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", "))), box)
        streams = [spark.readStream.schema(s).parquet(b) for b, s in ((sent_box, REQUEST_SCHEMA), (answer_box, ANSWER_SCHEMA))]
        writer = outcome_stream(*streams).writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    settled = spark.read.parquet(out).where("call <> 'end'")
    return settled.select("call", "index", "source", "id", "outcome", F.coalesce("reason", F.lit("")).alias("reason"))


METRIC_TOTALS = (
    ("events_published_total", "", "outcome = 'ok'"), ("publish_errors_total", "retryable", "outcome = 'retryable'"),
    ("publish_errors_total", "permanent", "outcome = 'permanent'"), ("dead_letters_total", "", "outcome = 'permanent'"),
)


@query(
    q.with_(q.ATTEMPTS)
    + " union all ".join(
        f"select '{sink}' sink, source, '{m}' metric, '{k}' kind, count(*) filter ({c})::double as \"value\" from attempts group by source"
        for sink in ("queue", "second") for m, k, c in METRIC_TOTALS
    )
)
def stream_metrics(spark, sf_dir):
    """The last samples of two relays, one that retries in place and one that goes through the pending table, with as
    many outcomes: the counters are carried over all their steps."""
    relays = [relayed(spark, sf_dir, retries=3), settled(spark, sf_dir, retries=2, sink="second")]
    rows = [r.at_step("metric_samples", r.last_step()) for r in relays]
    totals = rows[0].unionByName(rows[1]).where(F.col("metric").isin([m for m, _, _ in METRIC_TOTALS]))
    return totals.select("sink", "source", "metric", "kind", "value")


@query(
    q.with_(
        q.ATTEMPTS,
        f"bounds as (select min(commit_lsn) lo, (max(commit_lsn) - min(commit_lsn)) // {SLICES} + 1 width from outbox)",
    )
    + f"""select 'r0' replica, source, min(n) * 60000000 since_us, min(n) * 60000000 fired_us, {SLICES - 1}::bigint * 60000000 until_us
from (select source, (commit_lsn - lo) // width n from attempts, bounds where outcome = 'permanent') where n > 0 group by source"""
)
def stream_poison(spark, sf_dir):
    """``alert_poison`` over the samples a relay has written, one step a minute by its clock: from the first step in which a
    source's count of dead letters grew, to the last."""
    minutes = iter(range(1_000))
    relay = Relay(spark, new_path(spark, "relay"), broker, retries=3, clock=lambda: 60.0 * next(minutes))
    inbox, checkpoint = new_path(spark, "inbox"), new_path(spark, "offsets")
    for part in slices(stage(t.outbox(spark, sf_dir), "events")):
        arrive(part, inbox)
        relay.start(read_events(spark, inbox), checkpoint).awaitTermination()
    return alerts.poison_events(relay.table("metric_samples").drop("batch", "retry"))


@query(ORACLE["alert_firings"])
def stream_alerts(spark, sf_dir):
    """The stretches of ``alert_firings`` from samples that arrive in slices of their time; one sample a day after the last
    ends what is still open."""
    rows = alerts.gauge(t.metric_samples(spark, sf_dir), "source_up").select("replica", "source", "at_us", "value")
    rows = stage(rows, "gauge")
    low, high = rows.agg(F.min("at_us"), F.max("at_us")).first()
    width = (high - low) // SLICES + 1
    day_later = spark.range(1).select(
        F.lit("end").alias("replica"), F.lit("end").alias("source"), F.lit(high + 86_400_000_000).alias("at_us"), F.lit(1.0).alias("value")
    )
    inbox, out, checkpoint = new_path(spark, "samples"), new_path(spark, "alerts"), new_path(spark, "offsets")
    parts = [rows.where(F.floor((F.col("at_us") - low) / width) == i) for i in range(SLICES)]
    for part in (*parts, day_later):
        arrive(part, inbox)
        stream = spark.readStream.schema("replica string, source string, at_us bigint, value double").parquet(inbox)
        writer = held_stream(stream, ["replica", "source"], F.col("value") == 0, 3).writeStream.format("parquet")
        writer = writer.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        writer.start().awaitTermination()
    return spark.read.parquet(out).where("state = 'resolved'").drop("state")
