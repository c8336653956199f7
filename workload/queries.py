"""The registered queries, each with the same result as SQL over the given tables where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from commitpost.functions import outcome, text
from commitpost.operators import alerts, dedup, messages, outcomes, reconcile, reports
from commitpost.plans import ack, batches
from commitpost.plans.stage import new_path, stage
from commitpost.sources import changelog, outbox as outbox_source, schema, tenants as registry
from commitpost.sources.dated import DatedOutbox, day_of

from . import tables as t, tables_sql as q
from .ship import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run: Query) -> Query:
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[run.__name__] = in_utc
        if sql:
            ORACLE[run.__name__] = sql
        return run

    return register


def us(name: str):
    return F.unix_micros(name)


def wal(spark, sf_dir):
    return stage(t.wal_log(spark, sf_dir), "wal")


def samples(spark, sf_dir):
    return stage(t.metric_samples(spark, sf_dir), "samples")


# ---- sources ----------------------------------------------------------------


@query(
    q.with_(q.OUTBOX)
    + "select id, aggregate_type, aggregate_id, event_type, payload, headers, epoch_us(created_at) created_us from outbox"
)
def outbox_scan(spark, sf_dir):
    rows = outbox_source.outbox_scan(t.outbox(spark, sf_dir))
    return rows.withColumn("created_us", us("created_at")).drop("created_at")


@query(q.with_(q.OUTBOX) + "select source, id, commit_lsn, row_seq, payload from outbox")
def tenant_union(spark, sf_dir):
    path = new_path(spark, "tenants")
    t.outbox(spark, sf_dir).write.partitionBy("source").parquet(path)
    names = ["tenant_0", " tenant_1", "", "tenant_2 ", "tenant_3", "tenant_4"]
    stored = {
        name: spark.read.parquet(f"{path}/source={name.strip()}") if name.strip() else None for name in names
    }
    return outbox_source.tenant_union(stored).select("source", "id", "commit_lsn", "row_seq", "payload")


@query(
    q.with_(q.DELIVERIES) + "select source, id, epoch_us(created_at) created_us from outbox "
    "where (source, id) not in (select source, id from deliveries) order by created_at, id, source limit 10"
)
def poll_oldest(spark, sf_dir):
    oldest = outbox_source.poll_oldest(t.outbox(spark, sf_dir), t.deliveries(spark, sf_dir))
    return oldest.select("source", "id", us("created_at").alias("created_us"))


ACKS_SQL = "acks as (select source, max(commit_lsn) acked from outbox where event_type = 'user.signup' and tx % 3 = 1 and source <> 'tenant_2' group by source)"


@query(
    q.with_(q.OUTBOX, ACKS_SQL)
    + "select source, id, commit_lsn, row_seq from outbox left join acks using (source) where commit_lsn > coalesce(acked, 0)"
)
def resume_after(spark, sf_dir):
    events = t.outbox(spark, sf_dir)
    some = (F.col("event_type") == "user.signup") & (F.floor(F.col("row_seq") / 16) % 3 == 1) & (F.col("source") != "tenant_2")
    acks = events.where(some).groupBy("source").agg(F.max("commit_lsn").alias("acked"))
    return outbox_source.resume_after(events, acks).select("source", "id", "commit_lsn", "row_seq")


@query(
    q.with_(q.WAL)
    + """select w.source, w.wal_pos, e.commit_lsn, epoch_us(e.committed_at) committed_us
from wal_log w join wal_events e on w.source = e.source and w.id = e.id where w.kind = 'I' and e.tx % 13 <> 0"""
)
def txn_assembly(spark, sf_dir):
    rows = changelog.assemble(wal(spark, sf_dir))
    return rows.select("source", "wal_pos", "commit_lsn", us("committed_at").alias("committed_us"))


@query(
    q.with_(
        q.WAL,
        """runs as (select *, count(*) filter (kind = 'B') over w run from wal_log window w as (partition by source order by wal_pos)),
closed as (select source, run, min(wal_pos) filter (kind = 'C') closed_at from runs group by all)""",
    )
    + """select source, wal_pos, end_lsn lsn from runs join closed using (source, run)
where kind = 'C' or (kind = 'K' and (run = 0 or wal_pos > closed_at))"""
)
def progress_marks(spark, sf_dir):
    return changelog.progress_marks(wal(spark, sf_dir))


WAL_FAULT = f"""case
  when not exists (select 1 from wal_first f where f.source = e.source and f.commit_lsn <= e.commit_lsn) then 'relation not seen yet'
  when h % 211 = 5 then 'the message ends too early'
  when h % 223 = 5 then concat('value kind not read in ', case when period % 2 = 0 then 'id' else 'trace' end) end"""


@query(
    q.with_(q.WAL)
    + """select e.source, commit_lsn - 3900 + row_seq % 16 * 100 wal_pos,
  (select max(f.commit_lsn) - 3990 from wal_first f where f.source = e.source and f.commit_lsn <= e.commit_lsn) relation_pos
from wal_events e where exists (select 1 from wal_first f where f.source = e.source and f.commit_lsn <= e.commit_lsn)"""
)
def relation_asof(spark, sf_dir):
    found = changelog.relation_asof(wal(spark, sf_dir)).where(F.col("relation").isNotNull())
    return found.select("source", "wal_pos", F.col("relation.wal_pos").alias("relation_pos"))


@query(
    q.with_(q.WAL, f"judged as (select *, {WAL_FAULT} fault from wal_events e where tx % 13 <> 0)")
    + """select source, id, aggregate_type, aggregate_id, event_type, payload, headers, occurred_at, epoch_us(created_at) created_us,
  commit_lsn, commit_lsn - 3900 + row_seq % 16 * 100 row_seq, epoch_us(committed_at) committed_us from judged where fault is null"""
)
def wal_decode(spark, sf_dir):
    events, _ = changelog.decoded_events(wal(spark, sf_dir))
    return events.select(
        *[c for c in schema.EVENT_COLUMNS if c not in ("created_at", "committed_at")],
        us("created_at").alias("created_us"), us("committed_at").alias("committed_us"),
    )


@query(
    q.with_(q.WAL, f"judged as (select *, {WAL_FAULT} fault from wal_events e where tx % 13 <> 0)")
    + "select source, commit_lsn - 3900 + row_seq % 16 * 100 wal_pos, fault error from judged where fault is not null"
)
def wal_rejects(spark, sf_dir):
    return changelog.decoded_events(wal(spark, sf_dir))[1]


PROBLEM_SQL = """case when aggregate_id is null then 'aggregate_id: missing' when event_type is null then 'event_type: missing'
  when headers is null then 'headers: missing' when not json_valid(payload) then 'payload: not JSON' end"""


@query(q.with_(q.RAW) + f"select source, id, {PROBLEM_SQL} problem from raw_outbox where {PROBLEM_SQL} is not null")
def contract_violations(spark, sf_dir):
    return schema.contract_violations(t.raw_outbox(spark, sf_dir)).select("source", "id", "problem")


@query(
    q.with_(
        q.TENANTS,
        """listed as (select * replace (trim(database) as database) from tenants where trim(database) <> ''),
expanded as (select *, replace(dsn_template, '{database}', replace(replace(database, '_', '%5F'), '-', '%2D')) dsn,
  replace(slot_template, '{database}', database) slot from listed),
named as (select *, regexp_extract(dsn, '^[a-z]+://[^/]*/([^?]*)', 1) source from expanded),
counted as (select *, count(*) over (partition by group_id, database) times, count(*) over (partition by group_id, source) same from named)""",
    )
    + """select group_id, database, source, dsn, slot, publication,
  case when contains(publication, '{database}') then 'publication is a template'
    when not contains(dsn_template, '{database}') then 'dsn is not a template'
    when not contains(slot_template, '{database}') then 'slot is not a template'
    when times > 1 then 'listed twice' when not regexp_full_match(slot, '[a-z0-9_]{1,63}') then 'not a slot name'
    when same > 1 then 'several sources of one name' end problem from counted"""
)
def tenant_registry_audit(spark, sf_dir):
    return registry.expand_tenants(t.tenants(spark, sf_dir))


# ---- shaping ----------------------------------------------------------------

ATTRIBUTES_SQL = """concat('{"id":"', id, '","source":"', source, '","event_type":"', event_type, '"}')"""


@query(
    q.with_(q.OUTBOX)
    + f"""select source, id, {q.envelope()} body, {ATTRIBUTES_SQL} attributes, concat_ws(':', source, aggregate_type, aggregate_id) group_id,
  concat_ws(':', source, id) dedup_id, strlen({q.envelope()}) + strlen(id) + strlen(event_type) + strlen(source) + 64 size from outbox"""
)
def fifo_messages(spark, sf_dir):
    shaped = messages.messages(t.outbox(spark, sf_dir), "events.fifo")
    return shaped.withColumn("attributes", F.to_json("attributes")).drop("commit_lsn", "row_seq")


@query(
    q.with_(q.CONVERSATIONS.replace("'{}' headers", "'{}' headers, 'x' unused"), f"""timed as (select *, {q.occurred("timestamp '2024-01-01 00:00:00' + to_minutes(cast((commit_lsn - 96636764160) // 4096 // 100000 as int))")} occurred_at from outbox_conversations)""")
    + f"select source, id, {q.envelope()} body, {ATTRIBUTES_SQL} attributes, false grouped from timed"
)
def standard_messages(spark, sf_dir):
    shaped = messages.messages(t.outbox_conversations(spark, sf_dir), "events")
    grouped = F.col("group_id").isNotNull() | F.col("dedup_id").isNotNull()
    return shaped.select("source", "id", "body", F.to_json("attributes").alias("attributes"), grouped.alias("grouped"))


@query(
    q.with_(q.DOCUMENTS)
    + f"select concat('outbox:', aggregate_type) stream, source, id, event_type, {q.envelope()} envelope from outbox_documents"
)
def stream_entries(spark, sf_dir):
    return messages.stream_entries(t.outbox_documents(spark, sf_dir)).drop("commit_lsn", "row_seq")


@query(q.with_(q.ORDERS) + f"select source, id, {q.envelope()} envelope from outbox_orders")
def envelopes(spark, sf_dir):
    return t.outbox_orders(spark, sf_dir).select("source", "id", text.envelope().alias("envelope"))


@query(q.with_(q.OUTBOX) + f"select source, id, {q.lsn_text('commit_lsn')} lsn, commit_lsn lsn_back from outbox")
def lsn_text(spark, sf_dir):
    lsn = text.lsn_text(F.col("commit_lsn"))
    return t.outbox(spark, sf_dir).select("source", "id", lsn.alias("lsn"), text.lsn_value(lsn).alias("lsn_back"))


@query(
    "select event_id, 946684800000000 + greatest(epoch_us(ts) - 946684800000000 - event_id % 3 * 800000000000000, 0) committed_us from events"
)
def commit_time(spark, sf_dir):
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    stamped = at - text.DATABASE_EPOCH_MICROS - F.col("event_id") % 3 * 800_000_000_000_000
    events = t.table(spark, sf_dir, "events")
    return events.select("event_id", F.unix_micros(text.commit_time(stamped)).alias("committed_us"))


@query(
    q.with_(q.OUTBOX)
    + f"select source, id, case when {q.HASH} % 17 = 0 then 'infinity' else occurred_at end occurred_at from outbox"
)
def occurred_at(spark, sf_dir):
    stored = F.when(t.hash16(F.col("id")) % 17 == 0, "infinity").otherwise(text.database_time_text(F.col("created_at")))
    return t.outbox(spark, sf_dir).select("source", "id", text.rfc3339(stored).alias("occurred_at"))


@query(r"select doc_id, left(regexp_replace(text, '[^\x21-\x7E]', '_', 'g'), 128) broker_id from documents")
def broker_ids(spark, sf_dir):
    return t.table(spark, sf_dir, "documents").select("doc_id", text.broker_id(F.col("text")).alias("broker_id"))


@query(
    q.with_(q.DOCUMENTS)
    + f"select source, id, strlen({q.envelope()}) + strlen(id) + strlen(event_type) + strlen(source) + 64 size from outbox_documents"
)
def entry_sizes(spark, sf_dir):
    return t.outbox_documents(spark, sf_dir).select("source", "id", text.entry_size(text.envelope()).alias("size"))


@query(
    q.with_(q.OUTBOX)
    + f"""select source, event_type, json_extract_string(headers, '$.tenant') tenant, count(*) events, cast(sum(cast(json_extract(payload, '$.k') as bigint)) as bigint) k_total
from outbox group by all"""
)
def consume_envelopes(spark, sf_dir):
    sent = t.outbox(spark, sf_dir).select(text.envelope().alias("body"))
    shape = "source string, event_type string, headers struct<tenant:string>, payload struct<k:bigint>"
    read = sent.select(F.from_json("body", shape).alias("e")).select("e.*")
    return read.groupBy("source", "event_type", F.col("headers.tenant").alias("tenant")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("payload.k").alias("k_total")
    )


# ---- plans ------------------------------------------------------------------

BATCHES_SQL = """
laned as (select *, cast(concat('0x', substr(md5(concat_ws(':', source, aggregate_type, aggregate_id)), 1, 8)) as bigint) % 4 lane from outbox),
rounds as (select *, row_number() over (partition by source, aggregate_id order by commit_lsn, row_seq) as "round" from laned),
placed as (select *, row_number() over (partition by source, lane, "round" order by commit_lsn, row_seq) - 1 n from rounds),
plan as (select source, lane, "round", n // 10 batch, n % 10 as "position", id, aggregate_id from placed)"""


def planned(spark, sf_dir):
    return batches.plan_batches(t.outbox(spark, sf_dir), lanes=4)


@query(q.with_(q.OUTBOX, BATCHES_SQL) + 'select source, lane, "round", batch, "position", id from plan')
def publish_batches(spark, sf_dir):
    return planned(spark, sf_dir).select("source", "lane", "round", "batch", "position", "id")


@query()
def publish_batches_exact(spark, sf_dir):
    return batches.plan_buffers(t.outbox(spark, sf_dir), batches.MAX_EVENTS, buffer=1_000)


CALL_BYTES = 65_536


@query(
    q.with_(
        q.DOCUMENTS,
        f"""sized as (select source, (commit_lsn - 96636764160) // 4096 // 10 batch, (commit_lsn - 96636764160) // 4096 % 10 pos, id,
  strlen({q.envelope()}) + strlen(id) + strlen(event_type) + strlen(source) + 64 size from outbox_documents),
numbered as (select *, row_number() over (partition by source, batch order by pos) n from sized),
walk as (
  select source, batch, n, id, size as bytes, 0 as call_no, 0 as idx from numbered where n = 1
  union all
  select x.source, x.batch, x.n, x.id,
    case when w.idx + 1 = 10 or w.bytes + x.size > {CALL_BYTES} then x.size else w.bytes + x.size end,
    case when w.idx + 1 = 10 or w.bytes + x.size > {CALL_BYTES} then w.call_no + 1 else w.call_no end,
    case when w.idx + 1 = 10 or w.bytes + x.size > {CALL_BYTES} then 0 else w.idx + 1 end
  from walk w join numbered x on x.source = w.source and x.batch = w.batch and x.n = w.n + 1)""",
    )
    + 'select source, batch, id, cast(call_no as bigint) as "call", cast(idx as bigint) as "index" from walk'
)
def call_split(spark, sf_dir):
    place = F.floor((F.col("commit_lsn") - t.LSN_BASE) / t.LSN_STEP)
    entries = t.outbox_documents(spark, sf_dir).select(
        "source", "id", F.floor(place / 10).alias("batch"), (place % 10).alias("position"),
        text.entry_size(text.envelope()).alias("size"),
    )
    return batches.split_calls(entries, ["source", "batch"], max_bytes=CALL_BYTES)


@query(
    q.with_(q.OUTBOX, BATCHES_SQL)
    + f"""select source, id, lane, "round", batch, cast(0 as bigint) as "call", "position" as "index", {q.envelope()} body
from plan join outbox using (source, id)""".replace("aggregate_id :=", "aggregate_id := outbox.")
    .replace("outbox. aggregate_id", "outbox.aggregate_id")
)
def publish_requests(spark, sf_dir):
    requests = messages.publish_requests(t.outbox(spark, sf_dir), "events.fifo", lanes=4)
    return requests.select("source", "id", "lane", "round", "batch", "call", "index", "body")


@query(
    q.with_(
        q.OUTBOX, BATCHES_SQL,
        """broken as (select source, lane, aggregate_id, case when lane = 1 then "round" // 2 else "round" end "round",
  case when lane = 2 then batch // 2 else batch end batch from plan)""",
    )
    + """select source, lane, "round", batch, count(*) events, cast(max(c) as bigint) most_of_one_key from (
  select *, count(*) over (partition by source, lane, "round", batch, aggregate_id) c from broken)
group by all having count(*) > 10 or max(c) > 1"""
)
def batch_violations(spark, sf_dir):
    """Over a plan that was broken on purpose: lane 1 runs two rounds at once, lane 2 two batches."""
    plan = planned(spark, sf_dir)
    halved = lambda lane, c: F.when(F.col("lane") == lane, F.floor(F.col(c) / 2)).otherwise(F.col(c))
    broken = plan.withColumns({"round": halved(1, "round"), "batch": halved(2, "batch")})
    return reconcile.batch_violations(broken, ["source", "lane", "round", "batch"])


# ---- outcomes ---------------------------------------------------------------

CODES_SQL = str(list(t.ANSWER_CODES))
PERMANENT_SQL = "regexp_matches(code, '(InvalidParameterValue|InvalidMessageContents|InvalidAttributeValue|MessageTooLong|InvalidParameter)$')"


def calls(spark, sf_dir):
    return planned(spark, sf_dir).select(
        F.concat_ws("-", "source", "lane", "round", "batch").alias("call"), F.col("position").alias("index"), "source", "id"
    )


@query(
    q.with_(
        q.OUTBOX, BATCHES_SQL,
        f"""judged as (select source, id, "position" idx, h, h % 13 = 0 bad, h % 2 = 0 fault, {CODES_SQL}[h % 7 + 1] code
  from (select *, {q.HASH} h from plan))""",
    )
    + f"""select source, id, idx as "index",
  case when h % 29 = 0 then 'retryable' when not bad then 'ok' when fault and {PERMANENT_SQL} then 'permanent' else 'retryable' end outcome,
  case when h % 29 = 0 then 'missing from the broker response' when not bad then '' else concat(code, ': entry ', idx) end reason from judged"""
)
def publish_outcomes(spark, sf_dir):
    requests = stage(calls(spark, sf_dir), "requests")
    answers = t.responses(spark, sf_dir, requests)
    judged = outcomes.publish_outcomes(requests, answers)
    return judged.select("source", "id", "index", "outcome", F.coalesce("reason", F.lit("")).alias("reason"))


@query(
    q.with_(q.OUTBOX, BATCHES_SQL)
    + f"""select concat_ws('-', source, lane, "round", batch) as "call", case when {q.HASH} % 2 = 0 then 'x1' else '99' end as "index", count(*) answers, 'unknown' problem
from plan where {q.HASH} % 29 <> 0 and {q.HASH} % 31 = 0 group by all"""
)
def answer_audit(spark, sf_dir):
    requests = stage(calls(spark, sf_dir), "requests")
    return outcomes.answer_audit(requests, t.responses(spark, sf_dir, requests))


@query(
    q.with_(q.OUTBOX)
    + f"""select source, id, concat(code, ': ', event_type) reason, case when h % 2 = 0 and {PERMANENT_SQL} then 'permanent' else 'retryable' end outcome
from (select *, {CODES_SQL}[h % 7 + 1] code from (select *, {q.HASH} h from outbox))"""
)
def classify_errors(spark, sf_dir):
    codes = F.array(*(F.lit(c) for c in t.ANSWER_CODES))
    h = t.hash16(F.col("id"))
    errors = t.outbox(spark, sf_dir).select("source", "id", "event_type", h.alias("h")).withColumn(
        "code", F.element_at(codes, (F.col("h") % 7 + 1).cast("int"))
    )
    return errors.select(
        "source", "id",
        outcome.failure_reason(F.col("code"), F.col("event_type")).alias("reason"),
        outcome.entry_failure(F.col("h") % 2 == 0, F.col("code")).alias("outcome"),
    )


@query(
    q.with_(
        q.OUTBOX, BATCHES_SQL,
        """named as (select *, concat_ws('-', source, lane, "round", batch) c from plan),
failed as (select *, cast(concat('0x', substr(md5(c), 1, 4)) as bigint) hc, count(*) over (partition by c) entries from named)""",
    )
    + """select source, id, case when hc % 2 = 0 then 'BatchRequestTooLong' else 'Throttled' end reason,
  case when hc % 2 = 0 and entries = 1 then 'permanent' else 'retryable' end outcome from failed where hc % 7 = 0"""
)
def call_failures(spark, sf_dir):
    requests = stage(calls(spark, sf_dir), "requests")
    h = t.hash16(F.col("call"))
    error = F.when(h % 2 == 0, outcome.CALL_TOO_LONG).otherwise("Throttled")
    failed = requests.select("call").distinct().where(h % 7 == 0).withColumn("error", error)
    return outcomes.call_failures(requests, failed).select("source", "id", "reason", "outcome")


@query(
    q.with_(q.ATTEMPTS)
    + """select source, id, attempt, delay_ms, epoch_us(sent_at) + delay_ms * 1000 retry_us from (
  select *, cast(floor(least(100 * pow(2.0, least(attempt - 1, 30)), 30000.0) *
    (cast(cast(concat('0x', substr(md5(concat_ws(':', source, id, attempt)), 1, 8)) as bigint) as double) / 4294967296)) as bigint) delay_ms
  from attempts where outcome = 'retryable')"""
)
def retry_schedule(spark, sf_dir):
    planned_again = outcomes.retry_schedule(t.attempts(spark, sf_dir))
    return planned_again.select("source", "id", "attempt", "delay_ms", us("retry_at").alias("retry_us"))


@query(q.with_(q.ATTEMPTS) + "select source, id, epoch_us(sent_at) sent_us, cast(attempt as bigint) attempt, attempt > 1 resent from attempts")
def attempts(spark, sf_dir):
    numbered = outcomes.number_attempts(t.attempts(spark, sf_dir).select("source", "id", "sent_at"))
    return numbered.select("source", "id", us("sent_at").alias("sent_us"), "attempt", (F.col("attempt") > 1).alias("resent"))


@query(
    q.with_(q.ATTEMPTS)
    + """select source, id, pending, blocked_by is not null held, coalesce(blocked_by, 0) blocked_by from (
  select source, id, fails > 0 pending, min(case when fails > 0 then commit_lsn end) over (
    partition by source, aggregate_id order by commit_lsn, row_seq rows between unbounded preceding and 1 preceding) blocked_by from failing)"""
)
def held_events(spark, sf_dir):
    first_failed = t.attempts(spark, sf_dir).where((F.col("attempt") == 1) & (F.col("outcome") == "retryable"))
    held = outcomes.held_events(t.outbox(spark, sf_dir), first_failed)
    return held.select("source", "id", "pending", "held", F.coalesce("blocked_by", F.lit(0)).alias("blocked_by"))


STORED_SQL = "stored as (select distinct slot, id from dead_rows where h % 5 = 0)"


@query(
    q.with_(q.DEAD, STORED_SQL)
    + """select slot, id, envelope, reason, epoch_us(failed_at) failed_us from dead_rows
where (slot, id) not in (select slot, id from stored)"""
)
def dead_letters(spark, sf_dir):
    failed = stage(t.dead_letter_rows(spark, sf_dir), "failed")
    stored = failed.where(F.col("h") % 5 == 0)
    new = outcomes.new_dead_letters(failed.drop("h", "source"), stored)
    return new.select("slot", "id", "envelope", "reason", us("failed_at").alias("failed_us"))


@query(q.with_(q.DEAD) + "select slot, id, reason, epoch_us(failed_at) failed_us, envelope from dead_rows order by failed_at, id")
def dead_letter_report(spark, sf_dir):
    failed = t.dead_letter_rows(spark, sf_dir).drop("h", "source")
    stored = outcomes.new_dead_letters(failed, failed.limit(0))
    ordered = stored.orderBy("failed_at", "id")
    return ordered.select("slot", "id", "reason", us("failed_at").alias("failed_us"), "envelope")


@query(
    q.with_(q.DEAD, f"fixed as (select *, md5(concat_ws(':', 'republished', slot, id)) m from dead_rows where h % 2 = 0)")
    + f"""select 'outbox' as "table", slot, {q.uuid_sql()} id, id replaces from fixed
union all select 'dead letters', slot, id, '' from dead_rows where h % 2 <> 0"""
)
def republish_dead_letters(spark, sf_dir):
    failed = stage(t.dead_letter_rows(spark, sf_dir), "failed")
    dead = outcomes.new_dead_letters(failed.drop("source"), failed.limit(0))
    fixes = failed.where(F.col("h") % 2 == 0).select("slot", "id").distinct().withColumn("payload", F.lit("{}"))
    again, left = outcomes.republish_dead_letters(dead, fixes)
    return again.select(F.lit("outbox").alias("table"), "slot", "id", "replaces").unionByName(
        left.select(F.lit("dead letters").alias("table"), "slot", "id", F.lit("").alias("replaces"))
    )


# ---- acknowledgement --------------------------------------------------------

RELEASED_SQL = """
entries as (select source, lsn, count(*) filter (action = 'track') n, count(*) filter (action = 'confirm') c,
  max(seq) filter (action = 'confirm') done_at, min(seq) filter (action = 'progress') prog_at from log group by all),
obs as (select *, min(prog_at) over (partition by source order by lsn desc) obs_at from entries),
ready as (select source, lsn, n = 0 and obs_at < prog_at late,
  case when obs_at is null or c < n then 4611686018427387904 when n = 0 then prog_at else greatest(obs_at, done_at) end ready_at from obs),
pop as (select source, lsn, greatest(ready_at, coalesce(max(case when not late then ready_at end) over (partition by source order by lsn), 0)) pop_at from ready)"""


@query(
    q.with_(q.ACK_LOG, RELEASED_SQL)
    + "select source, coalesce(max(lsn) filter (pop_at < 4611686018427387904), 0) acked from pop group by source"
)
def ack_frontier(spark, sf_dir):
    return ack.ack_frontier(t.ack_log(spark, sf_dir))


@query(
    q.with_(
        q.ACK_LOG, RELEASED_SQL,
        """moments as (select source, seq, max(lsn) lsn from (
  select source, seq, null lsn from log union all select source, pop_at, lsn from pop where pop_at < 4611686018427387904) group by all)""",
    )
    + "select source, seq, coalesce(max(lsn) over (partition by source order by seq), 0) acked from moments"
)
def ack_timeline(spark, sf_dir):
    return ack.ack_timeline(stage(t.ack_log(spark, sf_dir), "log"))


@query(
    q.with_(
        q.ACK_LOG,
        "changes as (select source, seq, sum(case action when 'track' then 1 when 'confirm' then -1 else 0 end) d from log group by all)",
    )
    + "select source, seq, cast(sum(d) over (partition by source order by seq) as bigint) depth from changes"
)
def backlog_depth(spark, sf_dir):
    return ack.backlog_depth(t.ack_log(spark, sf_dir))


# ---- reconciliation ---------------------------------------------------------


@query(
    q.with_(q.DELIVERIES)
    + """select source, id, commit_lsn from outbox where (source, id) not in (select source, id from deliveries)
and (source, id) not in (select source, id from attempts where outcome = 'permanent')"""
)
def missing_events(spark, sf_dir):
    dead = t.attempts(spark, sf_dir).where(F.col("outcome") == "permanent")
    committed = t.outbox(spark, sf_dir).select("source", "id", "commit_lsn")
    return reconcile.missing_events(committed, t.deliveries(spark, sf_dir), dead)


@query(
    q.with_(
        q.DELIVERIES,
        """received as (select id, source written_by, concat_ws(':', source, aggregate_type, aggregate_id) expected_group,
  case when h % 61 = 0 then 'tenant_9' else source end source,
  concat_ws(':', case when h % 67 = 0 then 'tenant_8' else source end, aggregate_type, aggregate_id) group_id from deliveries)""",
    )
    + """select id, source, group_id, count(*) messages, written_by, expected_group from received
where source <> written_by or group_id <> expected_group group by all"""
)
def tenant_mismatches(spark, sf_dir):
    h = F.col("h")
    sender = F.when(h % 67 == 0, "tenant_8").otherwise(F.col("source"))
    received = t.deliveries(spark, sf_dir).select(
        "id",
        F.when(h % 61 == 0, "tenant_9").otherwise(F.col("source")).alias("source"),
        F.concat_ws(":", sender, "aggregate_type", "aggregate_id").alias("group_id"),
    )
    return reconcile.tenant_mismatches(t.outbox(spark, sf_dir), received)


@query(
    q.with_(q.DELIVERIES)
    + "select source, id, min(epoch_us(sent_at)) sent_us, any_value(event_type) event_type from deliveries where h % 4 <> 0 group by source, id"
)
def consume_once(spark, sf_dir):
    received = stage(t.deliveries(spark, sf_dir, ("event_type",)), "received")
    processed = received.where(F.col("h") % 4 == 0)
    kept = reconcile.consume_once(received.select("source", "id", "event_type", "sent_at"), processed)
    return kept.select("source", "id", us("sent_at").alias("sent_us"), "event_type")


GAP_LSN = 96_636_764_160 + 4_096 * 500


@query(
    q.with_(q.DELIVERIES)
    + f"select source, id, payload from outbox where commit_lsn > {GAP_LSN} and (source, id) not in (select source, id from deliveries)"
)
def republish_gap(spark, sf_dir):
    gap = reconcile.republish_gap(t.outbox(spark, sf_dir), t.deliveries(spark, sf_dir), GAP_LSN)
    return gap.select("source", "id", "payload")


@query(q.with_(q.DELIVERIES) + "select source, id, count(*) deliveries from deliveries group by all having count(*) > 1")
def duplicate_deliveries(spark, sf_dir):
    return reconcile.duplicate_deliveries(t.deliveries(spark, sf_dir))


@query(q.with_(q.DELIVERIES) + "select source, id from outbox except select source, id from deliveries")
def ids_lost(spark, sf_dir):
    return reconcile.ids_lost(t.outbox(spark, sf_dir), t.deliveries(spark, sf_dir))


@query(
    q.with_(q.DELIVERIES, "got as (select source, id, count(*) n from deliveries group by all)")
    + """select source, id, case when coalesce(n, 0) = 0 then 'left' else 'right' end side, abs(1 - coalesce(n, 0)) copies
from outbox left join got using (source, id) where coalesce(n, 0) <> 1"""
)
def ids_diff(spark, sf_dir):
    return reconcile.ids_diff(t.outbox(spark, sf_dir), t.deliveries(spark, sf_dir))


@query(
    q.with_(
        q.DELIVERIES,
        "firsts as (select source, id, aggregate_id, commit_lsn, row_seq, min(epoch_us(sent_at)) sent_us from deliveries group by all)",
    )
    + """select source, id, sent_us, commit_lsn, previous_lsn from (
  select *, lag(commit_lsn) over (partition by source, aggregate_id order by sent_us, commit_lsn, row_seq) previous_lsn from firsts)
where commit_lsn <= previous_lsn"""
)
def order_violations(spark, sf_dir):
    found = reconcile.order_violations(t.deliveries(spark, sf_dir))
    return found.select("source", "id", "sent_us", "commit_lsn", "previous_lsn")


@query(
    q.with_(q.OUTBOX)
    + """select source, id, commit_lsn from (select *, max({'a': created_at, 'b': id}) over (partition by source, aggregate_id order by commit_lsn, row_seq
  rows between unbounded preceding and 1 preceding) latest from outbox) where {'a': created_at, 'b': id} < latest"""
)
def poll_inversions(spark, sf_dir):
    return reconcile.poll_inversions(t.outbox(spark, sf_dir)).select("source", "id", "commit_lsn")


@query(
    q.with_(q.ORDERS)
    + "select source, id, row_number() over (partition by source order by commit_lsn, row_seq) place from outbox_orders"
)
def commit_order(spark, sf_dir):
    return reconcile.commit_order(t.outbox_orders(spark, sf_dir)).select("source", "id", "place")


RETAIN_BEFORE = "2024-01-20 00:00:00"


@query(
    q.with_(q.DELIVERIES)
    + f"""select source, id, epoch_us(created_at) created_us from outbox where created_at < timestamp '{RETAIN_BEFORE}'
and ((source, id) in (select source, id from deliveries) or (source, id) in (select source, id from attempts where outcome = 'permanent'))"""
)
def retention_candidates(spark, sf_dir):
    dead = t.attempts(spark, sf_dir).where(F.col("outcome") == "permanent").select("source", "id")
    settled = t.deliveries(spark, sf_dir).select("source", "id").unionByName(dead)
    old = reconcile.retention_candidates(t.outbox(spark, sf_dir), settled, F.lit(RETAIN_BEFORE).cast("timestamp"))
    return old.select("source", "id", us("created_at").alias("created_us"))


@query(
    q.with_(q.DELIVERIES)
    + f"""select strftime(created_at, '%Y-%m-%d') "day", count(*) events, cast(count_if(gone) as bigint) expired,
  case when bool_and(gone) then 'drop' when bool_or(gone) then 'rewrite' else 'keep' end verdict, cast(count_if(not gone) as bigint) left_over
from (select created_at, created_at < timestamp '{RETAIN_BEFORE}' and ((source, id) in (select source, id from deliveries)
  or (source, id) in (select source, id from attempts where outcome = 'permanent')) and {q.HASH} % 499 <> 3
  and day(created_at) % 3 <> 2 gone from outbox) group by all"""
)
def retention_plan(spark, sf_dir):
    """Verdicts for each day, and how many events the table holds of it after they have been carried out."""
    events = stage(t.outbox(spark, sf_dir), "events")
    dead = t.attempts(spark, sf_dir).where(F.col("outcome") == "permanent").select("source", "id")
    settled = t.deliveries(spark, sf_dir).select("source", "id").unionByName(dead)
    open_days = events.where((F.dayofmonth("created_at") % 3 == 2) | (t.hash16(F.col("id")) % 499 == 3))
    settled = stage(settled.join(open_days.select("source", "id"), ["source", "id"], "left_anti"), "settled")
    table = DatedOutbox(spark, new_path(spark, "dated"), events.schema)
    table.create(events)
    plan = stage(table.expire(settled, F.lit(RETAIN_BEFORE).cast("timestamp")), "plan")
    table.vacuum()
    left = table.read().groupBy(day_of().alias("day")).agg(F.count(F.lit(1)).alias("left_over"))
    return plan.join(left, "day", "left").withColumn("left_over", F.coalesce("left_over", F.lit(0)))


@query(
    q.with_(
        q.OUTBOX,
        f"""readers as (select concat('outbox:', event_type) stream, g, max(commit_lsn) last_delivered from outbox, (values (0), (1), (2)) gs(g)
  where {q.HASH} % (5 + g) <> g and commit_lsn % (3 + g) = 0 group by all)""",
    )
    + "select stream, min(last_delivered) trim_below from readers group by all"
)
def trim_points(spark, sf_dir):
    g, h = F.col("g"), t.hash16(F.col("id"))
    reads = t.outbox(spark, sf_dir).withColumn("g", F.explode(F.array(*(F.lit(i) for i in range(3)))))
    reads = reads.where((h % (g + 5) != g) & (F.col("commit_lsn") % (g + 3) == 0))
    groups = reads.groupBy(F.concat(F.lit("outbox:"), "event_type").alias("stream"), "g").agg(
        F.max("commit_lsn").alias("last_delivered")
    )
    return reconcile.trim_points(groups)


@query(
    q.with_(
        q.DELIVERIES,
        """sends as (select distinct source, id, epoch_us(sent_at) // 1000 ms from deliveries),
taken as (
  select source, id, min(ms) ms from sends group by all
  union all
  select source, id, nx from (
    select w.source, w.id, (select min(s.ms) from sends s where s.source = w.source and s.id = w.id and s.ms >= w.ms + 300000) nx from taken w) where nx is not null)""",
    )
    + "select concat_ws(':', source, id) dedup_id, ms sent_ms from taken"
)
def fifo_dedup(spark, sf_dir):
    sends = t.deliveries(spark, sf_dir).select(text.dedup_key().alias("dedup_id"), F.unix_millis("sent_at").alias("sent_ms"))
    return dedup.fifo_dedup(sends)


# ---- reports ----------------------------------------------------------------


@query(
    q.with_(
        q.ATTEMPTS,
        """counts as (select source, count(*) filter (outcome = 'ok') ok, count(*) filter (outcome = 'retryable') retryable,
  count(*) filter (outcome = 'permanent') permanent from attempts group by all
  union all select concat('nation_', cast(n_nationkey as varchar)), 0, 0, 0 from nation)""",
    )
    + """select 'queue' sink, source, 'events_published' metric, '' kind, ok total from counts
union all select 'queue', source, 'publish_errors', 'retryable', retryable from counts
union all select 'queue', source, 'publish_errors', 'permanent', permanent from counts
union all select 'queue', source, 'dead_letters', '', permanent from counts"""
)
def delivery_totals(spark, sf_dir):
    idle = t.table(spark, sf_dir, "nation").select(F.concat(F.lit("nation_"), F.col("n_nationkey").cast("string")).alias("source"))
    return reports.delivery_totals(t.attempts(spark, sf_dir), idle, "queue")


BOUNDS_SQL = "(values (0, '0.005', 5000), (1, '0.01', 10000), (2, '0.025', 25000), (3, '0.05', 50000), (4, '0.1', 100000), (5, '0.25', 250000), (6, '0.5', 500000), (7, '1.0', 1000000), (8, '2.5', 2500000), (9, '5.0', 5000000), (10, '10.0', 10000000), (11, '30.0', 30000000), (12, '+Inf', 9000000000000000)) b(bucket, le, le_us)"
LATENCY_SQL = "latencies as (select source, greatest(epoch_us(sent_at) - epoch_us(committed_at), 0) us, epoch_us(sent_at) // 86400000000 * 86400000000 day_us from deliveries)"
HISTOGRAM_SQL = f"hist as (select source, bucket, le, count(*) filter (us <= le_us) deliveries from latencies, {BOUNDS_SQL} group by all)"


def quantile_sql(by: str) -> str:
    return f"""
steps as (select {by}, bucket, coalesce(lag(try_cast(le as double)) over w, 0) lo, case when le = '+Inf' then null else cast(le as double) end hi,
  coalesce(lag(deliveries) over w, 0) below, deliveries n, max(deliveries) over (partition by {by}) total from hist window w as (partition by {by} order by bucket)),
quantiles as (select {by}, qv, coalesce(lo + (hi - lo) * (qv * total - below) / (n - below), lo) as "seconds"
  from steps, (values (cast(0.5 as double)), (cast(0.99 as double))) qs(qv) where n >= qv * total and below < qv * total)"""


@query(q.with_(q.DELIVERIES, LATENCY_SQL, HISTOGRAM_SQL) + "select source, bucket, le, deliveries from hist")
def latency_histogram(spark, sf_dir):
    return reports.latency_histogram(t.deliveries(spark, sf_dir))


@query(
    q.with_(q.DELIVERIES, LATENCY_SQL, HISTOGRAM_SQL, quantile_sql("source"))
    + 'select source, cast(qv as varchar) q, round("seconds", 6) as "seconds" from quantiles'
)
def latency_quantiles(spark, sf_dir):
    found = reports.histogram_quantiles(reports.latency_histogram(t.deliveries(spark, sf_dir)))
    return found.select("source", F.col("q").cast("string").alias("q"), F.round("seconds", 6).alias("seconds"))


@query(
    q.with_(q.DELIVERIES, LATENCY_SQL)
    + """select source, quantile_disc(us // 1000, 0.5) p50_ms, quantile_disc(us // 1000, 0.99) p99_ms, max(us // 1000) max_ms from latencies group by all"""
)
def latency_percentiles(spark, sf_dir):
    return reports.latency_percentiles(t.deliveries(spark, sf_dir))


DEPTH_SQL = """
per_minute as (select source, epoch_us(sent_at) // 60000000 m, count(*) c from deliveries group by all),
depths as (select source, m * 60000000 at_us, cast(sum(c) over (partition by source order by m) as bigint) queued, c from per_minute)"""


def depth_samples(spark, sf_dir):
    from commitpost.plans.scan import Agg, running

    minutes = stage(reports.rate_per_minute(t.deliveries(spark, sf_dir)), "minutes")
    levels = [[F.floor(F.col("minute") / 1_440)], [F.col("minute")]]
    summed = running(minutes, ["source"], ["minute"], {"queued": Agg("sum", F.col("deliveries"))}, levels)
    return summed.select("source", (F.col("minute") * 60_000_000).alias("at_us"), "queued", "deliveries")


@query(
    q.with_(
        q.DELIVERIES, DEPTH_SQL,
        """totals as (select source, max(queued) total from depths group by all),
ends as (select source, min({'a': at_us, 'b': queued}) filter (queued > 0) f, min({'a': at_us, 'b': queued}) filter (queued >= total) d from depths join totals using (source) group by all)""",
    )
    + "select source, round((d.b - f.b) / ((d.a - f.a) / 1000000.0), 9) events_per_second from ends"
)
def drain_rate(spark, sf_dir):
    depth = stage(depth_samples(spark, sf_dir), "depth")
    total = depth.groupBy("source").agg(F.max("queued").alias("total"))
    rate = reports.drain_rate(depth, total)
    return rate.withColumn("events_per_second", F.round("events_per_second", 9))


@query(
    q.with_(q.DELIVERIES, DEPTH_SQL)
    + """select source, c median from (select source, c, row_number() over (partition by source order by c) rn, count(*) over (partition by source) n from depths)
where rn = n // 2 + 1"""
)
def load_median(spark, sf_dir):
    return reports.upper_median(depth_samples(spark, sf_dir), ["source"], "deliveries")


@query(q.with_(q.DELIVERIES) + 'select source, epoch_us(sent_at) // 60000000 as "minute", count(*) deliveries from deliveries group by all')
def rate_per_minute(spark, sf_dir):
    return reports.rate_per_minute(t.deliveries(spark, sf_dir))


@query(q.with_(q.SLOTS) + """, gaps as (select source, case when active then
  (cast(concat('0x', split_part(current_lsn, '/', 1)) as bigint) - cast(concat('0x', split_part(confirmed_lsn, '/', 1)) as bigint)) * 4294967296
  + cast(concat('0x', split_part(current_lsn, '/', 2)) as bigint) - cast(concat('0x', split_part(confirmed_lsn, '/', 2)) as bigint) else 0 end lag from slots)
select source, max(lag) lag_bytes from gaps group by all""")
def slot_lag(spark, sf_dir):
    return reports.slot_lag(t.slots(spark, sf_dir))


@query(q.with_(q.SAMPLES) + "select source, at_us, cast(sum(value) as bigint) up from samples where metric = 'source_up' group by all")
def source_up(spark, sf_dir):
    return reports.source_up(samples(spark, sf_dir))


@query(
    q.with_(
        q.SAMPLES,
        """troubled as (select distinct source, epoch_us(sent_at) // 60000000 * 60000000 at_us from attempts where outcome = 'retryable'),
flags as (select s.replica, s.at_us, s.value = 1 source_ready, t.source is null sink_ready from samples s
  left join troubled t on s.source = t.source and s.at_us = t.at_us where s.metric = 'source_up')""",
    )
    + "select replica, at_us, bool_or(source_ready) and bool_and(sink_ready) ready from flags group by all"
)
def readiness(spark, sf_dir):
    at = (F.floor(us("sent_at") / 60_000_000) * 60_000_000).alias("at_us")
    failing = t.attempts(spark, sf_dir).where(F.col("outcome") == "retryable").select("source", at).distinct()
    streams = alerts.gauge(samples(spark, sf_dir), "source_up")
    flags = streams.join(failing.withColumn("failed", F.lit(True)), ["source", "at_us"], "left").select(
        "replica", "at_us", (F.col("value") == 1).alias("source_ready"), F.col("failed").isNull().alias("sink_ready")
    )
    return reports.readiness(flags, ["replica", "at_us"])


STEPS_SQL = """
seen as (select *, lag(value) over (partition by replica, metric, source, kind order by at_us) previous from samples where metric like '%_total'),
gains as (select *, case when value >= previous then value - previous else value end gain from seen where previous is not null)"""


def trailing_sql(by: str, value: str, minutes: int) -> str:
    return f"sum({value}) over (partition by {by} order by at_us range between {minutes * 60_000_000 - 1} preceding and current row)"


@query(
    q.with_(q.SAMPLES, STEPS_SQL)
    + f"""select metric, source, kind, at_us, gain, {trailing_sql('replica, metric, source, kind', 'gain', 1)} in_1m,
  {trailing_sql('replica, metric, source, kind', 'gain', 5)} in_5m, {trailing_sql('replica, metric, source, kind', 'gain', 15)} in_15m from gains"""
)
def counter_increase(spark, sf_dir):
    counters = samples(spark, sf_dir).where(F.col("metric").endswith("_total"))
    increase = reports.counter_increase(counters, {"in_1m": 1, "in_5m": 5, "in_15m": 15})
    return increase.drop("replica", "value")


@query(
    q.with_(
        q.SAMPLES, STEPS_SQL, LATENCY_SQL.replace("from deliveries", "from attempts where outcome = 'ok'"),
        HISTOGRAM_SQL.replace("source", "day_us"), quantile_sql("day_us"),
        """dayed as (select *, at_us // 86400000000 * 86400000000 as day from samples), gained as (select *, at_us // 86400000000 * 86400000000 as day from gains),
figures as (
  select day at_us, 'replicas_up' panel, replica as label, min(value) as value from dayed where metric = 'up' group by all
  union all select day, 'published_per_second', '', sum(gain) / 86400 from gained where metric = 'events_published_total' group by all
  union all select day, 'published_per_second_by_source', source, sum(gain) / 86400 from gained where metric = 'events_published_total' group by all
  union all select day, 'errors_per_second', kind, sum(gain) / 86400 from gained where metric = 'publish_errors_total' group by all
  union all select day, 'dead_letters', '', sum(gain) from gained where metric = 'dead_letters_total' group by all
  union all select day, 'slot_lag', '', max(value) from dayed where metric = 'slot_lag_bytes' group by all
  union all select day, 'slot_lag_by_source', source, max(value) from dayed where metric = 'slot_lag_bytes' group by all
  union all select day_us, 'latency_seconds', cast(qv as varchar), "seconds" from quantiles)""",
    )
    + "select at_us, panel, label, round(value, 6) as value from figures"
)
def overview(spark, sf_dir):
    ok = t.attempts(spark, sf_dir).where(F.col("outcome") == "ok")
    figures = reports.overview(samples(spark, sf_dir), ok)
    return figures.withColumn("value", F.round("value", 6))


# ---- alerts -----------------------------------------------------------------


def held_sql(rows: str, by: str, minutes: int) -> str:
    """``rows`` gives ``by``, ``at_us`` and ``cond``."""
    return f"""
marked as ({rows}),
gapped as (select *, coalesce(at_us - lag(at_us) over (partition by {by} order by at_us) > 300000000, true) gap from marked),
islands as (select *, count(*) filter (gap or not cond) over (partition by {by} order by at_us) island from gapped),
stretches as (select {by}, island, min(at_us) since_us, max(at_us) until_us from islands where cond group by all),
fired as (select {by}, since_us, since_us + {minutes} * 60000000 fired_us, until_us from stretches where until_us - since_us >= {minutes} * 60000000)"""


ALL_FIRED = "select * from fired"


@query(q.with_(q.SAMPLES, held_sql("select replica, source, at_us, value > 536870912 cond from samples where metric = 'slot_lag_bytes'", "replica, source", 10)) + ALL_FIRED)
def alert_slot_lag(spark, sf_dir):
    return alerts.slot_lag_high(samples(spark, sf_dir))


@query(q.with_(q.SAMPLES, held_sql("select replica, at_us, value = 0 cond from samples where metric = 'up'", "replica", 5)) + ALL_FIRED)
def alert_relay_down(spark, sf_dir):
    return alerts.relay_down(samples(spark, sf_dir))


@query(
    q.with_(q.SAMPLES, held_sql("select source, at_us, sum(value) = 0 cond from samples where metric = 'source_up' group by all", "source", 5))
    + ALL_FIRED
)
def alert_source_down(spark, sf_dir):
    return alerts.source_down(samples(spark, sf_dir))


@query(
    q.with_(
        q.SAMPLES, STEPS_SQL,
        """both_gains as (select source, at_us, sum(case when kind = 'retryable' then gain else 0 end) failed,
  sum(case when metric = 'events_published_total' then gain else 0 end) published from gains where kind = 'retryable' or metric = 'events_published_total' group by all)""",
        held_sql(
            f"select source, at_us, {trailing_sql('source', 'failed', 5)} > 0 and {trailing_sql('source', 'published', 5)} = 0 cond from both_gains",
            "source", 5,
        ),
    )
    + ALL_FIRED
)
def alert_publish_stalled(spark, sf_dir):
    return alerts.publish_stalled(samples(spark, sf_dir))


@query(
    q.with_(
        q.SAMPLES, STEPS_SQL,
        held_sql(
            f"select replica, source, at_us, {trailing_sql('replica, source', 'gain', 15)} > 0 cond from gains where metric = 'dead_letters_total'",
            "replica, source", 0,
        ),
    )
    + ALL_FIRED
)
def alert_poison(spark, sf_dir):
    return alerts.poison_events(samples(spark, sf_dir))


@query(
    q.with_(q.SAMPLES, held_sql("select replica, source, at_us, value = 0 cond from samples where metric = 'source_up'", "replica, source", 3))
    + ALL_FIRED
)
def alert_firings(spark, sf_dir):
    streams = alerts.gauge(samples(spark, sf_dir), "source_up")
    return alerts.held(streams, ["replica", "source"], F.col("value") == 0, 3)
