"""The rules of ``workload.tables`` as SQL over the given tables, for checking."""

from __future__ import annotations


def uuid_sql(m: str = "m") -> str:
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return "concat_ws('-', " + ", ".join(f"substr({m},{a},{n})" for a, n in cuts) + ")"


def us(ts: str) -> str:
    return f"epoch_us({ts})"


def lsn_text(lsn: str) -> str:
    return f"printf('%X/%X', {lsn} >> 32, {lsn} & 4294967295)"


def occurred(ts: str) -> str:
    return f"concat(replace(cast({ts} as varchar), ' ', 'T'), 'Z')"


HASH = "cast(concat('0x', substr(md5(id), 1, 4)) as bigint)"

EVENT = "source, id, aggregate_type, aggregate_id, event_type, payload, headers, created_at, occurred_at, commit_lsn, row_seq, committed_at"

OUTBOX = f"""
outbox_base as (
  select concat('tenant_', cast(user_id % 5 as varchar)) source, md5(concat('event-', cast(event_id as varchar))) m,
    cast(user_id as varchar) aggregate_id, concat('user.', event_type) event_type, props payload, ts,
    event_id // 16 tx, event_id row_seq from events),
outbox as (
  select source, {uuid_sql()} id, 'user' aggregate_type, aggregate_id, event_type, payload,
    concat('{{"tenant": "', source, '"}}') headers,
    min(ts) over t - to_hours(cast(tx % 4 * 2 as int)) created_at,
    {occurred("min(ts) over t - to_hours(cast(tx % 4 * 2 as int))")} occurred_at,
    96636764160 + (max(row_seq) over t + 1) * 4096 commit_lsn, row_seq, max(ts) over t committed_at, tx
  from outbox_base window t as (partition by source, tx))"""

DOCUMENTS = f"""
outbox_documents as (
  select source, {uuid_sql("md5(concat('doc-', cast(doc_id as varchar)))")} id, 'document' aggregate_type,
    cast(doc_id as varchar) aggregate_id, 'document.added' event_type,
    cast(to_json({{'text': text}}) as varchar) payload, concat('{{"lang": "', lang, '"}}') headers,
    timestamp '2024-01-01 00:00:00' created_at, '2024-01-01T00:00:00Z' occurred_at,
    96636764160 + (doc_id + 1) * 4096 commit_lsn, 0 row_seq, timestamp '2024-01-01 00:00:00' committed_at
  from documents)"""

CONVERSATIONS = f"""
outbox_conversations as (
  select 'chat' source, {uuid_sql("md5(concat('turn-', cast(conv_id as varchar), '-', cast(turn as varchar)))")} id,
    'conversation' aggregate_type, cast(conv_id as varchar) aggregate_id, concat('turn.', role) event_type,
    concat('{{"turn": ', cast(turn as varchar), ', "chars": ', cast(length(text) as varchar), '}}') payload, '{{}}' headers,
    96636764160 + (turn * 100000 + conv_id + 1) * 4096 commit_lsn, 0 row_seq
  from conversations)"""

ORDERS = f"""
order_heads as (
  select concat('nation_', cast(c_nationkey as varchar)) source, o_orderkey, o_orderdate from orders join customer on o_custkey = c_custkey),
order_rows as (
  select source, o_orderkey, o_orderdate, 'order.created' event_type, 'head' part, cast(0 as bigint) row_seq, '' extra from order_heads
  union all
  select source, o_orderkey, o_orderdate, 'order.line_added', concat_ws('-', l_linenumber, l_partkey, cast(l_quantity as int)),
    cast(l_linenumber as bigint) * 17592186044416 + l_partkey * 64 + cast(l_quantity as bigint), concat(', "part_id": ', cast(l_partkey as varchar))
  from order_heads join (select distinct l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem) on o_orderkey = l_orderkey),
outbox_orders as (
  select source, {uuid_sql("md5(concat('order-', cast(o_orderkey as varchar), '-', part))")} id, 'order' aggregate_type,
    cast(o_orderkey as varchar) aggregate_id, event_type, concat('{{"order_id": ', cast(o_orderkey as varchar), extra, '}}') payload,
    '{{}}' headers, o_orderdate created_at, {occurred("o_orderdate")} occurred_at,
    96636764160 + (o_orderkey + 1) * 4096 commit_lsn, row_seq, o_orderdate committed_at
  from order_rows)"""

RAW = f"""{OUTBOX},
raw_outbox as (
  select source, id, aggregate_type, case when {HASH} % 79 = 3 then null else aggregate_id end aggregate_id,
    case when {HASH} % 89 = 3 then null else event_type end event_type,
    case when {HASH} % 97 = 3 then left(payload, length(payload) - 1) else payload end payload,
    case when {HASH} % 83 = 3 then null else headers end headers, created_at from outbox)"""

ATTEMPTS = f"""{OUTBOX},
hashed as (select *, {HASH} h from outbox),
failing as (select *, case when h % 97 = 0 then 0 when h % 11 = 0 then h % 3 + 1 else 0 end fails from hashed),
attempts as (
  select source, id, aggregate_type, aggregate_id, event_type, payload, headers, occurred_at, commit_lsn, row_seq, committed_at, h, fails,
    cast(k as int) attempt,
    case when h % 97 = 0 then 'permanent' when k <= fails then 'retryable' else 'ok' end outcome,
    committed_at + to_milliseconds(12 + h % 50 + (k - 1) * 200) sent_at
  from failing join (values (1), (2), (3), (4)) ks(k) on k <= fails + 1)"""

DELIVERIES = f"""{ATTEMPTS},
deliveries as (
  select source, id, aggregate_type, aggregate_id, event_type, payload, headers, occurred_at, commit_lsn, row_seq, committed_at, h,
    sent_at + to_milliseconds(delay) sent_at
  from attempts join (values (0), (30000), (600000)) ds(delay)
    on delay = 0 or (h % 53 = 0 and delay = 30000) or (h % 53 = 0 and h % 2 = 0 and delay = 600000)
  where outcome = 'ok' and h % 101 <> 7)"""


def envelope() -> str:
    texts = ", ".join(f"{c} := {c}" for c in ("id", "source", "aggregate_type", "aggregate_id", "event_type", "occurred_at"))
    json = f"cast(to_json(struct_pack({texts})) as varchar)"
    return f"""concat(left({json}, length({json}) - 1), ',"headers":', headers, ',"payload":', payload, '}}')"""


DEAD = f"""{DELIVERIES},
dead_rows as (
  select concat('outbox_', source) slot, source, id, {envelope()} envelope,
    concat('InvalidMessageContents: rejected ', cast(h % 7 as varchar)) reason, sent_at failed_at, h
  from attempts where outcome = 'permanent')"""

ACK_LOG = f"""{ATTEMPTS},
commits as (select source, commit_lsn, max(committed_at) committed_at from outbox group by all),
log as (
  select source, epoch_us(committed_at) * 4 seq, 'track' action, commit_lsn lsn from outbox
  union all select source, epoch_us(committed_at) * 4 + 1, 'progress', commit_lsn from commits
  union all select source, (epoch_us(committed_at) + 1000000) * 4 + 1, 'progress', commit_lsn + 1024 from commits where (commit_lsn // 4096) % 7 = 0
  union all select source, epoch_us(sent_at) * 4 + 2, 'confirm', commit_lsn from attempts where outcome <> 'retryable' and h % 2003 <> 7)"""

WAL = f"""{OUTBOX},
wal_events as (select *, tx // 50 period, {HASH} h from outbox),
wal_txs as (select source, commit_lsn, tx, period, max(committed_at) committed_at from wal_events group by all),
wal_first as (select source, period, min(commit_lsn) commit_lsn from wal_txs where not (source = 'tenant_3' and period = 0) group by all),
wal_log as (
  select source, commit_lsn - 4000 wal_pos, 'B' kind, null end_lsn, null commit_micros, null id from wal_txs
  union all select source, commit_lsn - 3990, 'R', null, null, null from wal_first
  union all select source, commit_lsn - 3950, 'K', commit_lsn - 3950, null, null from wal_txs where tx % 7 = 0
  union all select source, commit_lsn - 3900 + row_seq % 16 * 100, 'I', null, null, id from wal_events
  union all select source, commit_lsn - 100, 'C', commit_lsn, epoch_us(committed_at) - 946684800000000, null from wal_txs where tx % 13 <> 0
  union all select source, commit_lsn + 50, 'K', commit_lsn + 50, null, null from wal_txs where tx % 3 = 0)"""

GAP = "((hh = 1 and mm < 4) or (hh = 3 and mm < 6) or (hh = 5 and mm < 12))"

SAMPLES = f"""{ATTEMPTS},
sample_done as (
  select source, epoch_us(sent_at) // 60000000 + case when fails = 3 then (attempt - 1) * 2 else 0 end "minute",
    count(*) filter (outcome = 'ok') ok, count(*) filter (outcome = 'retryable') retryable, count(*) filter (outcome = 'permanent') permanent
  from attempts where not (fails = 3 and outcome = 'ok') group by all),
sample_grid as (
  select source, day, unnest(range(day * 1440, day * 1440 + 1440)) "minute" from (select distinct source, "minute" // 1440 as day from sample_done)),
sample_counters as (
  select source, "minute", cast(sum(coalesce(ok, 0)) over d as double) ok, cast(sum(coalesce(retryable, 0)) over d as double) retryable,
    cast(sum(coalesce(permanent, 0)) over d as double) permanent
  from sample_grid left join sample_done using (source, "minute")
  window d as (partition by source, day order by "minute" rows unbounded preceding)),
sample_gauges as (
  select *, ("minute" // 60) % 24 hh, "minute" % 60 mm from sample_grid cross join (values ('r0'), ('r1')) r(replica)),
samples as (
  select "minute" * 60000000 at_us, 'r0' replica, source, 'events_published_total' metric, '' kind, ok as value from sample_counters
  union all select "minute" * 60000000, 'r0', source, 'publish_errors_total', 'retryable', retryable from sample_counters
  union all select "minute" * 60000000, 'r0', source, 'publish_errors_total', 'permanent', permanent from sample_counters
  union all select "minute" * 60000000, 'r0', source, 'dead_letters_total', '', permanent from sample_counters
  union all select "minute" * 60000000, replica, source, 'source_up', '',
    case when {GAP} then 0.0 when replica = concat('r', cast(cast(substr(source, 8) as int) % 2 as varchar)) then 1.0 else 0.0 end from sample_gauges
  union all select "minute" * 60000000, replica, source, 'slot_lag_bytes', '',
    case when {GAP} and hh >= 3 then 629145600.0 else cast("minute" % 97 * 1048576 as double) end from sample_gauges
  union all select distinct "minute" * 60000000, replica, '', 'up', '',
    case when {GAP} and replica = 'r1' then 0.0 else 1.0 end from sample_gauges)"""

TENANTS = """
tenants as (
  select cast(c_nationkey as bigint) group_id,
    case when c_custkey % 19 = 0 then concat(' ', nm) when c_custkey % 23 = 0 then '  ' when c_custkey % 29 = 0 then replace(nm, '_', '-')
      when c_custkey % 31 = 0 then 'customer_shared' else nm end as database,
    case when c_custkey % 37 = 0 then 'postgres://courier@pg7.test/ledger' when c_custkey % 41 = 0 then 'postgres://courier@{database}.pg.test/ledger'
      else 'postgres://courier:s3@pg7.test:6432/{database}?application_name=mail' end dsn_template,
    case when c_custkey % 43 = 0 then 'outbox_slot' else 'outbox_{database}' end slot_template,
    case when c_custkey % 47 = 0 then 'outbox_pub_{database}' else 'outbox_pub' end publication
  from (select *, lower(replace(c_name, '#', '_')) nm from customer))"""

SLOTS = f"""{OUTBOX},
slot_days as (
  select source, epoch_us(committed_at) // 86400000000 as day, max(commit_lsn) filter ({HASH} % 101 <> 7) confirmed, max(commit_lsn) written
  from outbox group by all),
slots as (
  select concat('outbox_', source) slot, source, {lsn_text('confirmed')} confirmed_lsn,
    {lsn_text('(written + 8192 + day % 11 * 512)')} current_lsn, day % 5 <> 0 active from slot_days where confirmed is not null)"""


def with_(*parts: str) -> str:
    return "with recursive " + ", ".join(parts) + "\n"
