"""A database change log as rows: decode messages, assemble transactions, report progress.

The log has ``(source, wal_pos, kind, relation_oid, data, end_lsn, commit_micros)``. Kinds: B begin, R relation,
I insert, C commit, K keepalive; others are ignored. ``wal_pos`` orders the messages of a source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from commitpost.functions import text
from commitpost.plans.scan import Agg, running
from commitpost.plans.stage import stage

from .schema import EVENT_COLUMNS, JSON_COLUMNS, REQUIRED

# The message layout of the database's logical replication, positions from 1.
OID_AT, OID_BYTES = 2, 4
TUPLE_KIND_AT, COLUMN_COUNT_AT, FIRST_VALUE_AT = 6, 7, 9
COUNT_BYTES, LENGTH_BYTES = 2, 4
TYPE_BYTES = 8  # type oid and type modifier after a column name
NEW_TUPLE, NULL_VALUE, TEXT_VALUE = "N", "n", "t"


def chunks():
    return [[F.shiftright("wal_pos", 24)], [F.col("wal_pos")]]


def uint(data: Column, start: Column | int, size: int, kind: str = "int") -> Column:
    at = F.lit(start) if isinstance(start, int) else start
    return F.conv(F.hex(F.substring(data, at, F.lit(size))), 16, 10).cast(kind)


def letter(data: Column, start: Column | int) -> Column:
    at = F.lit(start) if isinstance(start, int) else start
    return F.substring(data, at, F.lit(1)).cast("string")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once: inside a lambda function nothing else keeps it from being repeated."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def up_to(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.expr("cast(array() as array<int>)"))


def relation_columns(data: Column) -> Column:
    """Column names of a relation message; null if it is cut short."""
    chars = F.decode(data, "ISO-8859-1")  # one character per byte
    end = F.lit("\x00")
    schema_end = F.locate("\x00", chars, OID_AT + OID_BYTES)
    table_end = F.position(end, chars, schema_end + 1)
    count_at = table_end + 2  # after the replica identity
    start = F.struct(
        (count_at + COUNT_BYTES).alias("at"), F.expr("cast(array() as array<string>)").alias("names")
    )

    def read(state: Column, _: Column) -> Column:
        name_at = state["at"] + 1  # after the flags
        name_end = F.position(end, chars, name_at)
        name = F.decode(F.encode(F.substring(chars, name_at, name_end - name_at), "ISO-8859-1"), "UTF-8")
        next_at = name_end + 1 + TYPE_BYTES
        complete = (name_end > 0) & (next_at <= F.length(chars) + 1)
        return F.struct(
            next_at.alias("at"), F.when(complete, F.concat(state["names"], F.array(name))).alias("names")
        )

    names = F.aggregate(up_to(uint(data, count_at, COUNT_BYTES)), start, read, lambda state: state["names"])
    return F.when((schema_end > 0) & (table_end > 0) & (F.length(data) >= count_at + 1), names)


def insert_values(data: Column, names: Column) -> Column:
    """``(values, error)`` of an insert message, read against the column names of its relation."""
    size = F.length(data)
    count = uint(data, COLUMN_COUNT_AT, COUNT_BYTES)
    start = F.struct(
        F.lit(FIRST_VALUE_AT).alias("at"),
        F.expr("cast(array() as array<string>)").alias("values"),
        F.lit(None).cast("string").alias("error"),
    )

    def read(state: Column, i: Column) -> Column:
        head = F.struct(
            letter(data, state["at"]).alias("kind"),
            F.coalesce(uint(data, state["at"] + 1, LENGTH_BYTES, "bigint"), F.lit(0)).alias("length"),
        )
        return bound(head, lambda head: body(state, i, head))

    def body(state: Column, i: Column, head: Column) -> Column:
        fits = head["length"] <= size - state["at"] - LENGTH_BYTES  # a length of 32 bits may be larger than any message
        length = F.when(fits, head["length"]).otherwise(size).cast("int")
        is_text = head["kind"] == TEXT_VALUE
        field = F.struct(
            F.when(is_text, F.substring(data, state["at"] + 1 + LENGTH_BYTES, length).cast("string")).alias("value"),
            (state["at"] + 1 + F.when(is_text, length + LENGTH_BYTES).otherwise(0)).alias("after"),
        )
        return bound(field, lambda field: judged(state, i, head["kind"], field))

    def judged(state: Column, i: Column, kind: Column, field: Column) -> Column:
        error = (
            F.when(state["error"].isNotNull(), state["error"])
            .when(field["after"] > size + 1, F.lit("the message ends too early"))
            .when((kind == TEXT_VALUE) & ~F.is_valid_utf8(field["value"]), F.lit("value is not UTF-8"))
            .when(~kind.isin(NULL_VALUE, TEXT_VALUE), F.concat(F.lit("value kind not read in "), F.element_at(names, i)))
        )
        return F.struct(
            field["after"].alias("at"),
            F.concat(state["values"], F.array(field["value"])).alias("values"),
            error.alias("error"),
        )

    read_all = F.aggregate(
        up_to(count), start, read, lambda end: F.struct(end["values"].alias("values"), end["error"].alias("error"))
    )
    nothing = F.expr("cast(null as array<string>)")

    def failed(message: Column | str) -> Column:
        reason = F.lit(message) if isinstance(message, str) else message
        return F.struct(nothing.alias("values"), reason.alias("error"))

    arity = F.concat(count.cast("string"), F.lit(" values for "), F.size(names).cast("string"), F.lit(" columns"))
    return (
        F.when(names.isNull(), failed("relation not seen yet"))
        .when(size < FIRST_VALUE_AT - 1, failed("the message ends too early"))
        .when(letter(data, TUPLE_KIND_AT) != NEW_TUPLE, failed("no new row in the insert"))
        .when(count != F.size(names), failed(arity))
        .otherwise(read_all)
    )


def relation_asof(log: DataFrame, limit: int | None = None, inserts: DataFrame | None = None) -> DataFrame:
    """Inserts (of ``log``, or those given) with the position and columns of the latest relation message of their table.

    Only positions are scanned: the bytes of the inserts stay out of the window."""
    if inserts is None:
        inserts = log.where(F.col("kind") == "I").select("source", "wal_pos", "relation_oid")
    relation = F.struct("wal_pos", relation_columns(F.col("data")).alias("names")).alias("relation")
    relations = log.where(F.col("kind") == "R").select("source", "wal_pos", "relation_oid", relation)
    rows = inserts.unionByName(relations, allowMissingColumns=True).withColumnRenamed("relation", "_relation")
    known = {"relation": Agg("last", F.col("_relation"))}
    found = running(rows, ["source", "relation_oid"], ["wal_pos"], known, chunks(), limit=limit)
    return found.where(F.col("_relation").isNull()).drop("_relation")


def with_data(inserts: DataFrame, log: DataFrame) -> DataFrame:
    """Inserts with their bytes, which are joined once, after all scans."""
    return inserts.join(log.where(F.col("kind") == "I").select("source", "wal_pos", "data"), ["source", "wal_pos"])


def decode(found: DataFrame) -> DataFrame:
    """Each insert with its column ``names`` and ``values``, or the ``error`` that makes it unreadable."""
    kept = [c for c in found.columns if c not in ("data", "relation")]
    found = found.withColumn("names", F.col("relation.names"))
    # A generator, so that each message is read once however often its values are used.
    return found.select(*kept, "names", F.inline(F.array(insert_values(F.col("data"), F.col("names")))))


def as_map(decoded: DataFrame) -> DataFrame:
    """Decoded rows with one map from column name to text."""
    return decoded.withColumn("row", F.map_from_arrays("names", "values")).drop("names", "values")


def column_of(name: str) -> Column:
    """A column of a decoded row by name, null if its relation has none."""
    return F.get("values", F.array_position("names", name).cast("int") - 1)


COMMITTED, OPEN, LOST, STRAY = "committed", "open", "lost", "stray"


def boundaries(log: DataFrame, limit: int | None = None) -> DataFrame:
    """Begins and commits, each with the one after it in ``after`` (null: none yet) and the kind of the one before."""
    rows = log.where(F.col("kind").isin("B", "C")).select("source", "wal_pos", "kind", "end_lsn", "commit_micros")
    this = F.struct("kind", "end_lsn", "commit_micros")
    rows = running(rows, ["source"], ["wal_pos"], {"after": Agg("last", this)}, chunks(), before=True, descending=True, limit=limit)
    return running(rows, ["source"], ["wal_pos"], {"before": Agg("last", F.col("kind"))}, chunks(), before=True, limit=limit)


def transactions(log: DataFrame, bounds: DataFrame, limit: int | None = None) -> DataFrame:
    """Inserts without their bytes, with the position and time of their commit and the ``state`` of their transaction.

    Between a begin and a commit they are committed; open if nothing follows the begin yet, lost if another begin does
    (rolled back or cut off); stray if no begin comes before. A transaction of any size needs no buffer for that."""
    span = F.struct(F.col("kind").alias("opened"), "after").alias("span")
    inserts = log.where(F.col("kind") == "I").select("source", "wal_pos", "relation_oid")
    rows = inserts.unionByName(bounds.select("source", "wal_pos", span), allowMissingColumns=True)
    seen = running(rows, ["source"], ["wal_pos"], {"_in": Agg("last", F.col("span"))}, chunks(), limit=limit)
    after = F.col("_in.after.kind")
    state = F.when(F.coalesce(F.col("_in.opened") != "B", F.lit(True)), STRAY).when(after.isNull(), OPEN).when(after == "C", COMMITTED)
    return seen.where("span is null").select(
        "source", "wal_pos", "relation_oid", state.otherwise(LOST).alias("state"),
        F.col("_in.after.end_lsn").alias("commit_lsn"), text.commit_time(F.col("_in.after.commit_micros")).alias("committed_at"),
    )


def assemble(log: DataFrame, limit: int | None = None) -> DataFrame:
    """Inserts of committed transactions, with the position and time of their commit."""
    found = transactions(log, boundaries(log, limit), limit)
    return found.where(F.col("state") == COMMITTED).drop("state")


def progress_marks(log: DataFrame, limit: int | None = None) -> DataFrame:
    """Positions the source has sent everything up to: commits, and keepalives between transactions."""
    rows = log.where(F.col("kind").isin("B", "C", "K")).select("source", "wal_pos", "kind", "end_lsn")
    latest = {"_open": Agg("last", F.when(F.col("kind") != "K", F.col("kind")))}
    seen = running(rows, ["source"], ["wal_pos"], latest, chunks(), before=True, limit=limit)
    marks = F.when(F.col("kind") == "C", F.col("_open") == "B").when(F.col("kind") == "K", F.coalesce("_open", F.lit("C")) == "C")
    return seen.where(marks).select("source", "wal_pos", F.col("end_lsn").alias("lsn"))


def located(log: DataFrame, bounds: DataFrame, limit: int | None = None) -> DataFrame:
    """All inserts with the state of their transaction, their relation and their bytes."""
    return with_data(relation_asof(log, limit, transactions(log, bounds, limit)), log)


def strays(found: DataFrame, bounds: DataFrame) -> DataFrame:
    """Inserts and commits outside any transaction, as rejects."""
    inserts = found.where(F.col("state") == STRAY).select("source", "wal_pos", F.lit("an insert outside of a transaction").alias("error"))
    commits = bounds.where((F.col("kind") == "C") & F.coalesce(F.col("before") != "B", F.lit(True)))
    return inserts.unionByName(commits.select("source", "wal_pos", F.lit("a commit without its begin").alias("error")))


def decoded_events(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Committed outbox events of a log, and the messages that cannot be events or ends of one, each with its reason."""
    bounds = boundaries(log)
    found = located(log, bounds)
    events, rejects = read_inserts(found.where(F.col("state") == COMMITTED).drop("state"))
    return events, rejects.unionByName(strays(found, bounds))


def read_inserts(found: DataFrame, once: bool = False) -> tuple[DataFrame, DataFrame]:
    """Events of located inserts, and the inserts that cannot be events. A caller that uses both has them decoded ``once``:
    what was read is staged."""
    rows = decode(found)
    missing = F.coalesce(
        "error",
        *(F.when(column_of(c).isNull(), F.lit(f"no value for `{c}`")) for c in REQUIRED),
        *(F.when(~text.is_json(column_of(c)), F.lit(f"{c}: not JSON")) for c in JSON_COLUMNS),
    )
    checked = rows.withColumn("error", missing)
    if once:
        checked = stage(checked, "decoded")
    rejects = checked.where(F.col("error").isNotNull()).select("source", "wal_pos", "error")
    values = {c: column_of(c) for c in REQUIRED}
    values["occurred_at"] = text.rfc3339(values["created_at"])
    values["created_at"] = values["created_at"].try_cast("timestamp")
    values |= {c: F.col(c) for c in ("source", "commit_lsn", "committed_at")}
    values["row_seq"] = F.col("wal_pos")
    events = checked.where(F.col("error").isNull()).select(*(values[c].alias(c) for c in EVENT_COLUMNS))
    return events, rejects
