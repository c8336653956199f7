"""The outbox by day: expiring drops whole days, rewrites mixed ones, and loses nothing if it dies before the swap."""

import pytest
from events import events
from pyspark.sql import functions as F

from commitpost.sources.dated import DatedOutbox


def noon():
    return F.lit("2031-01-03 12:00:00").cast("timestamp")


@pytest.fixture
def table(spark, tmp_path):
    days = {"a": "01", "b": "01", "c": "02", "d": "02", "e": "03", "f": "03", "g": "04"}
    rows = events(spark, [{"id": i} for i in [*days, "n"]])
    at = F.create_map(*(F.lit(x) for i, d in days.items() for x in (i, f"2031-01-{d} {'13' if i == 'f' else '08'}:00:00")))[F.col("id")]
    made = DatedOutbox(spark, str(tmp_path / "dated"), rows.schema)
    made.create(rows.withColumn("created_at", at.cast("timestamp")))
    return made


def settled(spark, ids):
    return spark.createDataFrame([("north", i) for i in ids], "source string, id string")


def ids(table):
    return {r["id"] for r in table.read().collect()}


def test_days_are_dropped_rewritten_or_kept(spark, table):
    before = table.folders()
    verdicts = {r["day"]: r["verdict"] for r in table.expire(settled(spark, "abcefgn"), noon()).collect()}
    assert verdicts == {
        "2031-01-01": "drop", "2031-01-02": "rewrite", "2031-01-03": "rewrite", "2031-01-04": "keep", "none": "keep",
    }
    assert ids(table) == {"d", "f", "g", "n"}
    after = table.folders()
    assert after["2031-01-04"] == before["2031-01-04"] and "2031-01-01" not in after
    assert table.vacuum() == sorted(before[f"2031-01-0{d}"] for d in (1, 2, 3))
    assert ids(table) == {"d", "f", "g", "n"}


def test_nothing_is_lost_by_a_crash_before_the_swap(spark, table, monkeypatch):
    def die(self, folders, version):
        raise OSError("lost")

    whole = ids(table)
    with monkeypatch.context() as m:
        m.setattr(DatedOutbox, "publish", die)
        with pytest.raises(OSError):
            table.expire(settled(spark, "abc"), noon())
    assert ids(table) == whole and table.version() == 0
    table.expire(settled(spark, "ab"), noon())
    assert ids(table) == whole - {"a", "b"}


def test_nothing_settled_publishes_nothing(spark, table):
    table.expire(settled(spark, []), noon())
    assert table.version() == 0


def test_everything_settled_leaves_an_empty_table(spark, table):
    table.expire(settled(spark, "abcdefgn"), F.lit("2040-01-01").cast("timestamp"))
    assert ids(table) == {"n"}  # no time, so it never expires


def test_an_empty_table(spark, table, tmp_path):
    empty = DatedOutbox(spark, str(tmp_path / "empty"), table.schema)
    assert empty.read().count() == 0
    empty.create(table.read().limit(0))
    assert empty.expire(settled(spark, "a"), noon()).count() == 0 and empty.read().count() == 0
