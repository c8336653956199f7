"""The split scan equals the plain window, whatever the chunks."""

import random

import pytest
from pyspark.sql import functions as F

from commitpost.operators.reconcile import commit_order
from commitpost.plans.scan import Agg, count, log_levels, running


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(3000):
        source = "hot" if rng.random() < 0.6 else f"s{rng.randrange(20)}"
        lsn = (1 << 26) if rng.random() < 0.3 else rng.randrange(1 << 28)
        data.append((source, lsn, i << 16, rng.randrange(100), rng.randrange(9) if rng.random() < 0.2 else None))
    return spark.createDataFrame(data, "source string, commit_lsn bigint, row_seq bigint, v bigint, mark bigint")


@pytest.mark.parametrize("before", [False, True])
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("limit", [5, 100, 100_000])
def test_matches_plain_window(rows, before, descending, limit):
    aggs = {
        "n": count(),
        "marks": count(F.col("mark")),
        "total": Agg("sum", F.col("v")),
        "top": Agg("max", F.col("v")),
        "low": Agg("min", F.col("v")),
        "seen": Agg("last", F.col("mark")),
    }
    got = running(rows, ["source"], ["commit_lsn", "row_seq"], aggs, log_levels(), before, descending, limit)
    plain = running(rows, ["source"], ["commit_lsn", "row_seq"], aggs, [], before, descending)
    key = ["source", "commit_lsn", "row_seq"]
    assert got.columns == plain.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert got.select(key).distinct().count() == 3000


def test_commit_order_reads_its_events_once_however_many_groups_are_hot(spark, rows):
    read = spark.sparkContext.accumulator(0)

    def counted(lsn):
        read.add(1)
        return lsn

    events = rows.select("source", F.col("row_seq").cast("string").alias("id"), "row_seq",
                         F.udf(counted, "bigint").asNondeterministic()("commit_lsn").alias("commit_lsn"))
    got = commit_order(events, limit=100)
    assert got.where("source = 'hot'").agg(F.max("place")).first()[0] == rows.where("source = 'hot'").count()
    assert read.value == 3000
