"""What the library stores: files hold stretches of one log, in commit order."""

import glob

import pyarrow.parquet as pq
import pytest
from events import events
from pyspark.sql import functions as F

from commitpost.operators.messages import stream_entries, write_streams
from commitpost.operators.reconcile import write_in_commit_order
from commitpost.plans.stage import new_path, shared_dir, stage
from commitpost.sources.outbox import after_position, outbox_events, read_outbox, read_tenants, resume_after


@pytest.fixture(scope="module")
def rows(spark):
    made = [
        {
            "id": str(n), "source": "big" if n % 3 else "small", "aggregate_type": ("order", "user")[n % 2],
            "aggregate_id": str(n % 5), "commit_lsn": (n // 2) << 22, "row_seq": (n * 7) % 200,
        }
        for n in range(200)
    ]
    return events(spark, made).cache()


def files(path):
    found = glob.glob(f"{path}/**/*.parquet", recursive=True)
    return [pq.ParquetFile(name).read().to_pylist() for name in found]


def in_order(part, keys):
    positions = [tuple(r[k] for k in keys) for r in part]
    return positions == sorted(positions)


def test_stream_files(rows, tmp_path):
    write_streams(stream_entries(rows, "events:"), str(tmp_path))
    parts = files(tmp_path)
    assert sum(map(len, parts)) == 200
    assert all(in_order(part, ["source", "commit_lsn", "row_seq"]) for part in parts)
    assert {p.split("stream=")[1].split("/")[0] for p in glob.glob(f"{tmp_path}/*/*.parquet")} == {"events%3Aorder", "events%3Auser"}


def test_commit_order_files_and_tenant_folders(spark, rows, tmp_path):
    path = str(tmp_path / "ordered")
    write_in_commit_order(rows, path)
    assert all(in_order(part, ["commit_lsn", "row_seq"]) for part in files(path))
    one = read_tenants(spark, path, [" small", ""])
    assert {r["source"] for r in one.select("source").distinct().collect()} == {"small"}
    assert read_tenants(spark, path, ["small", "big"]).count() == 200
    with pytest.raises(ValueError, match="twice"):
        read_tenants(spark, path, ["big", "big "])
    kept = read_outbox(spark, path)
    assert kept.count() == 200 and "source" not in kept.columns


def test_positions_reach_the_scan(spark, rows, tmp_path):
    path = str(tmp_path / "events")
    rows.write.parquet(path)
    late = after_position(spark.read.parquet(path), 50 << 22)
    assert late.count() == 98
    plan = late.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(commit_lsn" in plan


def test_resume_starts_after_each_acknowledgement(spark, rows):
    acks = spark.createDataFrame([("big", 90 << 22), ("big", 80 << 22)], "source string, acked bigint")
    left = resume_after(rows, acks).collect()
    assert {r["commit_lsn"] >> 22 for r in left if r["source"] == "big"} == set(range(91, 100))
    assert sum(r["source"] == "small" for r in left) == rows.where("source = 'small' and commit_lsn > 0").count()


def test_stages_are_written_to_the_shared_folder(spark, rows):
    staged = stage(rows.select("id"), "ids")
    assert staged.count() == 200
    assert any(shared_dir(spark) in name for name in staged.inputFiles())
    assert new_path(spark, "x") != new_path(spark, "x")


def test_event_times_come_from_the_table(rows):
    made = outbox_events(rows.drop("occurred_at").withColumn("created_at", F.lit("2026-03-01 01:02:03.45").cast("timestamp")))
    assert made.first()["occurred_at"] == "2026-03-01T01:02:03.45Z"
