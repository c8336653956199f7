"""Small event tables for tests."""

from pyspark.sql import functions as F

from commitpost.streaming.relay import EVENT_SCHEMA

COLUMNS = [part.split()[0] for part in EVENT_SCHEMA.split(", ")]


def events(spark, rows):
    """Rows are dicts; what they leave out gets a plain value."""
    plain = {
        "source": "north", "aggregate_type": "parcel", "aggregate_id": "p9", "event_type": "parcel.weighed",
        "payload": "{}", "headers": "{}", "occurred_at": "2031-01-02T00:00:00Z", "row_seq": 0, "commit_lsn": 1,
        "id": "0", "created_at": None, "committed_at": None,
    }
    full = [tuple({**plain, **row}[c] for c in COLUMNS) for row in rows]
    at = F.lit("2031-01-02 00:00:00").cast("timestamp")
    df = spark.createDataFrame(full, EVENT_SCHEMA)
    return df.withColumn("created_at", F.coalesce("created_at", at)).withColumn(
        "committed_at", F.coalesce("committed_at", at)
    )
