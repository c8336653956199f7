import random

from pyspark.sql import functions as F

from commitpost.operators.alerts import STALE_MINUTES, held
from commitpost.streaming.watch import held_stream

MINUTE = 60_000_000
SCHEMA = "replica string, at_us bigint, value double"


def run(spark, tmp_path, parts, minutes):
    box, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    for part in parts:
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(box)
        stream = spark.readStream.schema(SCHEMA).parquet(box)
        writer = held_stream(stream, ["replica"], F.col("value") == 0, minutes).writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", offsets).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).collect()


def test_any_cut_gives_what_the_whole_gives(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for replica in ("a", "b", "c"):
        minute = 0
        on = False
        for _ in range(120):
            minute += rng.choice([1, 1, 1, 2, STALE_MINUTES, STALE_MINUTES + 1])
            on = on if rng.random() < 0.8 else not on
            rows.append((replica, minute * MINUTE, 0.0 if on else None if rng.random() < 0.1 else 1.0))
    whole = held(spark.createDataFrame(rows, SCHEMA), ["replica"], F.coalesce(F.col("value") == 0, F.lit(False)), 4)
    want = sorted(map(tuple, whole.collect()))
    top = max(at for _, at, _ in rows)
    cuts = [0, top // 3, top // 3 + 7 * MINUTE, 2 * top // 3, top + 1]
    parts = [[r for r in rows if low <= r[1] < high] for low, high in zip(cuts, cuts[1:])]
    for part in parts:
        rng.shuffle(part)
    got = run(spark, tmp_path, [*parts, [("end", top + 1440 * MINUTE, 1.0)]], 4)
    assert sorted((r["replica"], r["since_us"], r["fired_us"], r["until_us"]) for r in got if r["state"] == "resolved") == want
    firing = sorted((r["replica"], r["since_us"], r["fired_us"], r["until_us"]) for r in got if r["state"] == "firing")
    assert firing == [(replica, since, fired, None) for replica, since, fired, _ in want]


def test_an_alert_fires_once_while_it_lasts_and_resolves_when_its_series_falls_silent(spark, tmp_path):
    down = [("a", n * MINUTE, 0.0) for n in range(1, 11)]  # Spark takes the epoch itself for late
    parts = [down[:3], down[3:6], down[6:], [("b", 60 * MINUTE, 1.0)]]
    got = sorted((r["state"], r["since_us"], r["until_us"]) for r in run(spark, tmp_path, parts, 4))
    assert got == [("firing", MINUTE, None), ("resolved", MINUTE, 10 * MINUTE)]
