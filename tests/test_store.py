import os
import random
from collections import Counter

from pyspark.sql import functions as F

from commitpost.streaming.store import START, KeyedStore, place

SCHEMA = "k string, v int"


def test_runs_of_a_bucket_grow_with_the_logarithm_of_its_steps():
    runs, written = [], Counter()
    rows = {}
    for step in range(200):
        folder = f"s{step}"
        runs, merged = place(runs, [0], folder, 4)
        name = f"{folder}/bucket=0"
        rows[name] = 1 + sum(rows.pop(run) for _, _, run in merged)
        written[step] = rows[name]
        assert set(rows) == {run for _, _, run in runs} and len(runs) <= 3 * 4
    assert sum(rows.values()) == 200
    assert sum(written.values()) <= 200 * 5  # each row once per level


def files(path):
    return sum(len(names) for _, _, names in os.walk(path))


def test_store_keeps_every_row_and_few_runs(spark, tmp_path):
    rng = random.Random(3)
    store = KeyedStore(spark, str(tmp_path / "store"), SCHEMA, ("k",), buckets=4, fan=3)
    store.prepare()
    want, previous = [], START
    for n in range(14):
        new = [(f"k{rng.randrange(30)}", n) for _ in range(rng.choice([0, 1, 3]))]
        rows = spark.createDataFrame(new, SCHEMA)
        step = (n, 0)
        if n == 6:  # a crash before the step is finished: it is repeated, with the same rows
            store.add(rows, store.buckets_of(rows), previous, step)
        store.add(rows, store.buckets_of(rows), previous, step)
        previous = step
        want += new
        live = store.manifest(step)
        assert max(Counter(bucket for bucket, _, _ in live).values(), default=0) <= 2 * 4
    assert sorted(map(tuple, store.read(previous).collect())) == sorted(want)
    some = store.buckets_of(spark.createDataFrame([("k1", 0)], SCHEMA))
    of_bucket = store.read(previous, some).where(F.col("k") == "k1").count()
    assert of_bucket == sum(k == "k1" for k, _ in want)
    gone = store.manifest(previous, live=False)
    kept = [run for _, _, run in store.manifest(previous) + gone]
    on_disk = [os.path.join(root, d) for root, names, _ in os.walk(tmp_path / "store" / "runs") for d in names if d.startswith("bucket=")]
    assert len(on_disk) == len(kept)


def test_an_empty_step_hands_the_manifest_on(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "store"), SCHEMA, ("k",), buckets=2)
    store.prepare()
    one = spark.createDataFrame([("a", 1), (None, 2)], SCHEMA)
    store.add(one, store.buckets_of(one), START, (0, 0))
    store.add(one.limit(0), [], (0, 0), (1, 0))
    assert store.manifest((1, 0)) == store.manifest((0, 0))
    assert store.read((1, 0)).count() == 2 and store.read(START).count() == 0
