"""Joins against a table with one row per key, safe when one key holds most of the big side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .stage import stage

BROADCAST_ROWS = 200_000
"""Largest lookup table that is broadcast; a row is a few short columns, so this stays in the tens of MB."""
HOT_KEY = 1_000_000
"""A key with more rows than this is spread over salts. At most rows / HOT_KEY keys can be."""


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    spread: Column,
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
    hot: int = HOT_KEY,
) -> DataFrame:
    """Joins ``small`` (unique on ``keys``) to ``big``.

    ``small`` is written and counted first. Up to ``broadcast_rows`` rows it is broadcast and ``big`` is not
    shuffled. Beyond that both are shuffled by the keys. Keys with more than ``hot`` rows of ``big``, which are few, are
    spread over salts by ``spread``, and only their rows of ``small`` are repeated per salt, so a hot key is shared by
    as many tasks as there are shuffle partitions and ``small`` hardly grows.
    """
    small = stage(small, "lookup")
    if small.count() <= broadcast_rows:
        return big.join(F.broadcast(small), keys, how)
    salts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot)
    named = F.broadcast(stage(counted.select(*keys, F.lit(True).alias("_hot_key")), "hot_keys"))
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    every = F.when(F.col("_hot_key"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted = small.join(named, keys, "left").withColumn("_salt", F.explode(every)).drop("_hot_key")
    spread_out = big.join(named, keys, "left").withColumn("_salt", F.when(F.col("_hot_key"), salt).otherwise(F.lit(0)))
    # a size estimate of short repeated rows is far below what they take in memory: never broadcast by it
    return spread_out.drop("_hot_key").join(salted.hint("shuffle_merge"), [*keys, "_salt"], how).drop("_salt")
