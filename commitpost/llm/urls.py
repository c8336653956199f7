"""URL filters as a range join by a sorted sweep, in DataFrame operations alone.

A rule is a host (with all its subdomains) and a path prefix. A URL has one key for each suffix of its host, at label
borders: that suffix reversed, a separator, then the path. On these binary keys every rule is the interval of the
strings that begin with its own key, and two intervals are nested or apart. The sweep sorts keys and interval ends
together; the rule in force after an end is known beforehand (the enclosing rule), so the top of the stack is the last
state seen. Long key ranges are cut into pieces by Spark's range partitioning; one row per piece carries the state
over. Keys are made distinct first, so a frequent URL is one key.

Cases: a null URL, or one without "://", has an empty host and path, and no rule fits it; a rule with an empty host or
an unknown verdict is refused; of rules alike in host and path, ``block`` counts; of several fitting rules the
longest counts, of equally long ones that with the longer host; a URL that no rule fits gets ``DEFAULT``; repeated
rows are judged alike; other columns are ignored; without rules or pages the result is as these cases say.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.stage import stage

DEFAULT = "allow"
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
RULE_COLUMNS = "verdict string, host string, path string"


def host(url: Column) -> Column:
    """What stands between the first :// and the next / ? # or end, A-Z lower-cased; empty if there is no ://."""
    raw = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed(host_labels: Column) -> Column:
    return F.array_join(F.reverse(host_labels), ".")


def _key(host_reversed: Column, url_path: Column) -> Column:
    """A zero byte parts host and path, so that no host is the beginning of another one's key."""
    return F.concat(host_reversed, F.lit("\0"), url_path).cast("binary")


def rule_table(rules: DataFrame) -> DataFrame:
    """rule_key, rule (as text), verdict, host_length; one row for each host and path."""
    bad = (F.col("host") == "") | F.col("host").isNull() | ~F.col("verdict").isin("allow", "block")
    checked = rules.withColumn("verdict", F.when(bad, F.raise_error(F.lit("a rule without host or verdict")))
                               .otherwise(F.col("verdict")))
    one = checked.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    return one.select(
        _key(_reversed(F.split("host", r"\.")), F.col("path")).alias("rule_key"),
        F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_length"),
    )


def _edges(table: DataFrame) -> DataFrame:
    """Where a rule begins and ends, each with the rule that is in force from there on.

    An end sorts after every key with the prefix (byte FF never occurs in UTF-8). The enclosing rule is the longest
    rule whose key is a proper prefix of this one's; rules are looked up by their own prefixes.
    """
    own = F.struct("rule", "verdict", "host_length")
    rules = table.select("rule_key", own.alias("own"))
    cuts = rules.select("rule_key", F.explode(F.sequence(F.lit(0), F.length("rule_key") - 1)).alias("cut"))
    prefixes = cuts.where("cut > 0").select(F.col("rule_key").alias("inner"), F.expr("substring(rule_key, 1, cut)").alias("rule_key"))
    enclosing = prefixes.join(rules, "rule_key").groupBy("inner").agg(F.max_by("own", F.length("rule_key")).alias("outer"))
    nested = rules.join(enclosing, F.col("inner") == F.col("rule_key"), "left")
    begins = nested.select(F.col("rule_key").alias("key"), F.lit(0).alias("turn"), F.struct("own").alias("state"))
    ends = nested.select(
        F.concat("rule_key", F.expr("X'FF'")).alias("key"), F.lit(0).alias("turn"), F.struct(F.col("outer").alias("own")).alias("state")
    )
    return begins.union(ends)


def innermost(keys: DataFrame, table: DataFrame) -> DataFrame:
    """key, own: for each distinct binary ``key`` the rule with the longest key that begins it; null if none does."""
    points = keys.select("key", F.lit(1).alias("turn"))
    points = points.withColumn("state", F.lit(None).cast("struct<own:struct<rule:string,verdict:string,host_length:int>>"))
    pieces = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = points.unionByName(_edges(table)).repartitionByRange(pieces, "key")
    # written: the pieces must stay what they were when they are read a second time
    dealt = stage(dealt.withColumn("piece", F.spark_partition_id()), "url-keys")

    order = F.struct("key", "turn")
    last = F.max_by("state", F.when(F.col("state").isNotNull(), order))
    totals = dealt.groupBy("piece").agg(last.alias("state"), F.min("key").alias("first"))  # one row for each piece
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("piece", F.last("state", ignorenulls=True).over(before).alias("carried"))

    seen = Window.partitionBy("piece").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, 0)
    swept = dealt.withColumn("top", F.last("state", ignorenulls=True).over(seen)).where("turn = 1")
    joined = swept.join(carried, "piece", "left")
    return joined.select("key", F.coalesce("top", "carried").getField("own").alias("own"))


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule (null if none fits) and verdict for each row of ``pages``."""
    parts = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    levels = F.sequence(F.lit(1), F.size(labels))
    urls = parts.where("host <> ''").select("host", "path").distinct()
    leveled = urls.select("host", "path", F.explode(levels).alias("level"))
    keyed = leveled.select(
        "host", "path",
        _key(F.expr("array_join(reverse(slice(split(host, '[.]'), -level, level)), '.')"), F.col("path")).alias("key"),
    )
    found = innermost(keyed.select("key").distinct(), rule_table(rules)).where("own is not null")
    best = F.max(F.struct(F.length("own.rule").alias("length"), "own.host_length", "own.rule", "own.verdict"))
    fitting = keyed.join(found, "key").groupBy("host", "path").agg(best.alias("best"))
    return parts.join(fitting, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict"),
    )


def given_rules(spark, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_COLUMNS)
