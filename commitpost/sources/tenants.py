"""The registry of tenant databases: expand the templates, and say what cannot work."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from commitpost.functions import text
from commitpost.plans.lookup import lookup_join

PLACEHOLDER = "{database}"


def database_name(dsn):
    """The database a connection URL names: its path, without the query."""
    return F.regexp_extract(dsn, r"^[a-z]+://[^/]*/([^?]*)", 1)


def expand_tenants(tenants: DataFrame) -> DataFrame:
    """One row per source with its connection, slot and ``problem`` (null if it can work).

    Input: ``(group_id, database, dsn_template, slot_template, publication)``; ``group_id`` names one list.
    Blank names are dropped, as an environment variable leaves them. A list of nothing else is one source, which
    its connection names; its ``database`` is then empty and nothing of it may be a template.
    """
    mark = F.lit(PLACEHOLDER)
    lists = tenants.groupBy("group_id").agg(F.bool_or(F.trim("database") != "").alias("_named"))
    listed = tenants.withColumn("database", F.trim("database"))
    listed = lookup_join(listed, lists, ["group_id"], F.col("database"), "inner")
    alone = listed.where(~F.col("_named")).dropDuplicates(["group_id"])
    listed = listed.where(F.col("database") != "").unionByName(alone)
    expanded = listed.withColumn("dsn", F.replace("dsn_template", mark, text.percent_encoded(F.col("database")))).withColumn(
        "slot", F.replace("slot_template", mark, F.col("database"))
    ).withColumn("source", database_name(F.col("dsn"))).where("source is not null")
    several = F.count(F.lit(1)) > 1  # names that occur once need no row in a lookup table
    repeated = expanded.groupBy("group_id", "database").agg(several.alias("_listed")).where("_listed")
    named = expanded.groupBy("group_id", "source").agg(several.alias("_same_name")).where("_same_name")
    checked = lookup_join(expanded, repeated, ["group_id", "database"], F.col("dsn"))
    checked = lookup_join(checked, named, ["group_id", "source"], F.col("database"))
    dsn_template = F.col("dsn_template").contains(PLACEHOLDER)
    slot_template = F.col("slot_template").contains(PLACEHOLDER)
    problem = (
        F.when(F.col("publication").contains(PLACEHOLDER), "publication is a template")
        .when(~F.col("_named") & (dsn_template | slot_template), "no databases for the templates")
        .when(F.col("_named") & ~dsn_template, "dsn is not a template")
        .when(F.col("_named") & ~slot_template, "slot is not a template")
        .when(F.col("_listed"), "listed twice")
        .when(~text.is_slot_name(F.col("slot")), "not a slot name")
        .when(F.col("_same_name"), "several sources of one name")
    )
    return checked.select("group_id", "database", "source", "dsn", "slot", "publication", problem.alias("problem"))
