"""Resolving, checking and expiring named snapshots of a catalog table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.parse import instant_literal, retention_days
from tallyhouse.operators.joins import salted_join


def snapshot_lookup(wanted: DataFrame, catalog: DataFrame) -> DataFrame:
    """Each wanted snapshot with what its id and its name find in the catalog.

    ``wanted`` has ``database_name``, ``snapshot_id`` and ``snapshot_name``.
    Database names compare in any letter case, snapshot names exactly.
    """
    listed = catalog.withColumn("__db", F.lower("database_name"))
    by_id = listed.groupBy("__db", F.col("snapshot_id").alias("__id")).agg(
        F.max(F.coalesce("snapshot_name", F.lit(""))).alias("__id_name")
    )
    by_name = (
        listed.filter("snapshot_name <> ''")
        .groupBy("__db", F.col("snapshot_name").alias("__name"))
        .agg(F.count("*").alias("__matches"), F.max("snapshot_id").alias("__name_id"))
    )
    asked = wanted.withColumn("__db", F.lower("database_name")).withColumns(
        {"__id": F.col("snapshot_id"), "__name": F.col("snapshot_name")}
    )
    # Requests without an id or name are many and match nothing, so they are spread.
    named = salted_join(asked, by_id, ["__db", "__id"], "left")
    return salted_join(named, by_name, ["__db", "__name"], "left")


def resolve_snapshots(catalog: DataFrame, wanted: DataFrame) -> DataFrame:
    """The snapshot each request names: by id first, by name when the id is not listed."""
    found = snapshot_lookup(wanted, catalog)
    by_id = F.col("__id_name").isNotNull()
    state = (
        F.when(by_id & (F.col("__id_name") == ""), "cleared")
        .when(by_id, "found")
        .when(F.col("__matches") > 1, "ambiguous")
        .when(F.col("__matches") == 1, "found")
        .otherwise("unlisted")
    )
    resolved = F.when(state == "found", F.when(by_id, F.col("snapshot_id")).otherwise(F.col("__name_id")))
    return found.select(
        "database_name",
        "snapshot_id",
        "snapshot_name",
        state.alias("state"),
        resolved.alias("resolved_id"),
    )


def resolve_snapshot(
    catalog: DataFrame, database: str, snapshot_id: str | None = None, name: str | None = None
) -> DataFrame:
    """The one catalog row that the id or name stands for; several matches fail."""
    mine = catalog.filter(F.lower("database_name") == F.lower(F.lit(database)))
    if snapshot_id is not None:
        by_id = mine.filter(F.col("snapshot_id") == snapshot_id)
        if not by_id.isEmpty():
            return by_id.filter("snapshot_name <> ''")
    if name is None:
        return mine.limit(0)
    named = mine.filter(F.col("snapshot_name") == name)
    matches = named.limit(2).count()
    if matches > 1:
        raise ValueError(f"several snapshots of {database!r} are named {name!r}")
    return named


def snapshot_status(wanted: DataFrame, catalog: DataFrame, databases: DataFrame) -> DataFrame:
    """Status per request: found, retained without database, cleared, ambiguous or unlisted."""
    live = databases.select(F.lower("database_name").alias("__live")).distinct().withColumn("__exists", F.lit(True))
    resolved = resolve_snapshots(catalog, wanted)
    joined = resolved.join(live, F.lower("database_name") == F.col("__live"), "left")
    gone = (F.col("state") == "found") & F.col("__exists").isNull()
    return joined.select(
        "database_name",
        "snapshot_id",
        "snapshot_name",
        F.when(gone, "retained_without_database").otherwise(F.col("state")).alias("status"),
    )


def rename_snapshot(catalog: DataFrame, snapshot_id: str, name: str) -> DataFrame:
    """The catalog with one snapshot renamed. An empty name releases it."""
    renamed = F.when(F.col("snapshot_id") == snapshot_id, F.lit(name)).otherwise(F.col("snapshot_name"))
    return catalog.withColumn("snapshot_name", renamed)


def expired_snapshots(catalog: DataFrame, databases: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Unnamed snapshots older than their database's retention.

    A retention that is no number of days never expires anything. Of a
    database that is listed more than once the longest retention counts.
    """
    days = databases.select(
        F.lower("database_name").alias("__db"), retention_days("historical_snapshot_retention").alias("__days")
    ).filter(F.col("__days").isNotNull()).groupBy("__db").agg(F.max("__days").alias("__days"))
    unnamed = catalog.filter(F.coalesce("snapshot_name", F.lit("")) == "").withColumn("__db", F.lower("database_name"))
    moment = instant_literal(catalog, "created_ts", as_of)
    limit = moment - F.make_dt_interval(F.col("__days").cast("int"))
    return unnamed.join(days, "__db").filter(F.col("created_ts") < limit).select(*catalog.columns)
