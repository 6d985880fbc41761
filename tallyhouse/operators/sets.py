"""Unions, first copies and set subtraction."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def role_members(users: DataFrame, roles: DataFrame) -> DataFrame:
    """User members and role members in one shape, by type and name.

    Both inputs carry ``granted_to`` (the role), so one call serves every role.
    """
    people = users.select(
        "granted_to",
        F.col("username").alias("member_name"),
        F.lit("user").alias("member_type"),
        "email",
        "is_service_account",
        "granted_at",
    )
    groups = roles.select(
        "granted_to", F.col("role_name").alias("member_name"), F.lit("role").alias("member_type"), "granted_at"
    )
    return people.unionByName(groups, allowMissingColumns=True).orderBy("granted_to", "member_type", "member_name")


def dedupe_first(df: DataFrame, key: str, sequence: Sequence[str]) -> DataFrame:
    """The first copy of each id in page order."""
    first = Window.partitionBy(key).orderBy(*sequence)
    return df.withColumn("__rn", F.row_number().over(first)).filter("__rn = 1").drop("__rn")


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """Pages of one listing as one table; no pages is an error."""
    if not pages:
        raise ValueError("union_pages needs at least one page")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def differences(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key of either side with a status: matched, missing or unexpected.

    Both sides are reduced per key on the map side and shuffled once, so copies
    and heavy keys cost nothing and there is no join.
    """
    keys = list(keys)
    wanted = expected.select(*keys, F.lit(True).alias("__want"), F.lit(False).alias("__have"))
    held = actual.select(*keys, F.lit(False).alias("__want"), F.lit(True).alias("__have"))
    status = (
        F.when(F.col("__want") & F.col("__have"), "matched")
        .when(F.col("__want"), "missing")
        .otherwise("unexpected")
    )
    return (
        wanted.unionByName(held)
        .groupBy(*keys)
        .agg(F.max("__want").alias("__want"), F.max("__have").alias("__have"))
        .select(*keys, status.alias("status"))
    )


def set_diff(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct expected keys that the actual side lacks, in order."""
    return differences(expected, actual, keys).filter("status = 'missing'").select(*keys).orderBy(*keys)
