"""Contract checks on tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.names import slug
from tallyhouse.operators.aggregates import collect_sorted


def one_row_per(df: DataFrame, name: str, value: str, counts: Mapping[str, Column]) -> DataFrame:
    """Several aggregates of one pass over ``df`` as rows (name, value)."""
    aliases = {label: f"c{i}" for i, label in enumerate(counts)}
    wide = df.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(aliases[n]) for n, c in counts.items()])
    pairs = [F.struct(F.lit(n).alias(name), F.col(a).alias(value)) for n, a in aliases.items()]
    return wide.select(F.inline(F.array(*pairs)))


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count of every column that must not be null, in one pass."""
    return one_row_per(df, "column_name", "violations", {c: F.count_if(F.col(c).isNull()) for c in columns})


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts. Null keys are not compared."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def enum_violations(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is none of the labels; labels are case sensitive."""
    return df.filter(~F.col(column).isin(list(values)))


def run_checks(
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[Sequence[str]] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per check with its failures. All row checks share one pass."""
    row_checks = {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in not_null}
    for column, labels in (accepted or {}).items():
        row_checks[f"accepted:{column}"] = F.count_if(~F.col(column).isin(list(labels)))
    results = [one_row_per(df, "check_name", "failures", row_checks)] if row_checks else []
    for keys in unique:
        label = F.lit("unique:" + ",".join(keys)).alias("check_name")
        results.append(duplicate_keys(df, keys).agg(F.count("*").alias("failures")).select(label, "failures"))
    if not results:
        raise ValueError("run_checks needs at least one check")
    return reduce(DataFrame.unionByName, results).withColumn("passed", F.col("failures") == 0)


def require_checks(results: DataFrame) -> None:
    """Fail when any check failed. There is one small row per check."""
    failed = [f"{r['check_name']} ({r['failures']})" for r in results.filter("NOT passed").collect()]
    if failed:
        raise ValueError("checks failed: " + ", ".join(sorted(failed)))


def slug_collisions(tenants: DataFrame, preferred: str = "slug", key: str = "tenant_id") -> DataFrame:
    """Slugs that more than one tenant would get."""
    named = tenants.select(slug(preferred, F.col(key).cast("string")).alias("slug"), F.col(key).cast("string").alias("tenant_id"))
    counts = named.distinct().groupBy("slug").agg(F.count("*").alias("tenants"))
    return counts.filter("tenants > 1")


def colliding_tenants(tenants: DataFrame, preferred: str = "slug", key: str = "tenant_id", *, part_size: int) -> DataFrame:
    """The tenants behind each collision, as sorted lists of ``part_size``."""
    named = tenants.select(slug(preferred, F.col(key).cast("string")).alias("slug"), F.col(key).cast("string").alias("tenant_id"))
    clashing = slug_collisions(tenants, preferred, key).select("slug")
    return collect_sorted(named.join(clashing, "slug", "left_semi"), ["slug"], "tenant_id", "tenants", part_size=part_size)
