"""Projections, predicates and row rules."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.parse import instant_literal
from tallyhouse.functions.render import value_text
from tallyhouse.operators.joins import sized_join


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns, so a column added later stays hidden."""
    return df.select(*columns)


def typed_rows(df: DataFrame, spec: Mapping[str, str | None]) -> DataFrame:
    """Text rows: output name to source column, values as the JSON rows show them. A source the rows lack gives null."""
    def value(name: str, source: str | None) -> Column:
        source = source or name
        if source not in df.columns:
            return F.lit(None).cast("string").alias(name)
        return value_text(F.col(f"`{source}`"), df.schema[source].dataType).alias(name)

    return df.select(*[value(n, s) for n, s in spec.items()])


def repository_metrics(df: DataFrame) -> DataFrame:
    return df.select("repo", "stars", "forks", (F.col("stars") + F.col("forks")).alias("engagement"))


def filter_name(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Rows with this name in any letter case; no value keeps all rows."""
    if value is None:
        return df
    return df.filter(F.lower(column) == F.lower(F.lit(value)))


def filter_optional(df: DataFrame, **conditions: object) -> DataFrame:
    """Rows that equal every condition that is set."""
    for column, value in conditions.items():
        if value is not None:
            df = df.filter(F.col(column) == F.lit(value))
    return df


def iso_date(text: str | None) -> dt.date:
    if text is None or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError("Use valid start and end dates in YYYY-MM-DD order")
    return dt.date.fromisoformat(text)


def usage_between(df: DataFrame, start: str, end: str) -> DataFrame:
    """Usage from ``start`` to ``end``, both included, in date order, as text."""
    first, last = iso_date(start), iso_date(end)
    if first > last:
        raise ValueError("Use valid start and end dates in YYYY-MM-DD order")
    return (
        df.filter(F.col("usage_date").between(F.lit(first), F.lit(last)))
        .orderBy("usage_date")
        .select(F.col("usage_date").cast("string"), F.col("event_count").cast("string"))
    )


def recent_rows(df: DataFrame, ts: str, as_of: Column | dt.datetime, days: int = 7) -> DataFrame:
    """Rows newer than ``as_of`` minus ``days``."""
    moment = instant_literal(df, ts, as_of)
    return df.filter(F.col(ts) > moment - F.make_dt_interval(F.lit(days)))


def filter_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Names that start with ``prefix``; no character of it is a wildcard."""
    return df.filter(F.col(column).startswith(prefix))


def bridge_finish_time(df: DataFrame) -> DataFrame:
    """Give rows of either schema generation both names of the finish time. Rows that have both stay as they are."""
    has_end, has_finished = "end_time" in df.columns, "run_finished_ts" in df.columns
    if has_end and not has_finished:
        return df.withColumn("run_finished_ts", F.col("end_time"))
    if has_finished and not has_end:
        return df.withColumn("end_time", F.col("run_finished_ts"))
    if not has_end:
        raise ValueError("Usage rows need end_time or run_finished_ts")
    return df


def filter_in(df: DataFrame, column: str, values: Sequence | DataFrame) -> DataFrame:
    """Rows whose value is listed, in a Python list or in a one-column table."""
    if isinstance(values, DataFrame):
        listed = values.select(F.col(values.columns[0]).alias(column)).distinct()
        return sized_join(df, listed, [column], "left_semi")
    return df.filter(F.col(column).isin(list(values)))


def topic_subtree(df: DataFrame, prefix: str, column: str = "topic") -> DataFrame:
    """The topic itself and everything below it."""
    return df.filter((F.col(column) == prefix) | F.col(column).startswith(prefix + "/"))


# Types of things that have a uuid, and the scheme of a catalog's url.
UUID_TYPES = ("dive", "flight", "guide")
CATALOG_SCHEME = "md:"
# What a catalog reference may name below its url.
CATALOG_PATHS = ("", "schema", "schema table", "schema table column", "schema view", "schema macro")


def check_reference(ref: Mapping[str, str | None]) -> None:
    """Refuse references of other types, and field combinations that name nothing."""
    kind = ref.get("type")
    if kind == "catalog":
        if not (ref.get("url") or "").startswith(CATALOG_SCHEME):
            raise ValueError(f"a catalog reference needs a url that starts with {CATALOG_SCHEME}")
        named = {f for path in CATALOG_PATHS for f in path.split() if ref.get(f)}
        if named not in [set(path.split()) for path in CATALOG_PATHS]:
            raise ValueError(f"a catalog reference cannot name {sorted(named)}; it names one of {CATALOG_PATHS[1:]}")
    elif kind not in UUID_TYPES:
        raise ValueError(f"a reference has one of the types catalog, {', '.join(UUID_TYPES)}")
    elif ref.get("uuid") is None:
        raise ValueError(f"a {kind} reference needs a uuid")


def filter_by_reference(df: DataFrame, ref: Mapping[str, str | None], column: str = "references") -> DataFrame:
    """Rows with a reference that agrees on every field that is set."""
    wanted = {f: v for f, v in ref.items() if v}
    if not wanted:
        return df
    check_reference(ref)

    def agrees(entry: Column) -> Column:
        condition = F.lit(True)
        for field, value in wanted.items():
            condition = condition & (entry[field] == value)
        return condition

    return df.filter(F.exists(column, agrees))


def explode_grantees(df: DataFrame, column: str = "access_role_names", kind: str = "role", privilege: str = "read") -> DataFrame:
    """One row per listed role of objects with role access."""
    others = [c for c in df.columns if c not in (column, "access")]
    return df.filter(F.lower("access") == "role").select(
        *others,
        F.explode(column).alias("grantee_name"),
        F.lit(kind).alias("grantee_type"),
        F.lit(privilege).alias("privilege"),
    )


def token_inventory(df: DataFrame, as_of: Column | dt.datetime, secret: str = "token") -> DataFrame:
    """Unexpired tokens in id order with the secret blanked."""
    moment = instant_literal(df, "expire_at", as_of)
    return (
        df.filter(F.col("expire_at").isNull() | (F.col("expire_at") > moment))
        .withColumn(secret, F.lit(""))
        .orderBy("id")
    )


def active_tenants(tenants: DataFrame, suspended: DataFrame, key: str = "tenant_id") -> DataFrame:
    """All tenants except the suspended ones."""
    return sized_join(tenants, suspended.select(key).distinct(), [key], "left_anti")


def with_reject_reason(df: DataFrame, rules: Mapping[str, Column], name: str = "reject_reason") -> DataFrame:
    """Name of the first rule each row breaks, or null. A rule holds only when true."""
    reason = F.lit(None).cast("string")
    for rule, holds in reversed(list(rules.items())):
        reason = F.when(~F.coalesce(holds, F.lit(False)), F.lit(rule)).otherwise(reason)
    return df.withColumn(name, reason)


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with the reason."""
    marked = with_reject_reason(df, rules)
    valid = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, marked.filter(F.col("reject_reason").isNotNull())
