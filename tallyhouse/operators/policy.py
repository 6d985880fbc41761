"""Row policies, column masks, exposure and tenant routing.

Session values are bound as literals. A missing value is null, and null never
equals anything, so a policy without its input returns no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.joins import entitled_rows, sized_join


@dataclass(frozen=True)
class Session:
    """Who reads: user, email, roles and token context."""

    user: str | None = None
    email: str | None = None
    roles: frozenset[str] = frozenset()
    context: Mapping[str, str] = field(default_factory=dict)

    def has_role(self, role: str) -> Column:
        return F.lit(role in self.roles)

    def context_value(self, key: str) -> Column:
        return F.lit(self.context.get(key)).cast("string")


def row_policy(facts: DataFrame, entitlements: DataFrame, session: Session, **names: str) -> DataFrame:
    """Rows of the tenants the session user is entitled to."""
    return entitled_rows(facts, entitlements, session.user, **names)


def mask_column(df: DataFrame, column: str, role: str, session: Session) -> DataFrame:
    """The column for sessions that hold ``role``, null for all others."""
    return df.withColumn(column, F.when(session.has_role(role), F.col(column)))


def secure_usage(facts: DataFrame, entitlements: DataFrame, session: Session, pii_role: str) -> DataFrame:
    """Entitled usage rows with the contact column masked."""
    rows = row_policy(facts, entitlements, session)
    listed = rows.select("tenant_id", "usage_date", "event_count", "contact_email")
    return mask_column(listed, "contact_email", pii_role, session)


def context_policy(
    df: DataFrame, key: str, session: Session, column: str = "tenant_id", reader: str | None = None
) -> DataFrame:
    """Rows of the tenant named in the session context, for one reader identity."""
    rows = df.filter(F.col(column).cast("string") == session.context_value(key))
    if reader is not None:
        rows = rows.filter(F.lit(session.user).cast("string") == F.lit(reader))
    return rows


def row_predicate(df: DataFrame, session: Session, column: str = "tenant_id", measure: str = "event_count") -> DataFrame:
    """Own rows with a positive measure."""
    own = F.col(column).cast("string") == F.lit(session.user).cast("string")
    return df.filter(own & (F.col(measure) > 0))


def check_patterns(patterns: Sequence[str] | None) -> None:
    for p in patterns or ():
        if p is None or not p.strip():
            raise ValueError("include patterns must not be null or blank")
        if p != p.strip():
            raise ValueError(f"include pattern {p!r} has surrounding whitespace")
        if "," in "".join(p.split('"')[::2]):
            raise ValueError(f"include pattern {p!r} has a comma outside quotes")


def exposed_tables(catalog: DataFrame, patterns: Sequence[str] | None, views: DataFrame) -> DataFrame:
    """Tables a consumer can see, and whether a secure view guards them.

    No pattern list exposes every table and an empty list none. A secure view
    is visible even when its table is excluded.
    """
    check_patterns(patterns)
    path = F.concat_ws(".", "schema_name", "table_name")
    tables = catalog.select("schema_name", "table_name")
    if patterns is not None:
        tables = tables.filter(F.col("schema_name").isin(list(patterns)) | path.isin(list(patterns)))
    guarded = views.select("schema_name", F.col("view_name").alias("table_name"), F.lit(True).alias("__view"))
    return (
        tables.withColumn("__view", F.lit(False))
        .unionByName(guarded)
        .groupBy("schema_name", "table_name")
        .agg(F.max("__view").alias("has_secure_view"))
    )


def unprotected_tables(exposed: DataFrame, views: DataFrame) -> DataFrame:
    """Exposed tables without a secure view, which consumers see in full."""
    guarded = views.select("schema_name", F.col("view_name").alias("table_name")).distinct()
    keys = ["schema_name", "table_name"]
    return exposed.select(*keys).distinct().join(guarded, keys, "left_anti")


def visible_counts(
    facts: DataFrame, entitlements: DataFrame, consumers: DataFrame, tenant: str = "tenant_id", reader: str = "reader_name"
) -> DataFrame:
    """Rows each consumer would see, zero included.

    Facts are counted per tenant before the join, so the join handles tenants
    and never facts.
    """
    per_tenant = facts.filter(F.col(tenant).isNotNull()).groupBy(tenant).agg(F.count("*").alias("__rows"))
    per_reader = (
        sized_join(entitlements.select(reader, tenant), per_tenant, [tenant])
        .groupBy(reader)
        .agg(F.sum("__rows").alias("__rows"))
    )
    return (
        consumers.select(reader)
        .distinct()
        .join(per_reader, reader, "left")
        .select(reader, F.coalesce("__rows", F.lit(0)).cast("bigint").alias("visible_rows"))
    )


def policy_inventory(df: DataFrame) -> DataFrame:
    """Secure views by schema and name, with absent flags and column lists filled."""
    return df.select(
        "schema_name",
        "view_name",
        "sql",
        F.coalesce("replaces_table", F.lit(False)).alias("replaces_table"),
        F.coalesce("columns", F.array().cast("array<string>")).alias("columns"),
    ).orderBy("schema_name", "view_name")


def route_by_tenant(
    df: DataFrame, path: str, tenant: str = "tenant_id", within: Sequence[str] = (), separate: bool = True
) -> None:
    """Write rows to one folder per tenant, or pooled in tenant order.

    The range split covers tenant and ``within``, or the whole row, so a large
    tenant is written by many tasks and pooled files can be skipped by their
    statistics.
    """
    keys = [tenant, *within]
    split = keys if within else [tenant, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    ordered = df.repartitionByRange(*split).sortWithinPartitions(*keys)
    writer = ordered.write.mode("errorifexists")
    (writer.partitionBy(tenant) if separate else writer).parquet(path)


def offboard(
    facts: DataFrame, entitlements: DataFrame, tenant_value: object, tenant: str = "tenant_id"
) -> tuple[DataFrame, DataFrame]:
    """Facts and entitlements without the tenant. Rows without a tenant stay."""
    others = ~F.col(tenant).eqNullSafe(F.lit(tenant_value))
    return facts.filter(others), entitlements.filter(others)
