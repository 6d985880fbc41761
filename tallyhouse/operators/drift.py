"""Comparing catalogs, definitions, states and table versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.names import ascii_folded
from tallyhouse.operators.aggregates import all_true, name_list
from tallyhouse.operators.joins import same

#: Ranges of key hashes that are compared as wholes; the driver sees at most so many numbers.
RANGES = 4096

# Identity fields of a managed object; versions may change.
IDENTITY_FIELDS = ("id", "uuid", "created_ts", "created_at", "run_number")
VERSION_FIELDS = ("current_version", "version")


def match_catalog(rows: DataFrame, names: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The catalog row each wanted name resolves to.

    The exact spelling wins over one that differs in ASCII case. ``names`` has
    the same ``parts`` columns as ``rows``; the spelling found is returned as
    ``found_<part>``.
    """
    wanted = names.select(*parts, *[ascii_folded(p).alias(f"__f_{p}") for p in parts]).distinct()
    found = rows.select(
        *[F.col(p).alias(f"found_{p}") for p in parts],
        *[ascii_folded(p).alias(f"__f_{p}") for p in parts],
        *[F.col(c) for c in rows.columns if c not in parts],
    )
    exact = F.lit(True)
    for p in parts:
        exact = exact & (F.col(p) == F.col(f"found_{p}"))
    best = Window.partitionBy(*parts).orderBy(F.desc("is_exact"), *[F.col(f"found_{p}") for p in parts])
    joined = wanted.join(found, [f"__f_{p}" for p in parts]).withColumn("is_exact", exact)
    return joined.withColumn("__rn", F.row_number().over(best)).filter("__rn = 1").drop("__rn", *[f"__f_{p}" for p in parts])


def definition_drift(stored: DataFrame, live: DataFrame, keys: Sequence[str], definition: str = "definition") -> DataFrame:
    """Stored against live definitions: same, changed, missing or unmanaged.

    Whitespace at the ends does not count.
    """
    strip = F.regexp_replace(F.col(definition), r"^\s+|\s+$", "")
    left = stored.select(*keys, strip.alias("__stored"), F.lit(True).alias("__s"))
    right = live.select(*keys, strip.alias("__live"), F.lit(True).alias("__l"))
    status = (
        F.when(F.col("__l").isNull(), "missing")
        .when(F.col("__s").isNull(), "unmanaged")
        .when(same(F.col("__stored"), F.col("__live")), "same")
        .otherwise("changed")
    )
    return left.join(right, list(keys), "full_outer").select(*keys, status.alias("status"))


def identity_drift(before: DataFrame, after: DataFrame, changes: DataFrame) -> DataFrame:
    """Objects on both sides whose identity changed without a planned reason.

    Planned deletes and snapshot renames are excluded, and version columns are
    not compared. ``changes`` has ``address``, ``kind``, ``actions`` and the
    planned ``before_name`` and ``after_name``.
    """
    excused = changes.filter(
        F.array_contains("actions", "delete")
        | ((F.col("kind") == "snapshot") & ~same(F.col("before_name"), F.col("after_name")))
    ).select("address")
    fields = [c for c in IDENTITY_FIELDS if c in before.columns and c in after.columns]
    old = before.select("address", F.struct(*fields).alias("__old"))
    new = after.select("address", F.struct(*fields).alias("__new"))
    changed = F.filter(
        F.array(*[F.when(~same(F.col(f"__old.{c}"), F.col(f"__new.{c}")), F.lit(c)) for c in fields]),
        lambda c: c.isNotNull(),
    )
    return (
        old.join(new, "address")
        .filter(~same(F.col("__old"), F.col("__new")))
        .join(excused, "address", "left_anti")
        .select("address", changed.alias("changed_fields"))
    )


def classify_actions(changes: DataFrame) -> DataFrame:
    """Planned action per address: replace, delete, create, update or no-op."""
    def has(action: str):
        return F.array_contains("actions", action)

    label = (
        F.when(has("delete") & has("create"), "replace")
        .when(has("delete"), "delete")
        .when(has("create"), "create")
        .when(F.col("actions") == F.array(F.lit("no-op")), "no-op")
        .otherwise("update")
    )
    return changes.select("address", label.alias("action"), (label == "replace").alias("is_replacement"))


def is_noop(changes: DataFrame) -> DataFrame:
    """Whether the plan changes nothing."""
    return classify_actions(changes).agg(all_true(F.col("action") == "no-op").alias("is_noop"))


def table_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row diff of two versions by unique key: added, removed or changed rows.

    ``changed_columns`` names what differs; null equals null.
    """
    values = [c for c in old.columns if c in new.columns and c not in keys]
    left = old.select(*keys, F.struct(*values).alias("__old"))
    right = new.select(*keys, F.struct(*values).alias("__new"))
    renamed = {k: f"__k{i}" for i, k in enumerate(keys)}
    on = [same(F.col(k), F.col(r)) for k, r in renamed.items()]
    changed = F.filter(
        F.array(*[F.when(~same(F.col(f"__old.{c}"), F.col(f"__new.{c}")), F.lit(c)) for c in values]),
        lambda c: c.isNotNull(),
    )
    status = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").otherwise("changed")
    return (
        left.join(right.withColumnsRenamed(renamed), on, "full_outer")
        .filter(~same(F.col("__old"), F.col("__new")))
        .select(
            *[F.coalesce(F.col(k), F.col(r)).alias(k) for k, r in renamed.items()],
            status.alias("status"),
            F.when(status == "changed", changed).otherwise(F.array().cast("array<string>")).alias("changed_columns"),
        )
    )


def differing_ranges(old: DataFrame, new: DataFrame, keys: Sequence[str], ranges: int = RANGES) -> list[int]:
    """Ranges of key hashes in which two versions differ.

    Each side is one pass that sends at most ``ranges`` rows per task. A range
    counts as equal if both sides have as many rows and two sums of 64-bit row
    hashes agree.
    """
    columns = [c for c in old.columns if c in new.columns]
    values = [F.col(f"`{c}`") for c in columns]
    nulls = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])

    def summary(side: DataFrame, sign: int) -> DataFrame:
        hashed = [F.xxhash64(F.lit(seed), nulls, *values).cast("decimal(38,0)") for seed in (0, 1)]
        sums = [F.sum(h * sign).alias(f"h{i}") for i, h in enumerate(hashed)]
        place = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(ranges)).cast("int")
        return side.groupBy(place.alias("range")).agg(F.sum(F.lit(sign)).alias("n"), *sums)

    both = summary(old, 1).unionByName(summary(new, -1)).groupBy("range")
    sums = both.agg(F.sum("n").alias("n"), F.sum("h0").alias("h0"), F.sum("h1").alias("h1"))
    return sorted(r["range"] for r in sums.filter("n <> 0 OR h0 <> 0 OR h1 <> 0").collect())


def table_diff_by_range(old: DataFrame, new: DataFrame, keys: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """The row diff of ``table_diff``, with only the rows of ranges that differ joined.

    Both sides need key columns of the same types. The ranges are found when
    this is called; the sides have to give the same rows when read again.
    """
    found = differing_ranges(old, new, keys, ranges)
    place = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(ranges)).cast("int")
    wanted = F.array(*[F.lit(r) for r in found]) if found else F.array().cast("array<int>")
    hit = F.array_contains(wanted, place) if len(found) < ranges else F.lit(True)
    return table_diff(old.filter(hit), new.filter(hit), keys)


def leftovers(objects: DataFrame, prefix: str, *, part_size: int) -> DataFrame:
    """Names with a test prefix per kind, ``part_size`` names to a text; a clean kind shows an empty one."""
    marked = objects.select("kind", F.when(F.col("name").startswith(prefix), F.col("name")).alias("name"))
    return name_list(marked, "name", ", ", ["kind"], part_size=part_size)
