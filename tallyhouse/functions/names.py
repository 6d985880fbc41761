"""Names, keys and membership."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def same_name(left: str | Column, right: str | Column) -> Column:
    """Equal in any letter case, over all of Unicode: databases, shares, roles, users."""
    return F.lower(left) == F.lower(right)


def ascii_folded(column: str | Column) -> Column:
    """Lower case for A to Z only: schemas, tables, views, columns."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def same_catalog_name(left: str | Column, right: str | Column) -> Column:
    return ascii_folded(left) == ascii_folded(right)


def typed_key(kind: str | Column, name: str | Column) -> Column:
    return F.concat_ws(":", kind, name)


def path_key(*parts: str | Column) -> Column:
    return F.concat_ws("/", *parts)


def slug(preferred: str | Column, fallback: str | Column) -> Column:
    """Lower-case name with everything but letters, digits and underscore replaced."""
    return F.regexp_replace(F.lower(F.coalesce(preferred, fallback)), "[^a-z0-9_]", "_")


def contains_name(names: str | Column, value: str | Column) -> Column:
    """Whether an array holds the name in any letter case."""
    wanted = F.lower(value)
    return F.exists(names, lambda n: F.lower(n) == wanted)


def shown_if(condition: Column, column: str | Column) -> Column:
    """The column where the condition holds, null elsewhere."""
    return F.when(condition, F.col(column) if isinstance(column, str) else column)
