"""Parsing and normalising text columns."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Run states that count as failures, after normalising.
FAILED_STATES = ("failed", "error", "errored", "canceled", "cancelled", "timed_out", "timeout")
# Fixed value: prefix dropped from run states.
STATUS_PREFIX = "run_status_"

# Patterns of access-bearing share addresses, in the order they
# are applied. The first ends in a token, the second is a quoted literal, the
# third runs to whitespace.
TOKEN_ADDRESS = (
    r"(?i)md(?::|%3a)_share(?:/|%2f)[^/\r\n]*?(?:/|%2f)"
    r"\{?[0-9a-f]{8}(?:-?[0-9a-f]{4}){3}-?[0-9a-f]{12}[0-9a-f-]*\}?"
)
QUOTED_ADDRESS = r"""(?i)(['"])md(?::|%3a)_share(?:/|%2f)[^\r\n]*?(['"](?:[\s.,;:)\]}]|$))"""
PLAIN_ADDRESS = r"""(?i)md(?::|%3a)_share(?:/|%2f)\S*[^\s'".,;:)\]}]"""
REDACTED = "<redacted share URL>"

# Spellings of a type and the one name they stand for.
TYPE_ALIASES = {
    "BIGINT": "BIGINT", "INT8": "BIGINT", "LONG": "BIGINT", "INT64": "BIGINT",
    "BIT": "BIT", "BITSTRING": "BIT",
    "BLOB": "BLOB", "BYTEA": "BLOB", "BINARY": "BLOB", "VARBINARY": "BLOB",
    "BOOLEAN": "BOOLEAN", "BOOL": "BOOLEAN", "LOGICAL": "BOOLEAN",
    "DATE": "DATE",
    "DECIMAL": "DECIMAL(18,3)", "NUMERIC": "DECIMAL(18,3)", "DEC": "DECIMAL(18,3)",
    "DOUBLE": "DOUBLE", "FLOAT8": "DOUBLE", "DOUBLE PRECISION": "DOUBLE",
    "FLOAT": "FLOAT", "FLOAT4": "FLOAT", "REAL": "FLOAT",
    "HUGEINT": "HUGEINT", "INT128": "HUGEINT",
    "INTEGER": "INTEGER", "INT": "INTEGER", "INT4": "INTEGER", "SIGNED": "INTEGER", "INT32": "INTEGER",
    "INTERVAL": "INTERVAL",
    "JSON": "JSON",
    "SMALLINT": "SMALLINT", "INT2": "SMALLINT", "SHORT": "SMALLINT", "INT16": "SMALLINT",
    "TIME": "TIME",
    "TIMESTAMP": "TIMESTAMP", "DATETIME": "TIMESTAMP",
    "TIMESTAMP WITH TIME ZONE": "TIMESTAMP WITH TIME ZONE", "TIMESTAMPTZ": "TIMESTAMP WITH TIME ZONE",
    "TINYINT": "TINYINT", "INT1": "TINYINT",
    "UBIGINT": "UBIGINT", "UINTEGER": "UINTEGER", "USMALLINT": "USMALLINT", "UTINYINT": "UTINYINT",
    "UUID": "UUID", "GUID": "UUID",
    "VARCHAR": "VARCHAR", "CHAR": "VARCHAR", "BPCHAR": "VARCHAR", "TEXT": "VARCHAR", "STRING": "VARCHAR",
    "CHARACTER VARYING": "VARCHAR", "NVARCHAR": "VARCHAR",
}


def run_status(column: str | Column) -> Column:
    """Run state in lower case without its prefix."""
    return F.regexp_replace(F.lower(F.trim(column)), f"^{STATUS_PREFIX}", "")


def is_failure(column: str | Column) -> Column:
    return F.coalesce(run_status(column).isin(*FAILED_STATES), F.lit(False))


def text_flag(column: str | Column) -> Column:
    """True only for a true value or the text true; never null."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.lower(value.cast("string")) == "true", F.lit(False))


def optional_flag(column: str | Column) -> Column:
    """Boolean from boolean or text; anything but true and false is null."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    bare = F.trim(F.trim(text), F.lit('"'))
    return F.when(bare == "true", True).when(bare == "false", False)


def retention_days(column: str | Column) -> Column:
    """``7 days`` gives 7, ``00:00:00`` gives 0, anything else null."""
    text = F.col(column) if isinstance(column, str) else column
    days = F.regexp_extract(text, r"^\s*([+-]?\d+)\s+(?i:day)", 1)
    return F.when(days != "", days.cast("bigint")).when(text.startswith("00:00:00"), F.lit(0).cast("bigint"))


def utc_instant(column: str | Column) -> Column:
    """Text with an offset as an instant; text without one is null."""
    text = F.col(column) if isinstance(column, str) else column
    complete = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$")
    return F.when(complete, F.try_to_timestamp(text))


RFC_3339 = re.compile(r"\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d{1,6})?([Zz]|[+-]\d{2}:\d{2})")


def parse_instant(text: str) -> dt.datetime:
    """A bound given by the caller: an RFC 3339 time with its offset, no finer than microseconds."""
    if not RFC_3339.fullmatch(text):
        raise ValueError(f"{text!r} must be an RFC 3339 timestamp with a time zone offset")
    return dt.datetime.fromisoformat(text.upper()).astimezone(dt.timezone.utc)


def instant_literal(df: DataFrame, column: str, moment: dt.datetime | Column) -> Column:
    """``moment`` in the type of ``column``. Columns without a zone hold UTC."""
    if isinstance(moment, Column):
        return moment
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    if df.schema[column].dataType.typeName() == "timestamp_ntz":
        text = moment.astimezone(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(moment)


def view_body(column: str | Column) -> Column:
    """The query of a view definition: text after its first ``AS``, without a last semicolon."""
    text = F.col(column) if isinstance(column, str) else column
    start = F.instr(text, " AS ")
    body = F.substring(text, F.when(start > 0, start + F.lit(4)).otherwise(F.lit(4)), F.length(text))
    return F.regexp_replace(body, ";$", "")


def redact_addresses(column: str | Column, configured: str | None = None) -> Column:
    """Replace access-bearing share addresses. Quotes around them stay."""
    from urllib.parse import quote, quote_plus
    import re

    text = F.col(column) if isinstance(column, str) else column
    if configured:
        forms = (configured, quote_plus(configured), quote(configured, safe="$&+:=@"), configured.replace("'", "''"))
        for form in dict.fromkeys(forms):
            literal = "".join("\\" + c if re.match(r"[^\w\s]", c, re.ASCII) else c for c in form)
            text = F.regexp_replace(text, F.lit(f"(?i){literal}"), F.lit(REDACTED))
    redacted = F.regexp_replace(text, F.lit(TOKEN_ADDRESS), F.lit(REDACTED))
    redacted = F.regexp_replace(redacted, F.lit(QUOTED_ADDRESS), F.lit(f"$1{REDACTED}$2"))
    redacted = F.regexp_replace(redacted, F.lit(PLAIN_ADDRESS), F.lit(REDACTED))
    # Text without the word that every address holds skips the three patterns.
    return F.when(F.lower(text).contains("_share"), redacted).otherwise(text)


def json_text(column: str | Column) -> Column:
    """JSON value as text: strings unescaped, other values as written, null as null."""
    raw = F.col(column) if isinstance(column, str) else column
    bare = F.trim(raw, F.lit(" \t\r\n"))
    unescaped = F.from_json(F.concat(F.lit('{"v":'), bare, F.lit("}")), "v string")["v"]
    return F.when((bare == "") | (bare == "null"), None).when(bare.startswith('"'), unescaped).otherwise(raw)


def canonical_type(column: str | Column) -> Column:
    """One spelling per type, so ``INT`` equals ``INTEGER``.

    A type with a quote, such as an enum, keeps its text: what is quoted is case
    sensitive.
    """
    text = F.trim(column)
    shape = r"^([A-Za-z0-9_ ]+?)\s*(\([0-9, ]*\))?((?:\[\d*\])*)$"
    name = F.regexp_replace(F.upper(F.regexp_extract(text, shape, 1)), r"\s+", " ")
    args = F.regexp_replace(F.regexp_extract(text, shape, 2), r"\s", "")
    tail = F.regexp_extract(text, shape, 3)
    aliases = F.create_map(*[F.lit(v) for pair in TYPE_ALIASES.items() for v in pair])
    base = F.coalesce(F.element_at(aliases, name), name)
    one_arg = F.regexp_replace(args, r"^\((\d+)\)$", "($1,0)")
    decimal = F.when(args == "", base).otherwise(F.concat(F.lit("DECIMAL"), one_arg))
    plain = (
        F.when(base.startswith("DECIMAL"), decimal)
        .when(base == "VARCHAR", base)
        .otherwise(F.concat(base, args))
    )
    quoted = text.rlike("['\"]") | (name == "")
    return F.when(quoted, F.when(text.rlike("['\"]"), text).otherwise(F.upper(text))).otherwise(F.concat(plain, tail))


def number_order(column: str | Column) -> Column:
    """Sort key of number text of any length; it never passes through a double.

    Orders by sign, then whole digits by length and value, then fraction.
    """
    text = F.trim(column)
    digits = F.regexp_replace(F.regexp_extract(text, r"^[+-]?0*(\d*)", 1), "^$", "0")
    whole = F.when(digits == "", "0").otherwise(digits)
    fraction = F.regexp_replace(F.regexp_extract(text, r"\.(\d*)$", 1), "0+$", "")
    zero = (whole == "0") & (fraction == "")
    negative = text.startswith("-") & ~zero
    flipped = F.translate(whole, "0123456789", "9876543210")
    # A shorter fraction is smaller; ':' sorts after every digit, so it makes a
    # shorter fraction larger once the digits are flipped.
    flipped_fraction = F.concat(F.translate(fraction, "0123456789", "9876543210"), F.lit(":"))
    return F.struct(
        F.when(negative, -1).when(zero, 0).otherwise(1).alias("sign"),
        F.when(negative, -F.length(whole)).otherwise(F.length(whole)).alias("size"),
        F.when(negative, flipped).otherwise(whole).alias("whole"),
        F.when(negative, flipped_fraction).otherwise(fraction).alias("fraction"),
    )
