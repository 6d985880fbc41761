"""Values as text: intervals, times, blobs, UUIDs and whole rows."""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blob_text(column: str | Column) -> Column:
    return F.lower(F.hex(column))


def uuid_text(column: str | Column) -> Column:
    """Sixteen bytes as dashed lower-case text."""
    digits = blob_text(column)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digits, start, n) for start, n in cuts])


def time_text(column: str | Column, zone: str = "Z") -> Column:
    """RFC 3339 text; the fraction loses its trailing zeros."""
    stamp = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(stamp, r"\.?0+$", ""), F.lit(zone))


def _count(n: Column, unit: str) -> Column:
    name = F.when(F.abs(n) == 1, F.lit(f" {unit}")).otherwise(F.lit(f" {unit}s"))
    return F.when(n != 0, F.concat(n.cast("string"), name))


def interval_text(months: Column, days: Column, micros: Column) -> Column:
    """Interval parts as text, for example ``1 year 2 months 03:04:05.5``.

    Years and months divide toward zero. The clock is exact for every 64-bit
    value, the smallest one included.
    """
    months, days = months.cast("bigint"), days.cast("bigint")
    whole = micros.cast("decimal(20,0)")
    size = F.abs(whole)

    def part(unit: int, wrap: int | None) -> Column:
        n = F.floor((size - size % F.lit(unit)) / F.lit(unit)).cast("bigint")
        return n if wrap is None else n % F.lit(wrap)

    hours, minutes, seconds = part(3_600_000_000, None), part(60_000_000, 60), part(1_000_000, 60)
    fraction = F.regexp_replace(F.lpad((size % F.lit(1_000_000)).cast("bigint").cast("string"), 6, "0"), "0+$", "")
    hour_text = F.when(hours < 100, F.lpad(hours.cast("string"), 2, "0")).otherwise(hours.cast("string"))
    clock = F.concat(
        F.when(whole < 0, F.lit("-")).otherwise(F.lit("")),
        hour_text,
        F.lit(":"),
        F.lpad(minutes.cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad(seconds.cast("string"), 2, "0"),
        F.when(fraction == "", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
    )
    years = (months - months % F.lit(12)) / F.lit(12)
    text = F.concat_ws(
        " ",
        _count(years.cast("bigint"), "year"),
        _count(months % F.lit(12), "month"),
        _count(days, "day"),
        F.when(whole != 0, clock),
    )
    known = months.isNotNull() & days.isNotNull() & micros.isNotNull()
    return F.when(known & (text == ""), F.lit("00:00:00")).when(known, text)


def decimal_text(column: Column, scale: int) -> Column:
    """The exact decimal without exponent and without trailing zeros."""
    if scale <= 0:
        return column.cast("string")
    if scale == 38:  # no room for a digit before the point
        return F.regexp_replace(column.cast("string"), r"\.?0+$", "")
    size = F.abs(column)
    one_more = ((size % F.lit(1)).cast(f"decimal({scale + 1},{scale})") + F.lit(1)).cast(f"decimal({scale + 1},{scale})")
    sign = F.when(column < 0, F.lit("-")).otherwise(F.lit(""))  # from one on, no text has an exponent
    fraction = F.regexp_replace(F.substr(one_more.cast("string"), F.lit(2)), r"\.?0+$", "")
    return F.concat(sign, F.floor(size).cast("decimal(38,0)").cast("string"), fraction)


def utc_text(column: Column, kind: T.DataType) -> Column:
    """RFC 3339 text in UTC, whatever the zone of the session. A time without a zone holds UTC."""
    if isinstance(kind, T.TimestampType):
        seconds = (F.unix_micros(column) * F.lit(Decimal("0.000001"))).cast("decimal(18,6)")
        column = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.concat(F.replace(column.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def value_text(column: Column, kind: T.DataType) -> Column:
    """The value as it stands in a JSON text, without the quotes of a string; null stays null."""
    zero = F.lit(0).cast("bigint")
    if isinstance(kind, T.BinaryType):
        return blob_text(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return utc_text(column, kind)
    if isinstance(kind, T.DateType):
        return F.concat(column.cast("string"), F.lit("T00:00:00Z"))
    if isinstance(kind, T.DecimalType):
        return decimal_text(column, kind.scale)
    if isinstance(kind, T.DayTimeIntervalType):
        seconds = column.cast(T.DayTimeIntervalType(0, 3))
        micros = F.extract(F.lit("SECOND"), seconds) * 1_000_000 + (
            F.extract(F.lit("MINUTE"), seconds).cast("bigint") * 60 + F.extract(F.lit("HOUR"), seconds).cast("bigint") * 3600
        ) * 1_000_000
        return interval_text(zero, F.extract(F.lit("DAY"), seconds), micros)
    if isinstance(kind, T.YearMonthIntervalType):
        spread = column.cast(T.YearMonthIntervalType(0, 1))
        months = F.extract(F.lit("YEAR"), spread) * 12 + F.extract(F.lit("MONTH"), spread)
        return interval_text(months, zero, zero)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.when(column.isNotNull(), json_value(column, kind))
    return column.cast("string")


def _leaf(column: Column) -> Column:
    """A number, boolean or string as JSON: what Spark writes for it inside an object."""
    whole = F.to_json(F.struct(column.alias("v")), {"ignoreNullFields": "false"})
    return F.substr(whole, F.lit(6), F.length(whole) - 6)


def _comma(items: Column, left: str, right: str) -> Column:
    return F.concat(F.lit(left), F.array_join(items, ","), F.lit(right))


def json_value(column: Column, kind: T.DataType) -> Column:
    """The value as JSON text, never null. Fields of a struct are in name order, entries of a map in their own."""
    if isinstance(kind, T.ArrayType):
        text = _comma(F.transform(column, lambda v: json_value(v, kind.elementType)), "[", "]")
    elif isinstance(kind, T.MapType):
        def entry(e: Column) -> Column:
            return F.concat(_leaf(value_text(e["key"], kind.keyType)), F.lit(":"), json_value(e["value"], kind.valueType))

        text = _comma(F.transform(F.map_entries(column), entry), "{", "}")
    elif isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        pairs = [F.concat(F.lit(json.dumps(f.name, ensure_ascii=False) + ":"), json_value(column[f.name], f.dataType)) for f in fields]
        text = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    elif isinstance(kind, T.VariantType):
        text = F.to_json(column)
    elif isinstance(kind, (T.DecimalType, T.IntegralType)):
        text = value_text(column, kind)
    elif isinstance(kind, (T.BooleanType, T.FractionalType)):
        text = _leaf(column)
    else:
        text = _leaf(value_text(column, kind))
    return F.when(column.isNull(), F.lit("null")).otherwise(text)


def rows_json(df: DataFrame) -> DataFrame:
    """One JSON object per row: exact decimals, RFC 3339 times, hex blobs, nulls kept.

    Columns are lower-cased and in name order; of two that collide the later one wins.
    """
    latest = {field.name.lower(): i for i, field in enumerate(df.schema.fields)}
    unique = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    row = T.StructType([T.StructField(name, df.schema.fields[i].dataType) for name, i in latest.items()])
    return unique.select(json_value(F.struct(*[F.col(f"c{i}").alias(name) for name, i in latest.items()]), row).alias("row_json"))
