"""Scalar functions against stated values and DuckDB."""

import datetime as dt
import hashlib
import json
import urllib.parse
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import names, parse, render


def apply(spark, function, values, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    return [r["o"] for r in df.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]


INTERVALS = [
    "INTERVAL 7 DAY", "INTERVAL 1 DAY", "INTERVAL 0 DAY", "INTERVAL 1 MONTH", "INTERVAL 12 MONTH", "INTERVAL 14 MONTH",
    "INTERVAL 100 HOUR", "INTERVAL 1000000 HOUR", "INTERVAL 1 MICROSECOND", "INTERVAL 1 MILLISECOND",
    "INTERVAL 1 DAY + INTERVAL 1 SECOND", "INTERVAL '1 year 2 months 3 days 04:05:06.789'", "INTERVAL '-1 year'",
    "INTERVAL '-14 months'", "INTERVAL '-1 month'", "INTERVAL '-3 days'", "INTERVAL '-1 hour'", "INTERVAL '-00:00:00.5'",
    "INTERVAL '1 year -2 months'", "INTERVAL '1 day -01:00:00'", "INTERVAL '-1 year -1 day -00:00:01'", "INTERVAL '0.123456 seconds'",
]


def test_interval_text_equals_the_duckdb_cast(spark):
    con = duckdb.connect()
    parts, want = [], []
    for e in INTERVALS:
        sql = f"""SELECT datepart('year', {e}) * 12 + datepart('month', {e}), datepart('day', {e}),
            datepart('hour', {e}) * 3600000000 + datepart('minute', {e}) * 60000000 + datepart('microsecond', {e}), CAST({e} AS VARCHAR)"""
        months, days, micros, text = con.sql(sql).fetchall()[0]
        parts.append((len(parts), months, days, micros))
        want.append(text)
    df = spark.createDataFrame(parts, "i int, months bigint, days bigint, micros bigint")
    got = df.select("i", render.interval_text(F.col("months"), F.col("days"), F.col("micros")).alias("o")).orderBy("i")
    assert [r["o"] for r in got.collect()] == want


def test_interval_text_of_the_smallest_value_and_null(spark):
    df = spark.createDataFrame([(0, 0, -(2**63)), (0, 0, None)], "m bigint, d bigint, u bigint")
    got = [r[0] for r in df.select(render.interval_text(F.col("m"), F.col("d"), F.col("u"))).collect()]
    assert got == ["-2562047788:00:54.775808", None]


def test_rows_json_keeps_every_value_exact(spark):
    df = spark.sql(
        f"""SELECT {2**62 + 1} AS whole, CAST('{10**30 + 7}.25' AS DECIMAL(38,2)) AS wide, map('north', CAST(0.75 AS DECIMAL(6,2))) AS rates,
        named_struct('token', X'0FF1', 'pause', INTERVAL '3' DAY) AS inner, array(X'01', X'FE') AS bytes, TIMESTAMP_NTZ '2024-02-29 06:07:08.25' AS Seen,
        INTERVAL '25' MONTH AS term, INTERVAL '0 00:00:01.5' DAY TO SECOND AS lag, CAST(NULL AS INT) AS gone"""
    )
    got = render.rows_json(df).first()["row_json"]
    assert got == (
        '{"bytes":["01","fe"],"gone":null,"inner":{"pause":"3 days","token":"0ff1"},"lag":"00:00:01.5","rates":{"north":0.75},'
        f'"seen":"2024-02-29T06:07:08.25Z","term":"2 years 1 month","whole":{2**62 + 1},"wide":{10**30 + 7}.25}}'
    )
    json.loads(got)


def test_rows_json_of_small_numbers_and_keys(spark):
    df = spark.sql(
        """SELECT CAST(0 AS DECIMAL(38,9)) AS zero, CAST(0.000000001 AS DECIMAL(38,9)) AS tiny, CAST(-120.50 AS DECIMAL(9,2)) AS trimmed,
        CAST(700 AS DECIMAL(9,0)) AS whole, map(X'0A', 1) AS raw, map(TIMESTAMP_NTZ '2024-01-01 00:00:00', CAST(NULL AS INT)) AS times,
        map(CAST(1.50 AS DECIMAL(9,2)), 'a"b') AS rates, named_struct('b', CAST(NULL AS STRING), 'a', array(0.25D, NULL)) AS pair"""
    )
    assert render.rows_json(df).first()["row_json"] == (
        '{"pair":{"a":[0.25,null],"b":null},"rates":{"1.5":"a\\"b"},"raw":{"0a":1},"times":{"2024-01-01T00:00:00Z":null},'
        '"tiny":0.000000001,"trimmed":-120.5,"whole":700,"zero":0}'
    )


def test_json_times_are_utc_in_any_session(spark):
    df = spark.sql("SELECT timestamp_micros(1704067200250000) AS at, TIMESTAMP_NTZ '2024-03-10 02:30:00' AS wall")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert render.rows_json(df).first()["row_json"] == '{"at":"2024-01-01T00:00:00.25Z","wall":"2024-03-10T02:30:00Z"}'
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_the_later_of_two_colliding_columns_wins(spark):
    df = spark.range(1).select(F.lit(1).alias("X"), F.lit(2).alias("x"))
    assert render.rows_json(df).first()["row_json"] == '{"x":2}'


def test_uuid_blob_and_time(spark):
    row = spark.range(1).select(
        render.uuid_text(F.unhex(F.lit("FDD482F5740B4E96B2582702D4A69945"))),
        render.blob_text(F.unhex(F.lit("AA0B"))),
        render.time_text(F.lit("2026-11-01 00:00:00").cast("timestamp_ntz")),
    ).first()
    assert tuple(row) == ("fdd482f5-740b-4e96-b258-2702d4a69945", "aa0b", "2026-11-01T00:00:00Z")


@pytest.mark.parametrize(
    "raw,want",
    [
        ('[1, {"k": null}]', '[1, {"k": null}]'), ("-0.50", "-0.50"), ("false", "false"), (None, None), ('"tab\\there"', "tab\there"),
        (f"{2**70}", f"{2**70}"), ('  "x y"', "x y"), ("null", None), ("", None), ('"\\u00e9"', "é"),
    ],
)
def test_json_text(spark, raw, want):
    assert apply(spark, parse.json_text, [raw]) == [want]


TOKEN = hashlib.md5(b"own token").hexdigest()
TOKENS = (TOKEN, TOKEN.upper(), str(uuid.UUID(hex=TOKEN)))
RED = parse.REDACTED


def messages():
    """Addresses of several names and token forms, bare, quoted and percent-encoded, with the text around them."""
    for name in ("north", "two words", "x+y"):
        for token in TOKENS:
            address = f"md:_share/{name}/{token}"
            yield f"opening {address} took long", f"opening {RED} took long"
            for mark in "'\"":
                yield f"no access to {mark}{address}{mark}; retry", f"no access to {mark}{RED}{mark}; retry"
            yield f"first {address} and then {address}.", f"first {RED} and then {RED}."
        yield f"call {urllib.parse.quote(f'md:_share/{name}/{TOKEN}', safe='')} ended", f"call {RED} ended"
    yield "try md:_share/alpha/beta, again", f"try {RED}, again"
    yield "nothing to hide in 'this' text", "nothing to hide in 'this' text"
    yield None, None


REDACTIONS = list(messages())


def test_redaction(spark):
    assert apply(spark, parse.redact_addresses, [m for m, _ in REDACTIONS]) == [w for _, w in REDACTIONS]


def test_redaction_of_a_configured_address_in_any_form(spark):
    configured = "md:_share/team data/it's latest"
    messages = [
        f"no {configured.upper()} here", "no md%3A_share%2Fteam+data%2Fit%27s+latest here",
        "no 'md:_share/team data/it''s latest' here", "plain (text) $1 .* stays",
    ]
    got = apply(spark, lambda c: parse.redact_addresses(c, configured), messages)
    assert got == [f"no {RED} here", f"no {RED} here", f"no '{RED}' here", "plain (text) $1 .* stays"]


def test_retention(spark):
    values = ["7 days", "1 day", "00:00:00", "unparsable", "2 months", None, "30 DAYS"]
    assert apply(spark, parse.retention_days, values) == [7, 1, 0, None, None, None, 30]


def test_status_and_flags(spark):
    assert apply(spark, parse.run_status, [" RUN_STATUS_Failed ", "ok", None]) == ["failed", "ok", None]
    states = ["RUN_STATUS_CANCELLED", "errored", "timeout", "succeeded", None, "failed2"]
    assert apply(spark, parse.is_failure, states) == [True, True, True, False, False, False]
    assert apply(spark, parse.text_flag, ["true", "TRUE", "false", "yes", None]) == [True, True, False, False, False]
    assert apply(spark, parse.optional_flag, ["true", ' "true" ', "false", "TRUE", None]) == [True, True, False, None, None]
    assert apply(spark, parse.text_flag, [True, False, None], "v boolean") == [True, False, False]


def test_instants(spark):
    values = ["2026-11-01T02:00:00+02:00", "2026-11-01T00:00:00Z", "2026-11-01T00:00:00", "2026-11-01", "2026-13-01T00:00:00Z"]
    midnight = dt.datetime(2026, 11, 1)
    got = apply(spark, lambda c: F.date_format(parse.utc_instant(c), "yyyy-MM-dd HH:mm"), values)
    assert got == [f"{midnight:%Y-%m-%d %H:%M}"] * 2 + [None] * 3
    for bad in ("2026-11-01T00:00:00", "2026-11-01", "soon"):
        with pytest.raises(ValueError):
            parse.parse_instant(bad)


def test_names(spark):
    assert apply(spark, names.ascii_folded, ["ÄbC", "Z_9"]) == ["Äbc", "z_9"]
    df = spark.createDataFrame([("Äpfel", "äpfel"), ("App", "aPP")], "a string, b string")
    got = [tuple(r) for r in df.select(names.same_name("a", "b"), names.same_catalog_name("a", "b")).collect()]
    assert got == [(True, False), (True, True)]
    df = spark.createDataFrame([(None, "Acme-EU 1"), ("Own Slug", "x")], "slug string, id string")
    assert [r[0] for r in df.select(names.slug("slug", "id")).collect()] == ["acme_eu_1", "own_slug"]


def test_view_body(spark):
    values = ["CREATE VIEW v AS SELECT ' AS ' AS a;", "CREATE VIEW v AS SELECT 1", None]
    assert apply(spark, parse.view_body, values) == ["SELECT ' AS ' AS a", "SELECT 1", None]


def test_type_aliases_equal_duckdb(spark):
    types = ["int", "INT4", "bigint", "Varchar(10)", "text", "numeric", "decimal(10, 2)", "DECIMAL(5)", "float8", "real",
             "double precision", "timestamptz", "datetime", "bool", "bytea", "int[]", "TEXT[3]", "uuid", "smallint", "date"]
    want = [duckdb.sql(f"SELECT typeof(CAST(NULL AS {t}))").fetchall()[0][0] for t in types]
    assert apply(spark, parse.canonical_type, types) == want
    labels = ["ENUM('ok', 'Sad')", "ENUM('ok', 'sad')", "my_type"]
    assert apply(spark, parse.canonical_type, labels) == ["ENUM('ok', 'Sad')", "ENUM('ok', 'sad')", "MY_TYPE"]


def test_number_text_sorts_as_numbers(spark):
    numbers = ["-170141183460469231731687303715884105728", "-12.5", "-12.25", "-12.2", "-12", "-0.5", "0", "0.5", "2", "9.75", "9.8", "10",
               "9007199254740992", "9007199254740993", "170141183460469231731687303715884105727"]
    df = spark.createDataFrame([(n,) for n in numbers[::-1]], "n string").repartition(3)
    assert [r["n"] for r in df.orderBy(parse.number_order("n")).collect()] == numbers
