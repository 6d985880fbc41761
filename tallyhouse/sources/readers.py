"""Reading JSON batches, CSV, lake tables and file listings."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_key(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Fail the whole batch when any row lacks a non-empty merge key.

    The check is part of the projection, so it costs no extra pass, and a write
    of the batch fails before it is committed.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    guarded = {}
    for k in keys:
        value = F.col(k)
        missing = value.isNull()
        if isinstance(df.schema[k].dataType, T.StringType):
            missing = missing | (value == "")
        failure = F.raise_error(F.lit(f"every row needs a {k} merge key")).cast(df.schema[k].dataType)
        guarded[k] = F.when(missing, failure).otherwise(value)
    return df.withColumns(guarded)


def read_keyed_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, key: str | Sequence[str], multiline: bool = True
) -> DataFrame:
    """Rows of JSON arrays of objects; a row that is no object or lacks its key fails the batch.

    One file is one array. With ``multiline=False`` every line is an array or an
    object, and large files are split between tasks.
    """
    rows = spark.read.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST").json(path)
    return require_key(rows, key)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred in an extra pass."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def lake_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The parquet table below ``path``. A known schema saves reading footers."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def generate_rows(spark: SparkSession, n: int, label: str) -> DataFrame:
    """``n`` rows with an id and a constant label, made on the executors."""
    return spark.range(n).select(F.col("id"), F.lit(label).alias("label"))


def generate_per_row(df: DataFrame, key: str, count: str, label: str) -> DataFrame:
    """``count`` numbered rows for each row of a table; none where the count is null or below one."""
    numbers = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(count).cast("bigint")))
    return df.filter(F.col(count) >= 1).select(key, numbers.alias("id"), F.lit(label).alias("label"))


def list_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Files and folders below ``path``: name, type, size, last_modified.

    Only the listing is read, never file contents. Folders are the first path
    segments of deeper files and have no size or time.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("last_modified"))
    )
    root = re.sub(r"^[a-z][a-z0-9+.-]*:/*", "/", path).rstrip("/") + "/"
    start = F.instr("path", F.lit(root)) + F.lit(len(root))
    rows = listed.withColumn("name", F.substring("path", start, F.length("path")))
    files = rows if recursive else rows.filter(~F.col("name").contains("/"))
    folders = rows.filter(F.col("name").contains("/")).select(
        F.substring_index("name", "/", 1).alias("name"), F.lit("folder").alias("type")
    ).distinct()
    return files.select("name", F.lit("file").alias("type"), F.col("length").alias("size"), "last_modified").unionByName(
        folders, allowMissingColumns=True
    )


def data_files(df: DataFrame) -> DataFrame:
    """The files a table is read from, with size and row count.

    No data column is read, and each task reports a file once.
    """
    return df.groupBy(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
    ).agg(F.count("*").alias("rows"))
