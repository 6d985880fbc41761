"""Parquet tables with atomic versions.

A table is a folder with ``data/<unique>`` folders and a ``log`` of versions.
Data is written first. A version exists once its log row is committed, so a
failed job leaves no trace a reader could see, and a table can be read while it
is refreshed. A log row is moved to the place of its version, which only the
first of several writers can do.

A log row names the folders a version adds and those it takes away; now and
then a row names all of them, so a version is read from few rows and a commit
does not repeat what has been there before. A table may be laid out by key: its
rows then lie in one folder per bucket of the key's hash.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Sequence
from typing import NamedTuple
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.joins import sized_join
from tallyhouse.operators.ranking import latest_revision
from tallyhouse.sources.readers import require_key

LOG = (
    "version bigint, committed_at timestamp, schema_json string, layout_json string, added array<string>, "
    "removed array<string>, paths array<string>, note string"
)
#: Every so many versions a log row names all folders.
WHOLE_EVERY = 32
BUCKETS = 64
BUCKET = "__bucket"
#: File systems whose rename is no single step, so that two writers could both win.
NO_ATOMIC_RENAME = ("s3", "s3a", "s3n", "gs", "oss", "cosn", "swift")


class Layout(NamedTuple):
    """Rows are dealt to buckets by the hash of their key, taken with the types of the table."""

    keys: tuple[str, ...]
    buckets: int

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int")


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def log(self) -> DataFrame | None:
        """The version log, or nothing when the table was never written."""
        try:
            return self.spark.read.schema(LOG).option("recursiveFileLookup", "true").parquet(f"{self.path}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def entry(self, version: int | None = None) -> Row | None:
        """What a version consists of, by default the newest. Readers resolve it once.

        It is put together from the last log row that names all folders and
        the rows after it.
        """
        log = self.log()
        if log is None:
            return None
        rows = log if version is None else log.filter(F.col("version") <= version)
        steps = rows.orderBy(F.desc("version")).limit(WHOLE_EVERY).collect()
        if not steps or version not in (None, steps[0]["version"]):
            return None
        paths: dict[str, None] = {}
        for step in reversed(steps[: next(i for i, s in enumerate(steps) if s["paths"] is not None) + 1]):
            if step["paths"] is not None:
                paths = dict.fromkeys(step["paths"])
            else:
                for gone in step["removed"]:
                    del paths[gone]
                paths |= dict.fromkeys(step["added"])
        last = steps[0]
        return Row(
            version=last["version"],
            schema_json=last["schema_json"],
            layout_json=last["layout_json"],
            paths=[f"{self.path}/{p}" for p in paths],
            note=last["note"],
        )

    def version(self) -> int:
        return number_of(self.entry())

    def read(self, version: int | None = None) -> DataFrame:
        entry = self.entry(version)
        if entry is None:
            raise LookupError(f"{self.path} has no version {version or ''}".rstrip())
        return self.rows_of(entry["paths"], schema_of(entry))

    def rows_of(self, paths: Sequence[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def stage(self, df: DataFrame, layout: Layout | None = None) -> list[str]:
        """Write rows to folders nobody reads yet, one per bucket that has rows if there is a layout.

        A bucket's rows are written by as many tasks as their size asks for.
        """
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        if layout is None:
            df.write.mode("errorifexists").parquet(folder)
            return [folder]
        dealt = df.withColumn(BUCKET, layout.bucket()).hint("rebalance", F.col(BUCKET))
        dealt.write.mode("errorifexists").partitionBy(BUCKET).parquet(folder)
        schema = T.StructType([*df.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        written = self.spark.read.schema(schema).parquet(folder).select(BUCKET).distinct().collect()
        return [f"{folder}/{BUCKET}={b}" for b in sorted(r[BUCKET] for r in written)]

    def commit(
        self, paths: Sequence[str], schema: T.StructType, note: str = "", base: int | None = None, layout: Layout | None = None
    ) -> int:
        """Make the folders the next version after ``base``, by default after the newest.

        A writer that read version ``base`` commits on top of it. If another one
        did so meanwhile, this one fails and the table stays as the other left it.
        That takes a file system whose rename is one step; others are refused.
        """
        if urlparse(self.path).scheme in NO_ATOMIC_RENAME:
            raise ValueError(f"{self.path} lies where a rename is no single step; keep tables on another file system")
        before = None if base == 0 else self.entry(base)
        version = number_of(before) + 1
        layout = layout or kept_layout(before, schema)
        held = set() if before is None else set(before["paths"])
        wanted = set(paths)
        added = [p for p in paths if p not in held]
        removed = [] if before is None else [p for p in before["paths"] if p not in wanted]
        whole = before is None or version % WHOLE_EVERY == 0 or len(added) + len(removed) >= len(paths)
        named = [None, None, self.names(paths)] if whole else [self.names(added), self.names(removed), None]
        line = (version, schema.json(), json.dumps(layout) if layout else None, *named, note)
        columns = [c.strip() for c in LOG.split(",") if "committed_at" not in c]
        row = self.spark.createDataFrame([line], ", ".join(columns)).withColumn("committed_at", F.current_timestamp())
        staged = f"{self.path}/staged/{uuid.uuid4().hex}"
        row.coalesce(1).write.mode("errorifexists").parquet(staged)
        if not self.place(staged, f"{self.path}/log/{version:012d}"):
            raise RuntimeError(f"another writer committed version {version} of {self.path}")
        return version

    def names(self, paths: Iterable[str]) -> list[str]:
        """Folders as the log names them, below the table."""
        return [p.removeprefix(f"{self.path}/") for p in paths]

    def place(self, staged: str, target: str) -> bool:
        """Move a written folder to a place that must be free. File systems with an atomic rename let one writer win."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        files = hadoop.FileContext.getFileContext(hadoop.Path(target).toUri(), self.spark._jsc.hadoopConfiguration())
        option = getattr(hadoop, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(option, 1)
        how[0] = option.NONE
        files.mkdir(hadoop.Path(target).getParent(), None, True)
        try:
            files.rename(hadoop.Path(staged), hadoop.Path(target), how)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        return True

    def create(self, schema: T.StructType, keys: Sequence[str] = (), buckets: int = BUCKETS) -> int:
        """An empty table with this definition, laid out by ``keys`` if there are any."""
        layout = Layout(tuple(keys), buckets) if keys else None
        return self.commit([], schema, "create", layout=layout)

    def conform(self, df: DataFrame, entry: Row | None) -> DataFrame:
        """Rows in the column order and types the table defines; absent columns are null."""
        if entry is None:
            return df
        schema = schema_of(entry)
        unknown = [c for c in df.columns if c not in schema.names]
        if unknown:
            raise ValueError(f"{self.path} has no columns {unknown}")
        return df.select(
            *[
                (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema.fields
            ]
        )

    def replace(self, df: DataFrame, note: str = "replace") -> int:
        entry = self.entry()
        rows = self.conform(df, entry)
        return self.commit(self.stage(rows, layout_of(entry)), rows.schema, note, number_of(entry))

    def append(self, df: DataFrame, note: str = "append") -> int:
        """Add rows. Earlier files are kept as they are."""
        entry = self.entry()
        rows = self.conform(df, entry)
        earlier = [] if entry is None else list(entry["paths"])
        return self.commit([*earlier, *self.stage(rows, layout_of(entry))], rows.schema, note, number_of(entry))

    def lay_out(self, keys: Sequence[str], buckets: int = BUCKETS) -> int:
        """Rewrite the table into buckets of a key. From then on merges and folds touch only the buckets they have to."""
        entry, layout = self.entry(), Layout(tuple(keys), buckets)
        rows = self.rows_of(entry["paths"], schema_of(entry))
        return self.commit(self.stage(rows, layout), rows.schema, "layout", entry["version"], layout)


def number_of(entry: Row | None) -> int:
    return 0 if entry is None else entry["version"]


def schema_of(entry: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(entry["schema_json"]))


def layout_of(entry: Row | None) -> Layout | None:
    if entry is None or entry["layout_json"] is None:
        return None
    keys, buckets = json.loads(entry["layout_json"])
    return Layout(tuple(keys), buckets)


def kept_layout(entry: Row | None, schema: T.StructType) -> Layout | None:
    """The layout of a version, unless its key is not the same under another definition."""
    layout = layout_of(entry)
    if layout is None:
        return None
    types = {f.name: f.dataType for f in schema.fields}
    return layout if all(types.get(k) == schema_of(entry)[k].dataType for k in layout.keys) else None


def bucket_of(path: str) -> int | None:
    """The bucket a folder holds; a folder written without a layout may hold any key."""
    found = re.search(rf"/{BUCKET}=(\d+)$", path)
    return int(found[1]) if found else None


def in_buckets(paths: Iterable[str], buckets: set[int]) -> list[str]:
    """The folders that may hold keys of these buckets."""
    return [p for p in paths if bucket_of(p) is None or bucket_of(p) in buckets]


def buckets_of(rows: DataFrame, layout: Layout) -> set[int]:
    """The buckets of some rows: at most as many numbers as the layout has buckets."""
    return {r[0] for r in rows.select(layout.bucket()).distinct().collect()}


def append_rows(df: DataFrame, table: VersionedTable, columns: Sequence[str]) -> int:
    """Append the listed columns, matched by name; the table's other columns are null."""
    return table.append(df.select(*columns))


def refresh_table(df: DataFrame, table: VersionedTable) -> DataFrame:
    """Replace all rows and keep the definition. Repeatable; no rows give an empty table."""
    return table.read(table.replace(df, "refresh"))


def merge_upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str] = (), gone: Column | None = None
) -> DataFrame:
    """Target with the batch upserted on its keys. Rows absent from the batch stay.

    A batch row without a key fails the merge. Several batch rows of one key are
    reduced to the newest by ``order``; without an order they fail the merge.
    Keys whose batch row meets ``gone`` are removed.
    """
    keys = list(keys)
    checked = require_key(batch, keys)
    if order:
        newest = latest_revision(checked, keys, order)
    else:
        others = [c for c in batch.columns if c not in keys]
        row = F.max(F.struct(*[F.col(f"`{c}`") for c in others])) if others else F.lit(None)
        reduced = checked.groupBy(*keys).agg(F.count("*").alias("__n"), row.alias("__row"))
        single = F.when(F.col("__n") > 1, F.raise_error(F.lit("a batch key repeats and no order is given")))
        first = single.cast(batch.schema[keys[0]].dataType)
        newest = reduced.select(
            *[(F.coalesce(first, F.col(k)) if k == keys[0] else F.col(k)).alias(k) for k in keys],
            *[F.col(f"__row.{c}").alias(c) for c in others],
        )
    kept = sized_join(target, newest.select(*keys).distinct(), keys, "left_anti")
    if gone is not None:
        newest = newest.filter(~F.coalesce(gone, F.lit(False)))
    return kept.select(*target.columns).unionByName(newest.select(*target.columns))


def touched_parts(table: VersionedTable, entry: Row, batch: DataFrame, keys: Sequence[str]) -> list[str]:
    """Folders of a version that hold a key of the batch. Only key columns are read.

    The result is bounded by the number of folders, not by rows.
    """
    folder = F.regexp_extract(F.col("_metadata.file_path"), f"/data/([0-9a-f]{{32}}(?:/{BUCKET}=[0-9]+)?)/", 1)
    held = table.rows_of(entry["paths"], schema_of(entry)).select(*keys, folder.alias("__part"))
    hits = sized_join(held, batch.select(*keys).distinct(), keys, "left_semi").select("__part").distinct()
    names = {r["__part"] for r in hits.collect()}
    return [p for p in entry["paths"] if p.rsplit("/data/", 1)[-1] in names]


def merge_into(
    table: VersionedTable,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    gone: Column | None = None,
    note: str = "merge",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Merge a batch into a versioned table and return its new rows.

    A table that is new is laid out by the merge key. In a table laid out by it
    only the buckets that hold a key of the batch are rewritten, each as a
    folder of its own. In any other table the folders that hold one are
    rewritten as one. All other folders are kept as they are.
    """
    entry = table.entry()
    rows = table.conform(batch, entry)
    paths = [] if entry is None else list(entry["paths"])
    layout = Layout(tuple(keys), buckets) if entry is None else layout_of(entry)
    if layout is not None and layout.keys == tuple(keys):
        touched = in_buckets(paths, buckets_of(rows, layout)) if paths else []
    else:
        touched = touched_parts(table, entry, rows, keys) if paths else []
    merged = merge_upsert(table.rows_of(touched, rows.schema), rows, keys, order, gone)
    rewritten = set(touched)
    staged = [*[p for p in paths if p not in rewritten], *table.stage(merged, layout)]
    table.commit(staged, rows.schema, note, number_of(entry), layout)
    return table.rows_of(staged, rows.schema)


def rows_with_keys(table: VersionedTable, wanted: DataFrame, version: int | None = None) -> DataFrame:
    """The rows of a table whose key is in ``wanted``, read from the buckets of these keys only."""
    entry = table.entry(version)
    layout = layout_of(entry)
    if layout is None:
        raise ValueError(f"{table.path} is not laid out by key")
    schema = schema_of(entry)
    wanted = wanted.select(*[F.col(f"`{k}`").cast(schema[k].dataType).alias(k) for k in layout.keys]).distinct()
    rows = table.rows_of(in_buckets(entry["paths"], buckets_of(wanted, layout)), schema)
    return sized_join(rows, wanted, layout.keys, "left_semi").select(*schema.names)


def changed_folders(table: VersionedTable, old: int, new: int) -> tuple[list[str], list[str]]:
    """Folders that only the old and only the new version has. What both have holds no difference."""
    before, after = table.entry(old), table.entry(new)
    if before is None or after is None:
        raise LookupError(f"{table.path} has no versions {old} and {new}")
    left, right = set(before["paths"]), set(after["paths"])
    return [p for p in before["paths"] if p not in right], [p for p in after["paths"] if p not in left]


LEDGER = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)


def append_ledger(ledger: VersionedTable, run_id: str, rows: int, status: str) -> DataFrame:
    """Record one load."""
    spark = ledger.spark
    if ledger.entry() is None:
        ledger.create(LEDGER)
    line = spark.createDataFrame([(run_id, status, rows)], "run_id string, status string, rows bigint")
    return ledger.read(ledger.append(line.withColumn("loaded_at", F.current_timestamp()), run_id))


def ledgered_append(table: VersionedTable, df: DataFrame, ledger: VersionedTable, run_id: str) -> DataFrame:
    """Append rows and record how many were written.

    They are counted in the written files, where rerun tasks cannot count twice.
    A load that fails is recorded as failed and its error goes on to the caller.
    """
    try:
        earlier = table.version()
        version = table.append(df, run_id)
        written = changed_folders(table, earlier, version)[1] if earlier else table.entry(version)["paths"]
    except Exception:
        append_ledger(ledger, run_id, 0, "failed")
        raise
    rows = table.rows_of(written, schema_of(table.entry(version)))
    return append_ledger(ledger, run_id, rows.count(), "succeeded")


def publish(source: DataFrame, share: VersionedTable) -> int:
    """Publish a full copy; consumers of the share see it from now on."""
    return share.commit(share.stage(source), source.schema, "publish")


def read_published(share: VersionedTable, version: int | None = None) -> DataFrame:
    """What consumers of a manual share see: the last published copy."""
    return share.read(version)


def read_share(share: VersionedTable, live: VersionedTable, update_mode: str) -> DataFrame:
    """Manual shares show the last publication, automatic ones the live table."""
    if update_mode not in ("manual", "automatic"):
        raise ValueError("update_mode must be manual or automatic")
    return live.read() if update_mode == "automatic" else read_published(share)
