"""Named snapshots kept as immutable copies beside a catalog table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.ranking import latest_revision
from tallyhouse.operators.snapshots import rename_snapshot, resolve_snapshot
from tallyhouse.sources.tables import VersionedTable

CATALOG = T.StructType(
    [
        T.StructField("database_name", T.StringType()),
        T.StructField("snapshot_id", T.StringType()),
        T.StructField("snapshot_name", T.StringType()),
        T.StructField("created_ts", T.TimestampType()),
        T.StructField("path", T.StringType()),
    ]
)


class SnapshotStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.table = VersionedTable(spark, f"{self.path}/catalog")
        if self.table.entry() is None:
            self.table.create(CATALOG)

    def catalog(self) -> DataFrame:
        return self.table.read()

    def take(self, df: DataFrame, database: str, name: str) -> str:
        """Copy the rows and list the copy under ``name``."""
        if not name:
            raise ValueError("a snapshot needs a name")
        if not resolve_snapshot(self.catalog(), database, name=name).isEmpty():
            raise ValueError(f"{database!r} already has a snapshot named {name!r}")
        snapshot_id = str(uuid.uuid4())
        path = f"{self.path}/data/{snapshot_id}"
        df.write.mode("errorifexists").parquet(path)
        row = self.spark.createDataFrame(
            [(database, snapshot_id, name, path)],
            "database_name string, snapshot_id string, snapshot_name string, path string",
        )
        self.table.append(row.withColumn("created_ts", F.current_timestamp()), f"take {snapshot_id}")
        return snapshot_id

    def rename(self, snapshot_id: str, name: str) -> DataFrame:
        """Rename a snapshot; an empty name releases it."""
        return self.table.read(
            self.table.replace(rename_snapshot(self.catalog(), snapshot_id, name), f"rename {snapshot_id}")
        )

    def read(self, database: str, name: str | None = None, snapshot_id: str | None = None) -> DataFrame:
        """The rows as they were when the snapshot was taken."""
        found = resolve_snapshot(self.catalog(), database, snapshot_id, name).select("path").collect()
        if not found:
            raise LookupError(f"{database!r} has no snapshot {name or snapshot_id!r}")
        return self.spark.read.parquet(found[0]["path"])

    def restore(self, database: str, name: str, target: VersionedTable) -> DataFrame:
        """Make the snapshot the current version of a table."""
        rows = self.read(database, name)
        return target.read(target.commit(target.stage(rows), rows.schema, f"restore {name}"))

    def newest(self) -> DataFrame:
        """The latest snapshot of each database."""
        return latest_revision(self.catalog(), ["database_name"], ["created_ts", "snapshot_id"])
