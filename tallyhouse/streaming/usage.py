"""Usage windows and page dedupe over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.operators.usage import usage_windows
from tallyhouse.sources.tables import LEDGER, VersionedTable


def read_events(spark: SparkSession, path: str, schema, glob: str = "*.parquet", max_files: int = 1_000) -> DataFrame:
    """A file stream; each micro-batch takes a bounded number of files."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files)
        .parquet(path)
    )


def with_event_time(stream: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need an instant, so a time without zone is taken as session time."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_usage_windows(
    stream: DataFrame, watermark: str = "10 minutes", width: str = "30 seconds", ts: str = "ts", **names: str
) -> DataFrame:
    """Tumbling usage windows. Events later than the watermark are dropped.

    State holds one row per open window and user, and a window is emitted once
    the watermark has passed its end.
    """
    return usage_windows(with_event_time(stream, ts).withWatermark(ts, watermark), width, ts, **names)


def stream_dedupe(stream: DataFrame, key: str, watermark: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """The first copy of each id; repeats within the watermark are dropped."""
    return with_event_time(stream, ts).withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])


def run_available(stream: DataFrame, path: str) -> DataFrame:
    """Process what is there now into a parquet table, then stop and read it.

    Progress is kept beside the table, so a second run takes only new input.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .start(f"{path}/rows")
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/rows")


def run_accounted(
    stream: DataFrame,
    path: str,
    ledger: VersionedTable,
    run_id: str,
    watermark: str = "10 minutes",
    width: str = "30 seconds",
    ts: str = "ts",
    **names: str,
) -> DataFrame:
    """``stream_usage_windows`` over what is there now, with an account of every batch in the ledger.

    The lines of a batch have the run id ``<run_id>:<batch>`` and say by status
    how many rows came ``in``, how many of them had no time (``untimed``), how
    many ``windows`` were closed, how many rows these hold (``out``), how many
    rows are held in windows still ``open`` after it, and how many were too
    late for any window (``late``). In all batches together, rows in are rows
    untimed, out and late and the rows that are open last.

    Rows in and out are observed in the batch's own job. Open rows are read
    from the state that the batch has left, which has one row per open window
    and user; late rows are what is missing then. Spark's own figure of late
    rows counts them after they were added up per task, so it is no number of rows.

    A failed run writes no account of its batches; its windows are kept, and
    the next run starts after them.
    """
    counted = stream.observe("arrived", F.count(F.lit(1)).alias("rows"), F.count_if(F.col(ts).isNull()).alias("untimed"))
    windows = stream_usage_windows(counted, watermark, width, ts, **names)
    closed = windows.observe("closed", F.count(F.lit(1)).alias("windows"), F.coalesce(F.sum("queries"), F.lit(0)).alias("rows"))
    progress = f"{path}/progress"
    query = (
        closed.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start(f"{path}/rows")
    )
    spark = stream.sparkSession
    lines, held = [], None
    for batch, seen in sorted(observed_batches(query).items()):
        arrived, done = seen["arrived"], seen["closed"]
        if held is None:
            held = open_rows(spark, progress, batch - 1)
        left = open_rows(spark, progress, batch)
        late = arrived["rows"] - arrived["untimed"] - done["rows"] - (left - held)
        held = left
        counts = {"in": arrived["rows"], "untimed": arrived["untimed"], "windows": done["windows"], "out": done["rows"], "open": left, "late": late}
        lines += [(f"{run_id}:{batch}", status, rows) for status, rows in counts.items()]
    if lines:
        if ledger.entry() is None:
            ledger.create(LEDGER)
        account = spark.createDataFrame(lines, "run_id string, status string, rows bigint")
        ledger.append(account.withColumn("loaded_at", F.current_timestamp()), run_id)
    return spark.read.schema(windows.schema).parquet(f"{path}/rows")


def observed_batches(query: StreamingQuery) -> dict[int, dict[str, Row]]:
    """What was observed in each batch until the query ends. A query keeps its last hundred only, so they are taken while it runs."""
    found: dict[int, dict[str, Row]] = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(1)
        found |= {p.batchId: p.observedMetrics for p in query.recentProgress if {"arrived", "closed"} <= set(p.observedMetrics)}
    return found


def open_rows(spark: SparkSession, progress: str, batch: int) -> int:
    """Rows in the windows that are open after a batch."""
    if batch < 0:
        return 0
    state = spark.read.format("statestore").option("batchId", batch).load(progress)
    return state.agg(F.coalesce(F.sum("value.count"), F.lit(0)).alias("n")).first()["n"]
