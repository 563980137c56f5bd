"""Event-time windows on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerline.functions.exact import exact_sum
from ledgerline.sources.readers import existing, read_stream
from ledgerline.sources.writers import full_refresh

MARKER = "closing_marker"
LATE = "came_late"
_ALL = 2**31 - 1  # files of a micro-batch


def tumbling_totals(
    events: DataFrame,
    time: str,
    value: str,
    keys: Sequence[str] = (),
    width: str = "1 hour",
    lateness: str | None = None,
    scale: int = 4,
) -> DataFrame:
    """Count and sum per window and key; with ``lateness`` a stream can close its windows."""
    source = events.withWatermark(time, lateness) if lateness else events
    return (
        source.groupBy(F.window(time, width), *keys)
        .agg(F.count("*").alias("event_count"), exact_sum(value, scale).alias("total_value"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *keys,
            "event_count",
            "total_value",
        )
    )


def _sorted_in(
    spark: SparkSession, path: str, schema: T.StructType, folder: str, time: str, named: Sequence[str],
    width: str, lateness: str, files_per_batch: int,
) -> None:
    """Copy what is new of the source, its needed columns only, with a flag on late rows.

    A row is late if its window ended before the watermark that the batches before its own had
    reached.  Every batch leaves a mark, one row with the latest time so far, after its rows; a
    batch that is run again replaces its own rows and its own mark.
    """
    kind = schema[time].dataType

    def latest(path: str, column: str) -> Column:
        found = existing(lambda: spark.read.schema(T.StructType([T.StructField(column, kind)])).parquet(path))
        return F.lit(None) if found is None else found.agg(F.max(column)).scalar()

    def keep(batch: DataFrame, number: int) -> None:
        # greatest() passes over nulls: the first batch has no mark before it, and no marker either
        before = F.greatest(latest(f"{folder}/marks/batch={number - 1}", "latest"), latest(f"{folder}/markers", time))
        watermark = before.cast("timestamp") - F.expr(f"INTERVAL {lateness}")
        placed = batch.withColumn("__window", F.window(F.col(time).cast("timestamp"), width))
        late = F.coalesce(F.col("__window.end") <= watermark, F.lit(False))
        rows = placed.where(F.col(time).isNotNull()).select(*named, late.alias(LATE))
        full_refresh(rows, f"{folder}/rows/batch={number}")
        reached = F.greatest(latest(f"{folder}/rows/batch={number}", time), before)
        full_refresh(spark.range(1).select(reached.cast(kind).alias("latest")), f"{folder}/marks/batch={number}")

    query = (
        read_stream(spark, path, schema, files_per_batch)
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", f"{folder}/arrivals")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that :func:`closed_windows` with this folder has left out, for their window had closed."""
    return spark.read.option("basePath", f"{folder}/rows").parquet(f"{folder}/rows").where(LATE).drop(LATE, "batch")


def closed_windows(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    folder: str,
    time: str,
    value: str,
    keys: Sequence[str] = (),
    width: str = "1 hour",
    lateness: str = "0 seconds",
    scale: int = 4,
    files_per_batch: int = 1000,
    close: bool = True,
) -> DataFrame:
    """All windows of a stream of files, each written once, when the watermark has closed it.

    The events are read from ``path`` as far as they go.  With ``close`` a marker event is put
    behind the last window afterwards, which moves the watermark past it, so the windows that
    were still open are written as well; the marker has a window of its own, which stays out.
    Without it they stay in the state, and a later call with the same ``folder`` goes on there.
    Rows that come after their window was closed are in no window; :func:`late_rows` has them.
    Rows without a time are in neither.

    The stream of windows takes all batches of a call at once, so its watermark is never ahead of
    the one that tells late rows, and no row is lost between the two.
    """
    empty = spark.createDataFrame([], schema)
    named = [time, value, *keys]
    empty.select(*named).write.mode("append").parquet(f"{folder}/markers")
    _sorted_in(spark, path, schema, folder, time, named, width, lateness, files_per_batch)
    kept = empty.select(*named, F.lit(False).alias(LATE))
    if existing(lambda: spark.read.schema(kept.schema).parquet(f"{folder}/rows")) is None:
        full_refresh(kept, f"{folder}/rows/batch=0")  # nothing has arrived so far
    events = (
        read_stream(spark, f"{folder}/rows", kept.schema, files_per_batch=_ALL)
        .where(~F.col(LATE))
        .select(*named, F.lit(False).alias(MARKER))
    )
    markers = read_stream(spark, f"{folder}/markers", empty.select(*named).schema).withColumn(MARKER, F.lit(True))
    stream = events.unionByName(markers).withColumn(time, F.col(time).cast("timestamp"))
    totals = tumbling_totals(stream, time, value, [*keys, MARKER], width, lateness, scale)

    def append(batch: DataFrame, number: int) -> None:
        # a batch that is run again replaces its own rows
        full_refresh(batch.where(~F.col(MARKER)).drop(MARKER), f"{folder}/windows/batch={number}")

    def run() -> None:
        query = (
            totals.writeStream.outputMode("append")
            .foreachBatch(append)
            .option("checkpointLocation", f"{folder}/offsets")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    run()
    if close:
        rows = spark.read.schema(kept.schema).parquet(f"{folder}/rows")
        last = rows.agg(F.max(F.col(time).cast("timestamp")).alias("t"))
        behind = F.col("t") + F.expr(f"2 * INTERVAL {width}") + F.expr(f"2 * INTERVAL {lateness}")
        kind = schema[time].dataType
        row = last.where("t is not null").select(
            *[(behind.cast(kind) if c == time else F.lit(None).cast(schema[c].dataType)).alias(c) for c in named]
        )
        row.coalesce(1).write.mode("append").parquet(f"{folder}/markers")
        run()
    return spark.read.parquet(f"{folder}/windows").drop("batch")
