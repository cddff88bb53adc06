"""Deduplication and windows over event streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcela.streaming.ingest import batch_folder


def stream_dedup(stream: DataFrame, key: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """Native deduplication within the watermark.

    All rows of a key meet in one task, and late rows are dropped.  For keys that may hold a large part
    of the stream, and for late rows, use :func:`parcela.streaming.dedup.dedup_into`.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def first_per_key(batch: DataFrame, key: str, ts: str) -> DataFrame:
    """Earliest row of each key (ties by row hash), reduced on the map side."""
    rank = F.struct(F.col(ts), F.xxhash64(*batch.columns))
    others = [c for c in batch.columns if c != key]
    return (
        batch.groupBy(key).agg(F.min_by(F.struct(*others), rank).alias("_row"))
        .select(key, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*batch.columns)
    )


def windowed_counts(
    stream: DataFrame,
    ts: str,
    keys: list[str],
    window: str = "1 hour",
    slide: str | None = None,
    delay: str = "10 minutes",
    value: str | None = None,
) -> DataFrame:
    """Counts (and sums) per time window; partial sums are made before the shuffle."""
    measures = [F.count("*").alias("nombre")]
    if value:
        measures.append(F.sum(F.col(value).cast("decimal(28,4)")).alias("total"))
    if stream.isStreaming:
        stream = stream.withWatermark(ts, delay)
    return (
        stream.groupBy(F.window(ts, window, slide), *keys).agg(*measures)
        .select(F.col("window.start").alias("debut"), F.col("window.end").alias("fin"), *keys,
                *["nombre", "total"][: len(measures)])
    )


def write_updates(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body for update mode: the windows a batch has changed, in a folder of its own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return write


def latest_windows(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Every window as its last batch left it, open windows included."""
    of = ["debut", "fin", *keys]
    measures = [c for c in updates.columns if c not in [*of, "batch_id"]]
    last = updates.groupBy(*of).agg(F.max(F.struct("batch_id", *measures)).alias("_last"))
    return last.select(*of, *[F.col(f"_last.{c}").alias(c) for c in measures])


def session_counts(df: DataFrame, ts: str, key: str, gap: str = "30 minutes") -> DataFrame:
    """Sessions per key: rows less than ``gap`` apart belong together.

    Rows are first reduced to one per key and time slice as long as the gap, so a slice lies
    within one session.  What then meets in a key's task is bounded by the time range over the
    gap, however many rows the key has.
    """
    limit = F.expr(f"INTERVAL {gap}")
    slices = df.filter(F.col(ts).isNotNull()).groupBy(key, F.window(ts, gap).alias("_w")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count("*").alias("_n")
    )
    by_time = Window.partitionBy(key).orderBy("_first")
    opens = F.coalesce(F.col("_first") >= F.lag("_last").over(by_time) + limit, F.lit(True))
    numbered = slices.withColumn("_open", opens.cast("int")).withColumn(
        "_session", F.sum("_open").over(by_time.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        numbered.groupBy(key, "_session")
        .agg(F.min("_first").alias("debut"), (F.max("_last") + limit).alias("fin"),
             F.sum("_n").alias("nombre"))
        .drop("_session")
    )


def session_stream(stream: DataFrame, ts: str, key: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Sessions of a stream; set ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``
    so that rows of one session are merged before the shuffle."""
    return (
        stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap), key)
        .agg(F.count("*").alias("nombre"))
        .select(key, F.col("session_window.start").alias("debut"),
                F.col("session_window.end").alias("fin"), "nombre")
    )
