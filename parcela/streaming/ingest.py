"""Multi-source ingestion with Structured Streaming.

Sources land JSON lines in one folder per kind.  Each kind is normalised into one envelope, all
kinds are united, and every micro-batch is written to a folder named by its batch id, so a batch
that is run again replaces what it wrote before.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from parcela.sources.versions import StoredTable, purge_before

# Source kinds, queue names and the normalised envelope.
KINDS = ["api", "file", "web", "database"]
QUEUES = ["queue_api", "queue_file", "queue_web", "queue_db", "queue_normalized"]
FORMAT, STEP = "standard_v1", "normalization"
LOG_PURGE_DAYS = 30

_LINE = T.StructType([T.StructField("value", T.StringType())])


def collect_source(
    spark: SparkSession, path: str, max_files: int | None = None, archive: str | None = None
) -> DataFrame:
    """Stream of raw JSON lines of one source folder.

    ``max_files`` bounds a run; ``archive`` moves files away once their batch is committed.
    """
    reader = spark.readStream.format("text").schema(_LINE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


_STRING = r'"[^"\\\\]*+(?:\\\\.[^"\\\\]*+)*+"'
_NUMBER_WORDS = r"-?\bInfinity\b|\bNaN\b"
_STRICT = {"columnNameOfCorruptRecord": "_corrupt_record", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def is_json(c: Column) -> Column:
    """Whether a text is one JSON value of any kind and size: objects (keys may repeat), arrays, scalars.

    The text is put into an array, once alone and once before another element: only a complete value gives
    arrays of one and two elements.  The parser also knows single quotes, which a look at the text without its
    strings rules out, and does not know NaN and Infinity, which are put aside there.  A strict parser reads objects
    first; what it takes needs no such look.
    """
    bare = F.regexp_replace(c, _STRING, '""')
    words = bare.rlike(_NUMBER_WORDS)
    text = F.when(words, F.regexp_replace(bare, _NUMBER_WORDS, "0")).otherwise(c)

    def elements(*parts: Column | str) -> Column:
        return F.json_array_length(F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))

    def alone(text: Column) -> Column:
        return (elements("[", text, "]") == 1) & (elements("[", text, ",0]") == 2)

    # where a text has backslashes, only the look itself says what it takes for strings
    plain = ~c.contains("\\") | ~reduce(Column.__or__, [c.contains(x) for x in ("'", "\t", "\n", "\r", "NaN", "Infinity")])
    strict = F.from_json(c, "_corrupt_record STRING", _STRICT)
    quick = c.startswith("{") & strict["_corrupt_record"].isNull() & plain & alone(c)
    one = alone(text)
    control = F.lit(r"[\x00-\x1f]")  # not inside strings
    looked = one & ~bare.contains("'") & (F.regexp_count(c, control) == F.regexp_count(bare, control))
    return F.when(quick, True).otherwise(F.coalesce(looked, F.lit(False)))


def normalise_stream(lines: DataFrame, kind: str, at: Column | None = None) -> DataFrame:
    """Readable messages of one kind (any JSON value) in the standard envelope.

    Messages of the "file" kind must hold ``data``.  Works on streams and batches alike.
    """
    value = F.col("value")
    valid = is_json(value)
    if kind == "file":
        valid = valid & F.get_json_object(value, "$.data").isNotNull()
    stamp = F.current_timestamp() if at is None else at
    return lines.filter(valid).select(
        F.lit(kind).alias("source"),
        value.alias("data"),
        F.lit(True).alias("normalized"),
        stamp.alias("normalized_timestamp"),
        F.lit(FORMAT).alias("format"),
        F.lit(STEP).alias("processing_step"),
    )


def rejected_lines(lines: DataFrame, kind: str) -> DataFrame:
    """The messages that :func:`normalise_stream` leaves out, for a side table."""
    value = F.col("value")
    valid = is_json(value)
    if kind == "file":
        valid = valid & F.get_json_object(value, "$.data").isNotNull()
    return lines.filter(~valid).select(F.lit(kind).alias("source"), "value")


def union_sources(*streams: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streams)


def message_source(df: DataFrame) -> Column:
    """Source of a message, else its origin, else "unknown"."""
    names = [F.nullif(F.col(c), F.lit("")) for c in ("source", "origin") if c in df.columns]
    return F.coalesce(*names, F.lit("unknown"))


def aggregate_messages(
    df: DataFrame,
    by: list[str] | None = None,
    kind: str = "stream_auto",
    environment: str = "prod",
    queue: str = "queue_normalized",
    at: Column | None = None,
) -> DataFrame:
    """One metadata row (JSON text) per group of messages, or one in all.

    ``at`` is the time of the aggregation and may name columns of ``by``.  Messages are counted per source first; only those counts meet in the group's task.
    """
    by = by or []
    stamp = F.date_format(F.current_timestamp() if at is None else at, "yyyy-MM-dd'T'HH:mm:ss")
    per_source = df.withColumn("_s", message_source(df)).groupBy(*by, "_s").agg(
        F.count("*").alias("_n")
    )
    total = F.coalesce(F.sum("_n"), F.lit(0))
    fields = {
        "aggregation_timestamp": stamp,
        "total_records": total,
        "sources": F.sort_array(F.collect_list("_s")),
        "aggregation_type": F.lit(kind),
        "environment": F.lit(environment),
        "queue": F.lit(queue),
        "initial_count": total,
        "records_processed": total,
    }
    summed = per_source.groupBy(*by).agg(*[c.alias(n) for n, c in fields.items()])
    return summed.select(*by, F.to_json(F.struct(*fields)).alias("metadata"))


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def append_aggregation_log(
    bronze: str, log: str, at: str | None = None
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: payload to bronze, one metadata row to the log.

    The log row is computed from the bronze files just written, so the source is read once and
    nothing is kept in executor memory.  Both folders carry the batch id: a retry overwrites.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        folder = batch_folder(bronze, batch_id)
        batch.write.mode("overwrite").parquet(folder)
        stored = batch.sparkSession.read.schema(batch.schema).parquet(folder)
        stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
        (
            aggregate_messages(stored, at=stamp)
            .withColumns({"id": F.lit(batch_id).cast("bigint"), "created_at": stamp, "updated_at": stamp})
            .coalesce(1).write.mode("overwrite").parquet(batch_folder(log, batch_id))
        )

    return write


def run_available(
    df: DataFrame, body: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process everything that is there, batch by batch, and stop."""
    query = (
        df.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


LOG_SCHEMA = "metadata STRING, id BIGINT, created_at TIMESTAMP, updated_at TIMESTAMP"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path).select("id", "metadata", "created_at", "updated_at")


def _meta(name: str) -> Column:
    return F.get_json_object("metadata", f"$.{name}")


def latest_aggregations(log: DataFrame, n: int = 1) -> DataFrame:
    """The newest ``n`` log rows with their metadata fields."""
    return (
        log.orderBy(F.desc("created_at"), F.desc("id")).limit(n)
        .select("id", _meta("total_records").alias("total_records"), _meta("sources").alias("sources"),
                _meta("aggregation_type").alias("aggregation_type"),
                _meta("aggregation_timestamp").alias("aggregation_time"), "created_at")
    )


def aggregation_report(log: DataFrame) -> DataFrame:
    """Totals over the log, and the distinct sources named in it."""
    records = _meta("total_records").try_cast("bigint")
    sources = log.select(
        F.explode(F.from_json(_meta("sources"), "array<string>")).alias("s")
    ).distinct()
    return log.agg(
        F.count("*").alias("total_aggregations"),
        F.coalesce(F.sum(records), F.lit(0)).alias("total_records_processed"),
        F.coalesce(F.avg(records), F.lit(0.0)).alias("avg_records_per_aggregation"),
        F.min("created_at").alias("first_aggregation"),
        F.max("created_at").alias("last_aggregation"),
    ).withColumn("unique_sources", sources.agg(F.count("*")).scalar())


def distinct_sources(log: DataFrame) -> DataFrame:
    return log.select(
        F.explode(F.from_json(_meta("sources"), "array<string>")).alias("source")
    ).distinct()


def hourly_activity(log: DataFrame, as_of: str, hours: int = 24, newest: int = 6) -> DataFrame:
    """Log rows per hour of the last hours, newest first."""
    since = F.lit(as_of).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    return (
        log.filter(F.col("created_at") >= since)
        .groupBy(F.date_trunc("hour", "created_at").alias("hour"))
        .agg(F.count("*").alias("count")).orderBy(F.desc("hour")).limit(newest)
    )


def purge_old(log: DataFrame, as_of: str, days: int = LOG_PURGE_DAYS) -> DataFrame:
    """Log rows not older than the term."""
    since = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return log.filter((F.col("created_at") >= since) | F.col("created_at").isNull())


def purge_stored(log: StoredTable, as_of: str, days: int = LOG_PURGE_DAYS) -> DataFrame:
    """Take old rows out of a stored log (parts by day) for good; counts before, after and removed."""
    cutoff = dt.datetime.fromisoformat(as_of) - dt.timedelta(days=days)
    return purge_before(log, "created_at", cutoff.isoformat())


def purge_counts(log: DataFrame, as_of: str, days: int = LOG_PURGE_DAYS) -> DataFrame:
    since = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    old = F.coalesce(F.col("created_at") < since, F.lit(False))
    return log.agg(F.count("*").alias("avant"), F.count_if(~old).alias("apres")).withColumn(
        "supprimes", F.col("avant") - F.col("apres")
    )


def queue_depths(pending: DataFrame, names: list[str], column: str = "source") -> DataFrame:
    """Pending messages per queue, empty queues included, with a status."""
    spark = pending.sparkSession
    known = spark.createDataFrame([(n,) for n in names], "queue string")
    depths = pending.groupBy(F.col(column).alias("queue")).agg(F.count("*").alias("elements"))
    n = F.col("elements")
    return (
        known.join(depths, "queue", "left").fillna(0, ["elements"])
        .withColumn("etat", F.when(n == 0, "vide").when(n < 10, "faible").otherwise("charge"))
    )


def export_latest_sample(log: DataFrame, path: str, exported_at: str) -> None:
    """The newest log row as one JSON document, or a NO_DATA marker when the log is empty."""
    newest = log.orderBy(F.desc("created_at"), F.desc("id")).limit(1).select(
        F.col("id").alias("aggregation_id"), "metadata",
        _meta("total_records").alias("data_count"), F.col("created_at").cast("string"),
    )
    marker = log.agg(F.count("*").alias("_n")).filter(F.col("_n") == 0).select(
        F.lit("NO_DATA").alias("status"), F.lit("log is empty").alias("message")
    )
    (
        newest.unionByName(marker, allowMissingColumns=True)
        .withColumn("export_timestamp", F.lit(exported_at))
        .coalesce(1).write.mode("overwrite").json(path)
    )
