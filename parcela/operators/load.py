"""Idempotent loads: new keys only, aggregates once per listing, validated documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcela.functions.numbers import parse_iso_timestamp, strip
from parcela.schemas import DATE_PATHS, REQUIRED_PATHS
from parcela.session import shared_dir

INSERTED, SKIPPED, ERROR = "inserted", "skipped", "error"


def classify_by_key(
    target: DataFrame, batch: DataFrame, key: str = "reference", order: str | None = None
) -> DataFrame:
    """One row per non-blank key of the batch with its ``statut`` and the number of its rows.

    The row kept for a key is the first by ``order`` and then by row hash, so the choice does not
    depend on partitioning.  It is reduced on the map side: a key that fills a third of the batch
    travels as one row per task.
    """
    trimmed = batch.withColumn(key, strip(F.coalesce(F.col(key), F.lit(""))))
    others = [c for c in batch.columns if c != key]
    rank = F.struct(*([order] if order else []), F.xxhash64(*batch.columns))
    keyed = trimmed.filter(F.col(key) != "").groupBy(key).agg(
        F.count("*").alias("_rows"), F.min_by(F.struct(F.lit(0), *others), rank).alias("_row")
    )
    known = target.select(strip(F.col(key)).alias(key)).distinct().withColumn("_known", F.lit(True))
    return keyed.join(known, key, "left").select(
        key, *[F.col(f"_row.{c}").alias(c) for c in others], "_rows",
        F.when(F.col("_known"), SKIPPED).otherwise(INSERTED).alias("statut"),
    )


def new_rows(
    target: DataFrame, batch: DataFrame, key: str = "reference", order: str | None = None
) -> DataFrame:
    """One row per key the target does not hold: the first of :func:`classify_by_key`.

    Rows are sorted and passed on as they are, where an aggregate would build and copy each as a struct.  Spark keeps the
    first row of a key before the shuffle already, so a hot key travels as one row per task here as well.
    """
    keyed = batch.withColumn(key, strip(F.coalesce(F.col(key), F.lit("")))).filter(F.col(key) != "")
    first = Window.partitionBy(key).orderBy(*([order] if order else []), "_hash")
    ranked = keyed.withColumn("_hash", F.xxhash64(*batch.columns)).withColumn("_rank", F.row_number().over(first))
    known = target.select(strip(F.col(key)).alias(key)).distinct()
    return ranked.filter(F.col("_rank") == 1).join(known, key, "left_anti").select(*batch.columns)


def load_counts(target: DataFrame, batch: DataFrame, key: str = "reference") -> DataFrame:
    """Rows of the batch by outcome; the three counts add up to the size of the batch."""
    placed = classify_by_key(target, batch, key).agg(
        F.coalesce(F.sum(F.when(F.col("statut") == INSERTED, 1)), F.lit(0)).alias("n"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"),
    )
    blank = batch.agg(F.count_if(strip(F.coalesce(F.col(key), F.lit(""))) == "")).scalar()
    return (
        placed.withColumn("erreurs", blank)
        .select(F.inline(F.array(
            F.struct(F.lit(INSERTED).alias("statut"), F.col("n").alias("nombre")),
            F.struct(F.lit(SKIPPED).alias("statut"), (F.col("total") - F.col("n")).alias("nombre")),
            F.struct(F.lit(ERROR).alias("statut"), F.col("erreurs").alias("nombre")),
        )))
    )


def upsert_new_by_key(
    target_path: str, batch: DataFrame, key: str = "reference"
) -> DataFrame:
    """Append the new keys of a batch to a Parquet table; gives the counts by outcome.

    The batch is classified once against the table as it was (a table that is not there yet is
    empty) and stored; counts and appended rows come from that one result.  Running the same batch
    again appends nothing.
    """
    spark = batch.sparkSession
    try:
        target = spark.read.schema(batch.schema).parquet(target_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        target = spark.createDataFrame([], batch.schema)
    placed = shared_dir(spark, "classified")
    classify_by_key(target, batch, key).write.parquet(placed)
    classified = spark.read.parquet(placed)
    fresh = classified.filter(F.col("statut") == INSERTED)
    fresh.select(*batch.columns).write.mode("append").parquet(target_path)
    blank = batch.agg(F.count_if(strip(F.coalesce(F.col(key), F.lit(""))) == "")).first()[0]
    total, added = classified.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.count_if(F.col("statut") == INSERTED)).first()
    counts = [(INSERTED, added), (SKIPPED, total - added), (ERROR, blank)]
    return spark.createDataFrame(counts, "statut string, nombre bigint")


def insert_aggregates_if_absent(
    listings: DataFrame, existing: DataFrame, batch: DataFrame, key: str = "reference"
) -> DataFrame:
    """Aggregates of known listings that have none yet, one per listing by the rule of ``classify_by_key``."""
    known = listings.select(strip(F.col(key)).alias(key))
    return new_rows(existing, batch, key).join(known, key, "left_semi").select(*batch.columns)


def _has(schema: T.StructType, path: str) -> bool:
    current: T.DataType = schema
    for part in path.split("."):
        if not isinstance(current, T.StructType) or part not in current.names:
            return False
        current = current[part].dataType
    return True


def _filled(df: DataFrame, path: str) -> Column:
    if not _has(df.schema, path):
        return F.lit(False)
    return F.coalesce(F.col(path).cast("string"), F.lit("")) != ""


def _replace_path(df: DataFrame, path: str, value: Column) -> DataFrame:
    top, _, inner = path.partition(".")
    return df.withColumn(top, F.col(top).withField(inner, value) if inner else value)


def validate_documents(
    df: DataFrame,
    imported_at: str,
    required: list[str] = REQUIRED_PATHS,
    dates: list[str] = DATE_PATHS,
) -> DataFrame:
    """Documents with ``erreur`` (null when valid), dates converted and import stamps.

    A date that cannot be read stays null in the typed column.
    """
    missing = [F.when(~_filled(df, p), F.lit(f"champ requis manquant: {p}")) for p in required]
    blank = F.when(strip(F.coalesce(F.col("reference"), F.lit(""))) == "", F.lit("référence manquante"))
    out = df.withColumn("erreur", F.coalesce(*missing, blank))
    for path in dates:
        if _has(df.schema, path):
            out = _replace_path(out, path, parse_iso_timestamp(F.col(path).cast("string")))
    stamp = F.lit(imported_at).cast("timestamp")
    out = out.withColumn("date_import", stamp)
    if "metadata" in df.columns:
        return out.withColumn("metadata", F.col("metadata").withField("imported_at", stamp))
    return out.withColumn("metadata", F.struct(stamp.alias("imported_at")))
