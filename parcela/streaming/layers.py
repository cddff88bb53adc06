"""Bronze, silver and gold layers: raw envelopes, prepared listings, aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.operators.load import new_rows
from parcela.operators.market import aggregate_listings, market_partials, market_values, stats_of_partials
from parcela.operators.prepare import prepare_listings
from parcela.operators.quality import filter_valid
from parcela.operators.quantiles import node
from parcela.schemas import RAW_LISTING
from parcela.sources.storage import Folder
from parcela.sources.versions import StoredTable
from parcela.streaming.ingest import batch_folder

BRONZE_SCHEMA = (
    "source STRING, data STRING, normalized BOOLEAN, normalized_timestamp TIMESTAMP, "
    "format STRING, processing_step STRING"
)


def to_bronze(path: str):
    """``foreachBatch`` body: envelopes as they come, one folder per batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(batch_folder(path, batch_id))

    return write


def raw_from_envelopes(bronze: DataFrame) -> DataFrame:
    """Listings held in the envelopes' ``data``: the object itself or its inner ``data``."""
    data = F.col("data")
    # a key may be written with escapes; without either the text needs no parsing to know that it holds none
    held = F.when(data.contains("data") | data.contains("\\"), F.get_json_object(data, "$.data"))
    inner = F.coalesce(held, data)
    # as a row of their own: a filter on the fields of a plain struct would parse the text once more for each mention
    return bronze.select(F.inline_outer(F.array(F.from_json(inner, RAW_LISTING))))


def bronze_to_silver(spark: SparkSession, bronze: str, silver: str, as_of_year: int) -> int:
    """Prepared listings of the bronze batches that silver has not taken yet; the number of those batches.

    The version of silver that holds a batch's listings also notes the batch, so a batch is in both or in
    neither, and no batch is read twice.
    """
    table = silver_table(spark, silver)
    version = table.version
    done = table.notes()
    batches = [n for n in Folder(spark, bronze).names() if n.startswith("batch_id=") and n not in done]
    if not batches:
        return 0
    envelopes = spark.read.schema(BRONZE_SCHEMA).parquet(*[f"{bronze}/{n}" for n in batches])
    prepared = prepare_listings(filter_valid(raw_from_envelopes(envelopes), ["titre"]), as_of_year)
    target = table.read().select("reference") if version else spark.createDataFrame([], "reference string")
    added = table.stage(new_rows(target, prepared), _month())
    table.commit(version, add=added, schema=prepared.schema, notes=batches)
    return len(batches)


def _month() -> Column:
    """The month in a listing's date of extraction, null where the text has none."""
    return F.nullif(F.regexp_extract("metadata.date_extraction", r"^(\d{4}-\d{2})-", 1), F.lit(""))


def silver_table(spark: SparkSession, silver: str) -> StoredTable:
    """Prepared listings by month of extraction, indexed by reference."""
    return StoredTable(spark, silver, ["reference"])


def gold_listings(spark: SparkSession, gold: str) -> StoredTable:
    return StoredTable(spark, f"{gold}/listings", ["reference"])


def silver_to_gold(spark: SparkSession, silver: str, gold: str, as_of: str) -> int:
    """Market statistics and aggregated listings; the number of silver files that were new.

    Partials of the statistics are kept for the silver files they were made from.  New files add theirs, so the
    statistics never read the listings again; only when files have left silver (erasure, retention) the partials
    are made anew.  The listings depend on the statistics and are written once more from silver, in one
    pass.  Without any change nothing is done.
    """
    table = silver_table(spark, silver)
    files = set(table.files())
    partials, values = StoredTable(spark, f"{gold}/partials"), StoredTable(spark, f"{gold}/values")
    known = partials.notes()
    fresh = files - known
    listings = gold_listings(spark, gold)
    if files == known and as_of in listings.notes():
        return 0
    one = F.lit("all")
    if known - files:
        fresh = files
    rows = table.read(fresh)
    by_value = market_values(rows).withColumn("noeud", node("m2")).repartitionByRange("m2").sortWithinPartitions("m2")
    for store, frame in ((values, by_value), (partials, market_partials(rows))):
        if fresh == files:  # first run, or files have left
            _replaced(store, frame, one, fresh)
        else:
            store.commit(store.version, add=store.stage(frame, one), notes=fresh)
    stats = stats_of_partials(partials.read(), values.read())
    stats.coalesce(1).write.mode("overwrite").parquet(f"{gold}/market_stats")
    enriched = aggregate_listings(table.read(), as_of, spark.read.parquet(f"{gold}/market_stats"))
    _replaced(listings, enriched, _month(), [as_of])
    return len(fresh)


def _replaced(table: StoredTable, rows: DataFrame, part: Column, notes) -> None:
    """All rows of a table by others."""
    version = table.version
    added = table.stage(rows, part)
    table.commit(version, remove=table.files(), add=added, schema=rows.schema, notes=notes, forget=True)
    table.vacuum()
