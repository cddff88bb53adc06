"""Text search through a stored index of trigrams.

Listings are stored in the order of their key, in blocks of consecutive keys.  The index holds, for each
column, which three letters occur in which block.  A search reads the lists of its trigrams, takes the blocks that have
all of them in one column, and reads those blocks only, newest first, until the page is full; ``ILIKE`` decides
about every row.  The index says nothing about patterns without three letters in a row: they read all blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "id_annonce"
COLUMNS = ("titre", "description", "localisation")
BUCKETS = 64
ROWS = 4096  # keys of a block


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, column, block) of rows of (block, lower-case texts), each once per batch.

    A gram is one number of three code points; those that reach over the end of a text are left out.
    """
    for batch in batches:
        blocks = np.asarray(batch.column(0))
        for name, texts in zip(batch.schema.names[1:], batch.columns[1:], strict=True):
            for block in np.unique(blocks):
                own = texts.filter(pa.array(blocks == block)).drop_null().unique()
                joined = "\n".join(own.to_pylist()).encode("utf-32-le", "surrogatepass")
                points = np.frombuffer(joined, dtype="<u4").astype(np.int64)
                if len(points) < 3:
                    continue
                lengths = np.asarray(pc.utf8_length(own), dtype=np.int64)
                inside = np.ones(len(points), dtype=bool)
                ends = np.cumsum(lengths + 1)[:-1] - 1  # between two texts
                for back in range(3):
                    inside[ends[ends >= back] - back] = False
                codes = np.unique((points[:-2] << 42 | points[1:-1] << 21 | points[2:])[inside[:-2]])
                grams = np.stack([codes >> 42, codes >> 21 & 0x1FFFFF, codes & 0x1FFFFF], axis=1).astype("<u4")
                whole = grams.tobytes().decode("utf-32-le", "surrogatepass")
                found = [whole[i:i + 3] for i in range(0, len(whole), 3)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.string()), pa.array([name] * len(found), pa.string()), pa.array(np.full(len(found), block), pa.int64())],
                    names=["gram", "colonne", "bloc"])


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS))


def write_index(df: DataFrame, path: str, key: str = KEY, columns: tuple[str, ...] = COLUMNS, rows: int = ROWS) -> None:
    """Store the listings in blocks and the index of their trigrams.

    Grams are made distinct per block and batch of rows before the shuffle, so a gram of every row is a few rows per block.
    """
    blocks = df.withColumn("bloc", F.floor(F.col(key) / rows).cast("long"))
    stored = blocks.repartitionByRange("bloc").sortWithinPartitions("bloc", key)
    stored.write.option("parquet.block.size", 16 * 1024**2).parquet(f"{path}/annonces")
    kept = df.sparkSession.read.schema(blocks.schema).parquet(f"{path}/annonces")
    low = kept.select("bloc", *(F.lower(F.col(c)).alias(c) for c in columns))
    grams = low.mapInArrow(_grams, "gram string, colonne string, bloc long")
    lists = grams.groupBy("gram", "colonne", "bloc").agg(F.lit(1).alias("un")).select("gram", "colonne", "bloc")
    lists = lists.withColumn("seau", _bucket(F.col("gram"))).hint("rebalance", "seau").sortWithinPartitions("seau", "gram")
    lists.write.partitionBy("seau").parquet(f"{path}/trigrammes")


def _pattern_grams(spark: SparkSession, text: str) -> list[str]:
    """Trigrams that every match must hold: those between wildcards and escapes."""
    parts = [p for p in re.split(r"[%_\\]", text) if len(p) >= 3]
    if not parts:
        return []
    lowered = spark.range(1).select(*[F.lower(F.lit(p)).alias(f"p{i}") for i, p in enumerate(parts)]).first()
    return sorted({p[i:i + 3] for p in lowered for i in range(len(p) - 2)})


def candidate_blocks(spark: SparkSession, path: str, text: str) -> DataFrame | None:
    """Blocks that hold all trigrams of the text in one column; None if the index cannot tell."""
    grams = _pattern_grams(spark, text)
    if not grams:
        return None
    buckets = [r[0] for r in spark.createDataFrame([(g,) for g in grams], "g string").select(_bucket(F.col("g"))).distinct().collect()]
    lists = spark.read.schema("gram STRING, colonne STRING, bloc LONG, seau LONG").parquet(f"{path}/trigrammes")
    met = lists.where(F.col("seau").isin(buckets) & F.col("gram").isin(grams))
    full = met.groupBy("colonne", "bloc").agg(F.count("*").alias("n")).where(F.col("n") == len(grams))
    return full.select("bloc").distinct()


def indexed_search(
    spark: SparkSession, path: str, text: str, limit: int = 100, key: str = KEY, columns: tuple[str, ...] = COLUMNS, first: int = 16
) -> DataFrame:
    """The newest listings with the text in one of the columns: the rows of a scan with ``ILIKE``.

    Blocks are read newest first, twice as many each time, until enough rows are found.
    """
    listings = spark.read.parquet(f"{path}/annonces")
    shown = [c for c in listings.columns if c != "bloc"]
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.ilike(F.col(c), F.lit(f"%{text}%"))
    hits = listings.where(hit)
    blocks = candidate_blocks(spark, path, text)
    if blocks is not None:
        # block numbers only, at most one for every block of the table
        numbers = sorted((r["bloc"] for r in blocks.collect()), reverse=True)
        taken = first
        while taken < len(numbers) and hits.where(F.col("bloc").isin(numbers[:taken])).limit(limit).count() < limit:
            taken *= 2
        hits = hits.where(F.col("bloc").isin(numbers[:taken]))
    return hits.orderBy(F.desc(key)).limit(limit).select(*shown)
