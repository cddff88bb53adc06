"""Stored intermediate tables and other helpers that several operators use."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.session import shared_dir

TEXT_COLUMNS = ("doc_id", "text")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the folder all executors share and read it back.

    Cuts the lineage: a lost executor costs at most the current job, and every reader sees the same
    rows.
    """
    path = shared_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_key(text: str | Column) -> Column:
    """Tells apart texts that stand under the same doc_id (rows of equal id and text are one)."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has."""
    taken = {c.lower() for f in frames for c in f.columns}
    return name if name.lower() not in taken else f"{name}_{uuid.uuid4().hex[:8]}"


def sampled(frame: DataFrame, by_hash: Column, rows: int, wanted: int) -> DataFrame:
    """About ``wanted`` of the frame's ``rows`` rows, those with the smallest hashes; each task drops the others."""
    if rows <= wanted:
        return frame
    return frame.where(by_hash < F.lit(int((2 * wanted / rows - 1) * 2**63)))
