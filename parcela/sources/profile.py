"""Profiles of the registered tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_count_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table with a status; one aggregate per table, put together by union."""
    counts = [
        df.agg(F.count("*").alias("nombre")).select(F.lit(name).alias("nom_table"), "nombre")
        for name, df in sorted(tables.items())
    ]
    joined = reduce(DataFrame.unionByName, counts)
    return joined.withColumn("statut", F.when(F.col("nombre") > 0, "ok").otherwise("vide"))


def profile_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Name, type and nullability of every column of every table (schema facts, no scan)."""
    rows = [
        (name, field.name, i, field.dataType.simpleString(), field.nullable)
        for name, df in sorted(tables.items())
        for i, field in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(
        rows, "nom_table string, colonne string, position int, type string, nullable boolean"
    )


def profile_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Columns of every table with the table's row count."""
    return profile_columns(spark, tables).join(
        table_count_report(tables).select("nom_table", "nombre"), "nom_table"
    )


def sample_rows(df: DataFrame, n: int = 2) -> DataFrame:
    """A few rows as JSON text, for display."""
    return df.limit(n).select(F.to_json(F.struct("*")).alias("ligne"))
