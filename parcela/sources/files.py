"""Readers and writers of listing files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcela.functions.text import postal_code_anywhere
from parcela.schemas import CATALOGUE_CSV, OUTPUT_FIELDS, RAW_LISTING, SNAPSHOT

CORRUPT = "_corrupt_record"


def read_listings_json(
    spark: SparkSession, path: str, schema: T.StructType = RAW_LISTING, multiline: bool = True
) -> DataFrame:
    """Listings of JSON files; what does not parse comes with ``_corrupt_record`` filled.

    A file that holds one JSON array is read by one task.  Large inputs should be JSON lines
    (``multiline=False``), which split.
    """
    if multiline:
        parsed = spark.read.text(path, wholetext=True).select(
            "value", F.from_json("value", T.ArrayType(schema)).alias("_rows")
        )
        rows = parsed.select("value", F.explode_outer("_rows").alias("_r"), F.col("_rows").isNull().alias("_bad"))
        return rows.filter(F.col("_bad") | F.col("_r").isNotNull()).select(
            "_r.*", F.when(F.col("_bad"), F.col("value")).alias(CORRUPT)
        )
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"columnNameOfCorruptRecord": CORRUPT}
    lines = spark.read.text(path).filter(F.col("value") != "")
    return lines.select(F.from_json("value", wanted, options).alias("_r")).select("_r.*")


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable rows, and the quarantine of unreadable ones."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_snapshots(spark: SparkSession, glob: str, multiline: bool = True) -> DataFrame:
    """Rows of all run files with the run's stamp (``_yyyyMMdd_HHmmss``) from their path.

    ``media_info`` is text in some files and an object in others; it stays as JSON text.
    """
    stamp = F.regexp_extract(F.col("_metadata.file_path"), r"_(\d{8}_\d{6})(?:\.json|/)", 1)
    return (
        spark.read.schema(SNAPSHOT).option("multiLine", multiline).json(glob)
        .select("*", F.col("_metadata.file_name").alias("fichier"),
                F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmmss")).alias("horodatage"))
    )


def media_info(df: DataFrame, column: str = "media_info") -> Column:
    """The media block of a snapshot row as a struct, from either of its two forms."""
    schema = "nombre_photos INT, has_video BOOLEAN, has_visite_virtuelle BOOLEAN, media_description STRING"
    return F.from_json(F.col(column), schema)


def write_parquet(df: DataFrame, path: str, stamp: str | None = None, partition_by: list[str] | None = None) -> str:
    """Overwrite a Parquet folder, named by the run's stamp when one is given."""
    target = f"{path}_{stamp}" if stamp else path
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
    return target


def write_bucketed(df: DataFrame, name: str, key: str = "id_annonce", buckets: int = 512) -> str:
    """A catalogue table bucketed and sorted by its key.

    Tables of one listing model written with the same key and number of buckets join on the key
    without a shuffle.
    """
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return name


def _flat_columns(schema: T.StructType, prefix: str = "") -> list[Column]:
    out = []
    for field in schema.fields:
        path = f"{prefix}{field.name}"
        if isinstance(field.dataType, T.StructType):
            out += _flat_columns(field.dataType, f"{path}.")
        else:
            value = F.col(path)
            if isinstance(field.dataType, T.ArrayType | T.MapType | T.VariantType):
                value = F.to_json(value)
            out.append(value.alias(path.replace(".", "_")))
    return out


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header; structs become flat columns and arrays JSON text."""
    df.select(*_flat_columns(df.schema)).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str, compression: str | None = None) -> str:
    """JSON lines without null keys; a file of a compression such as gzip is read by one task."""
    df.write.mode("overwrite").json(path, compression=compression)
    return path


def write_json_arrays(df: DataFrame, path: str, key: str, count: int) -> str:
    """So many files of one JSON array each, an element per line, rows dealt to them by a hash of the key.

    A file is written row by row from its sorted rows; no array is ever held as a whole.
    """
    rows = df.select(
        F.to_json(F.struct("*")).alias("j"), F.pmod(F.xxhash64(key), F.lit(count)).alias("f"), F.xxhash64(key).alias("h"))
    order = Window.partitionBy("f").orderBy("h", "j")
    numbered = rows.select("f", "j", F.row_number().over(order).alias("n"), F.lead("f").over(order).isNull().alias("last"))
    line = F.concat(F.when(F.col("n") == 1, "[").otherwise(""), "j", F.when(F.col("last"), "]").otherwise(","))
    numbered.sortWithinPartitions("f", "n").select(line.alias("value"), "f").write.partitionBy("f").text(path)
    return path


def write_results(df: DataFrame, path: str, output_format: str = "parquet", stamp: str | None = None) -> str:
    writers = {"parquet": write_parquet, "csv": write_csv, "json": write_json}
    if output_format.lower() not in writers:
        raise ValueError(f"unsupported format: {output_format}")
    return writers[output_format.lower()](df, f"{path}_{stamp}" if stamp else path)


def project_output_fields(
    df: DataFrame,
    extracted_at: str,
    fields: list[str] = OUTPUT_FIELDS,
    transaction: str = "acheter",
    property_type: str = "ancien",
    present_only: bool = False,
) -> DataFrame:
    """The configured fields in order, "" where the input has none.

    Extraction date, transaction and property type are those of the run; the postal code is taken
    from the location, or the title when there is no location.  ``present_only`` keeps just the
    configured fields that the input has, as they are.
    """
    if present_only:
        return df.select(*[n for n in fields if n in df.columns])

    def given(name: str) -> Column:
        if name not in df.columns:
            return F.lit("")
        if isinstance(df.schema[name].dataType, T.StringType):
            return F.coalesce(F.col(name), F.lit(""))
        return F.col(name)

    place = F.coalesce(F.nullif(given("localisation"), F.lit("")), given("titre"))
    found = F.coalesce(postal_code_anywhere(place, F.lit(None).cast("string")), F.lit(""))
    run = {
        "date_extraction": F.lit(extracted_at),
        "type_transaction": F.lit(transaction),
        "type_bien": F.lit(property_type),
        "code_postal": given("code_postal") if "code_postal" in df.columns else found,
    }
    return df.select(*[run.get(name, given(name)).alias(name) for name in fields])


def describe_catalogue_csv(spark: SparkSession, path: str) -> DataFrame:
    """Column metadata kept as CSV, with ``NULL`` for absent values."""
    return (
        spark.read.schema(CATALOGUE_CSV).option("header", True).option("nullValue", "NULL").csv(path)
    )


def list_input_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Name, size and rows of the files of a folder.

    Sizes come from the listing; the contents are read as lines only to count them.  The file
    source leaves out empty files.
    """
    sizes = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("nom"), F.col("length").alias("taille"))
    )
    lines = (
        spark.read.option("pathGlobFilter", pattern).text(path)
        .groupBy(F.col("_metadata.file_name").alias("nom")).agg(F.count("*").alias("lignes"))
    )
    return sizes.join(lines, "nom", "left").fillna(0, ["lignes"])
