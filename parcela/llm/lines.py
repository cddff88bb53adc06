"""Operator 8: line deduplication by content-defined chunks of lines, in DataFrame functions only.

Each line is hashed; a chunk begins where the hash of two neighbouring line hashes falls into a
quarter of its range, so boundaries move with the text and not with line numbers.  Chunks of two lines or more
that occur more than once anywhere keep their first occurrence (smallest doc_id, then text hash,
then place); the others are removed.  Hashes only find candidates: occurrences are grouped and
joined on the bytes of the chunk.

Only chunks whose hash repeats are shuffled with their text; equal chunks are combined before the
shuffle, and the join back has plain exchanges on both sides, which adaptive execution can split.

Defined results: a null text stays null and has no lines; an empty text is one empty line; equal rows of one doc_id
are one document and are treated alike; the last line needs no line end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.llm.shared import read, stored, text_key

LEAST_LINES = 2
QUARTER = "4"  # hex digit below which a boundary falls


def _once(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once for each row, however often lambdas refer to it."""
    return frame.select("*", F.explode(F.array(value)).alias(name))


def chunked(frame: DataFrame) -> DataFrame:
    """Replace ``text`` by ``chunks``, an array of (number, n_lines, body); null for a null text."""
    frame = _once(frame, "lines", F.split("text", "\n", -1)).drop("text")
    frame = _once(frame, "hashes", F.transform("lines", lambda line: F.md5(line.cast("binary"))))

    def begins(i: Column) -> Column:
        pair = F.concat(F.get("hashes", i - 1), F.get("hashes", i))
        return (i == 0) | (F.substring(F.md5(pair.cast("binary")), 1, 1) < QUARTER)

    starts = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), begins)
    frame = _once(frame, "starts", F.when(F.col("lines").isNotNull(), starts)).drop("hashes")

    def chunk(start: Column, number: Column) -> Column:
        end = F.coalesce(F.get("starts", number + 1), F.size("lines"))
        return F.struct(number.alias("number"), (end - start).alias("n_lines"),
                        F.array_join(F.slice("lines", start + 1, end - start), "\n").alias("body"))

    return _once(frame, "chunks", F.transform("starts", chunk)).drop("lines", "starts")


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, tk, number, n_lines) of the chunks that are to go."""
    texts = docs.select("doc_id", text_key("text").alias("tk"), "text").where("text IS NOT NULL")
    rows = chunked(texts).select("doc_id", "tk", F.inline("chunks")).where(F.col("n_lines") >= LEAST_LINES)
    rows = rows.withColumn("hash", F.xxhash64("body"))
    often = rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    again = rows.join(stored(often, "repeated-hashes"), "hash").select("body", "doc_id", "tk", "number", "n_lines")
    again = stored(again, "repeated-chunks")
    place = F.struct("doc_id", "tk", "number")
    first = stored(again.groupBy("body").agg(F.min(place).alias("first")), "first-chunks")
    met = again.join(first, "body")
    return met.where(~place.eqNullSafe(F.col("first"))).select("doc_id", "tk", "number", "n_lines").distinct()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(row, text, n_lines, n_removed): each row as it was, and what is left of its text."""
    gone = repeats(docs).groupBy("doc_id", "tk").agg(
        F.collect_set("number").alias("gone"), F.sum("n_lines").cast("int").alias("n_removed"))
    gone = stored(gone, "removed-chunks").withColumnsRenamed({"doc_id": "lost_id", "tk": "lost_tk"})
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), text_key("text").alias("tk"))
    met = rows.join(gone.hint("merge"), F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("tk") == F.col("lost_tk")), "left")
    met = met.select("row", "gone", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                     F.when(F.col("gone").isNotNull(), F.col("row.text")).alias("text"))
    met = _once(chunked(met), "left", F.array_except(F.sequence(F.lit(0), F.size("chunks") - 1), "gone"))
    left = F.array_join(F.transform("left", lambda i: F.get("chunks", i)["body"]), "\n")
    return met.select("row", F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(left).alias("text"),
                      F.coalesce(F.size(F.split("row.text", "\n", -1)), F.lit(0)).alias("n_lines"), "n_removed")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows with what is left of their texts; ``n_chars``, if there, follows the text."""
    rows = remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))
    own = {"text": F.col("text"), "n_chars": F.coalesce(F.col("n_chars"), F.col("row").getField("n_chars"))
           if "n_chars" in docs.columns else None}
    return rows.select(*(own[c].alias(c) if c in own else F.col("row").getField(c).alias(c) for c in docs.columns))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(read(spark, sf_dir, "documents"))
    return rows.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "text")


OP8_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL
), h AS (
  SELECT *, md5(line) AS m, lag(md5(line)) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM l
), c AS (
  SELECT *, sum(CASE WHEN before IS NULL OR substr(md5(before || m), 1, 1) < '4' THEN 1 ELSE 0 END)
            OVER (PARTITION BY doc_id ORDER BY pos) AS number FROM h
), b AS (
  SELECT doc_id, number, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS body FROM c GROUP BY doc_id, number
), r AS (
  SELECT *, n >= 2 AND row_number() OVER (PARTITION BY body, n >= 2 ORDER BY doc_id, number) > 1 AS gone FROM b
), k AS (
  SELECT doc_id, CAST(sum(n) AS INTEGER) AS n_lines, CAST(sum(CASE WHEN gone THEN n ELSE 0 END) AS INTEGER) AS n_removed,
         coalesce(string_agg(body, chr(10) ORDER BY number) FILTER (WHERE NOT gone), '') AS kept
  FROM r GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, kept AS text
FROM documents LEFT JOIN k USING (doc_id)
"""
