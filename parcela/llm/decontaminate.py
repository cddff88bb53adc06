"""Operator 2: benchmark decontamination by template windows.

Words become template tokens: numbers, units and names turn into typed placeholders, the rest is
lower-cased and freed of punctuation at its edges.  Windows of 13 tokens (a shorter item: its whole length) of documents and
benchmark meet by hash.  A meeting counts if the values in the slots agree: each benchmark value stands for one value of the
document over all windows of the item at that place; two benchmark values may stand for the same.  So a question with
other numbers or names is found, a chance meeting of placeholders is not.  Windows with many slots and whole items of up to 13
tokens also meet word for word, by the words in lower case instead of the template; such a meeting counts by itself.

A bitmap of fixed size (``BITMAP_BITS``) holds the benchmark's window hashes and keeps windows that cannot meet
from being shuffled; it is built by an aggregation and never grows.

Defined results: null and empty texts and items have no windows; items of fewer than ``SHORTEST`` tokens are
not searched; windows in which fewer than 60 % of the tokens are literal are searched word for word only; equal
items and equal rows count once each; rows of one doc_id with different texts are judged apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.llm.shared import fresh, read, stored, text_key
from parcela.llm.words import Words, prefix_sums, range_hash, shingles, signed, slices

WIDTH = 13
SHORTEST = 5
LITERAL_SHARE = 0.6
BITMAP_BITS = 25
SALTS = 16  # parts that the rows of one window are dealt to in the join

# Words that stand for numbers and for units.
NUMBER_WORDS = """one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion
half twice dozen""".split()
UNIT_WORDS = """mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers
kilometre kilometres g kg mg gram grams kilogram kilograms ton tons pound pounds ounce ounces l ml liter liters litre
litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year
years dollar dollars cent cents euro euros usd eur percent degree degrees mph kmh""".split()
WORD_FOR_WORD = np.uint64(0xA5A5A5A5A5A5A500)
NUMBER, UNIT, NAME = (np.uint64(x) for x in (0xA5A5A5A5A5A5A5A1, 0xA5A5A5A5A5A5A5A2, 0xA5A5A5A5A5A5A5A3))


def _marks(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in characters]] = True
    return out


PUNCTUATION = _marks("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
NUMERIC = _marks("0123456789.,:/-")
DIGIT = _marks("0123456789")
UPPER = _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LOWER = _marks("abcdefghijklmnopqrstuvwxyz'-")
LOWER[128:] = True
SENTENCE_END = _marks(".!?:")


def _hash_words(words: list[str]) -> np.ndarray:
    raw = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return np.sort(range_hash(prefix_sums(raw), ends - [len(w.encode()) for w in words], ends))


NUMBER_HASHES, UNIT_HASHES = _hash_words(NUMBER_WORDS), _hash_words(UNIT_WORDS)


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


def template(raw: np.ndarray, offsets: np.ndarray):
    """Tokens of a slice: document, token hash, value hash, whether it is a slot."""
    words = Words(raw, offsets, fold=True)
    start, end = words.start.copy(), words.end.copy()
    while True:
        trim = (end > start) & PUNCTUATION[words.raw[np.maximum(end - 1, 0)]]
        if not trim.any():
            break
        end[trim] -= 1
    while True:
        trim = (end > start) & PUNCTUATION[words.raw[np.minimum(start, len(raw) - 1)]] if len(raw) else np.zeros(0, bool)
        if not trim.any():
            break
        start[trim] += 1
    filled = end > start
    document, word_start, word_end = words.document[filled], words.start[filled], words.end[filled]
    start, end = start[filled], end[filled]
    value = range_hash(prefix_sums(words.raw), start, end)

    def only(marks: np.ndarray, first: np.ndarray) -> np.ndarray:
        others = np.concatenate([[0], np.cumsum(~marks[raw])])
        return others[end] == others[first]

    n = len(start)
    number = (only(NUMERIC, start) & DIGIT[raw[start]]) | _among(value, NUMBER_HASHES) if n else np.zeros(0, bool)
    unit = _among(value, UNIT_HASHES) & ~number
    opens = np.ones(n, bool)  # a sentence or a line
    if n > 1:
        breaks = np.concatenate([[0], np.cumsum(raw == 10)])
        opens[1:] = (document[1:] != document[:-1]) | SENTENCE_END[raw[word_end[:-1] - 1]]
        opens[1:] |= breaks[word_start[1:]] != breaks[word_end[:-1]]
    name = UPPER[raw[start]] & only(LOWER, start + 1) & ~opens & ~number & ~unit if n else np.zeros(0, bool)
    token = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, value)))
    return document, token, value, number | unit | name


def windows(raw: np.ndarray, offsets: np.ndarray, widths: list[int], whole_only: bool):
    """Windows of a slice, width by width, as templates and word for word: document, position, hash, width, slots, verbatim, counted.

    With ``whole_only`` a document gives only the windows of its own width, the least of its number
    of tokens and the largest width, and word for word only those with many slots or of the whole document;
    of a window that it gives both ways one is counted.  ``slots`` makes the values of chosen windows.
    """
    document, token, value, slot = template(raw, offsets)
    sizes = np.bincount(document, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(sizes)])
    slots = np.concatenate([[0], np.cumsum(slot)])
    for width in widths:
        at = np.arange(max(len(token) - width + 1, 0))
        good = document[at] == document[at + width - 1] if len(at) else np.zeros(0, bool)
        if whole_only:
            good &= np.minimum(sizes[document[at]], max(widths)) == width
        literal = (slots[at + width] - slots[at]) <= (1 - LITERAL_SHARE) * width
        for verbatim in (False, True):
            hashes = shingles(value if verbatim else token, width) ^ np.uint64(width) ^ (WORD_FOR_WORD if verbatim else np.uint64(0))
            chosen = good & literal if not verbatim else good & (~literal | (sizes[document[at]] == width)) if whole_only else good
            place = at[chosen]
            counted = ~literal[place] if verbatim else np.ones(len(place), bool)
            yield document[place], place - first[document[place]], hashes[place], width, _slots(place, width, value, slot, verbatim), verbatim, counted


def _slots(place: np.ndarray, width: int, value: np.ndarray, slot: np.ndarray, verbatim: bool):
    def rows(chosen: np.ndarray | slice) -> pa.Array:
        lists = [[] if verbatim else signed(value[a:a + width][slot[a:a + width]]).tolist() for a in place[chosen]]
        return pa.array(lists, pa.list_(pa.int64()))

    return rows


WINDOW = "wh long, at int, width int, slots array<long>, verbatim boolean"


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, wh, at, width, slots, verbatim, counted) of the benchmark's items."""
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, raw, offsets in slices(batch.column(1)):
                for document, at, hashes, width, slots, verbatim, counted in windows(
                        raw, offsets, list(range(SHORTEST, WIDTH + 1)), True):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(document + row)), pa.array(signed(hashes)),
                         pa.array(at.astype(np.int32)), pa.array(np.full(len(at), width, np.int32)),
                         slots(slice(None)), pa.array(np.full(len(at), verbatim)), pa.array(counted)],
                        names=["item_id", "wh", "at", "width", "slots", "verbatim", "counted"])

    return benchmark.select("item_id", "text").distinct().mapInArrow(run, f"item_id {kind}, {WINDOW}, counted boolean")


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, tk, item_id, n_windows, item_windows, exact): items found in documents.

    ``tk`` is the hash of the text in which the item was found.
    """
    spark = docs.sparkSession
    items = stored(benchmark_windows(benchmark), "benchmark-windows")
    widths = sorted(r[0] for r in items.select("width").distinct().collect())
    spot = f"shiftrightunsigned(wh, {64 - BITMAP_BITS})"
    words = (items.selectExpr(f"shiftright({spot}, 6) AS word", f"shiftleft(1L, CAST({spot} & 63 AS INT)) AS bit")
             .groupBy("word").agg(F.bit_or("bit").alias("bits")))
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for batch in words.toArrow().to_batches():  # at most 2^19 rows
        bitmap[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    kept = spark.sparkContext.broadcast(bitmap)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = kept.value.view(np.uint64)
        for batch in batches:
            for row, _, raw, offsets in slices(batch.column(2)):
                for document, at, hashes, width, slots, verbatim, _ in windows(raw, offsets, widths, False):
                    spot = hashes >> np.uint64(64 - BITMAP_BITS)
                    hit = np.flatnonzero((bits[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1))
                    if not len(hit):
                        continue
                    rows = pa.array(document[hit] + row)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(signed(hashes[hit])),
                         pa.array(at[hit].astype(np.int32)), pa.array(np.full(len(hit), width, np.int32)),
                         slots(hit), pa.array(np.full(len(hit), verbatim))],
                        names=["doc_id", "tk", "wh", "at", "width", "slots", "verbatim"])

    found = docs.select("doc_id", text_key("text").alias("tk"), "text").mapInArrow(run, f"doc_id {kind}, tk long, {WINDOW}")
    found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "tk", "at"), F.lit(SALTS)))
    sizes = items.groupBy("item_id").agg(F.count_if("counted").alias("item_windows"))
    known = items.join(sizes, "item_id").select(
        "item_id", "item_windows", "wh", "width", "verbatim", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    pairs = F.arrays_zip("item_slots", "slots")
    met = found.join(known, ["wh", "width", "verbatim", "salt"]).select(
        "doc_id", "tk", "item_id", "item_windows", (F.col("at") - F.col("item_at")).alias("shift"), "item_at", "verbatim", pairs.alias("pairs"))
    # repeated windows of repeated rows fall together in the set; a group is bounded by the item's length
    placed = met.groupBy("doc_id", "tk", "item_id", "item_windows", "shift").agg(
        F.collect_set(F.struct("item_at", "verbatim", "pairs")).alias("windows"))
    every = F.array_distinct(F.flatten(F.transform("windows", lambda w: w["pairs"])))
    placed = placed.select("doc_id", "tk", "item_id", "item_windows", "windows", every.alias("pairs"))
    one_value = F.size(F.array_distinct(F.col("pairs")["item_slots"])) == F.size("pairs")
    # windows that meet word for word, or with all their values, count whether or not the others agree
    placed = placed.withColumn("agreed", one_value).withColumn("windows", F.filter(
        "windows", lambda w: F.col("agreed") | w["verbatim"] | F.forall(w["pairs"], lambda p: p["item_slots"] == p["slots"])))
    n = F.size(F.array_distinct(F.col("windows")["item_at"]))
    same = ~F.col("agreed") | F.forall("pairs", lambda p: p["item_slots"] == p["slots"])
    return placed.where(F.size("windows") > 0).groupBy("doc_id", "tk", "item_id", "item_windows").agg(
        F.max(n).alias("n_windows"), F.max(same).alias("exact"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents in which no item was found, with all their columns."""
    found = stored(matches(docs, benchmark).select("doc_id", "tk").distinct(), "contaminated")
    key, ident = fresh("tk", docs), fresh("found_id", docs)
    found = found.select(F.col("doc_id").alias(ident), F.col("tk").alias(f"{key}_2"))
    marked = docs.withColumn(key, text_key("text"))
    return marked.join(found.hint("merge"), marked["doc_id"].eqNullSafe(found[ident]) & (marked[key] == found[f"{key}_2"]),
                       "left_anti").drop(key)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "item_windows", "exact")
