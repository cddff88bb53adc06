"""Deduplication of a stream with a horizon: a key counts as new again once the horizon has passed.

A row is kept if no kept row of its key lies within the horizon before it.  Per key that is a run in time order
whose only state is the last kept time.  So that a key with a large part of all rows does not run through one task, time
is cut into chunks of ``CHUNK`` horizons.  Each chunk is first reduced, for every time at which the key may count as new
again, to the last row that would then be kept in it; the chunks of a key are chained on these short tables; with its
entry time known, each chunk marks its rows.  Every step reads a sorted partition as a stream.

Kept rows of earlier batches take part as rows that are kept whatever comes before them.  Which of them are read is
decided by Bloom filters, one per time slice of a horizon: bitmaps in buckets of 32,768 bits, written with each
batch.  Filters of slices that lie ``slices`` behind the newest are removed; for rows that old the kept rows are looked
up without one, so late rows are judged exactly as well.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.session import shared_dir
from parcela.sources.storage import Folder

CHUNK = 8
ALWAYS, NEVER = -(2**62), 2**62
PROBES = 3


def micros(span: str) -> int:
    return int(pd.Timedelta(span).value // 1000)


def _groups(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """A number for each row that changes with the group; rows of a group stand together."""
    starts = np.zeros(batch.num_rows, bool)
    for name in keys:
        column = batch.column(name)
        here, before = column.slice(1), column.slice(0, max(len(column) - 1, 0))
        same = pc.or_kleene(pc.fill_null(pc.equal(here, before), False), pc.and_(pc.is_null(here), pc.is_null(before)))
        starts[1:] |= ~np.asarray(same)
    return np.cumsum(starts)


def _head(batch: pa.RecordBatch, keys: list[str], at: int) -> tuple:
    return tuple(batch.column(k)[at].as_py() for k in keys)


def jumps(group: np.ndarray, t: np.ndarray, old: np.ndarray, horizon: int) -> np.ndarray:
    """For each row, if it is kept: the row of its group that is kept next, or itself."""
    n = len(t)
    if not n:
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    rank = np.searchsorted(first, np.arange(n), "right") - 1
    base = t[first][rank]
    span = int((t - base).max()) + horizon + 1
    if span * (len(first) + 1) < 2**63:
        place = (t - base) + rank * span
        after = np.searchsorted(place, place + horizon)
    else:  # few groups at a time reach so far
        ends = np.r_[first[1:], n]
        after = np.concatenate([a + np.searchsorted(t[a:b], t[a:b] + horizon) for a, b in zip(first, ends, strict=True)])
    following = np.where(old, np.arange(n), n)
    following = np.minimum.accumulate(np.r_[following[1:], n][::-1])[::-1]
    end = np.r_[first[1:], n][rank]
    target = np.minimum(after, following)
    return np.where(target < end, target, np.arange(n))


def _tables(key: str, horizon: int) -> Callable:
    """Per chunk: rows (key, chunk, upto, exit): entered at a time up to ``upto``, the last kept row is at ``exit``."""
    keys = [key, "_chunk"]

    def reduce(batch: pa.RecordBatch) -> pa.RecordBatch:
        group, t = _groups(batch, keys), batch.column("_t").to_numpy()
        old = batch.column("_old").to_numpy(zero_copy_only=False)
        jump = jumps(group, t, old, horizon)
        last, further = jump, jump[jump]
        while (further != last).any():
            last, further = further, further[further]
        chunk = batch.column("_chunk").to_numpy()
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else group
        rank = np.searchsorted(first, np.arange(len(t)), "right") - 1
        closes = old | (t >= (chunk * CHUNK + 1) * horizon)  # nothing later can be an entry
        closed = np.cumsum(closes) - closes
        entry = np.flatnonzero(closed == closed[first][rank]) if len(t) else group
        leaves = t[last[entry]]
        same = np.zeros(len(entry), bool)
        same[:-1] = (rank[entry][1:] == rank[entry][:-1]) & (leaves[1:] == leaves[:-1])
        entry, leaves = entry[~same], leaves[~same]
        upto = np.where(old[entry], NEVER, t[entry])
        return pa.RecordBatch.from_arrays(
            [batch.column(key).take(pa.array(entry)), pa.array(chunk[entry]), pa.array(upto), pa.array(leaves)],
            names=[key, "_chunk", "_upto", "_exit"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # the last chunk waits for the next rows
        for batch in batches:
            whole = batch if kept is None else pa.Table.from_batches([kept, batch]).combine_chunks().to_batches()[0]
            if not whole.num_rows:
                continue
            group = _groups(whole, keys)
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield reduce(whole.slice(0, cut))
            kept = whole.slice(cut)
        if kept is not None:
            yield reduce(kept)

    return run


def _chained(key: str, horizon: int) -> Callable:
    """Per chunk: (key, chunk, entry): the time from which the key counts as new."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chunk, new, entered = object(), None, ALWAYS, False
        for batch in batches:
            keys, chunks, entries = [], [], []
            rows = zip(*(batch.column(n).to_pylist() for n in (key, "_chunk", "_upto", "_exit")), strict=True)
            for at, of, upto, leaves in rows:
                if at != now:
                    now, chunk, new = at, None, ALWAYS
                if of != chunk:
                    chunk, entered = of, False
                    entry = new
                    keys.append(at)
                    chunks.append(of)
                    entries.append(entry)
                if not entered and entry <= upto:
                    entered, new = True, leaves + horizon
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.column(key).type), pa.array(chunks, pa.int64()), pa.array(entries, pa.int64())],
                names=[key, "_chunk", "_entry"])

    return run


def _marked(key: str, horizon: int, columns: list[str]) -> Callable:
    """The rows to keep; each chunk is headed by its entry time (``_ord`` 0, in ``_t``)."""
    keys = [key, "_chunk"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, new = None, ALWAYS
        for batch in batches:
            if not batch.num_rows:
                continue
            group, t = _groups(batch, keys), batch.column("_t").to_numpy()
            head = batch.column("_ord").to_numpy() == 0
            old = batch.column("_old").to_numpy(zero_copy_only=False) & ~head
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            entry = np.where(head[first], t[first], ALWAYS)
            if not head[0] and _head(batch, keys, 0) == of:
                entry[0] = new
            # a row that only says when to begin stands before all others and is jumped from like a kept one
            rows = np.flatnonzero(~head)
            row_group, row_t, row_old = group[rows], t[rows], old[rows]
            jump = jumps(row_group, row_t, row_old, horizon)
            fits = np.flatnonzero(row_old | (row_t >= entry[row_group]))
            _, where = np.unique(row_group[fits], return_index=True)
            active, keep = fits[where], np.zeros(len(rows), bool)
            while len(active):
                keep[active] = True
                active = active[jump[active] != active]
                active = jump[active]
            of = _head(batch, keys, batch.num_rows - 1)
            mine = np.flatnonzero(keep & (row_group == group[-1]))
            new = int(row_t[mine[-1]]) + horizon if len(mine) else int(entry[-1])
            chosen = rows[keep & ~row_old]
            yield batch.take(pa.array(chosen)).select(columns)

    return run


def keep_by_horizon(rows: DataFrame, before: DataFrame, key: str, ts: str, horizon: str) -> DataFrame:
    """The rows that are no repetition within the horizon, after the kept rows (key, ts) of earlier batches.

    Of rows with equal key and time the one with the smallest row hash counts.  A null key is a key; rows without a time
    repeat nothing and are all kept.
    """
    h = micros(horizon)
    time = F.unix_micros(F.col(ts).cast("timestamp"))
    columns = rows.columns
    timed = rows.where(F.col(ts).isNotNull())
    others = [c for c in columns if c not in (key, ts)]
    one = timed.groupBy(key, ts).agg(F.min_by(F.struct(F.lit(0).alias("_"), *others), F.xxhash64(*columns)).alias("_row"))
    one = one.select(key, ts, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*columns)

    def flagged(frame: DataFrame, old: bool) -> DataFrame:
        return frame.withColumns({"_t": time, "_old": F.lit(old), "_ord": F.lit(1)})

    both = flagged(one, False).unionByName(flagged(before.select(key, ts), True), allowMissingColumns=True)
    both = both.withColumn("_chunk", F.floor(F.col("_t") / (CHUNK * h)).cast("long"))
    path = shared_dir(rows.sparkSession, "dedup-rows")
    both.write.parquet(path)
    both = rows.sparkSession.read.schema(both.schema).parquet(path)
    kind = rows.schema[key].dataType.simpleString()
    dealt = both.select(key, "_chunk", "_t", "_old").repartition(key, "_chunk").sortWithinPartitions(key, "_chunk", "_t", F.desc("_old"))
    tables = dealt.mapInArrow(_tables(key, h), f"`{key}` {kind}, _chunk long, _upto long, _exit long")
    tables = tables.repartition(key).sortWithinPartitions(key, "_chunk", "_upto")
    entries = tables.mapInArrow(_chained(key, h), f"`{key}` {kind}, _chunk long, _entry long")
    heads = entries.select(key, "_chunk", F.col("_entry").alias("_t"), F.lit(False).alias("_old"), F.lit(0).alias("_ord"))
    dealt = both.unionByName(heads, allowMissingColumns=True).repartition(key, "_chunk")
    dealt = dealt.sortWithinPartitions(key, "_chunk", "_ord", "_t", F.desc("_old"))
    kept = dealt.mapInArrow(_marked(key, h, columns), rows.schema)
    return kept.unionByName(rows.where(F.col(ts).isNull()))


# -- Bloom filters ---------------------------------------------------------------------------------


def _places(key: str, buckets: int) -> list[Column]:
    """Bucket of a key, and its bits there as numbers for the bitmap functions."""
    def place(i: int) -> Column:
        return F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(32768))

    return [F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).alias("bucket"), F.array(*(place(i) for i in range(PROBES))).alias("bits")]


def bloom(kept: DataFrame, key: str, buckets: int) -> DataFrame:
    """(slice, bucket, bitmap) over the keys of each slice."""
    bits = kept.select("slice", *_places(key, buckets)).select("slice", "bucket", F.explode("bits").alias("bit"))
    return bits.groupBy("slice", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def maybe_known(asked: DataFrame, filters: DataFrame, key: str, buckets: int, oldest: int) -> DataFrame:
    """The (key, slice) pairs that the filters do not rule out; slices before the oldest have none and stay."""
    merged = filters.groupBy("slice", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    met = asked.select(key, "slice", *_places(key, buckets)).join(merged, ["slice", "bucket"], "left")

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring("bitmap", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (bit % 8).cast("int")) == 1

    hit = F.col("bitmap").isNotNull() & F.forall("bits", is_set)
    return met.where(hit | (F.col("slice") < oldest)).select(key, "slice")


def dedup_into(path: str, key: str, ts: str, horizon: str = "7 days", slices: int = 8, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: the rows of a batch that are no repetition within the horizon.

    Kept rows lie in ``path`` by batch and time slice, filters beside them.  A batch that is run again sees the same earlier
    batches and replaces its own folders.
    """
    h = micros(horizon)
    filters_path = f"{path}/_filters"
    of_slice = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / h).cast("long")

    def known(batch: DataFrame, batch_id: int) -> DataFrame | None:
        spark = batch.sparkSession
        if not Folder(spark, filters_path).exists():
            return None
        fields = f"`{key}` {batch.schema[key].dataType.simpleString()}, `{ts}` {batch.schema[ts].dataType.simpleString()}, batch_id LONG, slice LONG"
        stored = spark.read.schema(fields).parquet(path).where((F.col("batch_id") < batch_id) & F.col("slice").isNotNull())
        filters = spark.read.schema("bucket LONG, bitmap BINARY, slice LONG, batch_id LONG").parquet(filters_path).where(
            F.col("batch_id") < batch_id)
        oldest = _oldest(spark, filters_path)
        # what was kept in a row's own slice or the one before may lie within the horizon before it
        asked = batch.where(F.col(ts).isNotNull()).select(key, F.explode(F.array(of_slice, of_slice - 1)).alias("slice")).distinct()
        asked = maybe_known(asked, filters, key, buckets, oldest)
        asked = asked.withColumnsRenamed({key: "_asked_key", "slice": "_asked_slice"})
        wanted = F.col(key).eqNullSafe(F.col("_asked_key")) & (F.col("slice") == F.col("_asked_slice"))
        return stored.join(asked, wanted, "left_semi").select(key, ts)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = known(batch, batch_id)
        if before is None:
            before = batch.select(key, ts).limit(0)
        kept = keep_by_horizon(batch, before, key, ts, horizon).withColumn("slice", of_slice)
        folder = f"{path}/batch_id={batch_id}"
        kept.write.mode("overwrite").partitionBy("slice").parquet(folder)
        written = spark.read.schema(kept.schema).parquet(folder).where("slice IS NOT NULL").select(key, "slice")
        newest = max(_slices(spark, filters_path) + _slices(spark, folder), default=0)
        filters = bloom(written.where(F.col("slice") > newest - slices), key, buckets)
        filters = filters.withColumn("batch_id", F.lit(batch_id).cast("long"))
        filters.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slice", "batch_id").parquet(filters_path)
        for number in _slices(spark, filters_path):
            if number <= newest - slices:
                Folder(spark, f"{filters_path}/slice={number}").remove()

    return write


def _slices(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the slice folders; rows without a time lie in one without a number."""
    return [int(name[6:]) for name in Folder(spark, path).names() if re.fullmatch(r"slice=-?\d+", name)]


def _oldest(spark: SparkSession, path: str) -> int:
    """The oldest slice that still has a filter; older ones are looked up without."""
    return min(_slices(spark, path), default=NEVER)
