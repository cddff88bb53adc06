"""Operator 7: exact top-k search by inner product with MaxScore.

Terms are the components of a vector, postings their values over the rows of a shard.  For a block
of queries the terms are ordered by the spread of their possible contributions.  The essential terms
are summed for every row of the shard; a row goes on to the non-essential terms only while its sum plus the
largest possible rest reaches the k-th best score known so far.  The best k of each shard are
merged.

Every query meets every row, in cells of one query block and one shard of bounded size; nothing is
broadcast.

Vectors with components so large that 64 bits could overflow in a sum are scored apart, in integers of any
size; a score beyond 64 bits is given as the nearest one that fits.

Defined results: vectors that are null or hold null or non-finite components, and null ids, take no part (nor
do components above 2^1017, whose scaled value is not finite); a shorter vector counts as zero beyond its end; rows of the
same id are never a query's candidates, and equal rows of one id count once.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcela.llm.shared import read

SHARD_ROWS = 8192
BLOCK_QUERIES = 1024
STEP = 16  # terms that are summed before the next look at the bounds


def scaled(vector: str | Column, factor: int = 64) -> Column:
    """floor(factor * component) of each component, as whole doubles; null where the vector takes no part."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    values = F.transform(vector, lambda x: x.cast("double") * factor)
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(values, lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))
    return F.when(sound, whole)


def top_of_shard(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """Best k rows of one shard for each query, and of the wide rows beside them: query ids, row ids, scores."""
    most = np.sqrt(2.0**62 / max(1, rows.shape[1]))
    wide, asks_wide = (np.abs(m).max(axis=1, initial=0) >= most for m in (rows, queries))
    parts = [_bounded(ids[~wide], rows[~wide].astype(np.int64), query_ids[~asks_wide], queries[~asks_wide].astype(np.int64), k)]
    if wide.any():
        parts.append(_unbounded(ids[wide], rows[wide], query_ids, queries, k))
    if asks_wide.any():
        parts.append(_unbounded(ids[~wide], rows[~wide], query_ids[asks_wide], queries[asks_wide], k))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _unbounded(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """The same in Python's integers, every row for every query."""
    exact = [[int(x) for x in row] for row in rows.tolist()]
    out = []
    for query, vector in zip(query_ids.tolist(), ([int(x) for x in q] for q in queries.tolist()), strict=True):
        used = [(i, x) for i, x in enumerate(vector) if x]
        found = ((-sum(x * row[i] for i, x in used), vec) for vec, row in zip(ids.tolist(), exact, strict=True) if vec != query)
        out += [(query, vec, min(max(-score, -2**63), 2**63 - 1)) for score, vec in heapq.nsmallest(k, found)]
    columns = list(zip(*out, strict=True)) or [(), (), ()]
    return tuple(np.array(c, np.int64) for c in columns)


def _bounded(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """Best k rows of one shard for each query: query ids, row ids, scores."""
    if not len(rows) or not len(queries):
        return (np.zeros(0, np.int64),) * 3
    limit = float(np.abs(rows).max()) * float(np.abs(queries).max()) * rows.shape[1]
    kind = np.float64 if limit < 2.0**52 else np.int64
    rows, queries = rows.astype(kind), queries.astype(kind)
    high, low = rows.max(axis=0), rows.min(axis=0)
    order = np.argsort(-(np.abs(queries).mean(axis=0) * (high - low)), kind="stable")
    rows, queries, high, low = rows[:, order], queries[:, order], high[order], low[order]
    bounds = np.maximum(queries * high, queries * low)
    rest = np.cumsum(bounds[:, ::-1], axis=1)[:, ::-1]  # rest[q, t]: most that terms t.. can add
    rest = np.concatenate([rest, np.zeros((len(queries), 1), kind)], axis=1)
    essential = min(STEP, rows.shape[1])
    out_q, out_r, out_s = [], [], []
    for at in range(0, len(queries), 64):
        partial = queries[at:at + 64, :essential] @ rows[:, :essential].T
        for q in range(at, min(at + 64, len(queries))):
            sums = partial[q - at].copy()
            own = ids == query_ids[q]
            if own.any():
                sums[own] = -np.inf if kind is np.float64 else np.iinfo(np.int64).min // 4
            others = len(sums) - int(own.sum())
            if others == 0:
                continue
            need = min(k, others)
            seeds = np.argpartition(-sums, min(4 * need, len(sums)) - 1)[:4 * need]
            seeds = seeds[~own[seeds]]
            exact = sums[seeds] + rows[seeds, essential:] @ queries[q, essential:]
            threshold = np.partition(exact, len(exact) - need)[len(exact) - need]
            alive = np.flatnonzero((sums + rest[q, essential] >= threshold) & ~own)
            values = sums[alive]
            for term in range(essential, rows.shape[1], STEP):
                end = min(term + STEP, rows.shape[1])
                values = values + rows[alive, term:end] @ queries[q, term:end]
                good = values + rest[q, end] >= threshold
                alive, values = alive[good], values[good]
            best = np.lexsort((ids[alive], -values))[:k]
            out_q.append(np.full(len(best), query_ids[q]))
            out_r.append(ids[alive[best]])
            out_s.append(values[best].astype(np.int64))
    if not out_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_q), np.concatenate(out_r), np.concatenate(out_s)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    at = 0
    for chunk in column.chunks:
        cuts = chunk.offsets.to_numpy().astype(np.int64)
        values = chunk.values.to_numpy(zero_copy_only=False)
        sizes = np.diff(cuts)
        if len(sizes) and (sizes == width).all():
            out[at:at + len(chunk)] = values[cuts[0]:cuts[-1]].reshape(-1, width)
        else:
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                out[at + i, :b - a] = values[a:b]
        at += len(chunk)
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, shard_rows: int = SHARD_ROWS,
          block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) over rows ``vec_id long, terms array<double>`` of whole numbers."""
    rows = vectors.where("vec_id IS NOT NULL AND terms IS NOT NULL")
    rows = rows.groupBy("vec_id", "terms").agg(is_query.alias("asks"))
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-asked // block_queries))
    part = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards))
    block = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks))
    searched = rows.select("vec_id", "terms", part.alias("shard"),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    asking = rows.where("asks").select("vec_id", "terms", block.alias("block"),
                                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))

    def cell(searched: pa.Table, asking: pa.Table) -> pa.Table:
        width = 1
        for table in (searched, asking):
            for chunk in table.column("terms").chunks:
                width = max(width, int(np.diff(chunk.offsets.to_numpy()).max(initial=0)))
        found = (np.zeros(0, np.int64),) * 3
        if searched.num_rows and asking.num_rows:
            found = top_of_shard(searched.column("vec_id").to_numpy(), _matrix(searched.column("terms"), width),
                                 asking.column("vec_id").to_numpy(), _matrix(asking.column("terms"), width), k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    found = (searched.groupBy("shard", "block").cogroup(asking.groupBy("shard", "block"))
             .applyInArrow(cell, "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op7_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", scaled("embedding").alias("terms"))
    return top_k(vectors, F.col("vec_id") % 20 == 0)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.c, d.c) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
