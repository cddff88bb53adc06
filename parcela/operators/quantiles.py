"""Exact quantiles that never hold the rows of a group in one task.

``percentile`` keeps every distinct value of a group in one aggregation buffer.  Here values are
counted before the shuffle, and ranks come from running counts over a tree of buckets: a node holds the values whose
logarithm has the same leading digits, so their number is bounded by the range of doubles and in practice
a few thousand.  Counts of two trees are merged by adding them.

* :func:`value_distribution` counts distinct values.  It reads the data once and suits columns
  with a small domain (scores, surfaces with two decimals).
* :func:`exact_quantiles` suits columns with very many distinct values.  A first pass counts per
  node; the running count finds the nodes that hold the wanted ranks, of all quantiles at once; a second
  pass counts single values in those nodes only.

Quantiles are interpolated linearly, as ``PERCENTILE_CONT`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _group(by: list[str]):
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))


def node(value: str | Column, level: int = 0) -> Column:
    """Node of a value: grows with the value; level 1 splits each node of level 0 into 1,024."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.floor(F.signum(v) * F.log1p(F.abs(v)) * F.lit(float(2 ** (10 + 10 * level))))


def before(n: str, group: Window, value: str) -> Column:
    """Sum of ``n`` over the rows of the group in front of this one."""
    return F.coalesce(F.sum(n).over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def rank_counts(counts: DataFrame, value: str, n: str, by: list[str] | None = None) -> DataFrame:
    """Counted values with ``_end``, the rank after the last of them, and ``_total`` of the group.

    Without groups the running count goes through the tree: the only window over everything sees one row
    per node, the others see the values of one node.
    """
    if by:
        group = _group(by)
        running = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return counts.withColumns({"_end": F.sum(n).over(running), "_total": F.sum(n).over(group)})
    keyed = counts.withColumn("_node", node(value))
    nodes = keyed.groupBy("_node").agg(F.sum(n).alias("_size"))
    offsets = nodes.select("_node", before("_size", _group([]), "_node").alias("_offset"), F.sum("_size").over(_group([])).alias("_total"))
    inside = before(n, Window.partitionBy("_node"), value) + F.col(n)
    return keyed.withColumn("_end", inside).join(offsets, "_node").withColumn("_end", F.col("_end") + F.col("_offset")).drop("_node", "_offset")


def quantile_of(value: str, n: str, p: float) -> Column:
    """Aggregate over ranked counts: the interpolated quantile."""
    position = (F.col("_total") - 1) * F.lit(float(p))

    def at(rank: Column) -> Column:
        hit = (rank >= F.col("_end") - F.col(n)) & (rank < F.col("_end"))
        return F.max(F.when(hit, F.col(value).cast("double")))

    low, high = at(F.floor(position)), at(F.ceil(position))
    return low + (high - low) * F.max(position - F.floor(position))


def value_distribution(
    df: DataFrame, value: str, quantiles: dict[str, float], by: list[str] | None = None
) -> DataFrame:
    """Count, sum, extremes and quantiles of the non-null values per group, from one scan."""
    by = by or []
    counts = (
        df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v"))
        .agg(F.count("*").alias("_n"))
    )
    weight = F.col("_n").cast("decimal(20,0)")
    return rank_counts(counts, "_v", "_n", by).groupBy(*by).agg(
        F.sum("_n").alias("nombre"),
        F.sum(F.col("_v").cast("decimal(18,4)") * weight).alias("somme"),
        F.min("_v").alias("minimum"),
        F.max("_v").alias("maximum"),
        *[quantile_of("_v", "_n", p).alias(name) for name, p in quantiles.items()],
    )


def holds_rank(quantiles: dict[str, float]) -> Column:
    """Whether ranked counts (``_end``, ``_n``, ``_total``) hold a rank that one of the quantiles needs."""
    held = F.lit(False)
    for p in quantiles.values():
        position = (F.col("_total") - 1) * F.lit(float(p))
        for rank in (F.floor(position), F.ceil(position)):
            held = held | ((rank >= F.col("_end") - F.col("_n")) & (rank < F.col("_end")))
    return held


def refined(keyed: DataFrame, targets: DataFrame, quantiles: dict[str, float], by: list[str]) -> DataFrame:
    """Quantiles from the values ``_v`` that lie in the target buckets (``_b``, ``_before``, ``_total``)."""
    keys = [*by, "_b"]
    renamed = targets.select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)], "_before", "_total")
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_t{i}"))
    if by:
        # the number of groups is open: count first, so equal values travel as one row
        counted = keyed.groupBy(*keys, "_v").agg(F.count("*").alias("_c")).join(renamed, match)
    else:
        # at most two buckets per quantile: rows outside them are dropped where they are read
        counted = keyed.join(F.broadcast(renamed), match).groupBy(*keys, "_v", "_before", "_total").agg(
            F.count("*").alias("_c")
        )
    counted = counted.withColumn("_s", node("_v", 1))
    parts = counted.groupBy(*keys, "_s").agg(F.sum("_c").alias("_size"))
    parts = parts.select(*[F.col(k).alias(f"_p{i}") for i, k in enumerate([*keys, "_s"])],
                         before("_size", Window.partitionBy(*keys), "_s").alias("_offset"))
    same = F.lit(True)
    for i, k in enumerate([*keys, "_s"]):
        same = same & F.col(k).eqNullSafe(F.col(f"_p{i}"))
    inside = before("_c", Window.partitionBy(*keys, "_s"), "_v") + F.col("_c")
    placed = counted.withColumn("_in", inside).join(parts, same).withColumn(
        "_end", F.col("_before") + F.col("_offset") + F.col("_in"))
    return placed.groupBy(*by).agg(
        *[quantile_of("_v", "_c", p).alias(name) for name, p in quantiles.items()]
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    by: list[str] | None = None,
    width: float | None = None,
) -> DataFrame:
    """One row per group with the named quantiles of the non-null values.

    ``width`` asks for buckets of fixed width in place of the nodes of the tree.
    """
    by = by or []
    bucket = node(value) if width is None else F.floor(F.col(value).cast("double") / F.lit(float(width)))
    keyed = df.filter(F.col(value).isNotNull()).select(
        *[F.col(c) for c in by], F.col(value).alias("_v"), bucket.alias("_b"))
    buckets = keyed.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    ranked = rank_counts(buckets, "_b", "_n", by)
    targets = ranked.filter(holds_rank(quantiles)).select(*by, "_b", (F.col("_end") - F.col("_n")).alias("_before"), "_total")
    return refined(keyed, targets, quantiles, by)
