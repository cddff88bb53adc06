"""Operator 4: URL filter by a sort-merge range join.

The key of a URL is its host with the labels reversed (``net.example.www.``) and its path.  In key
order a rule covers one interval of hosts, and intervals of nested rules nest.  Pages and rules are
dealt to key ranges (a rule to every range its interval meets) and sorted; one sweep over a range
keeps a stack of the rules whose host interval is open.  For each page the open rules whose path
starts its path compete, and the longest wins.

Equal URLs may hold any share of the rows: range limits are (key, page number) pairs, so that even
the rows of one URL are split.  Limits come from a sample of fixed size and decide only where rows go.

Defined results: a URL that is null or has no ``://`` has an empty host and path and gets the default
verdict; a tie between equally long rules goes to the smaller rule text, block before allow; repeated rows are
judged each on its own; without rules every page gets the default.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.llm.shared import read, sampled

LIMIT_SAMPLE = 4096
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))
END = "\x00"  # sorts before every character of a label; closes the last label


def host_of(url: str | Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str | Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels in reverse order, each closed: every subdomain's key starts with its parent's.

    A host that holds the closing character itself is written with another pair of characters in its place.
    """
    for char, pair in (("\x01", "\x01\x02"), (END, "\x01\x01")):
        host = F.replace(host, F.lit(char), F.lit(pair))
    return F.when(host == "", "").otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), END), F.lit(END)))


def sweep(batches: Iterator[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    """Rows of whole ranges, sorted by (range, key, pages after rules): the rule of each page."""
    stack: list[tuple[str, list[tuple[int, str, str, str]]]] = []
    current = None
    for batch in batches:
        ids, hosts, paths, rules, verdicts = [], [], [], [], []
        columns = [batch.column(n).to_pylist() for n in ("zone", "key", "is_page", "page_id", "host", "path", "verdict")]
        for zone, key, is_page, page, host, path, verdict in zip(*columns, strict=True):
            if zone != current:
                current, stack = zone, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_page:
                if not stack or stack[-1][0] != key:
                    stack.append((key, []))
                stack[-1][1].append((len(host) + len(path), path, verdict, host + path))
                continue
            open_rules = [r for _, level in stack for r in level if path.startswith(r[1])]
            best = min(open_rules, key=lambda r: (-r[0], r[3], r[2] != "block"), default=None)
            ids.append(page)
            hosts.append(host)
            paths.append(path)
            rules.append(best[3] if best else None)
            verdicts.append(best[2] if best else default)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *(pa.array(x, pa.string()) for x in (hosts, paths, rules, verdicts))],
            names=["page_id", "host", "path", "rule", "verdict"])


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", zones: int | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of pages (page_id, url) under rules (host, path, verdict)."""
    spark = pages.sparkSession
    zones = zones or int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"),
                         path_of(F.col("url")).alias("path"))
    asked = asked.withColumn("key", host_key(F.col("host"))).withColumn("at", F.concat("key", "path"))
    order = F.xxhash64("page_id", "at")
    sample = sampled(asked.select("at", order.alias("n")), F.xxhash64("n"), pages.count(), LIMIT_SAMPLE)
    seen = sorted((r[0], r[1]) for r in sample.collect())
    limits = sorted({seen[len(seen) * i // zones] for i in range(1, zones)}) if seen else []

    def zone_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            keys, numbers = batch.column("at").to_pylist(), batch.column("n").to_pylist()
            zone = [bisect.bisect_right(limits, x) for x in zip(keys, numbers, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(zone, pa.int32()), *(batch.column(c) for c in ("key", "page_id", "host", "path"))],
                names=["zone", "key", "page_id", "host", "path"])

    def zones_of(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            spans = [(bisect.bisect_left(limits, (k, -(2**63))), bisect.bisect_right(limits, (k + chr(0x10FFFF), 0)))
                     for k in batch.column("key").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(range(a, b + 1)) for a, b in spans], pa.list_(pa.int32())),
                 *(batch.column(c) for c in ("key", "host", "path", "verdict"))],
                names=["zones", "key", "host", "path", "verdict"])

    dealt = asked.select("key", "at", order.alias("n"), "page_id", "host", "path").mapInArrow(
        zone_of, "zone int, key string, page_id long, host string, path string")
    known = rules.select("host", "path", "verdict").distinct().withColumn("key", host_key(F.col("host")))
    spread = known.select("key", "host", "path", "verdict").mapInArrow(
        zones_of, "zones array<int>, key string, host string, path string, verdict string")
    both = dealt.select("zone", "key", F.lit(True).alias("is_page"), "page_id", "host", "path",
                        F.lit(None).cast("string").alias("verdict")).unionByName(
        spread.select(F.explode("zones").alias("zone"), "key", F.lit(False).alias("is_page"),
                      F.lit(None).cast("long").alias("page_id"), "host", "path", "verdict"))
    ranged = both.repartition(zones, "zone").sortWithinPartitions("zone", "key", "is_page")
    return ranged.mapInArrow(lambda b: sweep(b, default),
                             "page_id long, host string, path string, rule string, verdict string")


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"), rule_table(spark))


OP4_SQL = """
WITH p AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
         ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM p
), r(rh, rp, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), m AS (
  SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
  FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM h LEFT JOIN m USING (page_id)
"""
