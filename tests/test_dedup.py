"""Deduplication with a horizon against a run over all rows in time order."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcela.sources.storage import Folder
from parcela.streaming import dedup
from parcela.streaming.ingest import run_available

T0 = dt.datetime(2024, 1, 1)


def greedy(rows, horizon):
    """Kept (key, time) of each key, in time order."""
    last, kept = {}, []
    for key, t in sorted(set(rows), key=lambda r: r[1]):
        if key not in last or t - last[key] >= horizon:
            last[key] = t
            kept.append((key, t))
    return sorted(kept, key=str)


def some_rows(seed, n=3000, keys=40, days=20, hot=True):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        key = "hot" if hot and rnd.random() < 0.4 else f"k{rnd.randrange(keys)}"
        rows.append((key, T0 + dt.timedelta(seconds=rnd.randrange(days * 86400))))
    rows += [("grid", T0 + dt.timedelta(hours=i)) for i in range(24 * days)]  # chains that never meet
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "k string, ts timestamp, v int").repartition(5)


def pairs(frame):
    return sorted(((r["k"], r["ts"]) for r in frame.collect()), key=str)


@pytest.mark.parametrize("horizon", ["1 day", "5 hours", "40 days"])
def test_one_batch_equals_greedy(spark, horizon):
    rows = some_rows(1)
    frame = frame_of(spark, rows)
    kept = dedup.keep_by_horizon(frame, frame.select("k", "ts").limit(0), "k", "ts", horizon)
    assert pairs(kept) == greedy(rows, dt.timedelta(microseconds=dedup.micros(horizon)))


def test_rows_kept_before_count(spark):
    """Earlier kept rows stay and suppress what follows them, wherever they lie in time."""
    rows, before = some_rows(2, n=900), some_rows(3, n=60, hot=False)
    h = dt.timedelta(days=1)
    last, expected = {}, []
    for key, t, old in sorted([(k, t, 0) for k, t in set(before)] + [(k, t, 1) for k, t in set(rows)], key=lambda r: (r[1], r[2])):
        if not old or key not in last or t - last[key] >= h:
            last[key] = t
            if old:
                expected.append((key, t))
    kept = dedup.keep_by_horizon(frame_of(spark, rows), frame_of(spark, before), "k", "ts", "1 day")
    assert pairs(kept) == sorted(expected, key=str)


def test_null_keys_and_times_and_ties(spark):
    rows = [(None, T0, 1), (None, T0 + dt.timedelta(hours=1), 2), ("a", None, 3), ("a", None, 4), ("a", T0, 5), ("a", T0, 6)]
    frame = spark.createDataFrame(rows, "k string, ts timestamp, v int")
    kept = dedup.keep_by_horizon(frame, frame.select("k", "ts").limit(0), "k", "ts", "1 day").collect()
    assert sorted((str(r["k"]), str(r["ts"])) for r in kept) == [("None", str(T0)), ("a", str(T0)), ("a", "None"), ("a", "None")]
    assert dedup.keep_by_horizon(frame.limit(0), frame.select("k", "ts").limit(0), "k", "ts", "1 day").count() == 0


def _in_batches(spark, tmp_path, rows, batches, horizon="1 day", **options):
    land, out = tmp_path / f"land{batches}", str(tmp_path / f"out{batches}")
    step = -(-len(rows) // batches)
    body = dedup.dedup_into(out, "k", "ts", horizon, **options)
    schema = "k string, ts timestamp, v int"
    for i in range(batches):
        frame_of(spark, rows[i * step:(i + 1) * step]).coalesce(1).write.parquet(f"{land}/{i:03d}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(land))
        run_available(stream, body, str(tmp_path / f"c{batches}"))
    return out, spark.read.schema(schema).parquet(out)


@pytest.mark.parametrize("batches", [1, 3, 6])
def test_batches_in_time_order_give_the_same_rows(spark, tmp_path, batches):
    rows = sorted(some_rows(4, n=700, days=9), key=lambda r: r[1])
    out, kept = _in_batches(spark, tmp_path, rows, batches, slices=3, buckets=4)
    assert pairs(kept) == greedy(rows, dt.timedelta(days=1))
    names = Folder(spark, f"{out}/_filters").names()
    assert len([n for n in names if n.startswith("slice=")]) <= 3  # old filters are gone


def test_late_rows_are_kept_and_judged_by_what_was_kept_then(spark, tmp_path):
    day = dt.timedelta(days=1)
    first = [("a", T0 + 20 * day), ("b", T0 + 20 * day), ("a", T0 + 2 * day)]
    late = [("a", T0 + 2.5 * day), ("a", T0 + 9 * day), ("c", T0 + 1 * day), ("b", T0 + 19.5 * day)]
    _, kept = _in_batches(spark, tmp_path, first + late[:3] + late[3:], 2, slices=3)
    # seven rows, four and three: the fourth row comes with the first batch
    assert pairs(kept) == sorted([*first, ("a", T0 + 9 * day), ("c", T0 + day), ("b", T0 + 19.5 * day)], key=str)


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    rows = sorted(some_rows(5, n=300, days=5), key=lambda r: r[1])
    out = str(tmp_path / "out")
    body = dedup.dedup_into(out, "k", "ts", "1 day")
    for batch_id, part in [(0, rows[:400]), (1, rows[400:]), (1, rows[400:])]:
        body(frame_of(spark, part), batch_id)
    assert pairs(spark.read.parquet(out)) == greedy(rows, dt.timedelta(days=1))


def test_filters_rule_out_and_never_lose(spark):
    kept = spark.range(0, 3000, 3).select(F.col("id").alias("k"), (F.col("id") % 5).alias("slice"))
    filters = dedup.bloom(kept, "k", 4)
    asked = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("slice"))
    found = {(r["k"], r["slice"]) for r in dedup.maybe_known(asked, filters, "k", 4, -10).collect()}
    true = {(r["k"], r["slice"]) for r in kept.collect()}
    assert true <= found and len(found) < 1100
    assert dedup.maybe_known(asked, filters.limit(0), "k", 4, 2).count() == asked.where("slice < 2").count()


def test_jumps_with_far_apart_times():
    t = np.array([0, 5, 2**61, 0, 2**61])
    group, old = np.array([0, 0, 0, 1, 1]), np.zeros(5, bool)
    assert dedup.jumps(group, t, old, 10).tolist() == [2, 2, 2, 4, 4]
