"""SimHash near duplicates against all pairs."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from parcela.llm.simhash import GRIDS, counts, fingerprint, forest, manhattan, near_duplicates, near_links, op13_simhash
from tests.llm.conftest import corpus, prose


def brute_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = lower.encode().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(pairs, nodes):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def all_links(fps):
    fps = sorted(set(fps))
    return [(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= 4]


def clusters(seed, centers=12, copies=25):
    rnd = random.Random(seed)
    out = set()
    for _ in range(centers):
        center = rnd.getrandbits(64)
        for _ in range(copies):
            fp = center
            for bit in rnd.sample(range(64), rnd.randint(0, 6)):
                fp ^= 1 << bit
            out.add(fp)
    return sorted(out)


def signed(fp):
    return fp - 2**64 if fp >= 2**63 else fp


def test_fingerprint_and_spark_hash_agree(spark):
    texts = [None, "", " \t", "one", "One TWO three", "a b c d", "a b c d e", "Ünï CÖDE É x " * 9, prose(1, 500), "ha " * 200_000]
    assert [fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]
    assert spark.range(1).select(F.xxhash64(F.lit("one"))).first()[0] == signed(fingerprint("ONE"))


def test_manhattan_is_a_lower_bound_and_no_grid_misses():
    fps = np.array(clusters(1), np.uint64)
    points = counts(fps)
    for i in range(len(fps)):
        differ = np.bitwise_count(fps ^ fps[i])
        assert (manhattan(points, points[i:i + 1]) <= differ).all()
        brute = [sum(abs((int(f) >> s & 3).bit_count() - (int(fps[i]) >> s & 3).bit_count()) for s in range(0, 64, 2)) for f in fps[:20]]
        assert manhattan(points[:20], points[i:i + 1]).tolist() == brute
        shared = np.any([(points & g) == (points[i] & g) for g in GRIDS], axis=0)
        assert shared[differ <= 4].all()


def test_forest_keeps_components():
    rnd = random.Random(2)
    for _ in range(50):
        pairs = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(rnd.randint(1, 70))]
        a, b = forest(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
        nodes = range(60)
        assert roots(zip(a.tolist(), b.tolist(), strict=True), nodes) == roots(pairs, nodes)
        assert len(a) <= 59


@pytest.mark.parametrize("most", [16384, 3, 1])
def test_links_equal_all_pairs(spark, monkeypatch, most):
    """Also with cells that count as crowded, whose members meet halfway."""
    monkeypatch.setattr("parcela.llm.simhash.SWEEP", 64)
    fps = clusters(4) + [0, 1, 3, 7, 15, 2**64 - 1, 2**63]
    fps = sorted(set(fps))
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(3)
    found = [(r["a"] % 2**64, r["b"] % 2**64) for r in near_links(frame, most).collect()]
    assert roots(found, fps) == roots(all_links(fps), fps)


def variants():
    base = prose(50, 400).split()
    return [(2000 + i, " ".join([*base[:i * 3], f"new{i}", *base[i * 3:]])) for i in range(90)]


@pytest.mark.parametrize("extra", [False, True])
def test_query_equals_all_pairs(spark, tmp_path, extra):
    rows = [(i, t) for i, t, _ in corpus()] + variants() + [(None, prose(1, 120)), (None, "alone nobody else has this"), (500, "x " * 700_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        frame = frame.select("*", *(F.lit(1).alias(n) for n in ("fp", "least", "root", "node", "cell", "component_id")))
    frame.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    prints = [brute_fingerprint(t) if i != 500 else fingerprint(t) for i, t in rows]
    root = roots(all_links(prints), set(prints))
    least = {}
    for (i, _), fp in zip(rows, prints, strict=True):
        if i is not None:
            least[root[fp]] = min(least.get(root[fp], i), i)
    want = sorted(((i, f"{fp:016x}", least.get(root[fp])) for (i, _), fp in zip(rows, prints, strict=True)), key=str)
    got = op13_simhash(spark, str(tmp_path)).collect()
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == want
    assert len({c for _, _, c in want}) < len(rows)


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).collect() == []
