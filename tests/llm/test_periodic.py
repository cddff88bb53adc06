"""Periodic runs against a search over all periods and places."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcela.llm.periodic import PRIMES, inverse, op11_periodic, periodic_runs, runs_of_texts, transform, zero_mismatches


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(24, 3 * q) and i > start:
                w = words[start:start + length]
                if all(w[:-d] != w[d:] for d in range(1, q)):
                    out.append((start, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def digests(doc_id, text):
    words = planted(doc_id, text)
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def random_words(rnd):
    words = []
    for _ in range(rnd.randint(0, 7)):
        unit = [rnd.choice(b"abcdefgh"[:rnd.randint(1, 8)]) for _ in range(rnd.randint(1, 40))]
        many = rnd.randint(1, 12)
        piece = (unit * many)[:rnd.randint(1, len(unit) * many)]
        if rnd.random() < 0.3:
            piece[rnd.randrange(len(piece))] = 0
        words += piece
    return [bytes([w]) for w in words]


def test_runs_equal_brute_force():
    rnd = random.Random(3)
    texts = [random_words(rnd) for _ in range(150)]
    texts += [[b"ha"] * 23, [b"ha"] * 24, [b"a", b"b"] * 12, [b"%d" % (i % 9) for i in range(26)], [b"%d" % (i % 9) for i in range(27)]]
    assert runs_of_texts(texts) == [brute_runs(t) for t in texts]


def test_transform_is_exact():
    rnd = np.random.default_rng(1)
    for p, root in PRIMES:
        a = rnd.integers(0, p, (3, 64)).astype(np.uint64)
        assert (inverse(transform(a, p, root), p, root) == a).all()
    x = rnd.integers(0, 2, 400).astype(np.uint64) * np.uint64(2**24)  # sums of squares beyond one prime
    at = np.arange(0, 320, 16)
    block, d = zero_mismatches(x, at, 16, 16, 16)
    expected = [(i, q) for i in at.tolist() for q in range(16, 32) if (x[i:i + 16] == x[i + q:i + q + 16]).all()]
    assert list(zip(block.tolist(), d.tolist(), strict=True)) == expected


def test_hard_texts_stay_fast():
    long = [b"%d" % i for i in range(30_000)] * 3
    assert runs_of_texts([[b"ha"] * 100_000, long, long[:-1]]) == [[(0, 100_000, 1)], [(0, 90_000, 30_000)], []]
    a, b = [b"a"], [b"b"]
    while len(b) < 20_000:  # a Fibonacci word: very many repetitions
        a, b = b, b + a
    found = runs_of_texts([b])[0]
    assert all(b[s:s + length - q] == b[s + q:s + length] for s, length, q in found) and len(found) > 100


@pytest.mark.parametrize("extra", [False, True])
def test_query_equals_brute_force(spark, tmp_path, extra):
    rnd = random.Random(5)
    rows = [(i, b" ".join(random_words(rnd)).decode() if i % 3 else " ".join(f"w{i * i}" for i in range(i))) for i in range(160)]
    rows += [(-7, "x \t\n y " * 30), (1000, None), (1001, ""), (1002, " \t\r\n"), (1003, "é ü " * 40), (7, rows[7][1]), (None, "ja " * 30)]
    rows += [(1004, "ha " * 400_000)]  # above one part
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        frame = frame.select("*", *(F.lit(1).alias(n) for n in ("runs", "words", "h", "n", "start", "best")))
    frame.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_periodic(spark, str(tmp_path)).collect()
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    fast = [r for r in rows if r[0] != 1004]
    expected = sorted([(i if i is not None else -9, *digests(i if i is not None else 1, t)) for i, t in fast], key=str)
    assert sorted([(r["doc_id"] if r["doc_id"] is not None else -9, *(r[c] for c in columns)) for r in got if r["doc_id"] != 1004], key=str) == expected
    n = len(planted(1004, rows[-1][1]))
    assert [(r["start"], r["length"], r["period"]) for r in got if r["doc_id"] == 1004] == [(0, n, 1)]


def test_general_interface_and_empty_table(spark):
    frame = spark.createDataFrame([("x", "a b c " * 10), ("y", None)], "name string, body string")
    rows = {r["name"]: r for r in periodic_runs(frame, "name", "body").collect()}
    assert [tuple(r) for r in rows["x"]["runs"]] == [(0, 30, 3)] and rows["x"]["collapsed"] == "a b c"
    assert rows["y"]["runs"] == [] and rows["y"]["collapsed"] == ""
    assert periodic_runs(frame.where("false"), "name", "body").collect() == []
