"""Operator 11: stretches of words that repeat with a period, found by block convolution.

A run is a stretch of consecutive words with smallest period q and at least ``max(LEAST, CUBES * q)`` words that no
neighbouring word extends.  Periods are searched scale by scale.  For periods from b = 2^k up to 2b, every aligned block
of b words is laid over the 2b words that follow at distance b: the sum of squared differences of the word numbers is
zero exactly where the block occurs again.  The sums of all blocks of many texts come from one batched number-theoretic
transform; they are exact, since as many primes are used as the largest possible sum needs.  A run of period q holds an
aligned block together with its next occurrence, so no run is missed.  Each distance with a zero seeds an extension by
direct comparison to both sides; distances that are multiples of a shorter period found there are dropped.

Work is about n log^2 n for a text of n words.  A word of a run occurs three times at least, so only stretches of words
that occur three times in their text are transformed; this loses nothing.  Every text is judged alone: no shuffle.

Defined results: null, empty and blank texts have no words and no runs; rows are judged one by one, so repeated rows and
null ids give a row each; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.llm.shared import read

LEAST, CUBES = 24, 3
FIRST = 8  # periods below it share the first scale
CELLS = 1 << 18  # numbers that are transformed together
PART = 1 << 20  # bytes of text that are searched together; a longer text is a part of its own
#: Primes with a primitive root; p - 1 is divisible by 2^27, 2^26 and 2^23.
PRIMES = ((2013265921, 31), (469762049, 3), (998244353, 3))


@cache
def _twiddles(p: int, root: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the 2*half-th root of unity, and of its inverse."""
    w = pow(root, (p - 1) // (2 * half), p)
    tables = []
    for base in (w, pow(w, -1, p)):
        out = np.ones(half, np.uint64)
        size = 1
        while size < half:  # doubling: powers size .. 2*size-1 are the first ones times base^size
            step = np.uint64(pow(base, size, p))
            out[size:2 * size] = _mod(out[:size] * step, p)[:half - size]
            size *= 2
        tables.append(out)
    return tables[0], tables[1]


def _mod(x: np.ndarray, p: int) -> np.ndarray:
    q = x // np.uint64(p)
    q *= np.uint64(p)
    return np.subtract(x, q, out=q)


def _less(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p for x below 2p; what is negative wraps to a large number."""
    return np.minimum(x, x - np.uint64(p))


def transform(a: np.ndarray, p: int, root: int) -> np.ndarray:
    """Number-theoretic transform of each row; the output is in bit-reversed order."""
    rows, n = a.shape
    half = n // 2
    while half:
        a = a.reshape(rows, -1, 2, half)
        u, v = a[:, :, 0], a[:, :, 1]
        out = np.empty_like(a)
        out[:, :, 0] = _less(u + v, p)
        out[:, :, 1] = _mod((u + np.uint64(p) - v) * _twiddles(p, root, half)[0], p)
        a, half = out, half // 2
    return a.reshape(rows, n)


def inverse(a: np.ndarray, p: int, root: int) -> np.ndarray:
    """Back from the bit-reversed order."""
    rows, n = a.shape
    half = 1
    while half < n:
        a = a.reshape(rows, -1, 2, half)
        u, v = a[:, :, 0], _mod(a[:, :, 1] * _twiddles(p, root, half)[1], p)
        out = np.empty_like(a)
        out[:, :, 0] = _less(u + v, p)
        out[:, :, 1] = _less(u + np.uint64(p) - v, p)
        a, half = out, half * 2
    return _mod(a.reshape(rows, n) * np.uint64(pow(n, -1, p)), p)


def zero_mismatches(x: np.ndarray, at: np.ndarray, size: int, low: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance): places ``at + low .. at + low + wide - 1`` where the block of ``size`` numbers at ``at`` stands again.

    ``wide + size`` must not exceed twice the size.  What lies behind the end counts as the last number.
    """
    n = 2 * size
    largest = int(x.max(initial=0))
    primes, reach = [], 1
    for prime in PRIMES:
        primes.append(prime)
        reach *= prime[0]
        if reach > size * largest * largest:
            break
    found_block, found_distance = [], []
    rows = max(1, CELLS // n)
    for first in range(0, len(at), rows):
        here = at[first:first + rows]
        block = x[here[:, None] + np.arange(size)]
        text = x[np.minimum(here[:, None] + low + np.arange(n), len(x) - 1)]
        squares = np.zeros((len(here), n + 1), np.uint64)
        np.cumsum(text * text, axis=1, out=squares[:, 1:])
        total = squares[:, size:size + wide] - squares[:, :wide] + (block * block).sum(axis=1, dtype=np.uint64)[:, None]
        backwards = np.zeros((len(here), n), np.uint64)
        backwards[:, 0] = block[:, 0]
        backwards[:, n - size + 1:] = block[:, :0:-1]
        zero = np.ones((len(here), wide), bool)
        for p, root in primes:
            product = _mod(transform(backwards % np.uint64(p), p, root) * transform(text % np.uint64(p), p, root), p)
            products = inverse(product, p, root)[:, :wide]
            zero &= _mod(total, p) == _less(products * np.uint64(2), p)
        i, d = np.nonzero(zero)
        found_block.append(here[i])
        found_distance.append(d + low)
    return np.concatenate(found_block or [at]), np.concatenate(found_distance or [at])


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """Numbers from the front in which two equally long stretches agree."""
    done, step = 0, 32
    while done < len(a):
        differ = a[done:done + step] != b[done:done + step]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done, step = done + step, step * 2
    return len(a)


def _extend(x: np.ndarray, at: int, size: int, d: int, low: int, high: int) -> tuple[int, int]:
    """The widest [l, r) around a block with x[i] = x[i + d], both inside [low, high)."""
    left = _same(x[low:at][::-1], x[low + d:at + d][::-1])
    right = _same(x[at + size:high - d], x[at + size + d:high])
    return at - left, at + size + right


def runs_of(stretches: list[np.ndarray], least: int = LEAST, cubes: int = CUBES) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each stretch of numbers, by start, then period."""
    lengths = np.array([len(s) for s in stretches], np.int64)
    starts = np.cumsum(lengths) - lengths
    flat = np.concatenate(stretches).astype(np.uint64) if stretches else np.zeros(0, np.uint64)
    runs: list[tuple[int, int, int]] = []  # start, end, period in the flat array

    def seeds(at: np.ndarray, d: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Without those inside a known run whose period divides the distance."""
        keep = np.ones(len(at), bool)
        for start, end, q in runs:
            i, j = np.searchsorted(at, (start, end))
            if i < j:
                keep[i:j] &= (d[i:j] % q != 0) | (at[i:j] + d[i:j] + size > end)
        return at[keep], d[keep]

    def extended(at: np.ndarray, d: np.ndarray, size: int) -> None:
        order = np.lexsort((at, d))
        at, d = at[order], d[order]
        owner = np.searchsorted(starts, at, "right") - 1
        done, of, reached = -1, -1, -1
        for i in range(len(at)):
            s, distance, own = int(at[i]), int(d[i]), int(owner[i])
            if distance == done and own == of and s + size <= reached:
                continue
            low, high = int(starts[own]), int(starts[own] + lengths[own])
            start, reached = _extend(flat, s, size, distance, low, high)
            done, of = distance, own
            if reached + distance - start >= max(least, cubes * distance):
                runs.append((start, reached + distance, distance))

    low = 1
    longest = int(lengths.max(initial=0))
    while longest >= max(least, cubes * low):
        high, size = (FIRST, FIRST) if low < FIRST else (2 * low, low)
        use = np.flatnonzero(lengths >= max(least, cubes * low))
        count = (lengths[use] - low) // size
        owner = np.repeat(use, count)
        at = np.repeat(starts[use], count) + size * (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count))
        block, d = zero_mismatches(flat, at, size, low, high - low)
        owner = np.searchsorted(starts, block, "right") - 1
        inside = block + d + size <= (starts + lengths)[owner]
        block, d = block[inside], d[inside]
        for some in ([d == q for q in range(low, high)] if low < FIRST else [np.ones(len(d), bool)]):
            extended(*seeds(block[some], d[some], size), size)
        low = high
    out: list[list[tuple[int, int, int]]] = [[] for _ in stretches]
    for start, end, q in runs:
        own = int(np.searchsorted(starts, start, "right")) - 1
        out[own].append((start - int(starts[own]), end - start, q))
    for found in out:
        found.sort(key=lambda run: (run[0], run[2]))
    return out


def _stretches(ids: np.ndarray, least: int) -> list[tuple[int, np.ndarray]]:
    """Start and word numbers (counted anew) of the stretches of words that occur three times or more."""
    often = np.bincount(ids)[ids] >= CUBES if len(ids) else np.zeros(0, bool)
    edges = np.flatnonzero(np.diff(np.r_[False, often, False].astype(np.int8)))
    out = []
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if end - start >= least:
            out.append((start, np.unique(ids[start:end], return_inverse=True)[1]))
    return out


def runs_of_texts(texts: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, given as its words."""
    places, stretches = [], []
    for i, words in enumerate(texts):
        if len(words) < least:
            continue
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        for start, numbers in _stretches(ids, least):
            places.append((i, start))
            stretches.append(numbers)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (i, start), found in zip(places, runs_of(stretches, least), strict=True):
        out[i] += [(start + s, length, q) for s, length, q in found]
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without what a run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        depth[start + q] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def _parts(texts: list[str | None]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """First row and words of rows that are searched together."""
    first, size, part = 0, 0, []
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        if part and size + len(raw) > PART:
            yield first, part
            first, size, part = i, 0, []
        part.append(raw.split())  # splits at \x20 and \x09 to \x0D
        size += len(raw)
    if part:
        yield first, part


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, n_words, runs (start, length, period; by start, then period) and the collapsed text."""
    kind = docs.schema[id_column].dataType.simpleString()
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in _parts(batch.column(1).to_pylist()):
                found = runs_of_texts(part)
                kept = [b" ".join(collapse(w, r)).decode() for w, r in zip(part, found, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(part)),
                    pa.array([len(w) for w in part], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found], run_type),
                    pa.array(kept, pa.string()),
                ], names=[id_column, "n_words", "runs", "collapsed"])

    schema = f"{id_column} {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(id_column, text_column).mapInArrow(search, schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth document (by a hash of its id) goes on periodically from some word on: (doc_id, text)."""
    def alone(column: Column, name: str, frame: DataFrame) -> DataFrame:
        return frame.select("*", F.explode(F.array(column)).alias(name))  # computed once a row

    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    rows = alone(F.when(F.col("h") % 10 == 0, words), "words", rows)
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    rows = rows.select("doc_id", "text", "words", n.alias("n"), g.alias("g"), F.when(n > 0, (g % n).cast("int")).alias("a"))
    tail = F.col("n") - F.col("a")
    rows = rows.withColumn("p", (1 + F.floor(tail / (3 + F.col("g") % 8))).cast("int"))
    unit = F.slice("words", F.col("a") + 1, F.col("p"))
    again = F.slice(F.flatten(F.array_repeat(unit, F.ceil(tail / F.col("p")).cast("int"))), F.lit(1), tail)
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), again), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(with_planted_runs(read(spark, sf_dir, "documents")))

    def stronger(best: Column, run: Column) -> Column:
        return F.when(best["start"].isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    nothing = F.struct(*(F.lit(None).cast("long").alias(c) for c in ("start", "length", "period")))
    best = F.aggregate("runs", F.coalesce(none, nothing), stronger)
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    rows = rows.select("*", F.explode(F.array(best)).alias("best"))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")
