"""Operator 6: toxicity by a factorization machine over hashed terms.

A text is the set of its hashed terms: words (A-Z in lower case) and their first four and five
bytes.  The machine scores  b + sum w_i + 1/2 sum_f ((sum v_if)^2 - sum v_if^2),  so a pair of terms
can weigh more than its parts.  Term weights are divided by the root of the number of *known* terms only in the
pair part, so a long text does not drown a single insult.

Every term that occurs in ``LEAST_TEXTS`` texts takes part in pairs, whatever its own share of toxic texts; a weight of
its own needs evidence of its own.  It is fitted in one task on a bounded sample of labelled rows (``SAMPLE_ROWS``, chosen by a hash of the
id); every document is scored over its whole text.

Defined results: null and empty texts have no terms and get the score of the intercept; labels that
are null are not learned from; an id with several labels counts as toxic if one of them is 1; without
any label the score is 0.  Repeated rows are scored each on its own.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.llm.shared import read, sampled
from parcela.llm.words import Words, prefix_sums, range_hash, slices

BITS = 18            # hashed terms
FACTORS = 4
SAMPLE_ROWS = 20_000  # labelled rows that the machine is fitted on, at most
LEAST_TEXTS = 4      # a term in fewer texts of the sample is not learned
UNUSUAL = 3.0        # a term has a weight of its own if its share of toxic texts is so many deviations off the mean
EPOCHS = 8
THRESHOLD = 0.3
HELD_OUT = 2         # remainder of crc32(doc_id) modulo 4 that is never learned from


def remainder(id_column: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(4))


def terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, term) of a slice: text numbers and term numbers, sorted by both."""
    words = Words(raw, offsets, fold=True)
    sums = prefix_sums(words.raw)
    hashes = [words.hash]
    for size in (4, 5):
        longer = words.end - words.start > size
        hashes.append(range_hash(sums, words.start[longer], words.start[longer] + size))
        hashes[-1] = hashes[-1] ^ np.uint64(size << 40)
    documents = [words.document] + [words.document[words.end - words.start > size] for size in (4, 5)]
    dims = np.concatenate([h >> np.uint64(64 - BITS) for h in hashes]).astype(np.int64)
    keys = np.unique((np.concatenate(documents) << BITS) | dims)
    return keys >> BITS, keys & ((1 << BITS) - 1)


class Machine:
    """Weights of the hashed terms; terms without weights are left out of a text."""

    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.bias, self.linear, self.factors = bias, linear, factors
        self.known = (linear != 0) | (factors != 0).any(axis=1)

    def raw_scores(self, rows: np.ndarray, dims: np.ndarray, n: int) -> np.ndarray:
        keep = self.known[dims]
        rows, dims = rows[keep], dims[keep]
        scale = 1 / np.maximum(np.bincount(rows, minlength=n), 1)
        out = self.bias + np.bincount(rows, self.linear[dims], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[dims, f]
            out += 0.5 * scale * (np.bincount(rows, v, n) ** 2 - np.bincount(rows, v * v, n))
        return out

    def scores(self, rows: np.ndarray, dims: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw_scores(rows, dims, n), -30, 30)))

    def to_bytes(self) -> bytes:
        file = io.BytesIO()
        np.savez_compressed(file, bias=self.bias, linear=self.linear.astype(np.float32),
                            factors=self.factors.astype(np.float32))
        return file.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Machine:
        with np.load(io.BytesIO(data)) as kept:
            return Machine(float(kept["bias"]), kept["linear"].astype(float), kept["factors"].astype(float))


def fit(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Machine:
    """Adaptive gradient steps on the logistic loss of mini-batches."""
    size = 1 << BITS
    counts, toxic = np.zeros(size), np.zeros(size)
    for t, label in zip(texts, labels, strict=True):
        counts[t] += 1
        toxic[t] += label
    rate = (labels.sum() + 0.5) / (len(labels) + 1)
    unusual = np.abs(toxic - counts * rate) / np.sqrt(np.maximum(counts, 1) * rate * (1 - rate))
    used_terms = counts >= LEAST_TEXTS
    alone = unusual >= UNUSUAL  # others count in pairs only: what is neutral alone may be toxic beside another
    texts = [t[used_terms[t]] for t in texts]
    rng = np.random.default_rng(seed)
    bias = float(np.log(rate / (1 - rate)))
    linear = np.zeros(size)
    factors = np.where(used_terms[:, None], rng.normal(0, 0.01, (size, FACTORS)), 0)
    g_linear, g_factors, g_bias = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), 64):
            batch = order[at:at + 64]
            sizes = np.array([len(texts[i]) for i in batch])
            rows = np.repeat(np.arange(len(batch)), sizes)
            dims = np.concatenate([texts[i] for i in batch]) if sizes.sum() else np.zeros(0, np.int64)
            n = len(batch)
            scale = 1 / np.maximum(sizes, 1)
            v = factors[dims]
            sums = np.stack([np.bincount(rows, v[:, f], n) for f in range(FACTORS)], 1)
            squares = np.stack([np.bincount(rows, v[:, f] ** 2, n) for f in range(FACTORS)], 1)
            score = bias + np.bincount(rows, linear[dims], n) + 0.5 * (scale[:, None] * (sums**2 - squares)).sum(1)
            error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels[batch]
            used, place = np.unique(dims, return_inverse=True)
            grad = np.where(alone[used], np.bincount(place, error[rows], len(used)) / n + 1e-5 * linear[used], 0)
            g_linear[used] += grad**2
            linear[used] -= 0.3 * grad / np.sqrt(g_linear[used])
            through = (error * scale)[rows]
            for f in range(FACTORS):
                grad = np.bincount(place, through * (sums[rows, f] - v[:, f]), len(used)) / n
                grad += 1e-4 * factors[used, f]
                g_factors[used, f] += grad**2
                factors[used, f] -= 0.5 * grad / np.sqrt(g_factors[used, f])
            g_bias += error.mean() ** 2
            bias -= 0.1 * error.mean() / np.sqrt(g_bias)
    return Machine(float(bias), linear, factors)


def _term_lists(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, raw, offsets in slices(batch.column(1)):
                rows, dims = terms(raw, offsets)
                cuts = np.searchsorted(rows, np.arange(end - row + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(dims.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), lists, batch.column(2).slice(row, end - row)],
                                                 names=["id", "terms", "label"])

    return docs.mapInArrow(run, "id long, terms array<int>, label int")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> bytes | None:
    """Fit on labelled rows that are not held out; the weights as bytes (at most 2^18 terms)."""
    known = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("label"))
             .where(F.col("id").isNotNull() & F.col("label").isNotNull() & (remainder("id") != HELD_OUT))
             .groupBy("id").agg(F.max("label").alias("label")))
    few = sampled(known, F.xxhash64("id"), known.count(), sample_rows + sample_rows // 10)
    chosen = few.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    rows = _term_lists(texts.join(chosen, "id").select("id", "text", "label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lists, marks = [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            flat, cuts = batch.column(1), batch.column(1).offsets.to_numpy()
            values = flat.values.to_numpy()
            lists += [values[a:b].astype(np.int64) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            marks += batch.column(2).to_pylist()
        if not ids:
            return
        order = sorted(range(len(ids)), key=lambda i: (ids[i], lists[i].tobytes()))
        machine = fit([lists[i] for i in order], np.array([marks[i] for i in order], float))
        yield pa.RecordBatch.from_arrays([pa.array([machine.to_bytes()], pa.binary())], names=["model"])

    found = rows.repartition(1).mapInArrow(run, "model binary").collect()
    return bytes(found[0][0]) if found else None


def score(docs: DataFrame, model: bytes | None) -> DataFrame:
    """Per row of ``docs``: doc_id and score of its whole text."""
    spark = docs.sparkSession
    kept = spark.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine.from_bytes(kept.value) if kept.value else None
        for batch in batches:
            for row, end, raw, offsets in slices(batch.column(1)):
                n = end - row
                values = machine.scores(*terms(raw, offsets), n) if machine else np.zeros(n)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, n), pa.array(values)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", (remainder() == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that are not predicted toxic, with all their columns."""
    model = train(docs, labels)
    kept = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine.from_bytes(kept.value) if kept.value else None
        for batch in batches:
            if machine is None:
                yield batch
                continue
            for row, end, raw, offsets in slices(batch.column(at)):
                clean = machine.scores(*terms(raw, offsets), end - row) < THRESHOLD
                yield batch.slice(row, end - row).filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
