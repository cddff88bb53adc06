"""Operator 13: near duplicates by SimHash, joined in the space of their segments' bit counts.

A fingerprint has a bit for each that is set in over half the hashes of the text's shingles.  Equal fingerprints are
one; the distinct ones are embedded as the bit counts of 32 segments of two bits.  The Manhattan distance of two such
points never exceeds the number of differing bits, so it is a lower bound.  The axes form seven groups.  Of two points at
distance four or less at least three groups agree, so a grid over each choice of three groups (35 grids of unit cells) brings
them together; within a cell points are sorted by the bits set in the other groups, and the sweep ends where these
differ by more than the distance.  What is left is judged by the Manhattan distance over all axes, then exactly.

Cells are swept in sorted partitions, many at a time, and leave a spanning forest of the links that a batch found, so a
cluster of m fingerprints costs m rows for a batch, not m^2.  Cells of more than ``CELL`` fingerprints are not swept: their
members meet at every fingerprint within half the distance of each, where two meet exactly if they link (2,081 rows for each
such fingerprint, whatever the cell's size).  Nothing is dropped either way.

Defined results: null, empty and blank texts have no words and fingerprint zero, which links like any other; rows without an id
join their component but never name it; a component of such rows alone has a null name; equal rows get equal rows;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.llm.components import components
from parcela.llm.shared import read, stored
from parcela.llm.words import mix

WIDTH, SEED, DISTANCE = 4, 42, 4
CELL = 16384  # fingerprints of a cell that are compared in one task
LONGEST = 1 << 17  # shingles whose bits are counted at a time
SWEEP = 1 << 16  # rows of cells that are swept together
EVEN = np.uint64(0x5555555555555555)
GROUPS = 7
LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    words = (text or "").encode().translate(LOWER).split()  # splits at \x20 and \x09 to \x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    many = max(1, len(words) - width + 1)
    starts, ends = starts[:many], ends[min(width, len(words)) - 1:]
    bits = np.zeros(64, np.int64)
    for first in range(0, many, LONGEST):
        some = zip(starts[first:first + LONGEST].tolist(), ends[first:first + LONGEST].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in some], "<u8")
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > many, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp): the fingerprint as a signed 64-bit integer."""
    kind = docs.schema[id_column].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=[id_column, "fp"])

    return docs.select(id_column, text_column).mapInArrow(digest, f"{id_column} {kind}, fp long")


def counts(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 segments, two bits each."""
    return (fp & EVEN) + ((fp >> np.uint64(1)) & EVEN)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of two embedded points: counts differ by two where only the high bit of their xor is set, else by one."""
    z = a ^ b
    return np.bitwise_count(z & EVEN).astype(np.int64) + 2 * np.bitwise_count((z >> np.uint64(1)) & ~z & EVEN)


def _grids() -> list[np.uint64]:
    """The bits of each choice of axis groups on which two points within the distance must agree for one choice at least."""
    edges = [32 * g // GROUPS for g in range(GROUPS + 1)]
    group = [sum(3 << (2 * axis) for axis in range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]
    return [np.uint64(sum(group[g] for g in chosen)) for chosen in combinations(range(GROUPS), GROUPS - DISTANCE)]


GRIDS = _grids()


def _cells(distinct: DataFrame) -> DataFrame:
    """(cell, rest, fp): a fingerprint in each of its cells; rest is the number of bits set in the groups left out."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            point = counts(fp)
            for number, chosen in enumerate(GRIDS):
                cell = mix(mix(point & chosen) + np.uint64(number))  # one-to-one for a grid
                rest = np.bitwise_count(fp & ~chosen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.view(np.int64)), pa.array(rest.astype(np.int8)), batch.column(0)], names=["cell", "rest", "fp"])

    return distinct.select("fp").mapInArrow(deal, "cell long, rest byte, fp long")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the links: (node, least node)."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[:len(a)], ends[len(a):]
    least = np.arange(len(nodes))
    while True:
        low = np.minimum(least[u], least[v])
        before = least.copy()
        np.minimum.at(least, u, low)
        np.minimum.at(least, v, low)
        np.minimum.at(least, before, least)  # whoever was named takes the lesser name along
        least = least[least]
        if (least == before).all():
            break
    moved = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[moved], nodes[least[moved]]


def links(cell: np.ndarray, rest: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by (cell, rest), as a forest."""
    point = counts(fp)
    found_a, found_b, size = [], [], 0
    at, step = np.arange(len(fp) - 1), 1
    while len(at):
        at = at[at + step < len(fp)]
        other = at + step
        near = (cell[at] == cell[other]) & (rest[other] - rest[at] <= DISTANCE)
        at = at[near]  # sorted: who is too far now stays so
        other = at + step
        some = at[manhattan(point[at], point[other]) <= DISTANCE]
        some = some[np.bitwise_count(fp[some] ^ fp[some + step]) <= DISTANCE]
        found_a.append(fp[some])
        found_b.append(fp[some + step])
        size += len(some)
        if size > 4 * SWEEP:  # keeps what is found in proportion to the rows
            a, b = forest(np.concatenate(found_a), np.concatenate(found_b))
            found_a, found_b, size = [a], [b], len(a)
        step += 1
    if not size:
        return fp[:0], fp[:0]
    return forest(np.concatenate(found_a), np.concatenate(found_b))


def _sweeper(most: int):
    """Sweeps sorted partitions of cells: links (a, b) with a > b, and (a, null) for the members of crowded cells."""
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        full = None  # the crowded cell that the partition is in

        def linked(cell: np.ndarray, rest: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
            size = np.diff(np.r_[first, len(cell)])
            crowded = np.repeat(size > most, size)
            a, b = links(cell[~crowded], rest[~crowded], fp[~crowded])
            a, none = np.concatenate([a, fp[crowded]]), int(crowded.sum())
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.concat_arrays([pa.array(b.view(np.int64)), pa.nulls(none, pa.int64())])], names=["a", "b"])

        def members(fp: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.nulls(len(fp), pa.int64())], names=["a", "b"])

        for batch in batches:
            new = [c.to_numpy() for c in batch.columns]
            new = [new[0], new[1].astype(np.int64), new[2].view(np.uint64)]
            if full is not None:
                end = int(np.searchsorted(new[0], full, "right"))
                yield members(new[2][:end])
                new = [c[end:] for c in new]
                full = full if not len(new[0]) else None
            kept = [np.concatenate(x) for x in zip(kept, new, strict=True)]
            if len(kept[0]) > SWEEP:
                last = int(np.searchsorted(kept[0], kept[0][-1]))
                yield linked(*(c[:last] for c in kept))
                kept = [c[last:] for c in kept]
                if len(kept[0]) > most:
                    full = kept[0][-1]
                    yield members(kept[2])
                    kept = [c[:0] for c in kept]
        yield linked(*kept)

    return sweep


def _halfway(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(meeting, fp): every fingerprint within half the distance."""
    single = np.uint64(1) << np.arange(64, dtype=np.uint64)
    masks = np.array([0, *single.tolist(), *(a | b for a, b in combinations(single.tolist(), 2))], np.uint64)
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        for first in range(0, len(fp), 32):
            some = fp[first:first + 32]
            meeting = (some[:, None] ^ masks).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(meeting.view(np.int64)), pa.array(np.repeat(some, len(masks)).view(np.int64))], names=["meeting", "fp"])


def near_links(distinct: DataFrame, most: int = CELL) -> DataFrame:
    """(a, b): links whose components are those of all pairs of fingerprints at the distance or less."""
    swept = _cells(distinct).repartition("cell").sortWithinPartitions("cell", "rest", "fp")
    swept = stored(swept.mapInArrow(_sweeper(most), "a long, b long"), "links")
    members = swept.where("b IS NULL").select("a").distinct()
    meetings = members.mapInArrow(_halfway, "meeting long, fp long")
    least = meetings.groupBy("meeting").agg(F.min("fp").alias("b"))
    met = meetings.join(least, "meeting").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return swept.where("b IS NOT NULL").unionByName(met)


def near_duplicates(docs: DataFrame, most: int = CELL) -> DataFrame:
    """(doc_id, fp, component_id, n_equal): component_id is the least doc_id reachable by links, n_equal counts equal fingerprints."""
    marked = stored(fingerprints(docs), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_equal")), "distinct-fingerprints")
    roots = components(near_links(distinct, most))
    named = distinct.join(roots.hint("merge"), F.col("fp") == F.col("node"), "left")
    named = stored(named.select("fp", "least", "n_equal", F.coalesce("root", "fp").alias("root")), "named-fingerprints")
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(lowest.hint("merge"), "root").select("fp", "n_equal", "component_id")
    return marked.join(named.hint("merge"), "fp").select("doc_id", "fp", "component_id", "n_equal")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_equal")
