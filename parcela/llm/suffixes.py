"""Operator 3: suffix-array deduplication of repeated 200-byte strings.

Texts are cut into segments around anchors (see ``repeats``), so that equal strings of 200 bytes meet in one task.
Segments that are equal as a whole are combined before they are shuffled; their strings are repeated.  The
others are laid one after the other and their suffixes sorted in two stages: suffixes smaller than their
successors are sorted directly, all others are induced by one scan over the buckets.  Neighbours in suffix order
whose common prefix reaches 200 bytes hold the same string.

Defined results: null and empty texts have no bytes; texts are their UTF-8 bytes; rows of equal id and text are one
document whose strings count as often as it stands there; rows without a doc_id keep all bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.llm.repeats import Repeats, covered, keyed, with_spots
from parcela.llm.shared import read
from parcela.llm.words import BASE, inverse, powers, ranges, slices

LENGTH, GRAM = 200, 100
SYMBOL_BITS, PACKED = 9, 7  # a symbol (byte + 1, 0 between segments); symbols in one sort key


def packed_symbols(symbols: np.ndarray) -> np.ndarray:
    """Each place's next seven symbols as one number that orders like them."""
    padded = np.concatenate([symbols, np.zeros(PACKED, symbols.dtype)]).astype(np.int64)
    out = np.zeros(len(symbols), np.int64)
    for i in range(PACKED):
        out = (out << SYMBOL_BITS) | padded[i:i + len(symbols)]
    return out


def ascends(symbols: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor."""
    n = len(symbols)
    following = np.append(symbols[1:].astype(np.int64), -1)
    differs = np.flatnonzero(following != symbols)
    decides = differs[np.searchsorted(differs, np.arange(n))]
    return following[decides] > symbols[decides]


def sorted_directly(places: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their suffixes up to ``depth`` symbols or the end of the segment.

    Groups whose strings have one hash over the whole depth are equal and are not sorted further.
    """
    sums = np.zeros(len(keys) + 1, np.uint64)
    np.cumsum(keys.view(np.uint64) * powers(BASE, len(keys))[:-1], out=sums[1:])
    ends = np.minimum(places + max(depth - PACKED, 0) + 1, len(keys))
    whole = (sums[ends] - sums[places]) * powers(inverse(BASE), len(keys))[places]
    hashes = np.zeros(len(keys), np.uint64)
    hashes[places] = whole
    group = np.zeros(len(places), np.int64)
    order = places.copy()
    open_at = np.arange(len(places))
    last = np.int64((1 << SYMBOL_BITS) - 1)
    padded = np.concatenate([keys, np.zeros(depth + PACKED, np.int64)])
    for reach in range(0, depth, PACKED):
        if not len(open_at):
            break
        key = padded[order[open_at] + reach]
        by = np.lexsort((key, group[open_at]))
        order[open_at] = order[open_at[by]]
        key, owner = key[by], group[open_at]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        run = np.cumsum(fresh) - 1
        ended = np.zeros(len(key), bool)  # a segment has ended within the key: the rest does not matter
        for i in range(PACKED):
            ended |= (key >> np.int64(i * SYMBOL_BITS)) & last == 0
        group[open_at] = open_at[np.flatnonzero(fresh)][run]
        starts = np.flatnonzero(fresh)
        of = hashes[order[open_at]]
        alike = np.minimum.reduceat(of, starts) == np.maximum.reduceat(of, starts)
        open_at = open_at[(np.bincount(run)[run] > 1) & ~ended & ~alike[run]]
    return order


def suffix_array(symbols: np.ndarray, depth: int, ends: np.ndarray | None = None) -> np.ndarray:
    """Suffix order up to ``depth`` symbols, in two stages.

    ``ends``: of each segment, the place after the last suffix that is asked for.  Suffixes behind it are
    left out, but for those up to the next that is smaller than its successor, which the others are induced from.
    """
    if not len(symbols):
        return np.zeros(0, np.int64)
    up = ascends(symbols)
    keys = packed_symbols(symbols)
    small = np.flatnonzero(up)
    if ends is not None:
        closes = np.append(np.flatnonzero(symbols == 0), len(symbols))
        until = np.searchsorted(small, ends)  # the next one is sorted as well
        limit = np.where(until < len(small), small[np.minimum(until, len(small) - 1)], len(symbols))
        small = small[small <= limit[np.searchsorted(closes, small)]]
    direct = sorted_directly(small, keys, depth)
    size = int(symbols.max()) + 1
    cuts = np.searchsorted(symbols[direct], np.arange(size + 1))
    induced: list[list[np.ndarray]] = [[] for _ in range(size)]
    out: list[np.ndarray] = []

    def induce(places: np.ndarray) -> np.ndarray:
        """Predecessors that are larger than these suffixes, dealt to their buckets; those of bucket c itself come back."""
        before = places[places > 0] - 1
        before = before[~up[before]]
        letter = symbols[before]
        by = np.argsort(letter, kind="stable")
        before, letter = before[by], letter[by]
        ends = np.searchsorted(letter, np.arange(size + 1))
        for s in np.unique(letter):
            if s != c:
                induced[s].append(before[ends[s]:ends[s + 1]])
        return before[ends[c]:ends[c + 1]]

    c = int(symbols[-1])
    if not up[-1]:
        induced[c].append(np.array([len(symbols) - 1]))  # the last suffix has no successor to come from
    for c in range(size):
        now = np.concatenate(induced[c]) if induced[c] else np.zeros(0, np.int64)
        while len(now):
            out.append(now)
            now = induce(now)
        now = direct[cuts[c]:cuts[c + 1]]
        if len(now):
            out.append(now)
            induce(now)
    return np.concatenate(out)


def same_strings(places: np.ndarray, data: np.ndarray, length: int) -> np.ndarray:
    """Whether the common prefix of each place and the one before it reaches ``length`` bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.zeros(len(data), np.uint64)
    for i in range(8):
        words = (words << np.uint64(8)) | padded[i:i + len(data)].astype(np.uint64)
    same = np.ones(len(places), bool)
    same[:1] = False
    alive = np.flatnonzero(same)
    for reach in [*range(0, length - 7, 8), length - 8]:
        equal = words[places[alive] + reach] == words[places[alive - 1] + reach]
        same[alive[~equal]] = False
        alive = alive[equal]
    return same


def repeated_strings(h: np.ndarray, rank: np.ndarray, start: np.ndarray, many: np.ndarray, symbols: list[np.ndarray]):
    """Runs of 200-byte strings that also start elsewhere: segment, first and last byte + 1 (in its document)."""
    lengths = np.array([len(s) for s in symbols], np.int64)
    begin = np.cumsum(lengths + 1) - lengths - 1
    text = np.zeros(int(lengths.sum()) + len(symbols), np.uint16)
    data = np.zeros(len(text), np.uint8)
    inside = ranges(begin, lengths)
    data[inside] = np.concatenate(symbols) if symbols else 0
    text[inside] = data[inside].astype(np.uint16) + 1
    owner = np.repeat(np.arange(len(symbols)), lengths + 1)
    order = suffix_array(text, LENGTH, begin + np.maximum(lengths - LENGTH + 1, 0))
    offset = np.arange(len(text)) - begin[owner] if len(owner) else np.zeros(0, np.int64)
    order = order[offset[order] <= lengths[owner[order]] - LENGTH]
    group = np.cumsum(~same_strings(order, data, LENGTH)) - 1
    segment = owner[order]
    place = offset[order] + start[segment]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    other = (rank[segment] != rank[segment[first]][group]) | (place != place[first][group]) if len(group) else np.zeros(0, bool)
    repeated = np.bincount(group, other | many[segment]) > 0 if len(group) else np.zeros(0, bool)
    found = np.sort(order[repeated[group]]) if len(group) else order
    breaks = np.ones(len(found), bool)
    breaks[1:] = (found[1:] != found[:-1] + 1) | (owner[found[1:]] != owner[found[:-1]])
    head = np.flatnonzero(breaks)
    tail = np.r_[head[1:], len(found)] - 1 if len(found) else head
    which = owner[found[head]]
    low = offset[found[head]] + start[which]
    return which, low, offset[found[tail]] + start[which] + LENGTH


FINDER = Repeats(LENGTH, GRAM, by_words=False, ordered=False, compare=repeated_strings)


def remove_strings(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): bytes not covered by a 200-byte string that also starts elsewhere."""
    rows = with_spots(docs, FINDER.spans(keyed(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, raw, offsets in slices(batch.column(1)):
                text = raw.tobytes()
                spots = batch.column(2).slice(row, end - row).to_pylist()
                sizes, removed, count, kept = [], [], [], []
                for i in range(end - row):
                    a, b = int(offsets[i]), int(offsets[i + 1])
                    runs = covered(spots[i])
                    edges = [0, *(x for pair in runs for x in pair), b - a]
                    pieces = [text[a + x:a + y] for x, y in zip(edges[::2], edges[1::2], strict=True)]
                    sizes.append(b - a)
                    removed.append(sum(y - x for x, y in runs))
                    count.append(len(runs))
                    kept.append(b"".join(pieces))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(count, pa.int64()), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_strings(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
