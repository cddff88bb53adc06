"""Operator 5: substring deduplication by phrase look-up in the blocks of an anchor, in place of relative Lempel-Ziv parsing.

The reference is the corpus itself: every distinct segment around an anchor (see ``repeats``) is an indexed block,
held by its earliest occurrence.  A later document is factored against all blocks that share its anchors.  A copy of
a whole block is one factor, found by its hash.  Against blocks that differ somewhere, each place looks up the earliest block with the
same 20 words (binary search over the blocks' sorted phrases), and places that go on in the same block form one
factor.  No longest match is extended and none is chosen at a boundary; windows across a boundary between factors count
only if some block holds them in one piece.  Factors of 20 words or more are the duplicate spans; 64-bit hashes of their
words are compared, so hashes decide.

Defined results: null, empty and blank texts have no words; the earlier of equal windows is the one with the smaller
doc_id, then the smaller text hash, then the earlier start; rows of equal id and text are one document; rows without a
doc_id keep all words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.llm.repeats import Repeats, covered, keyed, with_spots
from parcela.llm.shared import read
from parcela.llm.words import Words, mix, ranges, shingles, slices

WINDOW, GRAM = 20, 5


def factors(h: np.ndarray, rank: np.ndarray, start: np.ndarray, many: np.ndarray, symbols: list[np.ndarray]):
    """Factors of at least 20 words of each segment: segment, start, end (words of its document)."""
    lengths = np.array([len(s) for s in symbols])
    flat = np.concatenate(symbols) if symbols else np.zeros(0, np.uint64)
    base = np.cumsum(lengths) - lengths
    count = np.maximum(lengths - WINDOW + 1, 0)
    owner = np.repeat(np.arange(len(symbols)), count)
    at = ranges(base, count)
    phrase = shingles(flat, WINDOW)[at] if len(at) else np.zeros(0, np.uint64)
    phrase = mix(phrase ^ h[owner].view(np.uint64))  # phrases meet within an anchor
    place = at - base[owner] + start[owner]
    order = np.lexsort((place, rank[owner], phrase))
    sorted_phrase = phrase[order]
    first = np.searchsorted(sorted_phrase, phrase)  # the index entry: the earliest block with the phrase
    reference = order[first] if len(order) else order
    earlier = (rank[owner[reference]] != rank[owner]) | (place[reference] != place)
    found = np.flatnonzero(earlier)
    for i in range(WINDOW):  # hashes of the single words decide, not those of phrases
        if not len(found):
            break
        found = found[flat[at[found] + i] == flat[at[reference[found]] + i]]
    # places that go on in the same block are one factor
    breaks = np.ones(len(found), bool)
    if len(found) > 1:
        breaks[1:] = (found[1:] != found[:-1] + 1) | (owner[found[1:]] != owner[found[:-1]]) \
            | (at[reference[found[1:]]] != at[reference[found[:-1]]] + 1)
    head = np.flatnonzero(breaks)
    tail = np.r_[head[1:], len(found)] - 1 if len(found) else head
    return owner[found[head]], place[found[head]], place[found[tail]] + WINDOW


PARSER = Repeats(WINDOW, GRAM, by_words=True, ordered=True, compare=factors)


def remove_words(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): words not covered by windows that also start earlier, joined by a space."""
    rows = with_spots(docs, PARSER.spans(keyed(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, raw, offsets in slices(batch.column(1)):
                words = Words(raw, offsets)
                text = raw.tobytes()
                spots = batch.column(2).slice(row, end - row).to_pylist()
                totals, removed, kept = [], [], []
                for i in range(end - row):
                    a, b = words.first[i], words.first[i + 1]
                    stays = np.ones(b - a, bool)
                    for low, high in covered(spots[i]):
                        stays[low:high] = False
                    left = np.flatnonzero(stays) + a
                    pieces = [text[x:y] for x, y in zip(words.start[left].tolist(), words.end[left].tolist(), strict=True)]
                    totals.append(b - a)
                    removed.append(b - a - len(left))
                    kept.append(b" ".join(pieces).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_words(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = """
WITH t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS phrase
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM t WHERE len(w) >= 20)
), d AS (
  SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY phrase ORDER BY doc_id, i) AS n FROM s) WHERE n > 1
), c AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM d
), u AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM t
)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(count(c.p) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(u.word, ' ' ORDER BY u.p) FILTER (WHERE c.p IS NULL), '')) AS kept_sha256
FROM t LEFT JOIN u USING (doc_id) LEFT JOIN c ON c.doc_id = u.doc_id AND c.p = u.p GROUP BY t.doc_id, t.w
"""
