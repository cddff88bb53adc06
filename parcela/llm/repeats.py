"""Repeated windows of symbols across a corpus: the parts that operators 3 and 5 share.

Symbols are bytes or words.  Of every window of W symbols the run of k symbols with the smallest hash is
its anchor, so equal windows have equal anchors at equal offsets and only about 2 / (W - k + 2) of all places are
anchors.  The segment of an anchor holds all windows that may have chosen it.  Segments meet by the
anchor's hash: what is alike in the whole segment is settled there and then, after copies have been combined
in the task that reads them; anchors with different segments send one segment of each kind, with its text, to be
compared symbol by symbol.  The segments of an anchor with more of them than one task should hold are cut into parts
by where the anchor lies in a window: windows that are equal lie in the same part, and a part has a longer run of symbols
that all its windows hold, by which parts meet and are settled like segments.  Parts that still have too many
kinds are cut once more, and only what is left then is split into its single windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcela.llm.shared import stored, text_key
from parcela.llm.words import Words, inverse, mix, powers, prefix_sums, range_hash, ranges, signed, slices

STEP = 0xC2B2AE3D27D4EB4F  # base of the hashes over symbols
SEGMENTS = 4096            # segments of one anchor that are compared in one task
PARTS = (4, 16)            # parts of a segment whose anchor has more, and of one whose part still has
# a segment is one number: place of its anchor (45 bits), symbols before it (9), length (9)
ROW = "h long, g long, doc_id long, tk long, spot long, many boolean"


class Symbols:
    """Symbols of a slice: their values, the first symbol of each document, prefix sums."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, by_words: bool):
        if by_words:
            words = Words(raw, offsets)
            self.values, self.first = words.hash, words.first
            sums = np.zeros(len(self.values) + 1, np.uint64)
            np.cumsum(self.values * powers(STEP, len(self.values))[:-1], out=sums[1:])
            self.sums, self.back = sums, powers(inverse(STEP), len(self.values))
        else:
            self.values, self.first = raw, offsets
            self.sums, self.back = prefix_sums(raw), None

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if self.back is None:
            return range_hash(self.sums, start, end)
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def anchors(symbols: Symbols, window: int, gram: int) -> np.ndarray:
    """Places whose gram is the least of some window, the first of equals."""
    n = len(symbols.values)
    if n < window:
        return np.zeros(0, np.int64)
    at = np.arange(n - gram + 1)
    width = window - gram + 1
    # the hash orders, the place in the low bits breaks ties and comes back with the minimum
    bits = max(1, int(n).bit_length())
    key = (mix(symbols.hash(at, at + gram)) >> np.uint64(bits) << np.uint64(bits)) | at.astype(np.uint64)
    least, span = key, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    ends = np.repeat(symbols.first[1:], np.diff(symbols.first))[:len(least)]
    inside = np.arange(len(least)) + window <= ends
    return np.unique(least[inside] & np.uint64((1 << bits) - 1)).astype(np.int64)


def pack(place: np.ndarray, before: np.ndarray, length: np.ndarray) -> np.ndarray:
    return (place << 18) | (before << 9) | length


def unpack(spot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First symbol and end of a segment."""
    start = (spot >> 18) - ((spot >> 9) & 511)
    return start, start + (spot & 511)


def _equal_before(columns: list[np.ndarray]) -> np.ndarray:
    """Rows that equal the row before them."""
    out = np.zeros(len(columns[0]), bool)
    out[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in columns])
    return out


class Repeats:
    """Repeated windows of one kind of symbols.

    ``ordered``: a window is repeated if it also starts earlier (smaller doc_id, tk or place);
    otherwise if it also starts anywhere else.  ``compare`` marks the repeated windows among the segments of whole
    anchors: it gets anchors, order numbers, places, marks of known repeats and symbols of each segment.
    """

    def __init__(self, window: int, gram: int, by_words: bool, ordered: bool, compare: Callable):
        self.window, self.gram, self.by_words, self.ordered, self.compare = window, gram, by_words, ordered, compare

    # rows with h null are finished spans: spot holds them

    def _combined(self, rows: list[np.ndarray]) -> pa.RecordBatch:
        """Equal segments of a task's batch: one row for the earliest, spans for the others."""
        h, g, doc, tk, spot, many = rows
        order = np.lexsort((spot, tk, doc, g, h))
        if self.ordered:  # equal rows are one document
            order = order[~_equal_before([x[order] for x in (h, g, doc, tk, spot)])]
        h, g, doc, tk, spot, many = (x[order] for x in (h, g, doc, tk, spot, many))
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        run = np.cumsum(first) - 1
        many = (np.bincount(run) > 1)[run] | (np.bincount(run, many, run[-1] + 1 if len(run) else 0) > 0)[run] if len(run) else many
        return pa.RecordBatch.from_arrays(
            [pa.array(h, mask=~first), pa.array(g), pa.array(doc), pa.array(tk), pa.array(spot), pa.array(many)],
            names=["h", "g", "doc_id", "tk", "spot", "many"])

    def _segments(self, texts: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                found = []
                for row, _, raw, offsets in slices(batch.column(2)):
                    symbols = Symbols(raw, offsets, self.by_words)
                    place = anchors(symbols, self.window, self.gram)
                    document = np.searchsorted(symbols.first, place, "right") - 1
                    low, high = symbols.first[document], symbols.first[document + 1]
                    start = np.maximum(low, place - (self.window - self.gram))
                    end = np.minimum(high, place + self.window)
                    h = symbols.hash(place, place + self.gram)
                    g = mix(symbols.hash(start, end) + (place - start).astype(np.uint64))
                    found.append([signed(h), signed(g), ids[document + row], keys[document + row],
                                  pack(place - low, place - start, end - start), np.zeros(len(place), bool)])
                if found:
                    yield self._combined([np.concatenate(x) for x in zip(*found, strict=True)])

        return texts.mapInArrow(run, ROW)

    def _settled(self, rows: DataFrame, once: bool) -> DataFrame:
        """Finished spans, and one row for each kind of segment of the anchors that have several to compare.

        ``once``: rows of the same place are one occurrence.
        """

        def settle(table: pa.Table, state: list) -> pa.RecordBatch:
            """Whole runs of equal (h, g).  state: an anchor that goes on and its only row so far."""
            done = table.column("h").is_null().to_numpy()
            h, g, doc, tk, spot = (table.column(c).fill_null(0).to_numpy() for c in ("h", "g", "doc_id", "tk", "spot"))
            many = table.column("many").to_numpy()
            if once:
                stays = done | ~_equal_before([h, g, doc, tk, spot])
                done, h, g, doc, tk, spot, many = (x[stays] for x in (done, h, g, doc, tk, spot, many))
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1]) | done[1:] | done[:-1]
            run = np.cumsum(new) - 1
            repeated = (np.bincount(run) > 1)[run] | many
            repeated = (np.bincount(run, repeated) > 0)[run]
            anchor = np.ones(len(h), bool)
            anchor[1:] = (h[1:] != h[:-1]) | done[1:] | done[:-1]
            group = np.cumsum(anchor) - 1
            kinds = np.bincount(group, new)
            mixed = (kinds > 1)[group] & ~done
            continued = np.zeros(len(h), bool)
            if len(h) and state and not done[0] and state[0] == h[0]:
                continued = group == 0
                mixed |= continued
            spans = done | (repeated & ~new) | (repeated & new & (not self.ordered) & ~done)
            wanted = new & mixed
            if not self.ordered:  # every kind is repeated as a whole: nothing is left to compare
                unknown = np.bincount(group, ~repeated & ~done)
                settled = unknown[group] == 0
                wanted &= ~settled | continued | (group == (group[-1] if len(group) else 0))  # the last may go on
            parts = [(spans, True), (wanted, False)]
            columns = [[], [], [], [], [], []]
            for mask, finished in parts:
                for c, x in zip(columns, (h, g, doc, tk, spot, repeated), strict=True):
                    c.append(x[mask])
            arrays = [np.concatenate(c) for c in columns]
            is_span = np.concatenate([np.full(int(m.sum()), f) for m, f in parts])
            if len(h) and continued.any() and state[1] is not None:
                arrays = [np.concatenate([a, [v]]) for a, v in zip(arrays, state[1], strict=True)]
                is_span = np.append(is_span, False)
            if len(h) and not done[-1]:
                last = np.flatnonzero(group == group[-1])
                known = mixed[last[0]]
                state[:] = [h[-1], None if known else tuple(x[last[0]] for x in (h, g, doc, tk, spot, repeated))]
            return pa.RecordBatch.from_arrays(
                [pa.array(arrays[0].astype(np.int64), mask=is_span), *(pa.array(a.astype(np.int64)) for a in arrays[1:5]),
                 pa.array(arrays[5].astype(bool))], names=["h", "g", "doc_id", "tk", "spot", "many"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: pa.Table | None = None
            state: list = []
            for batch in batches:
                if not batch.num_rows:
                    continue
                table = pa.Table.from_batches([batch]).combine_chunks()
                if held is not None:
                    table = pa.concat_tables([held, table]).combine_chunks()
                h, g = table.column("h").fill_null(0).to_numpy(), table.column("g").to_numpy()
                differs = np.flatnonzero((h != h[-1]) | (g != g[-1]) | (table.column("h").is_null().to_numpy()))
                cut = int(differs[-1]) + 1 if len(differs) else 0
                if cut:
                    yield settle(table.slice(0, cut).combine_chunks(), state)
                held = table.slice(cut)
            if held is not None and held.num_rows:
                yield settle(held.combine_chunks(), state)

        dealt = rows.repartition(F.coalesce("h", F.xxhash64("doc_id", "spot")))
        return dealt.sortWithinPartitions("h", "g", "doc_id", "tk", "spot").mapInArrow(run, ROW)

    @staticmethod
    def _spots(wanted: DataFrame, *names: str) -> DataFrame:
        """The wanted segments of each document."""
        return wanted.groupBy("doc_id", "tk").agg(F.collect_set(F.struct(*names)).alias("want")).withColumnsRenamed(
            {"doc_id": "want_id", "tk": "want_tk"})

    @staticmethod
    def _with_texts(texts: DataFrame, spots: DataFrame) -> DataFrame:
        met = texts.join(spots, (F.col("doc_id") == F.col("want_id")) & (F.col("tk") == F.col("want_tk")))
        return met.select("doc_id", "tk", "text", "want")

    def _parts(self, texts: DataFrame, wanted: DataFrame, parts: int) -> DataFrame:
        """The parts of the wanted segments, as rows of segments: h of the symbols that all windows of a part hold, g of the part."""
        cuts_of_anchor = [i * (self.window - self.gram + 1) // parts for i in range(parts + 1)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                want, found = batch.column("want"), []
                ids, keys = batch.column("doc_id").to_numpy(), batch.column("tk").to_numpy()
                for row, end, raw, offsets in slices(batch.column("text")):
                    symbols = Symbols(raw, offsets, self.by_words)
                    cuts = want.offsets.to_numpy()[row:end + 1]
                    document = np.repeat(np.arange(end - row), np.diff(cuts))
                    spot, many = (want.values.field(f).slice(cuts[0], cuts[-1] - cuts[0]).to_numpy(zero_copy_only=False)
                                  for f in ("spot", "many"))
                    place = spot >> 18
                    start, stop = unpack(spot)
                    for part, (low, high) in enumerate(zip(cuts_of_anchor[:-1], cuts_of_anchor[1:], strict=True)):
                        first = np.maximum(start, place - (high - 1))  # windows of the part start from first to last
                        last = np.minimum(stop - self.window, place - low)
                        held = np.flatnonzero((first <= last) & (low < high))
                        if not len(held):
                            continue
                        first, until, at = first[held], last[held] + self.window, place[held]
                        base = symbols.first[document[held]]
                        h = mix(symbols.hash(base + at - low, base + at - (high - 1) + self.window) + np.uint64(parts + part))
                        g = mix(symbols.hash(base + first, base + until) + (at - first).astype(np.uint64))
                        owner = document[held] + row
                        found.append([signed(h), signed(g), ids[owner], keys[owner], pack(at, at - first, until - first),
                                      many[held].astype(bool)])
                if found:
                    yield self._combined([np.concatenate(x) for x in zip(*found, strict=True)])

        # stored, so that their size is known: few documents have large anchors, and then no text is shuffled
        return self._with_texts(texts, stored(self._spots(wanted, "spot", "many"), "large-spots")).mapInArrow(run, ROW)

    def _wanted_texts(self, texts: DataFrame, wanted: DataFrame) -> DataFrame:
        """The symbols of the wanted segments; of those marked ``single`` one row without symbols for each window."""
        names = ["h", "g", "doc_id", "tk", "spot", "many", "symbols"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                want = batch.column("want")
                for row, end, raw, offsets in slices(batch.column("text")):
                    symbols = Symbols(raw, offsets, self.by_words)
                    cuts = want.offsets.to_numpy()[row:end + 1]
                    document = np.repeat(np.arange(end - row), np.diff(cuts))
                    h, spot, many, single = (want.values.field(f).slice(cuts[0], cuts[-1] - cuts[0]).to_numpy(zero_copy_only=False)
                                             for f in ("h", "spot", "many", "single"))
                    single = single.astype(bool)
                    start, stop = unpack(spot)
                    base = symbols.first[document]

                    def rows(which, h, g, spot, values, document=document, row=row, batch=batch, many=many):
                        owner = pa.array(document[which] + row)
                        return pa.RecordBatch.from_arrays(
                            [pa.array(h), pa.array(g), batch.column("doc_id").take(owner), batch.column("tk").take(owner), pa.array(spot),
                             pa.array(many[which].astype(bool)), values], names=names)

                    alone = np.flatnonzero(single)
                    if len(alone):
                        count = (stop - start)[alone] - self.window + 1
                        which = np.repeat(alone, count)
                        begin = ranges(start[alone], count)
                        at = begin + base[which]
                        hashes = symbols.hash(at, at + self.window)
                        second = mix(symbols.hash(at, at + self.window // 2) ^ np.uint64(STEP))
                        spots = pack(begin, np.zeros(len(begin), np.int64), np.full(len(begin), self.window))
                        yield rows(which, signed(hashes), signed(second), spots, pa.nulls(len(which), pa.binary()))
                    whole = np.flatnonzero(~single)
                    values = [symbols.values[a:b].tobytes() for a, b in zip((base + start)[whole], (base + stop)[whole], strict=True)]
                    yield rows(whole, h[whole], np.zeros(len(whole), np.int64), spot[whole], pa.array(values, pa.binary()))

        spots = self._spots(wanted, "h", "spot", "many", "single").hint("merge")
        return self._with_texts(texts, spots).mapInArrow(run, ROW + ", symbols binary")

    def _compared(self, segments: DataFrame) -> DataFrame:
        """Spans of the repeated windows among the segments of each anchor."""

        def use(table: pa.Table) -> pa.RecordBatch:
            h, doc, tk, spot = (table.column(c).to_numpy() for c in ("h", "doc_id", "tk", "spot"))
            many = table.column("many").to_numpy()
            kind = np.uint64 if self.by_words else np.uint8
            symbols = [np.frombuffer(b, kind) for b in table.column("symbols").to_pylist()]
            start, _ = unpack(spot)
            order = np.lexsort((start, tk, doc))
            rank = np.empty(len(h), np.int64)
            rank[order] = np.cumsum(np.r_[0, (doc[order][1:] != doc[order][:-1]) | (tk[order][1:] != tk[order][:-1])]) if len(h) else 0
            owner, begin, end = self.compare(h, rank, start, many, symbols)
            out = pack(begin, np.zeros(len(begin), np.int64), end - begin)
            return pa.RecordBatch.from_arrays([pa.array(doc[owner]), pa.array(tk[owner]), pa.array(out)], names=["doc_id", "tk", "spot"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: pa.Table | None = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                table = pa.Table.from_batches([batch])
                if held is not None:
                    table = pa.concat_tables([held, table]).combine_chunks()
                h = table.column("h").to_numpy()
                last = int(np.searchsorted(h, h[-1]))  # the last anchor may go on
                if last:
                    yield use(table.slice(0, last).combine_chunks())
                held = table.slice(last)
            if held is not None and held.num_rows:
                yield use(held.combine_chunks())

        return segments.repartition("h").sortWithinPartitions("h").mapInArrow(run, "doc_id long, tk long, spot long")

    def _large(self, wanted: DataFrame) -> DataFrame:
        """Anchors with more kinds of segments than one task compares."""
        return wanted.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > SEGMENTS).select("h")

    def spans(self, texts: DataFrame) -> DataFrame:
        """(doc_id, tk, starts, ends): ranges of symbols covered by repeated windows, per text."""
        settled = stored(self._settled(self._segments(texts), self.ordered), "settled-segments")
        finished = settled.where("h IS NULL").select("doc_id", "tk", "spot")
        wanted = settled.where("h IS NOT NULL")
        large, marked = stored(self._large(wanted), "large-anchors"), []
        for parts in PARTS:
            marked.append(wanted.join(large, "h", "left_anti").withColumn("single", F.lit(False)))
            cut = stored(self._settled(self._parts(texts, wanted.join(large, "h", "left_semi"), parts), True), "settled-parts")
            finished = finished.unionByName(cut.where("h IS NULL").select("doc_id", "tk", "spot"))
            wanted = cut.where("h IS NOT NULL")
            large = stored(self._large(wanted), "large-parts")
        marked.append(wanted.join(large.withColumn("single", F.lit(True)), "h", "left").withColumn(
            "single", F.coalesce("single", F.lit(False))))
        marked = reduce(DataFrame.unionByName, marked)
        # both kinds in one table: the texts are joined once, whether or not there are large anchors
        segments = stored(self._wanted_texts(texts, marked), "wanted-segments")
        windows = self._settled(segments.where("symbols IS NULL").drop("symbols"), True)
        compared = stored(self._compared(segments.where("symbols IS NOT NULL").drop("g")), "compared-spans")
        spans = finished.unionByName(windows.where("h IS NULL").select("doc_id", "tk", "spot")).unionByName(compared)
        return spans.groupBy("doc_id", "tk").agg(F.collect_set("spot").alias("spots"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, tk and text of the rows that take part."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key("text").alias("tk"), "text").where(
        "doc_id IS NOT NULL AND text IS NOT NULL")


def with_spots(docs: DataFrame, spots: DataFrame) -> DataFrame:
    """doc_id, text and the spots of its spans for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key("text").alias("tk"), F.coalesce("text", F.lit("")).alias("text"))
    spots = spots.withColumnsRenamed({"doc_id": "span_id", "tk": "span_tk"})
    return rows.join(spots.hint("merge"), (F.col("doc_id") == F.col("span_id")) & (F.col("tk") == F.col("span_tk")), "left").select("doc_id", "text", "spots")


def covered(spots: list[int] | None) -> list[tuple[int, int]]:
    """Maximal ranges covered by spots."""
    if not spots:
        return []
    start, end = unpack(np.array(spots, np.int64))
    order = np.lexsort((end, start))
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
    return list(zip(start[first].tolist(), end[np.r_[first[1:] - 1, len(end) - 1]].tolist(), strict=True))
