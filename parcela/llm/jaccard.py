"""Operator 10: n-gram Jaccard join by T-occurrence search (DivideSkip).

A document is the set of its word shingles.  For a set of n shingles and similarity num/den any
linked set shares at least T = ceil(n * num / den) of them.  DivideSkip sets the T - 1 longest
inverted lists aside, merges the others, and probes the long lists only for the documents that the merge
has found.  Here that is done twice:

1. Over the whole corpus the short lists are the first n - T + 1 shingles in an order that puts rare
   ones first (long shingles before short ones, measured hot ones last).  Sets that meet in a list and whose parity
   bitmaps and sizes allow a link become candidates.  Within a list a spanning set of pairs is enough, so a list
   of near copies gives one edge a document.
2. Candidates fall into components; the sets of a component are searched together with inverted
   lists of its own, short lists merged and long ones probed by binary search, and each pair that reaches the
   overlap is a link.  A component that is too large for one task is searched in blocks, each with the same leader; sets that
   are not connected to the leader are dealt into blocks of their own, and each of these meets every block of the component in
   a task of its own, where what the first search has connected is one from the start.  Long lists are searched the same way.

Equal sets are one set from the start.  Pairs inside what is already connected need no search.

Defined results: words are runs without ASCII white space, A-Z folded; a text of fewer words than a shingle is
one shingle; null, empty and blank texts have the empty set, link with nothing and are their own component; rows
of a null doc_id have no component; rows of equal id and text are one document; texts that share a
doc_id are kept apart unless both represent their set, then they share the component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.llm.components import components
from parcela.llm.shared import fresh, read, stored, text_key
from parcela.llm.words import Words, mix, ranges, shingles, signed, slices

BLOCK_SETS = 2048    # sets of one component that a task searches together
LIST_SETS = 4096     # sets of one inverted list that a task searches together
PAIRED = 64          # lists up to this length compare all their pairs, longer ones by a leader first
HOT_COUNTERS = 4096  # shingles that a task's frequency summary holds
BITMAP_BITS = 256, 4096  # least and most bits of the parity bitmap of a set; as many as shingles in between


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int):
    """Distinct (document, shingle) of a slice, sorted by document and shingle: document, hash, bytes of words."""
    words = Words(raw, offsets, fold=True)
    sizes = np.diff(words.first)
    hashes = shingles(words.hash, width)
    at = np.flatnonzero(words.document[:len(hashes)] == words.document[width - 1:]) if len(hashes) else np.zeros(0, np.int64)
    lengths = np.concatenate([[0], np.cumsum(words.end - words.start)])
    document, value, length = words.document[at], hashes[at], lengths[at + width] - lengths[at]
    for few in range(1, width):  # the whole text is its only shingle
        short = np.flatnonzero(sizes == few)
        if len(short):
            first = words.first[short]
            document = np.concatenate([document, short])
            value = np.concatenate([value, shingles(words.hash, few)[first] ^ np.uint64(few)])
            length = np.concatenate([length, lengths[first + few] - lengths[first]])
    order = by_document(document, value)
    document, value, length = document[order], value[order], length[order]
    new = np.ones(len(order), bool)
    new[1:] = (document[1:] != document[:-1]) | (value[1:] != value[:-1])
    return document[new], value[new], length[new]


def by_document(document: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order by document, then key."""
    order = np.argsort(key)
    owner = document[order]
    if len(owner) and owner.max() < 1 << 16:
        owner = owner.astype(np.uint16)  # these are sorted by counting
    return order[np.argsort(owner, kind="stable")]


def needed(n, num: int, den: int):
    """Least overlap of a set of n shingles with any set that it is linked with."""
    return -(-n * num // den)


def prefixes(document, value, length, n_documents: int, num: int, den: int, hot: np.ndarray, times: int = 1):
    """Rows of the shingles that stand first in the common order: ``times`` * (n - T) + 1 of each set."""
    sizes = np.bincount(document, minlength=n_documents)
    rank = ((np.uint64(255) - np.minimum(length, 255).astype(np.uint64)) << np.uint64(55)) | (mix(value) >> np.uint64(9))
    if len(hot):
        rank |= (hot[np.minimum(np.searchsorted(hot, value), len(hot) - 1)] == value).astype(np.uint64) << np.uint64(63)
    order = by_document(document, rank)
    first = np.cumsum(sizes) - sizes
    nth = np.arange(len(order)) - first[document[order]]
    keep = nth < (times * (sizes - needed(sizes, num, den)) + 1)[document[order]]
    return order[keep], sizes


def signature(value: np.ndarray, sizes: np.ndarray, salt: int) -> np.ndarray:
    """Sum of the mixed hashes of each set."""
    sums = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(mix(value + np.uint64(salt * 0x1234567)), out=sums[1:])
    ends = np.cumsum(sizes)
    return signed(sums[ends] - sums[ends - sizes])


def parity_bitmap(value: np.ndarray) -> bytes:
    """Bit i is set if an odd number of shingles has the remainder i."""
    bits = min(max(BITMAP_BITS[0], 1 << int(len(value) - 1).bit_length()), BITMAP_BITS[1]) if len(value) else BITMAP_BITS[0]
    odd = np.bincount((value & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


class Sketches:
    """Sizes and parity bitmaps of sets; bitmaps also folded to half their bits."""

    def __init__(self, n: np.ndarray, bitmaps: list[bytes]):
        self.n = n.astype(np.int64)
        self.words = np.array([len(b) // 8 for b in bitmaps], np.int64)
        most = int(self.words.max(initial=1))
        self.full = np.zeros((len(bitmaps), most), np.uint64)
        self.half = np.zeros((len(bitmaps), most), np.uint64)
        for words in np.unique(self.words):
            at = np.flatnonzero(self.words == words)
            rows = np.frombuffer(b"".join([bitmaps[i] for i in at]), np.uint64).reshape(-1, words)
            self.full[at, :words] = rows
            self.half[at, :words // 2] = rows[:, :words // 2] ^ rows[:, words // 2:]

    def may_link(self, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
        """Of pairs of sets, those whose sizes and bitmaps allow a link (as a mask)."""
        small, large = np.minimum(self.n[a], self.n[b]), np.maximum(self.n[a], self.n[b])
        good = small * den >= large * num
        at = np.flatnonzero(good)
        both = (small + large)[at]
        most = both - 2 * -(-both * num // (num + den))
        a, b = a[at], b[at]
        left = np.where((self.words[a] > self.words[b])[:, None], self.half[a], self.full[a])
        left ^= np.where((self.words[b] > self.words[a])[:, None], self.half[b], self.full[b])
        # sizes of links differ by less than two, so one fold brings both to the same bits
        good[at] = (np.bitwise_count(left).sum(axis=1, dtype=np.int64) <= most) | (np.abs(self.words[a] - self.words[b]) > np.minimum(self.words[a], self.words[b]))
        return good


class HotSummary:
    """Misra-Gries summary: every value whose share exceeds 1 / size is in it."""

    def __init__(self, size: int):
        self.size, self.values, self.counts = size, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, values: np.ndarray) -> None:
        fresh_values, fresh_counts = np.unique(values, return_counts=True)
        every, place = np.unique(np.concatenate([self.values, fresh_values]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([self.counts, fresh_counts]), len(every)).astype(np.int64)
        if len(every) > self.size:
            counts = counts - np.partition(counts, len(counts) - self.size - 1)[len(counts) - self.size - 1]
        self.values, self.counts = every[counts > 0], counts[counts > 0]


def _survey(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Per document its set's size and signature, and per task the summary of frequent shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, total = HotSummary(HOT_COUNTERS), 0
        names = ["doc_id", "tk", "n", "s1", "s2", "bitmap", "hot"]
        for batch in batches:
            pending = []
            for row, end, raw, offsets in slices(batch.column(2)):
                document, value, length = shingle_sets(raw, offsets, width)
                n = end - row
                at, sizes = prefixes(document, value, length, n, num, den, np.zeros(0, np.uint64), 2)
                pending.append(value[at])
                total += len(at)
                sums = []
                for salt in (1, 2):
                    sums.append(pa.array(signature(value, sizes, salt)))
                ends = np.cumsum(sizes)
                bitmaps = [parity_bitmap(value[a:b]) for a, b in zip(ends - sizes, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), batch.column(1).slice(row, n), pa.array(sizes), *sums,
                     pa.array(bitmaps, pa.binary()), pa.nulls(n, pa.bool_())],
                    names=names)
            if pending:
                summary.add(np.concatenate(pending))
        if total:
            values = np.concatenate([signed(summary.values), [0]])
            counts = np.concatenate([summary.counts, [total]])
            flags = np.concatenate([np.ones(len(summary.values), bool), [False]])
            empty = pa.nulls(len(values), pa.int64())
            yield pa.RecordBatch.from_arrays([empty, empty, pa.array(counts), pa.array(values), empty,
                 pa.nulls(len(values), pa.binary()), pa.array(flags)], names=names)

    return docs.mapInArrow(run, "doc_id long, tk long, n long, s1 long, s2 long, bitmap binary, hot boolean")


def _postings(docs: DataFrame, width: int, num: int, den: int, hot: np.ndarray) -> DataFrame:
    """(token, set): the short lists; each task gives equal sets once."""
    kept = docs.sparkSession.sparkContext.broadcast(hot)  # at most 2 * HOT_COUNTERS values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            for row, end, raw, offsets in slices(batch.column(2)):
                document, value, length = shingle_sets(raw, offsets, width)
                n = end - row
                at, sizes = prefixes(document, value, length, n, num, den, kept.value)
                sets = signature(value, sizes, 1)
                new = np.zeros(n, bool)
                for i, s in enumerate(sets.tolist()):
                    if sizes[i] and s not in given:
                        given.add(s)
                        new[i] = True
                at = at[new[document[at]]]
                yield pa.RecordBatch.from_arrays([pa.array(signed(value[at])), pa.array(sets[document[at]])], names=["token", "set"])

    return docs.mapInArrow(run, "token long, set long")


def _forest(n: int):
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    return parent, find


def spanning(rows: np.ndarray, sketches: Sketches, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect the rows of one long list wherever sizes and bitmaps allow a link."""
    rows = rows[np.argsort(sketches.n[rows], kind="stable")]
    n = sketches.n[rows]
    parent, find = _forest(len(rows))

    def near(i: int, others: np.ndarray) -> np.ndarray:
        return others[sketches.may_link(np.full(len(others), rows[i]), rows[others], num, den)]

    leader = len(rows) // 2
    rest = np.concatenate([np.arange(leader), np.arange(leader + 1, len(rows))])
    for j in near(leader, rest).tolist():
        parent[j] = leader
    for i in [j for j in rest.tolist() if parent[j] != leader]:
        low = np.searchsorted(n, -(-n[i] * num // den))
        high = np.searchsorted(n, n[i] * den // num, "right")
        window = np.arange(low, high)
        for j in near(i, window[window != i]).tolist():
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    roots = np.array([find(i) for i in range(len(rows))])
    moved = roots != np.arange(len(rows))
    return rows[moved], rows[roots[moved]]


def _lists(rows: DataFrame, use: Callable[[pa.Table], Iterator[pa.RecordBatch]], out: str) -> DataFrame:
    """Apply ``use`` to runs of whole lists: rows (token, ...) dealt and sorted by token."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        going = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).select(names)
            token = table.column("token").to_numpy()
            last = int(np.searchsorted(token, token[-1]))  # the last list may go on
            if last or going != token[-1]:
                whole = [*held, table.slice(0, last)]
                yield from use(pa.concat_tables(whole).combine_chunks())
                held = []
            held.append(table.slice(last))
            going = token[-1]
        if held:
            yield from use(pa.concat_tables(held).combine_chunks())

    return rows.repartition("token").sortWithinPartitions("token").mapInArrow(run, out)


def _shared(postings: DataFrame) -> DataFrame:
    """(token, set) of the lists that hold more than one set; of lists with the same sets one.

    Near copies meet in most of their lists.  A list is named by the sum of its sets' hashes, a long one by an
    aggregation; should two lists get one name they are searched as one, which loses no pair.
    """
    postings = stored(postings, "postings")
    long = stored(postings.groupBy("token").agg(F.count("*").alias("rows")).where(F.col("rows") > LIST_SETS).select("token"), "long-postings")

    def use(table: pa.Table) -> Iterator[pa.RecordBatch]:
        token, sets = table.column("token").to_numpy(), table.column("set").to_numpy()
        order = np.lexsort((sets, token))
        token, sets = token[order], sets[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (sets[1:] != sets[:-1])
        token, sets = token[new], sets[new]
        cuts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[cuts, len(token)])
        names = np.add.reduceat(mix(sets.view(np.uint64)), cuts) if len(token) else np.zeros(0, np.uint64)
        several = np.repeat(sizes > 1, sizes)
        yield pa.RecordBatch.from_arrays([pa.array(signed(np.repeat(names, sizes))[several]), pa.array(sets[several])],
                                         names=["token", "set"])

    if long.isEmpty():
        return _lists(postings, use, "token long, set long").distinct()
    lists = stored(postings.join(long, "token").distinct(), "long-lists")
    names = lists.groupBy("token").agg(F.xxhash64(F.bit_xor(F.xxhash64("set")), F.count("*")).alias("name"))
    named = lists.join(names, "token").select(F.col("name").alias("token"), "set")
    return _lists(postings.join(long, "token", "left_anti"), use, "token long, set long").unionByName(named).distinct()


def _rounds(members: DataFrame, payload: list[str], search: Callable[[DataFrame], DataFrame], most: int, purpose: str) -> DataFrame:
    """(a, b): links that connect what ``search`` connects within each group, in tasks of about ``2 * most`` sets.

    ``members`` (comp, rep, leads, blocks, own, payload) are stored sets of groups with a leader.  First each block is searched
    with the leader; then blocks of the sets that are apart from it meet all blocks of a group that has several.
    """
    own = ["comp", "rep", *payload]
    first = members.select(*own, "leads", F.explode("own").alias("block"), F.lit(0).cast("long").alias("asking"), F.lit(True).alias("asks"),
                           F.col("rep").alias("tree"), F.lit(False).alias("known"))
    first = stored(search(first), purpose)
    state = first.groupBy("comp", "rep").agg(F.min("root").alias("tree"), F.max("main").alias("known"))
    split = members.where("blocks > 1").join(state, ["comp", "rep"])
    apart = state.where("NOT known").groupBy("comp").agg(F.ceil(F.count("*") / most).alias("groups"))
    split = split.join(apart, "comp").withColumn("leads", F.lit(False))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    groups = F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))
    flags = ["tree", "known"]
    asking = split.where("NOT known").select(*own, "leads", every.alias("block"), F.pmod(F.xxhash64("rep", F.lit("asks")), "groups").alias("asking"),
                                             F.lit(True).alias("asks"), *flags)
    asked = split.select(*own, "leads", "groups", F.explode("own").alias("block"), *flags).select(
        *own, "leads", "block", groups.alias("asking"), F.lit(False).alias("asks"), *flags)
    second = search(asked.unionByName(asking))
    return first.unionByName(second).select(F.col("rep").alias("a"), F.col("root").alias("b"))


def _cells(members: DataFrame, roots: Callable[[pa.Table, np.ndarray, np.ndarray, np.ndarray], list[int]]) -> DataFrame:
    """(comp, rep, root, main) of the rows of :func:`_rounds`; ``roots`` takes distinct sets, asks, tree and known of a cell."""

    def cell(table: pa.Table) -> pa.Table:
        table = table.sort_by([("known", "descending"), ("leads", "descending"), ("rep", "ascending"), ("asks", "descending")])
        reps = table.column("rep").to_numpy()
        table = table.take(pa.array(np.flatnonzero(np.r_[True, reps[1:] != reps[:-1]]))).combine_chunks()
        own = table.column("rep").to_numpy()
        found = roots(table, *(table.column(c).to_numpy() for c in ("asks", "tree", "known")))
        best: dict[int, int] = {}
        for i, r in enumerate(found):
            best[r] = min(best.get(r, own[i]), own[i])
        return pa.table({"comp": table.column("comp"), "rep": own, "root": np.array([best[r] for r in found], np.int64),
                         "main": np.array([r == found[0] for r in found], bool)})

    return members.groupBy("comp", "block", "asking").applyInArrow(cell, "comp long, rep long, root long, main boolean")


def _start(tree: np.ndarray, asks: np.ndarray, known: np.ndarray):
    """Forest of a cell's sets with equal trees joined, and whether a set connected to the first one need not search.

    It need not if the first one is known: a set that asks elsewhere finds it there, or is connected to the known ones too.
    It need not either if all sets ask here.
    """
    parent, find = _forest(len(tree))
    _, heads, place = np.unique(tree, return_index=True, return_inverse=True)
    parent[:] = heads[place].tolist()
    return parent, find, bool(known[0] or asks.all())


def met(sketches: Sketches, asks: np.ndarray, tree: np.ndarray, known: np.ndarray, num: int, den: int) -> list[int]:
    """Root of each set of a list after comparing all sets that ask, wherever sizes and bitmaps allow a link."""
    parent, find, enough = _start(tree, asks, known)

    def meet(i: int, others: np.ndarray) -> None:
        for j in others[sketches.may_link(np.full(len(others), i), others, num, den)].tolist():
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)

    meet(0, np.flatnonzero(asks | asks[0])[1 if asks[0] else 0:])
    order = np.argsort(sketches.n, kind="stable")
    n = sketches.n[order]
    for i in np.flatnonzero(asks)[1 if asks[0] else 0:].tolist():
        if enough and find(i) == find(0):
            continue
        low = np.searchsorted(n, needed(sketches.n[i], num, den))
        high = np.searchsorted(n, sketches.n[i] * den // num, "right")
        others = order[low:high]
        meet(i, others[others != i])
    return [find(i) for i in range(len(asks))]


def _candidates(postings: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): edges that connect all sets that meet in a list and may be linked."""

    def use(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        token, sets, n = (table.column(c).to_numpy() for c in ("token", "set", "n"))
        sketches = Sketches(n, table.column("bitmap").to_pylist())
        cuts = np.flatnonzero(np.r_[True, token[1:] != token[:-1], True])
        sizes = np.diff(cuts)
        rows = np.arange(len(token))
        later = np.repeat(cuts[1:], sizes) - rows - 1
        later[np.repeat(sizes > PAIRED, sizes)] = 0
        pairs = [(np.repeat(rows, later), ranges(rows + 1, later))]  # all pairs of short lists, not emitted
        pairs[0] = tuple(x[sketches.may_link(*pairs[0], num, den)] for x in pairs[0])
        for i in np.flatnonzero(sizes > PAIRED):
            pairs.append(spanning(rows[cuts[i]:cuts[i + 1]], sketches, num, den))
        both = np.stack([sets[np.concatenate(x)] for x in zip(*pairs, strict=True)], axis=1)
        both = np.unique(both[both[:, 0] != both[:, 1]], axis=0)
        parent: dict[int, int] = {}
        edges = []
        for a, b in both.tolist():
            while (up := parent.get(a, a)) != a:
                a = up
            while (up := parent.get(b, b)) != b:
                b = up
            if a != b:
                parent[max(a, b)] = min(a, b)
                edges.append((a, b))
        if edges:
            left, right = (pa.array(x, pa.int64()) for x in zip(*edges, strict=True))
            yield pa.RecordBatch.from_arrays([left, right], names=["a", "b"])

    lists = stored(_shared(postings), "shared-lists")
    long = lists.groupBy("token").agg(F.count("*").alias("size"), F.min("set").alias("leader")).where(F.col("size") > LIST_SETS)
    long = stored(long, "long-shared-lists")
    sketched = F.col("set") == F.col("s1")
    if long.isEmpty():
        return _lists(lists.join(sketches, sketched).select("token", "set", "n", "bitmap"), use, "a long, b long")
    short = lists.join(long, "token", "left_anti").join(sketches, sketched).select("token", "set", "n", "bitmap")
    leads, blocks = F.col("set") == F.col("leader"), F.ceil(F.col("size") / LIST_SETS)
    sets = lists.join(long, "token").join(sketches, sketched).select(
        F.col("token").alias("comp"), F.col("set").alias("rep"), "n", "bitmap", leads.alias("leads"), blocks.alias("blocks"),
        _dealt("set", leads, blocks).alias("own"))

    def roots(table: pa.Table, asks: np.ndarray, tree: np.ndarray, known: np.ndarray) -> list[int]:
        return met(Sketches(table.column("n").to_numpy(), table.column("bitmap").to_pylist()), asks, tree, known, num, den)

    found = _rounds(stored(sets, "long-list-sets"), ["n", "bitmap"], lambda rows: _cells(rows, roots), LIST_SETS, "long-list-links")
    return _lists(short, use, "a long, b long").unionByName(found)


def _dealt(ident: str, leads: Column, blocks: Column) -> Column:
    """Numbers of the blocks that a set stands in; the leader stands in every block of its group."""
    return F.when(leads, F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(F.array(F.pmod(F.xxhash64(ident), blocks)))


def shared(some: np.ndarray, others: np.ndarray) -> int:
    """How many of some values are among others, which are sorted."""
    at = np.searchsorted(others, some)
    return int((others[np.minimum(at, len(others) - 1)] == some).sum())


def linked(sets: list[np.ndarray], asks: np.ndarray, tree: np.ndarray, known: np.ndarray, num: int, den: int) -> list[int]:
    """Root of each set after searching the links of all sets that ask, within one task.

    Roots are indexes; two sets have the same root if links connect them, or their trees are equal.
    """
    count = len(sets)
    sizes = np.array([len(s) for s in sets])
    parent, find, enough = _start(tree, asks, known)

    def join(i: int, j: int) -> None:
        a, b = find(i), find(j)
        if a != b:
            parent[max(a, b)] = min(a, b)

    def is_link(i: int, j: int) -> bool:
        both = shared(sets[i], sets[j])
        return den * both >= num * (sizes[i] + sizes[j] - both)

    leader = 0
    for j in range(1, count):
        if (asks[j] or asks[leader]) and find(j) != find(leader):
            if min(sizes[leader], sizes[j]) * den >= max(sizes[leader], sizes[j]) * num and is_link(leader, j):
                join(leader, j)
    outside = [i for i in range(count) if asks[i] and not (enough and find(i) == find(leader))]
    if not outside:
        return [find(i) for i in range(count)]
    sketches = Sketches(sizes, [parity_bitmap(x) for x in sets])
    # inverted lists over the sets in order of size
    order = np.argsort(sizes, kind="stable")
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    values = np.concatenate([sets[i] for i in order])
    owners = np.repeat(np.arange(count), sizes[order])
    by_token = np.argsort(values, kind="stable")  # owners stay in order within a list
    values, owners = values[by_token], owners[by_token]
    for i in outside:
        low = np.searchsorted(values, sets[i], "left")
        high = np.searchsorted(values, sets[i], "right")
        least = int(needed(sizes[i], num, den))  # of sets no larger; a larger one shares more
        smallest = np.searchsorted(sizes[order], needed(sizes[i], num, den))
        largest = np.searchsorted(sizes[order], sizes[i] * den // num, "right")
        by_length = np.argsort(high - low, kind="stable")
        n_short = int(sizes[i]) - least + 1
        short, long = by_length[:n_short], by_length[n_short:]
        merged = np.sort(np.concatenate([owners[low[t]:high[t]] for t in short]))
        found, times = np.unique(merged, return_counts=True)
        good = (found >= smallest) & (found < largest) & (found != place[i])
        seen = dict(zip(order[found[good]].tolist(), times[good].tolist(), strict=True))
        others = order[found[good]]
        for j in others[sketches.may_link(np.full(len(others), i), others, num, den)].tolist():
            if find(j) == find(i):
                continue
            total = seen[j] + shared(sets[i][long], sets[j])  # binary search for the long lists
            if den * total >= num * (sizes[i] + sizes[j] - total):
                join(i, j)
    return [find(i) for i in range(count)]


def _search(members: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(comp, rep, root, main) of rows with a text, cell by cell."""

    def roots(table: pa.Table, asks: np.ndarray, tree: np.ndarray, known: np.ndarray) -> list[int]:
        sets: list[np.ndarray] = []
        for row, end, raw, offsets in slices(table.column("text").combine_chunks()):
            document, value, _ = shingle_sets(raw, offsets, width)
            cuts = np.searchsorted(document, np.arange(end - row + 1))
            sets += [value[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return linked(sets, asks, tree, known, num, den)

    return _cells(members, roots)


def join(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(doc_id, tk, n_shingles, component_id) of every document; links have den * I >= num * U."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key("text").alias("tk"), "text")
    survey = stored(_survey(texts, width, num, den), "shingle-sets")
    rows = survey.where("hot IS NULL").drop("hot")
    total = survey.where("NOT hot").agg(F.sum("n")).first()[0] or 0
    often = survey.where("hot").groupBy("s1").agg(F.sum("n").alias("n")).where(F.col("n") > total // HOT_COUNTERS + 8)
    hot = np.sort(often.select("s1").toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64))  # fewer than HOT_COUNTERS

    linkable = texts.where("doc_id IS NOT NULL")
    classes = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2", "n").agg(
        F.min(F.struct("doc_id", "tk", "bitmap")).alias("r"))
    classes = stored(classes.select("s1", "s2", "n", F.col("r.doc_id").alias("rep"), F.col("r.tk").alias("rep_tk"),
                                    F.col("r.bitmap").alias("bitmap")), "classes")
    edges = _candidates(_postings(linkable, width, num, den, hot), classes.select("s1", "n", "bitmap"), num, den)
    found = stored(components(edges), "candidates")
    inside = stored(classes.join(found, F.col("s1") == F.col("node")).select(F.col("root").alias("comp"), "rep", "rep_tk"), "members")
    sizes = inside.groupBy("comp").agg(F.count("*").alias("size"), F.min("rep").alias("leader"))
    dealt = inside.join(sizes, "comp").where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK_SETS)
    leads = F.col("rep") == F.col("leader")
    dealt = dealt.select("comp", "rep", "rep_tk", leads.alias("leads"), blocks.alias("blocks"), _dealt("rep", leads, blocks).alias("own"))
    with_text = texts.join(dealt.hint("merge"), (F.col("doc_id") == F.col("rep")) & (F.col("tk") == F.col("rep_tk"))).dropDuplicates(["rep", "rep_tk"])
    with_text = stored(with_text.select("comp", "rep", "leads", "blocks", "own", "text"), "candidate-texts")
    links = _rounds(with_text, ["text"], lambda rows: _search(rows, width, num, den), BLOCK_SETS, "links")
    joined = stored(components(links), "joined")
    classes = classes.join(joined, F.col("rep") == F.col("node"), "left").select(
        F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.col("n").alias("cn"), F.coalesce("root", "rep").alias("component"))
    classes = stored(classes, "class-components")
    met = rows.join(classes, (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")) & (F.col("n") == F.col("cn"))
                    & F.col("doc_id").isNotNull() & (F.col("n") > 0), "left")
    return met.select("doc_id", "tk", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One document of each component, the one with the smallest id; rows of equal id and text stay together.

    Rows without a doc_id stay.
    """
    found = join(docs, width, num, den)
    lost = found.where("doc_id <> component_id").select(F.col("doc_id").alias("lost_id"), F.col("tk").alias("lost_tk")).distinct()
    lost = stored(lost, "near-duplicates")
    key = fresh("tk", docs)
    ident, code = fresh("lost_id", docs), fresh("lost_tk", docs)
    lost = lost.select(F.col("lost_id").alias(ident), F.col("lost_tk").alias(code))
    marked = docs.withColumn(key, text_key("text"))
    return marked.join(lost.hint("merge"), (marked["doc_id"] == lost[ident]) & (marked[key] == lost[code]), "left_anti").drop(key)


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(read(spark, sf_dir, "documents"), 3, 90, 100).drop("tk")


OP10_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
         ELSE array_to_string(list_slice(w, i, i + 2), ' ') END AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), o AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (
  SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 90 * (p.n + q.n - i)
), r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.reached = e.x
)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.reached) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id
"""
