"""Operator 12: conversation structure repair by Wagner-Fischer alignment to the alternating grammar.

The grammar of role initials is ``(s?(ua)+)?``.  Its strings of one length differ only in the leading s, so the turns are
aligned with the alternating string of each feasible length in turn, nearest lengths first.  The cost of the best
alignment so far bounds the band of the next table (Ukkonen): cells whose surplus of insertions or deletions would
already cost more are not filled.  Of alignments of equal cost the least audit wins; an audit is traced back from the
table by taking the least letter that stays optimal.

Long conversations: a block of turns is aligned once for each state of the grammar that it can start in, and the blocks'
tables (start, end) -> (cost, audit) are chained.  Audits of equal cost that use up the same turns are never prefixes
of one another, so the least audit of the whole is made of least audits.  Rows are dealt to ranges of (conversation, turn,
role, text), so a conversation with a third of all rows is spread over many tasks; only tables meet in one task.
Equal rows are counted before any task sees them.  The repaired text streams through a sorted partition.  One conversation's
text passes one task there, row by row and in constant memory; who wants a digest of it in order cannot avoid that.

Order within a conversation: turn (nulls first), then role, then text.  Defined results: a null role or text is one space; an
empty role is no initial and cannot be kept; null conversation ids are one conversation; equal rows are duplicates; a conversation without rows has zeros, an empty
audit and an empty repair; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from parcela.llm.shared import read, stored

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
BLOCK = 16  # turns that are aligned together
NEVER = 1 << 60
START, AFTER_S, AFTER_U, AFTER_A = range(4)
BLANK = "[^\\x20\\x09-\\x0D]"
ENDED = "[.!?][\\x20\\x09-\\x0D]*\\z"

Table = dict[tuple[int, int], tuple[int, str]]


def _align(rows: tuple[tuple[str, int], ...], target: str, bound: int) -> tuple[int, str] | None:
    """Least cost, and the least audit of that cost, of turning the rows (initial, cost of deletion) into the target.

    The last edit uses up a row.  None if it costs more than the bound.
    """
    n, m = len(rows), len(target)
    cheapest = min((cost for _, cost in rows), default=DELETE)

    def surplus(d: int) -> int:
        return INSERT * d if d > 0 else -cheapest * d

    shifts = [d for d in range(-n, m + 1) if surplus(d) + surplus(m - n - d) <= bound]
    if not shifts:
        return None
    low, high = shifts[0], shifts[-1]
    table = [[NEVER] * (m + 2) for _ in range(n + 1)]
    table[n][m] = 0
    for i in range(n - 1, -1, -1):
        initial, deletion = rows[i]
        here, below = table[i], table[i + 1]
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            best = below[j] + deletion
            if j < m:
                if target[j] == initial:
                    best = min(best, below[j + 1])
                if target[j] != "s":
                    best = min(best, below[j + 1] + REROLE, here[j + 1] + INSERT)
            here[j] = best
    cost = table[0][0]
    if cost > bound or cost >= NEVER:
        return None
    audit, i, j = [], 0, 0
    while i < n:
        left = table[i][j]
        open_role = j < m and target[j] != "s"
        if left == table[i + 1][j] + rows[i][1]:
            audit.append("D")
            i += 1
        elif open_role and left == table[i][j + 1] + INSERT:
            audit.append("I")
            j += 1
        elif j < m and target[j] == rows[i][0] and left == table[i + 1][j + 1]:
            audit.append("K")
            i, j = i + 1, j + 1
        else:
            audit.append("R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


def _nearest(rows: tuple[tuple[str, int], ...], first: str, lengths: Iterator[int]) -> tuple[int, str] | None:
    """The best alignment over targets of the given lengths: ``first`` (a leading s, or nothing), then u and a in turn."""
    best = None
    for m in sorted(lengths, key=lambda m: abs(m - len(rows))):
        target = (first + "ua" * (m // 2 + 1))[:m] if first != "a" else ("au" * (m // 2 + 1))[:m]
        found = _align(rows, target, best[0] if best else NEVER - 1)
        if found and (best is None or found < best):
            best = found
    return best


@lru_cache(maxsize=1 << 14)
def _families(rows: tuple[tuple[str, int], ...], whole: bool) -> dict[tuple[str, str], tuple[int, str]]:
    """Best alignments by the first letter of the target and what its length is."""
    longest = 2 * len(rows)
    odd, even = range(1, longest + 1, 2), range(2, longest + 1, 2)
    wanted = {("u", "none"): ("", (0,)), ("u", "odd"): ("", odd), ("u", "even"): ("", even)}
    if any(initial == "s" for initial, _ in rows):
        wanted |= {("s", "one"): ("s", (1,)), ("s", "odd"): ("s", range(3, longest + 1, 2)), ("s", "even"): ("s", even)}
    if not whole:
        wanted |= {("a", "odd"): ("a", odd), ("a", "even"): ("a", even)}
    found = {key: _nearest(rows, first, lengths) for key, (first, lengths) in wanted.items()}
    return {key: best for key, best in found.items() if best}


#: (start, end) of the grammar's states for each family.
_MOVES = {
    ("u", "none"): [(q, q) for q in range(4)],
    ("u", "odd"): [(START, AFTER_U), (AFTER_S, AFTER_U), (AFTER_A, AFTER_U)],
    ("u", "even"): [(START, AFTER_A), (AFTER_S, AFTER_A), (AFTER_A, AFTER_A)],
    ("s", "one"): [(START, AFTER_S)], ("s", "even"): [(START, AFTER_U)], ("s", "odd"): [(START, AFTER_A)],
    ("a", "odd"): [(AFTER_U, AFTER_A)], ("a", "even"): [(AFTER_U, AFTER_U)],
}


def block_table(rows: list[tuple[str, str, int]], whole: bool = False) -> Table:
    """Table of rows (initial, kind, copies); kind is K, T (truncated) or F (has to go).  whole: only from the start."""
    free, gone, base = [], [0], 0
    for initial, kind, copies in rows:
        if kind == "F":
            gone[-1] += copies
            base += DELETE * copies
            continue
        base += TRUNCATED * (kind == "T")
        free.append((initial, DELETE - TRUNCATED * (kind == "T")))
        gone.append(copies - 1)  # further copies are duplicates
        base += DELETE * (copies - 1)
    out: Table = {}
    for family, (cost, audit) in _families(tuple(free), whole).items():
        woven, used = ["D" * gone[0]], 0
        for letter in audit:  # what has to go goes as soon as it comes: D is the least letter
            woven.append(letter)
            if letter != "I":
                used += 1
                woven.append("D" * gone[used])
        for move in _MOVES[family]:
            if not (whole and move[0]):
                out[move] = min(out.get(move, (NEVER, "")), (cost + base, "".join(woven)))
    return out


def chained(a: Table, b: Table) -> Table:
    out: Table = {}
    for (p, q), (cost, audit) in a.items():
        for (start, end), (more, rest) in b.items():
            if start == q and cost + more <= out.get((p, end), (NEVER, ""))[0]:
                out[p, end] = min(out.get((p, end), (NEVER, "")), (cost + more, audit + rest))
    return out


def finished(table: Table) -> tuple[int, str]:
    """Cost and audit of the whole conversation: what is still open is inserted."""
    ends = {START: 0, AFTER_S: 2, AFTER_U: 1, AFTER_A: 0}
    return min((table[START, q][0] + INSERT * k, table[START, q][1] + "I" * k) for q, k in ends.items() if (START, q) in table)


class Piece:
    """Consecutive rows of a conversation: their table, role initials at the ends and illegal neighbours."""

    def __init__(self, whole: bool):
        self.whole, self.first, self.last, self.illegal = whole, None, None, 0
        self.rows: list[tuple[str, str, int]] = []
        self.free = 0
        self.tables: list[tuple[int, Table]] = []  # sizes fall; equal sizes are chained, so audits are copied log n times

    def add(self, initial: str, kind: str, copies: int) -> None:
        if self.last is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        self.illegal += copies - 1
        self.rows.append((initial, kind, copies))
        self.free += kind != "F"
        if self.free == BLOCK or len(self.rows) == 64 * BLOCK:
            self._close()

    def _close(self) -> None:
        size, table = 1, block_table(self.rows, self.whole and not self.tables)
        self.rows, self.free = [], 0
        while self.tables and self.tables[-1][0] <= size:
            before, left = self.tables.pop()
            size, table = size + before, chained(left, table)
        self.tables.append((size, table))

    def table(self) -> Table:
        if self.rows or not self.tables:
            self._close()
        out = self.tables[0][1]
        for _, table in self.tables[1:]:
            out = chained(out, table)
        return out


def _coded(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, kind, initial): one row for all equal rows, kinds as in ``block_table``."""
    rows = rows.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    rows = stored(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = rows.groupBy("conv_id", "role", "text").agg(F.min(place).alias("first"))
    first = first.withColumnsRenamed({"conv_id": "f_conv", "role": "f_role", "text": "f_text"})
    met = rows.join(first, F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role"))
                    & (F.col("text") == F.col("f_text")))
    blank, again = ~F.col("text").rlike(BLANK), ~F.col("turn").eqNullSafe(F.col("first.turn"))
    truncated = ~F.col("text").rlike(ENDED)
    return met.select("conv_id", "turn", "role", "text", "copies", blank.alias("blank"), F.substring("role", 1, 1).alias("initial"),
                      F.when(blank | again, "F").when(truncated, "T").otherwise("K").alias("kind"))


def _audits(coded: DataFrame) -> DataFrame:
    """(conv_id, illegal, cost, audit) of every conversation with rows."""
    kind = coded.schema["conv_id"].dataType.simpleString()
    key = ["conv_id", "turn", "role", "text"]
    dealt = coded.repartitionByRange(*key).sortWithinPartitions(*key).select("conv_id", "initial", "kind", "copies")
    cell = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])

    def batch(pieces: list[tuple], ids: pa.DataType) -> pa.RecordBatch:
        done, ending = [], []
        for _, piece, edge in pieces:
            table = piece.table()
            done.append((None, None) if edge else finished(table))
            ending.append([{"start": p, "end": q, "cost": c, "audit": a} for (p, q), (c, a) in table.items()] if edge else None)
        part = TaskContext.get().partitionId()
        return pa.RecordBatch.from_arrays([
            pa.array([c for c, _, _ in pieces], ids), pa.array([part] * len(pieces), pa.int32()),
            pa.array([p.illegal for _, p, _ in pieces], pa.int64()), pa.array([p.first for _, p, _ in pieces], pa.string()),
            pa.array([p.last for _, p, _ in pieces], pa.string()), pa.array([c for c, _ in done], pa.int64()),
            pa.array([a for _, a in done], pa.string()), pa.array(ending, pa.list_(cell)),
        ], names=["conv_id", "part", "illegal", "first", "last", "cost", "audit", "cells"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first and the last conversation of a partition may go on beyond it: they leave as tables."""
        at, now, ids, edge, ready = object(), None, None, True, []
        for b in batches:
            ids = b.column(0).type
            for conv, rows in groupby(zip(*(c.to_pylist() for c in b.columns), strict=True), key=lambda r: r[0]):
                if conv != at:
                    if now is not None:
                        ready.append((at, now, edge))
                        edge = False
                        if len(ready) == 2048:
                            yield batch(ready, ids)
                            ready = []
                    at, now = conv, Piece(whole=now is not None)
                for _, initial, sort, copies in rows:
                    now.add(initial, sort, copies)
        if now is not None:
            yield batch([*ready, (at, now, True)], ids)

    cells = "cells array<struct<start:int,end:int,cost:long,audit:string>>"
    pieces = dealt.mapInArrow(
        align, f"conv_id {kind}, part int, illegal long, first string, last string, cost long, audit string, {cells}")
    pieces = stored(pieces, "pieces")

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        whole, illegal, last = None, 0, None
        for row in rows:
            own = {(c["start"], c["end"]): (c["cost"], c["audit"]) for c in row["cells"]}
            whole = own if whole is None else chained(whole, own)
            illegal += row["illegal"] + (last is not None and last + row["first"] not in ("su", "ua", "au"))
            last = row["last"]
        cost, audit = finished(whole)
        return pa.table({"conv_id": table.column("conv_id").slice(0, 1), "illegal": pa.array([illegal], pa.int64()),
                         "cost": pa.array([cost], pa.int64()), "audit": pa.array([audit], pa.string())})

    edges = pieces.where("cells IS NOT NULL").groupBy("conv_id")
    edges = edges.applyInArrow(join, f"conv_id {kind}, illegal long, cost long, audit string")
    return pieces.where("cells IS NULL").select("conv_id", "illegal", "cost", "audit").unionByName(edges)


def _repaired(coded: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of what the audits leave, in order within each partition."""
    kind = coded.schema["conv_id"].dataType.simpleString()
    rows = coded.select("conv_id", F.lit(1).alias("ord"), "turn", "role", "text", "copies")
    heads = audits.select("conv_id", F.lit(0).alias("ord"), F.lit(None).cast(coded.schema["turn"].dataType).alias("turn"),
                          F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"))
    order = ["conv_id", "ord", "turn", "role", "text"]
    names = ["conv_id", "place", "role", "text"]
    types = [to_arrow_type(coded.schema["conv_id"].dataType), pa.int64(), pa.string(), pa.string()]
    dealt = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions(*order)

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        conv, audit, at, end, place, lead = None, "", 0, 0, 0, 0
        names = ("conv_id", "ord", "role", "text", "copies")
        for key, is_turn, role, text, copies in (
                row for b in batches for row in zip(*(b.column(n).to_pylist() for n in names), strict=True)):
            if not is_turn:
                conv, audit, at, end, place = key, text, 0, len(text.rstrip("I")), 0
                lead = (len(audit) - audit.count("D")) % 2  # an odd length has a leading s
                continue
            for _ in range(copies):
                stop = at + 1
                while audit[stop - 1] == "I":
                    stop += 1
                for letter in audit[at:stop] if stop < end else audit[at:]:  # what is inserted behind the last turn as well
                    if letter != "D":
                        said = role if letter == "K" else ("user", "assistant")[(place - lead) % 2]
                        yield conv, place, said, "" if letter == "I" else text
                        place += 1
                at = stop

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = edited(batches)
        while some := list(islice(rows, 1024)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)], names=names)

    return dealt.mapInArrow(edit, f"conv_id {kind}, place long, role string, text string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Report and repaired turns of conversations (conv_id, turn, role, text).

    The report has conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation with rows;
    the turns have conv_id, place, role and text and keep their order within a partition.
    """
    coded = stored(_coded(rows), "coded-turns")
    audits = stored(_audits(coded), "audits")
    blank, kept = F.col("blank"), F.col("kind") != "F"

    def total(what: Column) -> Column:
        return F.coalesce(F.sum(what), F.lit(0)).cast("long")

    known = coded.groupBy("conv_id", "turn").agg(
        total(F.when(blank, F.col("copies"))).alias("blank"),
        total(F.when(~blank, F.col("copies") - kept.cast("long"))).alias("duplicate"),
        total(F.when(F.col("kind") == "T", 1)).alias("truncated"))
    faults = known.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    audits = audits.withColumnRenamed("conv_id", "audit_id")
    report = faults.join(audits, F.col("conv_id").eqNullSafe(F.col("audit_id"))).drop("audit_id")
    return report, _repaired(coded, audits.withColumnRenamed("audit_id", "conv_id"))


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha): SHA-256 of the lines role:text of repaired turns, in their order."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha, ids = None, None, None
        for b in batches:
            ids, out = b.column(0).type, []
            for key, place, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not place:
                    if sha is not None:
                        out.append((conv, sha.hexdigest()))
                    conv, sha = key, hashlib.sha256()
                sha.update((f"\n{role}:{text}" if place else f"{role}:{text}").encode())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], ids), pa.array([h for _, h in out], pa.string())],
                                             names=["conv_id", "sha"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], ids), pa.array([sha.hexdigest()])], names=["conv_id", "sha"])

    return turns.mapInArrow(digest, f"conv_id {kind}, sha string")


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with faults that depend on a hash of conversation and turn."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.crc32(key.cast("binary")) % 20
    rows = rows.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = rows.where("fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        copies.alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def op12_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    report, turns = repair(damaged(rows))
    every = rows.select("conv_id").distinct()
    report = report.withColumnRenamed("conv_id", "r_id")
    shas = digests(turns).withColumnRenamed("conv_id", "s_id")
    every = every.join(report, F.col("conv_id").eqNullSafe(F.col("r_id")), "left")
    every = every.join(shas, F.col("conv_id").eqNullSafe(F.col("s_id")), "left")
    return every.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS),
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def _sql() -> str:
    """The four states of the grammar carried row by row; a cell is the cost in eight digits, then the audit."""
    def add(cell: str, cost: str, letters: str) -> str:
        return f"lpad(CAST(CAST(substr({cell}, 1, 8) AS INTEGER) + {cost} AS VARCHAR), 8, '0') || substr({cell}, 9) || '{letters}'"

    into_u = [add(f"i{q}", "3 + t", "R") for q in (0, 1, 3)] + [f"CASE WHEN r.initial = 'u' THEN {add(f'i{q}', 't', 'K')} END" for q in (0, 1, 3)]
    into_a = [add("i2", "3 + t", "R"), f"CASE WHEN r.initial = 'a' THEN {add('i2', 't', 'K')} END"]
    into_s = f"CASE WHEN r.initial = 's' THEN {add('c0', 't', 'K')} END"
    gone = {q: add(f"c{q}", "4", "D") for q in range(4)}

    def state(q: int, *others: str) -> str:
        return f"CASE WHEN r.gone THEN {gone[q]} ELSE least({', '.join([gone[q], *others])}) END AS c{q}"

    insert_u = ", ".join(add(f"c{q}", "3", "I") for q in (0, 1, 3))
    return f"""
WITH RECURSIVE table256 AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [1, 1, 1, 1, 1, 1, 1, 1]),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc
), hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(list_prepend(4294967295,
      list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                     lambda x: CAST(ord(x) AS BIGINT))),
      lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS fault
  FROM conversations, table256
), d AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE fault <> 0
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, substr(role, 1, 1) AS initial,
         NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank FROM d
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM n
), r AS (
  SELECT *, blank OR again AS gone, NOT blank AND NOT again AND NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS cut,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM o
), steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '00000000' AS c0, CAST(NULL AS VARCHAR) AS c1, CAST(NULL AS VARCHAR) AS c2, CAST(NULL AS VARCHAR) AS c3
  FROM (SELECT DISTINCT conv_id FROM r)
  UNION ALL
  SELECT r.conv_id, r.i, {state(0)}, {state(1, into_s)}, {state(2, *into_u)}, {state(3, *into_a)}
  FROM (SELECT *, c0 AS i0, c1 AS i1, least(c2, {insert_u}) AS i2, least(c3, {add("c2", "3", "I")}) AS i3 FROM steps) s
  JOIN (SELECT *, CASE WHEN cut THEN 3 ELSE 0 END AS t FROM r) r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1
), best AS (
  SELECT conv_id, least(c0, c3, {add("c2", "3", "I")}, {add("c1", "6", "II")}) AS cell
  FROM steps QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), letters AS (
  SELECT conv_id, unnest(string_split(substr(cell, 9), '')) AS letter, generate_subscripts(string_split(substr(cell, 9), ''), 1) AS p
  FROM best WHERE length(cell) > 8
), placed AS (
  SELECT conv_id, letter, p, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER w AS i,
         sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER w AS j,
         sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) % 2 AS lead
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)
), said AS (
  SELECT x.conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN r.role WHEN (j - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END
         || ':' || CASE WHEN letter = 'I' THEN '' ELSE r.text END, chr(10) ORDER BY p)) AS sha
  FROM placed x LEFT JOIN r ON x.conv_id IS NOT DISTINCT FROM r.conv_id AND x.i = r.i WHERE letter <> 'D' GROUP BY x.conv_id
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE again AND NOT blank) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id
)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(CAST(substr(cell, 1, 8) AS INTEGER), 0) AS BIGINT) AS cost, coalesce(substr(cell, 9), '') AS audit,
       coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counted c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON a.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN said s ON a.conv_id IS NOT DISTINCT FROM s.conv_id
"""


OP12_SQL = _sql()
