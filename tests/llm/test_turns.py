"""Conversation repair against a search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from parcela.llm import turns
from parcela.llm.turns import OP12_SQL, Piece, digests, finished, op12_turns, repair

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
SPACE = " \t\n\v\f\r"


def cheapest(rows):
    """Least (cost, audit) by trying every edit: states are the strings of role initials modulo their length."""
    best = {"": (0, "")}
    for initial, kind in [*rows, (None, None)]:
        grown = dict(best)
        for _ in range(3):
            for said, (cost, audit) in list(grown.items()):
                for letter in "ua":
                    if fits := short(said + letter):
                        grown[fits] = min(grown.get(fits, (10**9, "")), (cost + 3, audit + "I"))
        if initial is None:
            best = grown
            break
        after = {}
        for said, (cost, audit) in grown.items():
            moves = [(said, 4, "D")]
            if kind != "F":
                more = 3 * (kind == "T")
                moves += [(short(said + initial) if initial else None, more, "K"), *((short(said + x), 3 + more, "R") for x in "ua")]
            for to, extra, letter in moves:
                if to is not None:
                    after[to] = min(after.get(to, (10**9, "")), (cost + extra, audit + letter))
        best = after
    return min(v for k, v in best.items() if GRAMMAR.match(k))


def short(said):
    """The string if it may begin one of the grammar, else None; long ones stand for all that go on alike."""
    if not re.match(r"s?(ua)*u?\Z", said):
        return None
    return said if len(said) < 4 else short(said[:-2])


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault:
            row = (conv, turn, "user" if fault == 4 else role, "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text)
            out += [row] * (2 if fault == 3 else 1)
    return out


def expected(rows):
    out = {}
    left = damage(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, kinds, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, text in own:
            fault = ("blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen
                     else "truncated" if text.rstrip(SPACE)[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                count[fault] += 1
            kinds.append((role[:1], {"truncated": "T", None: "K"}.get(fault, "F")))
        cost, audit = cheapest(kinds) if own else (0, "")
        said, i = [], 0
        lead = sum(x != "D" for x in audit) % 2
        for letter in audit:
            role = ("user", "assistant")[(len(said) - lead) % 2]
            if letter == "I":
                said.append(f"{role}:")
                continue
            if letter != "D":
                said.append(f"{own[i][2] if letter == 'K' else role}:{own[i][3]}")
            i += 1
        at = [r[1] for r in own if r[1] is not None]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:], strict=False))
        out[conv] = (max(at) - min(at) + 1 - len(set(at)) if at else 0, *count.values(), illegal, cost, audit,
                     hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def random_rows(rnd, convs=60, longest=9):
    rows = []
    for conv in [*range(convs), None, -5]:
        turn = rnd.randint(0, 3)
        for i in range(rnd.randint(1, longest)):
            role = rnd.choice(["system"] * (2 if not i else 0) + ["user", "assistant"] * 5 + ["tool", "", None])
            if rnd.random() < 0.6:
                role = ("user", "assistant")[i % 2]
            text = rnd.choice(["Yes.", "What?", "cut off", " \t", "", None, "é ü.", "No! \n", f"line {rnd.random()}.", f"then {rnd.random()}", "a "])
            rows.append((conv, None if rnd.random() < 0.05 else turn, role, text))
            turn += rnd.choice([0, 1, 1, 1, 1, 2])
    return rows


def answer(frame):
    return {r["conv_id"]: tuple(r[c] for c in (*turns.COUNTS, "audit", "repaired_sha256")) for r in frame.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_brute_force_and_sql(spark, tmp_path, seed):
    rnd = random.Random(seed)
    rows = random_rows(rnd)
    rows += [(900, i, ("user", "assistant")[i % 2 if rnd.random() < 0.9 else 0], f"t {i}{rnd.choice('..,')}") for i in range(400)]
    rows += [(901, 3, "user", "again.")] * 70 + [(902, 1, "user", "x" * 3_000_000 + "."), (902, 2, "assistant", "ok.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    if seed == 2:
        frame = frame.select("*", *(F.lit("x").alias(n) for n in ("copies", "kind", "fault", "first", "ord")))
    frame.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    want = expected(rows)
    got = op12_turns(spark, str(tmp_path))
    assert answer(got) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    sql = con.sql(OP12_SQL)
    assert {r[0]: r[1:] for r in sql.fetchall()} == want and sql.columns == got.columns


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert op12_turns(spark, str(tmp_path)).collect() == []


def test_alignment_equals_all_edits():
    rnd = random.Random(7)
    for n in [*range(8), 15, 16, 17, 33, 70] * 12:
        rows = [(rnd.choice("uuuaaast"), rnd.choice("KKKKTTF")) for _ in range(n)]
        piece = Piece(whole=rnd.random() < 0.5)
        for initial, kind in rows:
            piece.add(initial, kind, 1)
        assert finished(piece.table()) == cheapest(rows)


def test_one_conversation_over_many_partitions(spark):
    """A conversation of thousands of turns is cut by the ranges and gives what one piece gives."""
    rnd = random.Random(9)
    rows = [(1, i, ("user", "assistant")[i % 2 if rnd.random() < 0.95 else rnd.randint(0, 1)], f"text {i}{rnd.choice('....,')}") for i in range(6000)]
    frame = spark.createDataFrame([*rows, (2, 0, "user", "Hi."), (2, 1, "assistant", "Hi.")], "conv_id long, turn long, role string, text string")
    report, said = repair(frame)
    piece = Piece(whole=True)
    for _, _, role, text in rows:
        piece.add(role[0], "K" if text.endswith(".") else "T", 1)
    cost, audit = finished(piece.table())
    got = {r["conv_id"]: r for r in report.collect()}
    assert (got[1]["cost"], got[1]["audit"], got[1]["illegal"]) == (cost, audit, piece.illegal) and got[2]["audit"] == "KK"
    assert said.where("conv_id = 1").count() == len(audit) - audit.count("D")
    lines = [f"{r['role']}:{r['text']}" for r in said.where("conv_id = 1").orderBy("place").collect()]
    assert digests(said).where("conv_id = 1").first()["sha"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
