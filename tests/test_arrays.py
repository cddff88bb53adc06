"""JSON arrays cut into small ranges, against the parser of the standard library."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import types as T

from parcela.sources.arrays import array_elements, effect, read_json_arrays

TEXTS = ["plain", "a, b", 'quo"te', "back\\slash", "\\", '\\"', "[x]", "{,}", "é, ü", "", ",", "],[", '",', "line\nend", "tab\t,"]


def _value(rnd, depth=0):
    kind = rnd.random()
    if depth < 3 and kind < 0.25:
        return [_value(rnd, depth + 1) for _ in range(rnd.randint(0, 4))]
    if depth < 3 and kind < 0.6:
        return {rnd.choice(TEXTS) + str(i): _value(rnd, depth + 1) for i in range(rnd.randint(0, 4))}
    return rnd.choice([rnd.choice(TEXTS), rnd.randint(-9, 99), 1.5, None, True])


@pytest.fixture()
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_elements_equal_the_parser(spark, tmp_path, small_ranges):
    rnd, want = random.Random(1), []
    for i, indent in enumerate([None, 2, 0, None]):
        values = [_value(rnd) for _ in range(150)] + ["x" * 3000, [1, {"y": ["z, " * 900]}]]
        want += values
        (tmp_path / f"f{i}.json").write_text(("﻿" if i == 3 else " \n") + json.dumps(values, indent=indent, ensure_ascii=i % 2 == 0) + "\n", encoding="utf-8")
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "one.json").write_text('[ {"a": "b, c"} ]')
    want.append({"a": "b, c"})
    elements, files = array_elements(spark, str(tmp_path))
    rows = elements.collect()
    key = lambda v: json.dumps(v, sort_keys=True)
    assert sorted(key(json.loads(r["text"])) for r in rows) == sorted(map(key, want))
    assert all(r["lisible"] for r in files.collect()) and files.agg({"tranches": "max"}).first()[0] > 10


def test_broken_files_are_set_apart(spark, tmp_path, small_ranges):
    good = [{"reference": f"R{i}", "prix": i} for i in range(80)]
    (tmp_path / "good.json").write_text(json.dumps([*good, {"reference": ["no"], "prix": "text"}]))
    for name, text in {"cut": json.dumps(good)[:-30], "open": '[{"a": "b}]', "object": '{"a": 1}', "deep": "[[1]"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    schema = T.StructType([T.StructField("reference", T.StringType()), T.StructField("prix", T.LongType())])
    rows, files = read_json_arrays(spark, str(tmp_path), schema)
    state = {r["file"].rsplit("/", 1)[1]: r["lisible"] for r in files.collect()}
    assert state == {"good.json": True, "cut.json": False, "open.json": False, "object.json": False, "deep.json": False}
    found = rows.collect()
    assert sorted(r["reference"] for r in found if r["_corrupt_record"] is None) == sorted(g["reference"] for g in good)
    assert sum(r["_corrupt_record"] is not None for r in found) == 1


def test_effects_of_pieces():
    assert effect('{"a": "b', False) == (True, 1) and effect('c"}', True) == (False, -1)
    assert effect('x\\" y', True) == (True, 0) and effect('"[{"', False) == (False, 0) and effect("[[{]", False) == (False, 2)


def test_written_arrays_hold_every_row(spark, tmp_path):
    from parcela.sources.files import write_json_arrays

    rows = [(None if i % 9 == 0 else f"R{i % 40}", TEXTS[i % len(TEXTS)]) for i in range(300)]
    df = spark.createDataFrame(rows, "reference string, titre string").repartition(4)
    path = write_json_arrays(df, str(tmp_path / "out"), "reference", 5)
    written = [p for p in (tmp_path / "out").rglob("*.txt") if p.stat().st_size]
    assert len(written) <= 5 and sum(len(json.loads(p.read_text(encoding="utf-8"))) for p in written) == 300
    found, state = read_json_arrays(spark, path, df.schema)
    assert sorted(map(str, (tuple(r)[:2] for r in found.collect()))) == sorted(map(str, rows))
    assert state.where("NOT lisible").count() == 0


@pytest.mark.parametrize("border", [",", "},", "}},"])
def test_elements_are_the_same_with_any_border(spark, tmp_path, small_ranges, border):
    """Objects, nested ones, scalars and texts that hold the border, quotes and runs of backslashes, in many ranges."""
    rnd, want = random.Random(2), []
    texts = [*TEXTS, "},", "}", '"},', "\\},", '\\\\"', "a\\" * 5, "},{", "é},ü"]
    for i, indent in enumerate([None, 1]):
        values = [{"t": rnd.choice(texts), "n": [{"u": rnd.choice(texts)}, rnd.choice(texts)], "z": i} for _ in range(200)]
        values[20:20] = [{}, [], "x},", 5, None, ["},"], "y" * 2500, {"k": {"l": {}}}]
        want += values
        (tmp_path / f"f{i}.json").write_text(json.dumps(values, indent=indent, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "broken.json").write_text(json.dumps(want)[:-9])
    (tmp_path / "slash.json").write_text('[{"a": 1}, \\"]')
    elements, files = array_elements(spark, str(tmp_path), border)
    key = lambda v: json.dumps(v, sort_keys=True)
    assert sorted(key(json.loads(r["text"])) for r in elements.collect()) == sorted(map(key, want))
    state = {r["file"].rsplit("/", 1)[1]: r["lisible"] for r in files.collect()}
    assert state == {"f0.json": True, "f1.json": True, "broken.json": False, "slash.json": False}


def test_arrays_are_cut_and_parsed_once(spark, tmp_path):
    """Readable rows and rejects come from stored rows, not from the files again."""
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": "x"}, {"a": 3}]')
    rows, _ = read_json_arrays(spark, str(tmp_path), T.StructType([T.StructField("a", T.LongType())]))
    plan = rows._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "from_json" not in plan
    assert sorted(r["a"] for r in rows.where("_corrupt_record IS NULL").collect()) == [1, 3]
    assert rows.where("_corrupt_record IS NOT NULL").count() == 1


@pytest.mark.parametrize("border", [",", "},"])
def test_arrays_one_after_the_other(spark, tmp_path, small_ranges, border):
    """Their brackets are not part of any element, wherever the ranges end."""
    want = [[{"a": i, "t": "x" * (i % 60)} for i in range(n)] for n in range(60)]
    (tmp_path / "many.json").write_text(",".join(json.dumps(v) for v in want))
    elements, files = array_elements(spark, str(tmp_path), border)
    found = [json.loads(r["text"]) for r in elements.collect()]
    assert sorted(map(str, found)) == sorted(str(x) for v in want for x in v)
    assert files.first()["lisible"] and files.first()["tranches"] > 10
