"""Stored tables: versions, purges and erasure, read back from the files."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcela.sources.storage import Folder
from parcela.sources.versions import StoredTable, month_of, purge_before, purge_children, rewrite_subjects


def _rows(spark, n=120):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, f"p{i % 7}", t0 + dt.timedelta(days=i)) for i in range(n)] + [(900, "p3", None), (901, None, t0)]
    return spark.createDataFrame(rows, "id long, nom string, le timestamp").repartition(3)


@pytest.fixture()
def table(spark, tmp_path):
    t = StoredTable(spark, str(tmp_path / "t"), ["nom"])
    t.append(_rows(spark), month_of("le"))
    return t


def _ids(frame):
    return sorted(r["id"] for r in frame.collect())


def test_append_and_versions(spark, table):
    assert table.version == 1 and _ids(table.read()) == [*range(120), 900, 901]
    table.append(_rows(spark, 2), month_of("le"), notes=["x"])
    assert table.version == 2 and table.notes() == {"x"} and table.read().count() == 122 + 4
    again = StoredTable(spark, table.path, ["nom"])
    assert again.schema == table.schema and again.files() == table.files()


def test_purge_keeps_untouched_files_and_reads_back(spark, table):
    before = set(table.files())
    row = purge_before(table, "le", "2024-02-15T12:00:00").first()
    left = [*range(46, 120), 900]  # day 45 is the fifteenth of February at midnight
    assert _ids(table.read()) == left and row["avant"] == 122 and row["apres"] == len(left)
    on_disk = set(Folder(spark, f"{table.path}/data").files())
    assert on_disk == set(table.files())  # the old rows are gone from storage
    kept = {f for f in before if "/_part=2024-0" in f and f.split("/_part=")[1][:7] > "2024-02"}
    assert kept and kept <= on_disk
    assert spark.read.option("recursiveFileLookup", "true").schema(table.schema).parquet(f"{table.path}/data").count() == len(left)
    assert purge_before(table, "le", "2024-02-15T12:00:00").first()["supprimes"] == 0


def test_interrupted_runs_leave_the_old_state(spark, table, monkeypatch):
    monkeypatch.setattr(StoredTable, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        purge_before(table, "le", "2024-02-15")
    monkeypatch.undo()
    assert table.version == 1 and table.read().count() == 122
    assert len(Folder(spark, f"{table.path}/data").files()) > len(table.files())  # a stage without a version
    assert table.vacuum() > 0 and table.read().count() == 122


def test_two_writers_of_one_version(table):
    table.commit(1, notes=["a"])
    with pytest.raises(RuntimeError):
        table.commit(1, notes=["b"])
    assert table.notes() == {"a"}


def test_children_leave_with_their_parents(spark, table, tmp_path):
    children = _rows(spark).select("id", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("valeur"), "le")
    child = StoredTable(spark, str(tmp_path / "c"))
    child.append(children.drop("le"), month_of(F.lit("2024-01-01").cast("date")))
    by_month = StoredTable(spark, str(tmp_path / "m"))
    by_month.append(children, month_of("le"))
    purge_before(table, "le", "2024-02-15")
    purge_children(by_month, "id", table.read(), "2024-02-15")
    assert set(_ids(by_month.read())) == set(_ids(table.read()))


def test_erasure_writes_only_files_that_hold_the_subject(spark, table):
    late = spark.createDataFrame([(500, "solo", dt.datetime(2024, 3, 3))], "id long, nom string, le timestamp")
    table.append(late, month_of("le"))
    before = set(table.files())
    asked = spark.createDataFrame([("solo",), ("nobody",), (None,)], "nom string")
    written, left, gone = rewrite_subjects(table, asked, "nom", lambda rows: rows.join(asked, "nom", "left_anti").select(*rows.columns))
    assert (written, left, gone) == (1, len(before) - 1, 1)
    assert _ids(table.read()) == [*range(120), 900, 901]
    assert len(before & set(table.files())) == len(before) - 1
    assert len(Folder(spark, f"{table.path}/data").files()) == len(table.files())
    index = spark.read.option("recursiveFileLookup", "true").parquet(f"{table.path}/_subjects/nom")
    assert index.where(F.col("h") == F.xxhash64(F.lit("solo"))).count() == 0
    # rows of a null part and a null name are reachable by others and stay
    one = spark.createDataFrame([("p3",)], "nom string")
    rewrite_subjects(table, one, "nom", lambda rows: rows.join(one, "nom", "left_anti").select(*rows.columns))
    assert table.read().where("nom = 'p3'").count() == 0 and 901 in _ids(table.read())
