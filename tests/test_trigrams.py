"""Indexed text search against a scan."""

from __future__ import annotations

import pytest

from parcela.plans.search import text_search
from parcela.plans.trigrams import candidate_blocks, indexed_search, write_index

WORDS = "Maison Appartement été forêt LYON Paris balcon Étage 100% a_b vue-mer parking".split()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = [(i, f"{WORDS[i % 12]} {WORDS[i * 7 % 11]}", None if i % 5 == 0 else f"desc {WORDS[i % 9]} n{i}", WORDS[i * 3 % 12] if i % 4 else "") for i in range(3000)]
    rows.append((3500, "Unique phrase ici", "", None))
    df = spark.createDataFrame(rows, "id_annonce long, titre string, description string, localisation string").repartition(5)
    path = str(tmp_path_factory.mktemp("index"))
    write_index(df, path, rows=64)
    return df, path


@pytest.mark.parametrize("text", ["maison", "ÉTAGE", "lyon", "unique phrase", "forêt n1", "n12", "ab", "", "0%", "a_b", "vue%mer", "nowhere", "s P"])
def test_search_equals_the_scan(spark, stored, text):
    df, path = stored
    want = [tuple(r) for r in text_search(df, text).collect()]
    assert [tuple(r) for r in indexed_search(spark, path, text, first=2).collect()] == want


def test_only_candidate_blocks_are_read(spark, stored):
    _, path = stored
    assert [r["bloc"] for r in candidate_blocks(spark, path, "unique phrase").collect()] == [3500 // 64]
    assert candidate_blocks(spark, path, "nowhere").count() == 0 and candidate_blocks(spark, path, "ab") is None
    plan = indexed_search(spark, path, "unique phrase")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "bloc" in plan.split("PushedFilters")[1].split("]")[0]


def test_grams_of_a_block_are_those_of_its_texts(spark):
    import pyarrow as pa

    from parcela.plans.trigrams import _grams

    texts = ["maison", "a\nbc", "é", "", None, "\U0001f3e0xy", "mai", "maison"]
    batch = pa.RecordBatch.from_pydict({"bloc": pa.array([1, 1, 1, 1, 2, 2, 2, 2], pa.int64()), "titre": texts})
    found = [(r["gram"], r["bloc"]) for b in _grams(iter([batch])) for r in b.to_pylist()]
    want = {(t[i:i + 3], 1 + n // 4) for n, t in enumerate(texts) if t for i in range(len(t) - 2)}
    assert set(found) == want and len(found) == len(want)
