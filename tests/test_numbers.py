from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcela.functions import numbers as num

NN, NB = "\u202f", "\u00a0"


def test_normalise_price(values):
    items = [f"380{NN}000{NB}€", "12,5", "", None, f"9{NN}744{NB}€ / m²", "1 000", " 7 ", "12d", "5.", "abc"]
    assert values(num.normalise_price, items) == [380000.0, 12.5, None, None, None, None, 7.0, None, 5.0, None]


def test_clean_price(values):
    items = [f"380{NN}000{NB}€", "1 000,5 €", "", None, "12.5.1", "0", f"9{NN}744{NB}€ / m²"]
    assert values(num.clean_price, items) == [380000.0, 1000.5, None, None, None, 0.0, None]


def test_sql_prices(values):
    items = [f"1{NN}200 €", "12,5", "", None, "12.345"]
    assert values(num.price_to_decimal, items) == [Decimal("1200.00"), None, None, None, Decimal("12.35")]
    assert values(num.price_digits, items) == [Decimal(1200), Decimal(125), None, None, Decimal(12345)]


def test_numbers_and_years(values):
    assert values(num.normalise_number, ["39", f"1{NN}200.5", "39,5", "", None]) == [39.0, 1200.5, None, None, None]
    assert values(num.extract_first_int, ["3 pièces", "x12y7", "", None]) == [3, 12, None, None]
    assert values(num.extract_surface, ["39,5 m²", "0", "terrain 120", "", None]) == [39.5, None, 120.0, None, None]
    assert values(lambda c: num.extract_year(c, 2025), ["vers 1900", "2030", "1850", "", None]) == [1900, None, None, None, None]


def test_classes_and_booleans(values):
    assert values(num.extract_energy_class, ["Classe F", "b", "", None, "xyz"]) == ["C", "B", None, None, None]
    assert values(num.energy_score, ["A", "G", "H", "", None]) == [10, 2, 0, 0, 0]
    items = ["true", " Oui ", "VRAI", "t", "non", "", None, "2"]
    assert values(num.normalise_boolean, items) == [True, True, True, True, False, False, False, False]
    assert values(num.extract_boolean, items) == [True, False, True, False, False, False, False, False]
    assert values(num.number_to_boolean, [0, 2, None], "int") == [False, True, False]


def test_timestamps(values):
    items = ["2025-11-12T18:31:55.197754Z", "2025-11-12", "hier", "2025", "", None, "2025-11-12T18:31:55+01:00"]
    out = values(num.parse_iso_timestamp, items)
    assert out[0] == dt.datetime(2025, 11, 12, 18, 31, 55, 197754)
    assert out[1] == dt.datetime(2025, 11, 12)
    assert out[2:6] == [None] * 4
    assert out[6] == dt.datetime(2025, 11, 12, 17, 31, 55)
    filled = values(lambda c: num.parse_extraction_date(c, "2025-01-02T03:04:05"), ["hier"])
    assert filled == [dt.datetime(2025, 1, 2, 3, 4, 5)]


@pytest.mark.parametrize("digits", [1, 2])
def test_python_round_matches_the_language(values, digits):
    items = [20.005, 2.675, 1.005, 0.125, 0.375, -2.675, -0.125, 0.0, 12.5, 1e9 + 0.5, 9743.589743589744]
    assert values(lambda c: num.python_round(c, digits), items, "double") == [round(x, digits) for x in items]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 10**8), st.integers(1, 500)), min_size=50, max_size=200))
def test_python_round_on_quotients(spark, pairs):
    items = [a / 100 / b for a, b in pairs]
    items = [x for x in items if x >= 1 / 16]
    df = spark.createDataFrame([(x,) for x in items], "x double")
    got = [r[0] for r in df.select(num.python_round(F.col("x"))).collect()]
    assert got == [round(x, 2) for x in items]


def test_price_per_m2_variants(spark):
    df = spark.createDataFrame(
        [(380000.0, 39.0, None), (100.0, 0.0, 12.0), (0.0, 10.0, 0.0), (None, 10.0, None)],
        "p double, s double, g double",
    )
    p, s, g = (F.col(c) for c in "psg")
    rows = df.select(num.price_per_m2(p, s), num.price_per_m2_or_given(g, p, s)).collect()
    assert [tuple(r) for r in rows] == [(9743.59, 9743.59), (None, 12.0), (None, 0.0), (None, None)]
    exact = spark.sql("SELECT cast(1000.25 AS decimal(12,2)) p, cast(50 AS decimal(8,2)) s")
    assert exact.select(num.price_per_m2_decimal(p, s)).first()[0] == Decimal("20.01")


def test_small_helpers(values, spark):
    assert values(num.digits_to_int, ["1900", "vers 1900", "", None]) == [1900, None, None, None]
    assert values(lambda c: num.building_age(c, 2025), ["1900", ""]) == [125, None]
    assert values(num.truncate_localisation, ["Paris (75019)", "Ag", None]) == ["Par***", "Ag***", None]
    df = spark.createDataFrame([(2, 3.0), (0, 3.0), (None, 3.0), (None, 0.0), (None, None)], "c int, p double")
    out = [r[0] for r in df.select(num.bedrooms_or_fallback(F.col("c"), F.col("p"))).collect()]
    assert out == [2.0, 2.0, 2.0, None, None]
    box = spark.range(1).select(num.exterior_surface(F.lit(10), F.lit(20), F.lit(30))).first()[0]
    assert box == Decimal("2200.00")


def test_double_to_decimal(values):
    items = [68423.46, 0.07, -12.5, 0.0, 499978.59, 1e9 + 0.01, None]
    got = values(lambda c: num.double_to_decimal(c, 14, 2), items, "double")
    assert got == [None if x is None else Decimal(f"{x:.2f}") for x in items]
