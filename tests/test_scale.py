"""Operators on data where one key holds a large part of the rows, against brute force."""

from __future__ import annotations

import datetime as dt
import random
import re
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from parcela.operators import load, market
from parcela.operators.quantiles import exact_quantiles
from parcela.plans import commerce, views
from parcela.streaming import events

random.seed(7)


def _quantile(items, p):
    items = sorted(items)
    pos = (len(items) - 1) * p
    low, high = items[int(pos)], items[min(int(pos) + 1, len(items) - 1)]
    return low + (high - low) * (pos - int(pos))


@pytest.mark.parametrize("width", [0.5, 10.0, 1000.0])
def test_quantiles_per_group(spark, width):
    rows = [("hot", random.choice([5.0, 7.25, -3.0, 900.0])) for _ in range(3000)]
    rows += [(random.choice("abc"), random.uniform(-50, 500)) for _ in range(2000)]
    rows += [(None, 1.0), (None, 2.0), ("a", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    groups = defaultdict(list)
    for g, v in rows:
        if v is not None:
            groups[g].append(v)
    got = {r["g"]: (r["m"], r["q"]) for r in exact_quantiles(df, "v", {"m": 0.5, "q": 0.9}, ["g"], width).collect()}
    assert set(got) == set(groups)
    for g, items in groups.items():
        assert got[g][0] == pytest.approx(statistics.median(items), abs=1e-12)
        assert got[g][1] == pytest.approx(_quantile(items, 0.9), abs=1e-12)


def test_global_quantiles_and_empty(spark):
    items = [random.choice([1.0, 1.0, 1.0, 2.5, 8.0, 13.75]) for _ in range(999)]
    df = spark.createDataFrame([(v,) for v in items], "v double")
    row = exact_quantiles(df, "v", {"a": 0.1, "m": 0.5, "z": 1.0}).first()
    assert (row["a"], row["m"], row["z"]) == (_quantile(items, 0.1), statistics.median(items), max(items))
    empty = exact_quantiles(df.filter("v > 100"), "v", {"m": 0.5}).collect()
    assert [r["m"] for r in empty] in ([], [None])


def test_quantiles_by_the_tree_over_a_wide_range(spark):
    """Many distinct values of all sizes and signs, from buckets that differ by orders of magnitude."""
    items = [random.choice([-1, 1]) * 10 ** random.uniform(-9, 12) for _ in range(3000)] + [0.0] * 40 + [5000 + i * 1e-7 for i in range(900)]
    df = spark.createDataFrame([(v,) for v in items], "v double").repartition(6)
    row = exact_quantiles(df, "v", {"a": 0.1, "m": 0.5, "b": 0.7, "z": 0.999}).first()
    for name, p in (("a", 0.1), ("m", 0.5), ("b", 0.7), ("z", 0.999)):
        assert row[name] == pytest.approx(_quantile(items, p), rel=1e-12)
    got = sorted((r["v"], r["rang_exact"]) for r in market.percentile_rank_exact(df, "v").collect())
    values = sorted(items)
    first = {v: i for i, v in reversed(list(enumerate(values)))}
    assert got == [(v, pytest.approx(first[v] / (len(values) - 1) * 100)) for v in values]


def _listings(spark, rows):
    return spark.createDataFrame(rows, "p double, s double, c string").select(
        F.struct(F.col("p").alias("valeur")).alias("prix"), F.struct(F.col("s").alias("valeur")).alias("surface"),
        F.struct(F.col("c").alias("code_postal")).alias("localisation"))


def test_market_statistics_of_batches_stand_together(spark):
    rows = [(random.choice([None, 0.0, random.uniform(5e4, 9e6)]) if i % 9 == 0 else random.lognormvariate(12, 0.8),
             random.choice([None, random.uniform(9, 300)]) if i % 7 == 0 else float(random.randint(9, 200)),
             random.choice(["75001", "75002", None, "92100"])) for i in range(4000)]
    whole = _listings(spark, rows)
    parts = [market.market_partials(_listings(spark, rows[i::3])) for i in range(3)]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    m2 = [p / s for p, s, _ in rows if p and s]
    values = spark.createDataFrame([(v,) for v in m2], "m2 double")
    one, merged = market.market_stats(whole).first().asDict(), market.stats_of_partials(together, values).first().asDict()
    assert one == merged
    assert one["nombre_biens_analyses"] == len(m2) and one["prix_m2_median"] == round(statistics.median(m2), 2)
    assert one["ecart_type_prix_m2"] == pytest.approx(statistics.pstdev(m2), abs=0.006)
    assert one["arrondissements_uniques"] == ["75001", "75002", "92100"]
    nothing = market.market_stats(whole.limit(0)).first()
    assert nothing["nombre_biens_analyses"] == 0 and nothing["prix_m2_median"] is None


def test_market_statistics_scan_the_listings_twice(spark, tmp_path):
    """Once for the partials, once for the values of the median's bucket."""
    path = str(tmp_path / "silver")
    _listings(spark, [(float(i), 10.0, "75001") for i in range(100)]).write.parquet(path)
    stats = market.market_stats(spark.read.parquet(path))
    stats.collect()
    plan = stats._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    ran = "".join(re.findall("== Final Plan ==(.*?)== Initial Plan ==", plan, re.DOTALL))
    scans = {line.split("FileScan")[1] for line in ran.splitlines() if "FileScan" in line and "noeud" not in line and "surface" in line}
    assert len(scans) == 1


def test_exact_rank_with_a_hot_value(spark):
    items = [10.0] * 500 + [random.uniform(0, 30) for _ in range(700)] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, v double")
    got = {r["i"]: r["rang_exact"] for r in market.percentile_rank_exact(df, "v").collect()}
    known = sorted(v for v in items if v is not None)
    for i, v in enumerate(items):
        if v is None:
            assert got[i] is None
        else:
            smaller = sum(1 for x in known if x < v)
            assert got[i] == pytest.approx(smaller / (len(known) - 1) * 100)


def test_sessions_with_a_hot_key(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("hot", start + dt.timedelta(seconds=random.randint(0, 86400))) for _ in range(3000)]
    rows += [(random.choice("ab"), start + dt.timedelta(seconds=random.randint(0, 864000))) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, ts timestamp")
    got = sorted((r["k"], r["debut"], r["fin"], r["nombre"]) for r in events.session_counts(df, "ts", "k").collect())
    gap = dt.timedelta(minutes=30)
    expected = []
    for key in {k for k, _ in rows}:
        times = sorted(t for k, t in rows if k == key)
        first = last = times[0]
        n = 1
        for t in times[1:]:
            if t - last < gap:
                last, n = t, n + 1
            else:
                expected.append((key, first, last + gap, n))
                first, last, n = t, t, 1
        expected.append((key, first, last + gap, n))
    assert got == sorted(expected)


def test_load_with_a_hot_reference(spark):
    rows = [("R1", 1, "x")] * 300 + [(f"R{i}", i, "y") for i in range(2, 200)] + [("  ", 0, "z"), (None, 0, "z")]
    rows += [(" R5 ", 5, "late")]
    batch = spark.createDataFrame(rows, "reference string, n int, t string")
    target = batch.filter("n BETWEEN 100 AND 120")
    counts = {r["statut"]: r["nombre"] for r in load.load_counts(target, batch).collect()}
    assert sum(counts.values()) == len(rows)
    assert counts["error"] == 2
    fresh = load.new_rows(target, batch)
    assert counts["inserted"] == fresh.count() == 199 - 21
    assert load.new_rows(target.unionByName(fresh), batch).count() == 0


def test_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("R1", 1), ("R1", 1), ("R2", 2), ("", 3)], "reference string, n int")
    batch.limit(0).write.parquet(path)
    first = {r["statut"]: r["nombre"] for r in load.upsert_new_by_key(path, batch).collect()}
    again = {r["statut"]: r["nombre"] for r in load.upsert_new_by_key(path, batch).collect()}
    assert first == {"inserted": 2, "skipped": 1, "error": 1}
    assert again == {"inserted": 0, "skipped": 3, "error": 1}
    assert spark.read.parquet(path).count() == 2


def test_features_with_a_hot_listing(spark):
    rows = [(1, random.choice(["a", "b"])) for _ in range(1000)] + [(2, "c"), (2, "a")]
    t = {
        "annonces": spark.createDataFrame([(1, "R1", "t", 1.0, "x"), (2, "R2", "t", 1.0, "y"), (3, "R3", "t", 1.0, "y")],
                                          "id_annonce int, reference string, titre string, prix double, type_bien string"),
        "caracteristiques": spark.createDataFrame(rows, "id_annonce int, valeur string"),
    }
    texts = {r["id_annonce"]: r["caracteristiques"] for r in views.annonces_caracteristiques(t).collect()}
    assert texts[1] == ", ".join(sorted(v for k, v in rows if k == 1))
    assert texts[2] == "a, c"
    assert texts[3] is None
    counts = {(r["type_bien"], r["caracteristique"]): r["frequence"] for r in views.caracteristiques_par_type(t).collect()}
    expected = Counter(("x" if k == 1 else "y", v) for k, v in rows)
    assert counts == dict(expected)
    popular = views.stats_caracteristiques_populaires(t).filter("caracteristique = 'c'").first()
    assert (popular["frequence"], popular["pourcentage"]) == (1, 50.0)


def test_distinct_orders_per_material(spark):
    lines = [(1, i % 3, 1.0, 10.0, 0.1) for i in range(900)] + [(2, 0, 2.0, 5.0, 0.0), (3, 1, 1.0, 1.0, 0.0)]
    t = {
        "lignes_commande": spark.createDataFrame(lines, "id_commande int, id_boite int, quantite double, prix_unitaire double, taux_remise double"),
        "commandes": spark.createDataFrame([(1,), (2,)], "id_commande int"),  # order 3 is unknown
        "boites": spark.createDataFrame([(0, "m"), (1, "m"), (2, "n")], "id_boite int, id_matiere string"),
        "matieres": spark.createDataFrame([("m", "bois"), ("n", "fer")], "id_matiere string, nom_matiere string"),
    }
    got = {r["nom_matiere"]: (r["nombre_commandes"], r["chiffre_affaires"]) for r in commerce.chiffre_affaires_par_matiere(t).collect()}
    assert got == {"bois": (2, 600 * 9.0 + 10.0), "fer": (1, 300 * 9.0)}


def test_first_row_per_key(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot", t0 + dt.timedelta(minutes=i), i) for i in range(500)] + [("b", t0, 1)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v int").repartition(7)
    got = {r["k"]: r["v"] for r in events.first_per_key(df, "k", "ts").collect()}
    assert got == {"hot": 0, "b": 1}


def test_mean_rounded_is_exact_on_ties(spark):
    from parcela.functions.aggregates import mean_rounded, share_of

    df = spark.sql("SELECT * FROM VALUES (1, 0.01), (1, 0.02), (2, -0.01), (2, -0.02), (3, NULL) AS t(g, v)")
    got = {r["g"]: r["m"] for r in df.groupBy("g").agg(mean_rounded(F.col("v")).alias("m")).collect()}
    assert got == {1: 0.02, 2: -0.02, 3: None}
    one = spark.range(1).select(share_of(F.lit(1), F.lit(8)), share_of(F.lit(1), F.lit(0))).first()
    assert tuple(one) == (12.5, None)


def test_value_distribution(spark):
    from parcela.operators.quantiles import value_distribution

    rows = [("a", random.choice([1.5, 2.0, 9.25])) for _ in range(500)] + [("b", 4.0), ("b", 5.0), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in value_distribution(df, "v", {"m": 0.5, "q": 0.9}, ["g"]).collect()}
    assert set(got) == {"a", "b"}
    for g in got:
        items = [v for k, v in rows if k == g]
        assert got[g]["nombre"] == len(items)
        assert float(got[g]["somme"]) == pytest.approx(sum(items))
        assert (got[g]["minimum"], got[g]["maximum"]) == (min(items), max(items))
        assert got[g]["m"] == statistics.median(items)
        assert got[g]["q"] == pytest.approx(_quantile(items, 0.9))


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    from parcela.sources.files import write_bucketed

    spark.sql(f"CREATE DATABASE IF NOT EXISTS essai LOCATION '{tmp_path}/essai'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("essai.a", "essai.b"):
            write_bucketed(spark.range(1000).withColumnRenamed("id", "id_annonce"), name, buckets=4)
        joined = spark.table("essai.a").join(spark.table("essai.b"), "id_annonce", "left")
        assert joined.count() == 1000
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE essai CASCADE")


def test_rounding_never_raises(spark):
    from pyspark.sql import functions as F

    from parcela.functions.numbers import python_round

    sizes = [0.0, 1e-9, 0.125, 2.675, 12345.675, 2.0**52, 99999999999999999999.0, 1e30, float("inf")]
    sizes += [-x for x in sizes]
    df = spark.createDataFrame([(x,) for x in sizes], "x double")
    for r in df.select("x", python_round(F.col("x")).alias("y")).collect():
        assert r.y == (round(r.x, 2) if abs(r.x) < 1e300 else r.x)


def test_session_gap_below_five_minutes(spark):
    import datetime as dt

    from parcela.streaming import events

    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("k", start), ("k", start + dt.timedelta(seconds=280)), ("k", start + dt.timedelta(seconds=300))], "k string, ts timestamp")
    assert sorted(r["nombre"] for r in events.session_counts(df, "ts", "k", "1 minute").collect()) == [1, 2]


def test_first_load_needs_no_table(spark, tmp_path):
    from parcela.operators import load

    batch = spark.createDataFrame([("a", 1), ("a", 1), (" ", 2), ("b", 3)], "reference string, x int")
    path = f"{tmp_path}/target"
    assert [tuple(r) for r in load.upsert_new_by_key(path, batch).collect()][0][1] == 2
    assert spark.read.parquet(path).count() == 2
    assert [tuple(r) for r in load.upsert_new_by_key(path, batch).collect()][0][1] == 0


def test_only_queries_run(spark, tmp_path):
    from parcela.plans.catalogue import run_sql

    spark.range(3).createOrReplaceTempView("known")
    for text in ("WITH a AS (SELECT 1 AS x) INSERT INTO known SELECT * FROM a", f"SELECT * FROM text.`{tmp_path}`",
                 "SELECT java_method('java.lang.System', 'currentTimeMillis')", "SELECT (SELECT max(value) FROM text.`/etc/hosts`)",
                 "SELECT 1; SELECT 2", "DROP VIEW known"):
        assert run_sql(spark, text).columns == ["erreur"], text
    assert run_sql(spark, "SELECT count(*) AS n FROM known -- all; of them").first()[0] == 3


def test_read_only_gate_walks_the_tree(spark, tmp_path):
    from parcela.plans.catalogue import is_read_only, register_sql_functions

    wide = ", ".join(f"{i} AS c{i}" for i in range(40))
    call = "java_method('java.lang.System', 'getProperty', 'user.home')"
    refused = [
        f"SELECT {wide}, {call} AS x", f"SELECT {wide} FROM t WHERE EXISTS (SELECT {call})", f"WITH a AS (SELECT {call} AS x) SELECT * FROM a",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home')", "SELECT system.builtin.reflect('java.lang.System', 'exit', 0)",
        f"SELECT sum(v) OVER w FROM t WINDOW w AS (PARTITION BY {call})", f"SELECT transform(array(1), x -> {call})",
        "SELECT * FROM parquet.`/tmp/x`", "SELECT * FROM (SELECT * FROM csv.`/etc/passwd`) AS q", "SELECT * FROM other.t",
        "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "SELECT TRANSFORM(v) USING 'cat' AS x FROM t", "DROP TABLE t",
        f"VALUES ({call})", f"SELECT v FROM t ORDER BY {call}", f"SELECT v FROM t GROUP BY v HAVING {call} = 'x'", "SELECT my_python_udf(v) FROM t",
    ]
    assert [q for q in refused if is_read_only(spark, q)] == []
    register_sql_functions(spark)
    allowed = [
        "SELECT * FROM t WHERE kind = 'Delete'", "SELECT v AS Updated, 1 AS `Drop` FROM t", "SELECT 'java_method(' AS CreateTable -- insert into",
        f"SELECT {wide}", "(SELECT 1) UNION ALL (SELECT 2) ORDER BY 1 LIMIT 3", "WITH a AS (SELECT 1 AS x), b AS (SELECT * FROM a) SELECT * FROM b JOIN a USING (x)",
        "SELECT kind, count(DISTINCT v) FILTER (WHERE v > 1) FROM t GROUP BY ROLLUP(kind) HAVING count(*) > 0",
        "SELECT rank() OVER (PARTITION BY kind ORDER BY v) FROM t", "SELECT sum(v) OVER w FROM t WINDOW w AS (ORDER BY v)",
        "SELECT x FROM t LATERAL VIEW explode(array(1, 2)) e AS x", "SELECT * FROM range(5)", "VALUES (1, 'a'), (2, 'b')",
        "SELECT CASE WHEN v IN (SELECT max(v) FROM t) THEN 1 END, filter(array(1, 2), x -> x > 1) FROM t WHERE NOT EXISTS (SELECT 1 FROM t u WHERE u.v = t.v)",
        "SELECT nettoyer_prix('1 000 €')", "SELECT * FROM t PIVOT (sum(v) FOR kind IN ('a', 'b'))", "SELECT t.* EXCEPT (v) FROM t CROSS JOIN t AS u",
    ]
    assert [q for q in allowed if not is_read_only(spark, q)] == []


def test_catalogue_shows_the_error_of_a_failing_file(spark, tmp_path):
    from parcela.plans.catalogue import run_query_catalogue

    (tmp_path / "bad.sql").write_text("SELECT nothing_here FROM nowhere")
    (tmp_path / "good.sql").write_text("SELECT 1 AS n;")
    found = run_query_catalogue(spark, str(tmp_path))
    assert found["good"].first()["n"] == 1 and found["bad"].columns == ["erreur"]


def _odd_listings(spark):
    from parcela.operators import prepare
    from parcela.schemas import RAW_LISTING

    row = {f.name: ([] if f.dataType.typeName() == "array" else "") for f in RAW_LISTING.fields}
    rows = [
        {**row, "reference": "R1", "prix": "100 000 €".replace(" ", " "), "surface": "20", "localisation": "Paris (75011)",
         "copropriete_charges_previsionnelles": "1 200 € / an",
         "caracteristiques_detaillees": ["Étage 2 sur 9", "Cave", None, "3 CHAMBRES", "Cave", "Digicode"]},
        {**row, "reference": "R2", "prix": "nan", "surface": "12\n", "caracteristiques_detaillees": None},
        {**row, "reference": None, "prix": None, "dpe_classe_active": "G"},
    ]
    return prepare.prepare_listings(spark.createDataFrame(rows, RAW_LISTING), 2025)


def test_named_aggregates_equal_the_whole_and_leave_out_the_rest(spark):
    from parcela.operators import market, shred

    prepared = _odd_listings(spark)
    stats = spark.sql("SELECT 6000D prix_m2_moyen, 1000D ecart_type_prix_m2, 3L nombre_biens_analyses")
    whole = market.aggregate_listings(prepared, "2025-11-15T00:00:00", stats)

    def some(only):
        return market.aggregate_listings(prepared, "2025-11-15T00:00:00", stats, only=only)

    tables = shred.shred_aggregates(whole), shred.shred_aggregates(some)
    for name in tables[0]:
        assert sorted(map(str, tables[0][name].collect())) == sorted(map(str, tables[1][name].collect()))
    flat = [sorted(map(str, shred.flat_aggregates(a).collect())) for a in (whole, some)]
    assert flat[0] == flat[1]
    plan = tables[1]["aggregats_principaux"]._jdf.queryExecution().optimizedPlan().toString()
    assert "tres_sous_cote" not in plan and market.MORE_PHOTOS not in plan and "loyer_estime_mensuel" not in plan


def test_texts_and_numbers_are_made_once(spark):
    from parcela.functions import numbers

    prepared = _odd_listings(spark)
    first, second, _ = prepared.collect()
    assert first.caracteristiques == ["Cave", "Digicode"] and first.batiment.etage == 2 and first.composition.chambres == 3
    assert (first.copropriete.charges.valeur, first.copropriete.charges.periode) == (1200.0, "annuel")
    assert (first.prix.valeur, second.prix.valeur, second.surface.valeur, second.caracteristiques) == (100000.0, None, 12.0, [])
    plan = prepared.select("caracteristiques", "batiment", "copropriete.charges")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 2
    x = spark.range(1).select(numbers.python_round(F.col("id") / 3))._jdf.queryExecution().analyzed().toString()
    assert x.count("id#") <= 12
