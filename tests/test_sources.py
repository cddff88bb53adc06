from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from parcela.operators import load, privacy, quality
from parcela.plans import catalogue, search
from parcela.schemas import OUTPUT_FIELDS
from parcela.sources import files, profile


def _json(path, value):
    path.write_text(json.dumps(value, ensure_ascii=False), encoding="utf-8")


def test_read_listings_json(spark, tmp_path):
    _json(tmp_path / "a.json", [{"reference": "R1", "images": ["x"]}, {"reference": "R2"}])
    _json(tmp_path / "b.json", {"reference": "R3"})
    (tmp_path / "c.json").write_text("[{broken", encoding="utf-8")
    good, bad = files.split_corrupt(files.read_listings_json(spark, str(tmp_path)))
    assert sorted(r["reference"] for r in good.collect()) == ["R1", "R2", "R3"]
    assert [r[0] for r in bad.collect()] == ["[{broken"]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "d.json").write_text('{"reference": "R1"}\n{bad\n', encoding="utf-8")
    good, bad = files.split_corrupt(files.read_listings_json(spark, str(tmp_path / "lines"), multiline=False))
    assert (good.count(), bad.count()) == (1, 1)


def test_snapshots_repeat_and_load_once(spark, tmp_path):
    """Three runs hold the same references; media_info is text in one and an object in others."""
    rows = [{"reference": f"R{i}", "titre": "t", "media_info": {"nombre_photos": i, "has_video": False}} for i in range(5)]
    _json(tmp_path / "annonces_20251120_180128.json", rows)
    _json(tmp_path / "annonces_20251120_182747.json", rows)
    _json(tmp_path / "annonces_20251121_000000.json", [{"reference": "R9", "media_info": "7 photos"}])
    runs = files.read_snapshots(spark, str(tmp_path / "annonces_*.json"))
    assert runs.count() == 11
    stamps = sorted({str(r["horodatage"]) for r in runs.collect()})
    assert stamps == ["2025-11-20 18:01:28", "2025-11-20 18:27:47", "2025-11-21 00:00:00"]
    photos = runs.filter("reference = 'R3'").select(files.media_info(runs)["nombre_photos"]).distinct().collect()
    assert [r[0] for r in photos] == [3]
    none = runs.limit(0)
    kept = load.new_rows(none, runs, order="horodatage")
    assert kept.count() == 6
    assert str(kept.filter("reference = 'R3'").first()["horodatage"]) == "2025-11-20 18:01:28"


def test_writers(spark, tmp_path):
    df = spark.sql("SELECT 'R1' AS reference, named_struct('valeur', 1.5D, 'x', cast(null AS string)) AS prix, array('a','b') AS images")
    path = files.write_results(df, str(tmp_path / "csv"), "CSV")
    row = spark.read.option("header", True).csv(path).first().asDict()
    assert row == {"reference": "R1", "prix_valeur": "1.5", "prix_x": None, "images": '["a","b"]'}
    path = files.write_results(df, str(tmp_path / "json"), "json")
    assert "x" not in spark.read.text(path).first()[0].replace('"prix"', "")
    path = files.write_results(df, str(tmp_path / "pq"), "parquet", "20251115_021500")
    assert path.endswith("_20251115_021500")
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError, match="unsupported"):
        files.write_results(df, str(tmp_path / "x"), "xml")


def test_project_output_fields(spark):
    df = spark.createDataFrame([("R1", "Maison à Lyon (69002)", ""), ("R2", "T 13001", None)], "reference string, titre string, localisation string")
    out = files.project_output_fields(df, "2025-01-01")
    assert out.columns == OUTPUT_FIELDS
    rows = {r["reference"]: r for r in out.collect()}
    assert rows["R1"]["code_postal"] == "69002"
    assert rows["R2"]["code_postal"] == "13001"
    assert rows["R1"]["badges"] == ""
    assert rows["R1"]["type_transaction"] == "acheter"


def test_catalogue_csv_and_file_list(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        '"dbms","a","b","t","c","o","d","l","k","s2","t2","c2"\n'
        '"postgresql","db","public","clients","id_client",1,"character varying",6,"PRIMARY KEY",NULL,NULL,NULL\n',
        encoding="utf-8")
    row = files.describe_catalogue_csv(spark, str(tmp_path / "c.csv")).first()
    assert (row["column_name"], row["ordinal_position"], row["character_maximum_length"], row["table_name_2"]) == ("id_client", 1, 6, None)
    (tmp_path / "e.json").write_text("x\ny\nz", encoding="utf-8")
    listed = {r["nom"]: (r["taille"], r["lignes"]) for r in files.list_input_files(spark, str(tmp_path)).collect()}
    assert listed["c.csv"][1] == 2
    assert listed["e.json"] == (5, 3)


def test_ad_hoc_sql(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    assert catalogue.run_sql(spark, "-- note\nSELECT count(*) AS n FROM petite;", {"petite": df}).first()["n"] == 2
    for text in ("DROP TABLE petite", "SELECT 1; DROP TABLE petite", "INSERT INTO petite VALUES (1)"):
        assert catalogue.run_sql(spark, text).columns == ["erreur"]
    assert "erreur" in catalogue.run_sql(spark, "SELECT nope FROM petite").columns
    (tmp_path / "1.sql").write_text("SELECT id FROM petite", encoding="utf-8")
    (tmp_path / "9.sql").write_text("SELECT nope FROM petite", encoding="utf-8")
    out = catalogue.run_query_catalogue(spark, str(tmp_path))
    assert out["1"].count() == 2
    assert out["9"].columns == ["erreur"]  # the row says what failed


def test_sql_functions(spark):
    names = catalogue.register_sql_functions(spark)
    assert len(names) == 9
    row = spark.sql("""SELECT calculer_prix_au_m2(1000.25, 50) AS a, calculer_score_attractivite(6, true, 1, 10, 5) AS b,
        calculer_score_attractivite_avance(8, 7, 6, 6) AS c, calculer_rentabilite(100000D, 2000D, 50D, NULL).rendement_annuel AS d,
        analyser_potentiel_renovation('F', 40, 100000D).investissement_estime AS e""").first()
    assert float(row["a"]) == 20.01
    assert float(row["b"]) == 10.0
    assert float(row["c"]) == 10.0  # saturates
    assert row["d"] == pytest.approx(5.0)
    assert row["e"] == 10000.0


def test_profiles(spark):
    t = {"a": spark.range(3), "b": spark.range(0)}
    got = {r["nom_table"]: (r["nombre"], r["statut"]) for r in profile.table_count_report(t).collect()}
    assert got == {"a": (3, "ok"), "b": (0, "vide")}
    cols = profile.profile_tables(spark, t).collect()
    assert {(r["nom_table"], r["colonne"], r["type"], r["nombre"]) for r in cols} == {("a", "id", "bigint", 3), ("b", "id", "bigint", 0)}
    assert profile.sample_rows(spark.range(5)).count() == 2


def test_search(spark):
    df = spark.createDataFrame(
        [(i, f"R{i}", "Bel Appartement" if i % 2 else "Maison", float(i * 100), float(i), "Paris" if i < 6 else "Lyon", "x", "d") for i in range(1, 11)],
        "id_annonce int, reference string, type_bien string, prix double, surface double, localisation string, localisation_complete string, description string",
    ).withColumn("titre", F.col("type_bien"))
    assert [r["id_annonce"] for r in search.page_results(search.search_filter(df, type_bien="appart", min_prix=0, max_prix=700), 2, 1).collect()] == [5, 3]
    assert search.search_filter(df, localisation="PAR").count() == 5
    assert search.text_search(df, "lyon", 3).count() == 3
    assert search.listing_by_reference(df, "R4").count() == 1
    assert [r["reference"] for r in search.public_sample(df, 2).collect()] == ["R10", "R9"]
    assert search.distinct_locations(df, 1).first()[0] == "Lyon"


def test_quality_rules(spark):
    df = spark.createDataFrame([("ab-1", 10), ("AB-1", 1001), (None, None)], "id_client string, longueur_mm int")
    rules = {**quality.CLIENT_RULES, "chk_longueur": "longueur_mm <= 1000"}
    assert {(r["id_client"], r["regle"]) for r in quality.integrity_report(df, rules).collect()} == {("AB-1", "chk_id_client"), ("AB-1", "chk_longueur")}
    counts = {r["regle"]: r["violations"] for r in quality.integrity_counts(df, rules).collect()}
    assert counts == {"chk_id_client": 1, "chk_longueur": 1}
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert [r["k"] for r in quality.fk_violations(child, parent, "k", "id").collect()] == [2]
    valid = quality.filter_valid(spark.createDataFrame([("R1", "t"), (" ", "t"), ("R2", ""), (None, "t")], "reference string, titre string"), ["titre"])
    assert [r["reference"] for r in valid.collect()] == ["R1"]


def test_validate_documents(spark):
    docs = spark.sql("""SELECT * FROM VALUES ('R1', 't', named_struct('date_extraction', '2025-11-12T18:31:55Z')),
        (' ', 't', named_struct('date_extraction', 'hier')), ('R2', '', NULL) AS d(reference, titre, metadata)""")
    rows = load.validate_documents(docs, "2025-11-15T00:00:00").collect()
    assert [r["erreur"] for r in rows] == [None, "référence manquante", "champ requis manquant: titre"]
    assert str(rows[0]["metadata"]["date_extraction"]) == "2025-11-12 18:31:55"
    assert rows[1]["metadata"]["date_extraction"] is None
    assert load.validate_documents(docs.drop("metadata"), "2025-11-15").first()["metadata"]["imported_at"] is not None


def test_privacy_operators(spark, tmp_path):
    a = spark.sql("""SELECT * FROM VALUES (1, timestamp'2020-01-01'), (2, timestamp'2025-01-01'), (3, NULL) AS t(id_annonce, date_extraction)""")
    child = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (9, "w")], "id_annonce int, v string")
    tables = {"annonces": a, "images": child}
    kept = privacy.apply_retention(tables, "2025-11-15")
    assert [r["id_annonce"] for r in kept["images"].collect()] == [2]
    counts = {r["nom_table"]: r["supprimes"] for r in privacy.retention_counts(tables, "2025-11-15").collect()}
    assert counts == {"annonces": 1, "images": 3}
    data = spark.createDataFrame([("Jean Petit", "a@b.fr", "06"), (None, "c", "07"), ("Ana", "d", "08")], "nom_complet string, email string, telephone string")
    ask = spark.createDataFrame([("Jean Petit", "12")], "nom_complet string, telephone string")
    assert privacy.access_subject(data, ask, ["nom_complet"]).count() == 1
    assert privacy.erase_subject(data, ask, ["nom_complet"]).count() == 2
    fixed = {r["email"]: r["telephone"] for r in privacy.rectify_subject(data, ask, ["nom_complet"], ["telephone"]).collect()}
    assert fixed == {"a@b.fr": "12", "c": "07", "d": "08"}
    clean, done = privacy.drop_direct_identifiers(data)
    assert clean.columns == ["nom_complet"]
    assert done == [("nom_complet", "name"), ("email", "drop"), ("telephone", "drop")]
    masked = privacy.anonymise_personal_data(spark.createDataFrame([("Ana Sol", "3 rue X 75001 Paris")], "conseiller_nom string, localisation_complete string")).first()
    assert tuple(masked) == ("Ana S.", "X  Paris")
    valid = privacy.valid_requests(spark.createDataFrame(
        [("A", "a@b", "acces"), ("", "a@b", "acces"), ("A", "x", "acces"), ("A", "a@b", "autre")], "nom string, email string, type_demande string"))
    assert valid.count() == 1
    path = str(tmp_path / "audit")
    for user in ("u1", "u1", "u2"):
        privacy.log_access(spark, path, user, "read", "annonces", "2025-01-01T10:00:00")
    got = {r["user_name"]: r["acces"] for r in privacy.access_audit(spark.read.parquet(path)).collect()}
    assert got == {"u1": 2, "u2": 1}
    audit = {(r["colonne"], r["motif"]): r["nombre"] for r in privacy.audit_sensitive_data(data, ["email"]).collect()}
    assert audit == {("email", "telephone"): 0, ("email", "email"): 1, ("email", "carte"): 0}


def test_views_by_name(spark):
    from contract import bindings
    from parcela.plans import registration

    sf = "/root/testdata/sf0.001"
    names = registration.register_model(bindings.base_tables(spark, sf), registration.BASE_VIEWS)
    assert "v_stats_type_bien" in names
    assert spark.sql("SELECT * FROM v_stats_type_bien WHERE nombre_annonces > 10").count() == 6
    assert spark.sql("SELECT * FROM v_stats_par_pieces WHERE pieces BETWEEN 1 AND 5").count() == 5
    registration.register_model(bindings.commerce_tables(spark, sf), registration.COMMERCE_VIEWS)
    assert spark.sql("SELECT * FROM v4").count() == 5
    for name in names:
        spark.table(name).limit(1).collect()


def test_aggregate_views_by_name(spark):
    from contract.registry import source
    from parcela.plans import registration

    tables = source(spark, "/root/testdata/sf0.001").gold
    names = registration.register_model(tables, registration.AGGREGATE_VIEWS)
    for name in registration.AGGREGATE_VIEWS:
        assert name in names
        assert spark.table(name).limit(1).count() == 1
    assert spark.sql("SELECT * FROM v_biens_sous_cotes ORDER BY ecart_pourcentage LIMIT 3").count() == 3


def test_catalogue_gives_the_revenue_of_every_year(spark):
    import datetime as dt
    import os

    folder = os.path.join(os.path.dirname(catalogue.__file__), "sql")
    tables = {
        "clients": spark.createDataFrame([(1, "A")], "id_client long, nom_client string"),
        "commandes": spark.createDataFrame(
            [(1, 1, dt.date(1997, 5, 2)), (2, 1, dt.date(1998, 5, 3)), (3, 1, dt.date(2001, 1, 4))],
            "id_commande long, id_client long, date_commande date"),
        "lignes_commande": spark.createDataFrame(
            [(i, 7, 2.0, 10.0 * i, 0.0) for i in (1, 2, 3)],
            "id_commande long, id_boite long, quantite double, prix_unitaire double, taux_remise double"),
    }
    found = catalogue.run_query_catalogue(spark, folder, tables)["chiffre_affaires_par_mois"]
    assert [tuple(r) for r in found.collect()] == [("1997-05", 20.0), ("1998-05", 40.0), ("2001-01", 60.0)]


def _shop_folder(spark, folder, n):
    """Orders and customers with repeated and null values."""
    import datetime as dt

    orders = [(i, i % 7 if i % 9 else None, "O", 100.0 * i, dt.datetime(1995, 1 + i % 12, 3), "1-URGENT") for i in range(n)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
                          ).write.parquet(f"{folder}/orders.parquet")
    customers = [(i, f"Customer {i}", 1, 1.0, ["BUILDING", "MACHINERY"][i % 2]) for i in range(7)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
                          ).write.parquet(f"{folder}/customer.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["s01_read_listings_json", "s05_write_json"])
def test_json_lines_leave_little_on_disk(spark, tmp_path, monkeypatch, name):
    """Lines are compressed, nothing else is stored, and every listing with a customer is read back."""
    from contract import registry

    made = {}

    def shared(_, purpose):
        return made.setdefault(purpose, str(tmp_path / purpose))

    monkeypatch.setattr(registry, "shared_dir", shared)
    got = registry.QUERIES[name](spark, _shop_folder(spark, tmp_path / "in", 900))
    assert got.count() == 800 and got.columns[0] in ("reference", "id_annonce")
    assert len(made) == 1
    (folder,) = made.values()
    data = [p for p in (tmp_path / folder).rglob("part-*")]
    assert data and all(p.name.endswith(".json.gz") for p in data)
    plain = str(tmp_path / "plain")
    files.write_json(spark.read.json(folder), plain)
    assert sum(p.stat().st_size for p in data) * 3 < sum(p.stat().st_size for p in (tmp_path / "plain").rglob("part-*.json"))
