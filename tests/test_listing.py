"""One full listing from raw text to recommendations, with values worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcela.operators import market, prepare, quality, shred
from parcela.schemas import RAW_LISTING

NN, NB = "\u202f", "\u00a0"
PHOTO = "https://img.example/property/{}.jpg?format=auto&width=390"

RAW = {
    "reference": "1887635", "titre": "Appartement à Paris (75019)", "titre_complet": "Appartement à Paris (75019)",
    "prix": f"380{NN}000{NB}€", "prix_detaille": f"380{NN}000{NB}€", "prix_au_m2": f"9{NN}744{NB}€ / m²",
    "localisation": "Paris (75019)", "localisation_complete": "Appartement à Paris (75019)", "surface": "39",
    "surface_terrain": "", "pieces": "3", "type_bien": "Appartement",
    "description": "proche Buttes Chaumont, Quartier Secrétan, métro Bolivard, situé au 5 ème étage sans ascenseur",
    "caracteristiques_detaillees": [
        "1 chambre", "3 pièces", "39 m²", "Cave", "Salle à manger", "Câble TV", "Chauffage Électrique",
        "Construit en 1900", "Étage 5 sur 6", "Digicode", "Interphone"],
    "annee_construction": "1900", "honoraires": "", "image_url": "", "nombre_photos": "7", "has_video": "",
    "images": [PHOTO.format(n) for n in (1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)],
    "has_visite_virtuelle": "", "media_info": "7 photos", "lien": "https://site.example/annonce/r1887635",
    "date_extraction": "2025-11-12T18:31:55.197754", "dpe_classe_active": "F", "ges_classe_active": "C",
    "depenses_energie_min": "", "depenses_energie_max": "", "annee_reference": "2025", "copropriete_nb_lots": "48",
    "copropriete_charges_previsionnelles": f"1{NN}176{NB}€ / an", "copropriete_procedures": "",
    "conseiller_nom_complet": "Jeanne Martin", "conseiller_telephone": "+33 6 00 00 00 00",
    "conseiller_lien": "https://site.example/conseiller/jeanne", "conseiller_photo": "https://img.example/p.jpeg?w=1",
    "conseiller_note": "",
}


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([tuple(RAW[n] for n in RAW_LISTING.names)], RAW_LISTING)


@pytest.fixture(scope="module")
def prepared(raw):
    return prepare.prepare_listings(raw, 2025)


def test_prepared_document(prepared):
    d = prepared.first().asDict(recursive=True)
    assert d["prix"] == {"valeur": 380000.0, "devise": "€", "au_m2": 9743.59}
    assert d["surface"] == {"valeur": 39.0, "unite": "m²"}
    assert d["composition"] == {"pieces": 3.0, "chambres": 1.0, "type_bien": "Appartement"}
    assert d["localisation"] == {
        "ville": "Paris", "code_postal": "75019", "quartier": "Secrétan",
        "proximite": "Buttes Chaumont, métro Bolivard"}
    assert d["caracteristiques"] == [
        "Cave", "Salle à manger", "Câble TV", "Chauffage Électrique", "Digicode", "Interphone"]
    assert d["batiment"] == {
        "annee_construction": 1900, "age_bien": 125, "etage": 5, "etage_total": 6, "ascenseur": False}
    assert d["diagnostics"]["dpe"] == {"classe": "F", "score": 3, "indice": None}
    assert d["diagnostics"]["ges"] == {"classe": "C", "score": 6, "indice": None}
    assert d["copropriete"]["charges"] == {"valeur": 1176.0, "unite": "€ / an", "periode": "annuel"}
    assert d["copropriete"]["procedures_en_cours"] is True
    assert d["medias"]["nombre_photos"] == 11
    assert d["contact"]["photo"] == "https://img.example/p.jpeg"
    assert d["metadata"]["score_qualite"] == 10.0
    assert d["metadata"]["champs_manquants"] == []


def test_aggregates(prepared):
    a = market.aggregate_listings(prepared, "2025-11-15T00:00:00").first()["aggregats"].asDict(recursive=True)
    assert a["scores"] == {"emplacement": 6.0, "modernite": 4.0, "global": 5.0}
    assert a["segmentation"] == {"prix_m2": "superieur", "surface": "appartement", "age": "patrimoine"}
    assert a["performance"]["loyer_estime_mensuel"] == 1583.33
    assert a["performance"]["rendement_annuel_estime"] == 5.0
    assert a["performance"]["rentabilite_nette"] == max(0, 5.0 - 1176.0 / 380000.0 * 100)
    # a single listing has no spread, so it cannot be placed
    assert a["analyse_marche"]["positionnement_marche"] == "non_determine"
    assert a["analyse_marche"]["z_score_prix_m2"] == 0.0
    assert a["recommandations"]["ciblage"] == ["Cibler public jeune et sportif"]
    assert a["recommandations"]["amelioration"] == ["Priorité: rénovation énergétique"]


def test_loader_row_and_children(raw):
    cleaned = prepare.clean_loader_row(raw, "2025-11-15T00:00:00")
    row = cleaned.first()
    assert (row["prix"], row["prix_au_m2"], row["surface"], row["pieces"]) == (380000.0, 9743.59, 39.0, 3)
    assert row["copropriete_nb_lots"] == 48
    assert shred.shred_features(cleaned).count() == 11
    images = [r["ordre"] for r in shred.shred_images(cleaned).orderBy("ordre").collect()]
    assert images == list(range(1, 13))
    assert shred.shred_energy(cleaned).first()["classe_energie"] == "F"
    assert shred.shred_coownership(cleaned).first()["nb_lots"] == 48


def test_market_statistics_by_hand(spark):
    rows = [(p, s) for p, s in [(100.0, 10.0), (300.0, 10.0), (800.0, 10.0), (None, 10.0), (50.0, None), (0.0, 5.0)]]
    df = spark.createDataFrame(rows, "p double, s double").select(
        F.struct(F.col("p").alias("valeur")).alias("prix"), F.struct(F.col("s").alias("valeur")).alias("surface"),
        F.struct(F.lit("75001").alias("code_postal")).alias("localisation"))
    r = market.market_stats(df).first()
    assert (r["prix_m2_moyen"], r["prix_m2_median"], r["prix_m2_min"], r["prix_m2_max"]) == (40.0, 30.0, 10.0, 80.0)
    assert r["nombre_biens_analyses"] == 3
    assert r["ecart_type_prix_m2"] == 29.44  # population
    assert r["arrondissements_uniques"] == ["75001"]


def test_prune_and_null_keys(prepared, tmp_path):
    empty = prepared.withColumn("caracteristiques", F.array().cast("array<string>"))
    row = prepare.prune_empty(empty).first()
    assert row["caracteristiques"] is None
    assert row["metadata"]["champs_manquants"] is None
    assert row["batiment"]["ascenseur"] is False


def test_map_fields_and_flatten(prepared):
    flat = prepare.map_fields(prepared)
    row = flat.first()
    assert row["prix_valeur"] == 380000.0
    assert row["aggregats_scores_global"] is None  # absent path
    f = prepare.flatten_listing(prepared, "2025-11-15T00:00:00").first()
    assert (f["prix_devise"], f["composition_nb_pieces"]) == ("€", 3)
    metrics = quality.add_quality_metrics(prepare.flatten_listing(prepared, "2025-11-15T00:00:00")).first()
    assert metrics["data_quality_score"] == 1.0


def test_label_rules(values):
    assert values(market.segment_price_m2, [0.0, 4999.9, 5000.0, 15000.0, None], "double") == [
        None, "economique", "moyen", "luxe", None]
    assert values(market.segment_age, [0, 4, 5, 100, None], "int") == [None, "neuf", "recent", "patrimoine", None]
    assert values(market.percentile_rank_approx, [-5.0, -0.03, 0.0, 1.0, 9.0, None], "double") == [1, 50, 50, 70, 99, 50]
    assert values(market.yield_level, [8.0, 5.0, 4.99, None], "double") == ["eleve", "moyen", "faible", "faible"]
    assert values(market.document_label, ["economique", "tres_sur_cote", "moyen", None]) == [
        "économique", "très_sur_cote", "moyen", None]
