from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcela.functions import privacy as priv
from parcela.functions import text as txt

NN, NB = "\u202f", "\u00a0"


def test_localisation(values):
    out = values(txt.split_localisation, ["Paris (75019)", f"Lyon{NB}(69001) ", "Nice", "", None])
    assert [tuple(r) for r in out] == [
        ("Paris", "75019"), ("Lyon", "69001"), ("Nice", None), (None, None), (None, None)]


def test_district_and_proximity(values):
    texts = [
        "proche Buttes Chaumont, Quartier Secrétan, métro Bolivard, situé",
        "MÉTRO Gare du Nord. Calme", "école et métro.", "rien", "", None,
    ]
    assert values(txt.extract_district, texts) == ["Secrétan", None, None, None, None, None]
    assert values(txt.extract_proximity, texts) == [
        "Buttes Chaumont, métro Bolivard", "métro Gare du Nord", None, None, None, None]


def test_floor_info(values):
    items = [
        ["Étage 5 sur 6", "Cave"], ["Sans ascenseur", "étage 1/3", "Étage 2 / 4"], [], None,
    ]
    out = values(txt.floor_info, items, "array<string>")
    assert [tuple(r) for r in out] == [
        (5, 6, False), (2, 4, True), (None, None, False), (None, None, False)]


def test_features_and_images(values):
    items = [["1 chambre", "3 pièces", "39 m²", "Cave", "Cave", "Étage 5", "Construit en 1900", "Digicode"], [], None]
    assert values(txt.bedroom_count, items, "array<string>") == [1, None, None]
    assert values(txt.clean_features, items, "array<string>") == [["Cave", "Digicode"], [], []]
    images = [["a.jpg?w=1", "b.jpg", "a.jpg?w=2"], [], None]
    assert values(txt.clean_images, images, "array<string>") == [["a.jpg", "b.jpg"], [], []]


@pytest.mark.parametrize(("text", "expected"), [
    (f"1{NN}176{NB}€ / an", (1176.0, "€ / an", "annuel")),
    ("300 € / trim", (300.0, "€ / trim", "trimestriel")),
    ("45,50 €/mois", (45.5, "€ / mois", "mensuel")),
    ("90 €", (90.0, "€", "annuel")),
    ("90", (90.0, None, None)),
    ("néant", (None, None, None)), ("", (None, None, None)), (None, (None, None, None)),
])
def test_service_charge(values, text, expected):
    assert tuple(values(txt.parse_service_charge, [text])[0]) == expected


def test_other_texts(values):
    assert values(txt.extract_charge_amount, [f"1{NN}176{NB}€ / an", "1 200,5", "", None]) == [1176.0, 1200.5, None, None]
    assert values(txt.categorise_feature, ["Chauffage gaz", "Salle d'eau", "CAVE", "Balcon", "Alarme", "Vue"]) == [
        "chauffage", "equipements", "dependances", "exterieur", "securite", "autres"]
    media = values(txt.parse_media_text, ["7 Photos, 1 vidéo", "Visite virtuelle", None])
    assert [tuple(r) for r in media] == [
        ("7 Photos, 1 vidéo", 7, True, False), ("Visite virtuelle", 0, False, True), ("", 0, False, False)]
    assert values(lambda c: txt.absolute_url(c, "https://x.example"), ["/a", "http://b", "", None]) == [
        "https://x.example/a", "http://b", "", None]
    assert values(txt.clean_photo_url, ["p.jpg?format=auto&width=390", "p.jpg?width=780", "p.jpg", None]) == [
        "p.jpg?format=auto", "p.jpg?width=1200", "p.jpg", None]
    assert values(txt.contact_photo_url, ["p.jpg?w=1", "", None]) == ["p.jpg", None, None]
    assert values(txt.collapse_whitespace, ["a \n\t b"]) == ["a b"]
    assert values(txt.description_length_bucket, ["", "x" * 100, "x" * 500, "x" * 501, None]) == [
        "Description courte", "Description moyenne", "Description moyenne", "Description détaillée", "Pas de description"]
    codes = values(lambda c: txt.postal_code_anywhere(c, F.lit("12 rue X 69002")), ["Paris 75019", "123456", None])
    assert codes == ["75019", "69002", "69002"]


def test_privacy_texts(values):
    assert values(priv.is_sensitive, ["tel 0612345678", "a.b@c.fr", "1234-5678 9012 3456", "06123456789", "rien", None]) == [
        True, True, True, False, False, False]
    assert values(priv.anonymise_name, ["Jean Dupont", "Jean", "  ", "", None, "Ana  Maria Sol"]) == [
        "Jean D.", "Anonyme", "Anonyme", "Anonyme", "Anonyme", "Ana M."]
    assert values(priv.clean_location, ["12 rue de Lyon 75012 Paris", "5Avenue Foch", None]) == [
        "de Lyon  Paris", "Foch", None]
