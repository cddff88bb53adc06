from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from parcela.functions import pages as page_rules
from parcela.functions.pages import FieldRule
from parcela.operators import pages

CARD = """<article><a href="/annonce/maison-vente/r123"><h2> Maison à Lyon&nbsp;(69002) </h2></a>
<p class="text-lg">1 200 000 €</p><span class="inline badge">Nouveau</span>
<ul><li>• 2 chambres</li><li> • 4 pièces</li><li>• 95 m²</li></ul><img src="https://img.example/property/1.jpg"></article>"""

DETAIL = """<DL class="flex gap-m"><dt>Nombre de lots :</dt>
 <dd><b>48</b></dd><dt>Procédures</dt><dd> aucune &amp; close </dd></DL>
<a class="flex-col x" href="/conseiller/a"><img class="size-full" src="p.jpg?w=1"><p class="text-xl">Ana <b>Sol</b></p></a>
<button> <span>Appeler +33 6 11 22</span></button>
<ul class="a flex-col"><li><img src="1.jpg?format=auto&width=390" alt="salon"></li><li><img alt="sans"></li>
<li><img src="2.jpg?width=780"></li></ul>"""


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(1, CARD, 0), (2, DETAIL, 0), (3, "", 7), (4, None, 0)], "id int, html string, nombre_photos int")


def test_card(table):
    row = pages.extract_listing_fields_from_pages(table).filter("id = 1").first()
    assert row["titre"] == "Maison à Lyon\u00a0(69002)"
    assert (row["reference"], row["lien"]) == ("123", "https://listings.example/annonce/maison-vente/r123")
    assert (row["localisation"], row["code_postal"], row["type_bien"]) == ("Lyon\u00a0(69002)", "69002", "Maison")
    assert (row["prix"], row["badges"]) == ("1 200 000 €", ["Nouveau"])
    assert (row["surface"], row["pieces"], row["chambres"]) == ("95 m²", "4 pièces", "2 chambres")
    assert row["caracteristiques"] == ["2 chambres", "4 pièces", "95 m²"]
    empty = pages.extract_listing_fields_from_pages(table).filter("id >= 3").collect()
    assert all(r["titre"] is None and r["badges"] is None for r in empty)


def test_detail_blocks(table):
    row = pages.extract_coownership_fields(table).filter("id = 2").first()
    assert row["copropriete_nb_lots"] == "48"
    assert row["copropriete_procedures"] == "aucune & close"
    assert row["copropriete_charges_previsionnelles"] == ""
    agent = pages.extract_agent_fields(table).filter("id = 2").first()
    assert agent["conseiller_nom_complet"] == "Ana Sol"
    assert agent["conseiller_telephone"] == "+33 6 11 22"
    assert agent["conseiller_lien"] == "https://listings.example/conseiller/a"
    assert agent["conseiller_note"] == ""
    panel = pages.extract_energy_panel(table).filter("id = 2").first()
    assert (panel["dpe_classe_active"], panel["annee_reference"], panel["legende_dpe"]) == ("", "2025", [])


def test_gallery(table):
    rows = pages.extract_gallery(table, "id").orderBy("ordre").collect()
    assert [(r["url"], r["alt"], r["ordre"], r["description"]) for r in rows] == [
        ("1.jpg?format=auto", "salon", 1, "Photo 1/3"), ("2.jpg?width=1200", "", 3, "Photo 3/3")]
    counts = {r["id"]: r["nombre_photos"] for r in pages.photo_count(table).collect()}
    assert counts[2] == 3
    assert counts[3] == 7


def test_rules(table):
    rules = {
        "prix": FieldRule(r"<p[^>]*>(.*?)</p>", regex=r"([0-9 ]+)€"),
        "titre": FieldRule(r"<h2>(.*?)</h2>", regex=r"(introuvable)"),
        "honoraires": FieldRule(r"<p[^>]*>(.*?)</p>"),
        "bloc": {"badge": FieldRule(r"<span[^>]*>(.*?)</span>", multiple=True)},
    }
    out = {r["id"]: r for r in pages.extract_fields(table, rules).collect()}
    assert out[1]["prix"] == "1 200 000"
    assert out[1]["titre"] == "Maison à Lyon\u00a0(69002)"  # a regex that does not match keeps the text
    assert out[1]["honoraires"] == ""
    assert out[1]["bloc_badge"] == ["Nouveau"]
    assert out[1]["champs_manquants"] == []
    assert sorted(out[3]["champs_manquants"]) == ["bloc_badge", "prix", "titre"]


def _other_form(source):
    """The same markup with attributes in the opposite order, in single quotes or bare."""
    def turned(match):
        pairs = re.findall(r'([a-z]+)="([^"]*)"', match[2])
        written = [f"{n} = {v}" if re.fullmatch("[a-z]+", v) and i % 2 else f"{n}='{v}'" for i, (n, v) in enumerate(reversed(pairs))]
        return f"<{match[1]} data-x='a > b' {' '.join(written)}>" if pairs else match[0]

    return re.sub(r"<([A-Za-z0-9]+)([^>]*)>", turned, source)


@pytest.mark.parametrize("extract", [pages.extract_listing_fields_from_pages, pages.extract_coownership_fields, pages.extract_agent_fields,
                                     pages.extract_energy_panel, pages.photo_count])
def test_fields_do_not_depend_on_the_form_of_attributes(spark, extract):
    panel = """<section class="flex x"><h3>P</h3><div class="panel-dpe a"><p>Indice</p><em>bas</em><li class="border-white"><span>C</span></li></div>
<aside class="border-epc-C"><p class="b flex"><span class="text-base bold">120</span></p><span class="text-base">90</span><p class="grid g"><span class="text-base">12</span></p></aside>
<div class="text-sm m"><p>entre 900 € par an</p><p>et 1200 € par an</p></div></section>"""
    for source in (CARD, DETAIL, panel):
        other = _other_form(source)
        assert other != source
        df = spark.createDataFrame([(1, source, 0), (2, other, 0)], "id int, html string, nombre_photos int")
        first, second = (r.asDict() for r in extract(df).drop("html").orderBy("id").collect())
        assert {**first, "id": 0} == {**second, "id": 0}
    row = pages.extract_energy_panel(spark.createDataFrame([(panel,)], "html string")).first()
    assert (row["dpe_classe_active"], row["dpe_consommation_energie_primaire"], row["dpe_emissions"], row["depenses_energie_max"]) == ("C", "120", "12", "1200 €")


def test_each_pattern_of_the_coownership_block_runs_once_per_page(table):
    plan = pages.extract_coownership_fields(table)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Nombre de lots") == 1


def test_every_uneven_page_is_suspected_first(spark):
    gaps = ("", " ", "\n", " k ", " b='1' ", ' b="1" ')
    tags = [f"<a{x}{name}{gap}={gap}{value}{y}class{z}=\"x\">" for x in gaps for name in ("class", "HREF", "b") for gap in ("", " ", "\n")
            for value in ('"v"', "'v'", "v") for y in gaps for z in ("", " ")]
    assert not page_rules._SUSPECT.startswith("(?i)")
    df = spark.createDataFrame([(t,) for t in tags], "t string")
    uneven = df.filter(F.col("t").rlike(page_rules._UNEVEN))
    assert uneven.count() > 1000
    assert uneven.filter(~F.col("t").rlike(page_rules._SUSPECT)).count() == 0
