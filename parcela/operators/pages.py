"""Listing fields from a table of raw pages; every operator is one narrow ``select``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcela.functions.numbers import first_match, strip
from parcela.functions.pages import (
    AGENT_RULES, COOWNERSHIP_LABELS, ENERGY_RULES, FieldRule, canonical, definition_rule, gallery, gallery_images,
    legend, select_fields,
)
from parcela.functions.text import absolute_url, postal_code_anywhere

# Markup of one listing card.
CARD_RULES = {
    "titre": FieldRule(r"<a[^>]*href=\"[^\"]*/annonce/[^\"]*\"[^>]*>\s*<h[23][^>]*>(.*?)</h[23]>"),
    "lien": FieldRule(r"<a[^>]*href=\"([^\"]*/annonce/[^\"]*)\"", attribute=True),
    "prix": FieldRule(r"<(?:p|strong)[^>]*>([^<]*€[^<]*)</(?:p|strong)>"),
    "image_url": FieldRule(r"<img[^>]*src=\"([^\"]*property[^\"]*)\"", attribute=True),
    "badges": FieldRule(r"<span[^>]*class=\"[^\"]*badge[^\"]*\"[^>]*>(.*?)</span>", multiple=True),
    "caracteristiques": FieldRule(r"<li>(.*?)</li>", regex=r"(?U)^[•\s]*(.*?)\s*$", multiple=True),
}


PAGE = "_page"


def _read(pages: DataFrame, html: str) -> DataFrame:
    """The pages with their markup in one form beside them."""
    return pages.withColumn(PAGE, canonical(F.col(html)))


def extract_listing_fields_from_pages(
    pages: DataFrame, html: str = "html", base_url: str = "https://listings.example"
) -> DataFrame:
    """Raw listing fields of each card page; a missing element gives null."""
    out = select_fields(_read(pages, html), PAGE, CARD_RULES).drop(PAGE)
    features = F.col("caracteristiques")

    def feature(word: str, pattern: str, suffix: str):
        hits = F.filter(features, lambda x: x.contains(word) & x.rlike(pattern))
        return F.concat(F.regexp_extract(F.try_element_at(hits, F.lit(1)), pattern, 1), F.lit(suffix))

    place = strip(first_match(F.col("titre"), r"(?U)à\s+(.+)"))
    return out.withColumns({
        "reference": first_match(F.col("lien"), r"/r([0-9]+)"),
        "lien": absolute_url(F.col("lien"), base_url),
        "localisation": place,
        "code_postal": postal_code_anywhere(F.col("titre"), place),
        "type_bien": first_match(
            F.col("titre"), "^(Maison|Appartement|Villa|Studio|Loft|Duplex|Terrain)"
        ),
        "surface": feature("m²", r"(?U)([0-9]+)\s*m²", " m²"),
        "pieces": feature("pièces", "([0-9]+)", " pièces"),
        "chambres": feature("chambre", "([0-9]+)", " chambres"),
    })


def extract_coownership_fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """Lots, expected charges and procedures of each page, "" when absent."""
    rules = {n: definition_rule(label) for n, label in COOWNERSHIP_LABELS.items()}
    return select_fields(_read(pages, html), PAGE, rules, default="").drop(PAGE)


def extract_agent_fields(
    pages: DataFrame, html: str = "html", base_url: str = "https://listings.example"
) -> DataFrame:
    """Name, phone, link, photo, rating and number of reviews of the agent, "" when absent."""
    out = select_fields(_read(pages, html), PAGE, AGENT_RULES, default="").drop(PAGE)
    return out.withColumn("conseiller_lien", absolute_url(F.col("conseiller_lien"), base_url))


def extract_energy_panel(pages: DataFrame, html: str = "html") -> DataFrame:
    """Active classes, consumptions, emissions, spending and legends, "" or empty when absent."""
    out = select_fields(_read(pages, html), PAGE, ENERGY_RULES, default="")
    return out.withColumns({f"legende_{k}": legend(F.col(PAGE), f"panel-{k}") for k in ("dpe", "ges")}).drop(PAGE)


def extract_gallery(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """One row per photo of each page."""
    tags = _read(pages, html).select(key, gallery_images(F.col(PAGE)).alias("_i"))
    return tags.select(key, F.explode(gallery(F.col("_i"))).alias("_p")).select(key, "_p.*")


def photo_count(pages: DataFrame, html: str = "html", given: str = "nombre_photos") -> DataFrame:
    """The number of images in the gallery replaces a count of zero."""
    seen = _read(pages, html).withColumn("_n", F.size(gallery_images(F.col(PAGE)))).drop(PAGE)
    return seen.withColumn(
        given, F.when((F.col(given) == 0) & (F.col("_n") > 0), F.col("_n")).otherwise(F.col(given))
    ).drop("_n")


def extract_fields(
    pages: DataFrame, rules: dict[str, FieldRule | dict[str, FieldRule]], html: str = "html"
) -> DataFrame:
    """Fields by rule, with the names of the missing ones.

    Nested rules give columns ``section_field``.  A missing single field is ""; a missing
    multiple field is null.  ``honoraires`` is always "".
    """
    flat: dict[str, FieldRule] = {}
    for name, rule in rules.items():
        if isinstance(rule, dict):
            flat.update({f"{name}_{inner}": r for inner, r in rule.items()})
        else:
            flat[name] = rule
    found = select_fields(pages, html, {n: r for n, r in flat.items() if n != "honoraires"})
    if "honoraires" in flat:
        found = found.withColumn("honoraires", F.lit(""))
    missing = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in flat]))
    filled = {n: F.coalesce(F.col(n), F.lit("")) for n, r in flat.items() if not r.multiple}
    return found.withColumn("champs_manquants", missing).withColumns(filled)
