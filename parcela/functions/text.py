"""Text, array and URL extraction as ``Column -> Column`` expressions.

``(?U)`` lets ``\\s`` and ``\\b`` follow Unicode, so hard spaces count as whitespace.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcela.functions.numbers import (
    EURO, HARD_SPACE, NARROW_SPACE, first_match, strip, to_float, without,
)

# Features that the structured fields already hold.
COVERED_FEATURES = ["chambre", "pièces", "m²", "étage", "construit"]

# Feature categories in order of precedence, with their keywords.
FEATURE_CATEGORIES = {
    "chauffage": ["chauffage", "climatisation"],
    "equipements": ["cuisine", "salle de bain", "salle d'eau"],
    "dependances": ["parking", "garage", "cave"],
    "exterieur": ["terrasse", "balcon", "jardin"],
    "securite": ["digicode", "interphone", "alarme"],
}

_FLOOR = r"(?U)étage\s*(\d+)\s*(?:sur|/)\s*(\d+)"
_BEDROOM = r"(?U)(\d+)\s*chambre"


def contains_any(c: Column, words: list[str]) -> Column:
    """True when one of the fixed words occurs in the text."""
    hit = F.lit(False)
    for word in words:
        hit = hit | c.contains(word)
    return hit


def collapse_whitespace(c: Column) -> Column:
    """Runs of whitespace to one space; ASCII whitespace, as in the Spark job."""
    return F.regexp_replace(c, r"\s+", " ")


def postal_code_in_brackets(c: Column) -> Column:
    return first_match(c, r"\(([0-9]{5})\)")


def city(c: Column) -> Column:
    return F.when(c != "", strip(F.regexp_replace(c, r"(?U)\s*\([0-9]{5}\)", "")))


def split_localisation(c: Column) -> Column:
    return F.struct(city(c).alias("ville"), postal_code_in_brackets(c).alias("code_postal"))


def extract_district(c: Column) -> Column:
    return first_match(c, r"(?U)Quartier\s+([^,.]+)")


def extract_proximity(c: Column) -> Column:
    station = first_match(c, r"(?iU)métro\s+([^,.]+)")
    return F.nullif(
        F.concat_ws(
            ", ",
            F.when(c.contains("Buttes Chaumont"), F.lit("Buttes Chaumont")),
            F.concat(F.lit("métro "), station),
        ),
        F.lit(""),
    )


def lowered(texts: Column) -> Column:
    """Every text in lower case; a column of its own where several functions look into it."""
    return F.transform(texts, lambda x: F.lower(x))


def floor_info(features: Column, low: Column | None = None) -> Column:
    """Floor, number of floors and lift; the last feature naming a floor wins.

    "Sans ascenseur" counts as a lift: the word alone decides.  ``low`` may give the features in lower case.
    """
    low = lowered(features) if low is None else low
    # the plain word is looked for first: few features come to the pattern
    named = F.try_element_at(F.filter(low, lambda x: x.contains("étage") & x.rlike(_FLOOR)), F.lit(-1))
    return F.struct(
        F.regexp_extract(named, _FLOOR, 1).try_cast("int").alias("etage"),
        F.regexp_extract(named, _FLOOR, 2).try_cast("int").alias("etage_total"),
        F.coalesce(F.exists(low, lambda x: x.contains("ascenseur")), F.lit(False)).alias("ascenseur"),
    )


def bedroom_count(features: Column, low: Column | None = None) -> Column:
    low = lowered(features) if low is None else low
    named = F.try_element_at(F.filter(low, lambda x: x.contains("chambre") & x.rlike(_BEDROOM)), F.lit(1))
    return F.regexp_extract(named, _BEDROOM, 1).try_cast("int")


def _strings() -> Column:
    return F.array().cast("array<string>")


def clean_features(features: Column, low: Column | None = None) -> Column:
    """Features not covered elsewhere, each once, in first-seen order."""
    low = lowered(features) if low is None else low
    kept = F.zip_with(features, low, lambda x, y: F.when(~contains_any(y, COVERED_FEATURES), x))
    return F.coalesce(F.array_distinct(F.array_compact(kept)), _strings())


def before_query(url: Column) -> Column:
    return F.split_part(url, F.lit("?"), F.lit(1))


def clean_images(images: Column) -> Column:
    return F.coalesce(F.array_distinct(F.transform(images, before_query)), _strings())


def charge_text(c: Column) -> Column:
    return without(c, f"{NARROW_SPACE}{HARD_SPACE}")


def parse_service_charge(c: Column, text: Column | None = None, low: Column | None = None) -> Column:
    """Amount, unit and period of a service charge; all null when no amount is found.

    ``text`` may give its :func:`charge_text` as a column and ``low`` the same in lower case: both are named many times.
    """
    text = charge_text(c) if text is None else text
    low = F.lower(text) if low is None else low
    amount = F.replace(first_match(text, r"([0-9]+(?:[.,][0-9]+)?)"), F.lit(","), F.lit("."))
    yearly = contains_any(low, ["/ an", "annuel"])
    quarterly = contains_any(low, ["/ trim", "trimestriel"])
    monthly = contains_any(low, ["/ mois", "/mois", "mensuel"])
    period = (
        F.when(yearly, "annuel")
        .when(quarterly, "trimestriel")
        .when(monthly, "mensuel")
        .when(text.contains(EURO), "annuel")
    )
    unit = (
        F.when(yearly, "€ / an")
        .when(quarterly, "€ / trim")
        .when(monthly, "€ / mois")
        .when(text.contains(EURO), "€")
    )
    return F.struct(
        amount.try_cast("double").alias("valeur"),
        F.when(amount.isNotNull(), unit).alias("unite"),
        F.when(amount.isNotNull(), period).alias("periode"),
    )


def extract_charge_amount(c: Column) -> Column:
    """Loader variant: first number once spaces are removed."""
    text = without(c, f" {NARROW_SPACE}")
    number = first_match(text, r"(?U)([0-9]+\s?[0-9]*[,.]?[0-9]*)")
    return to_float(F.replace(number, F.lit(","), F.lit(".")))


def categorise_feature(c: Column) -> Column:
    low = F.lower(c)
    chain = None
    for category, words in FEATURE_CATEGORIES.items():
        hit = contains_any(low, words)
        chain = F.when(hit, category) if chain is None else chain.when(hit, category)
    return chain.otherwise("autres")


def parse_media_text(c: Column) -> Column:
    low = F.lower(c)
    photos = first_match(c, r"(?iU)([0-9]+)\s*photos?").try_cast("int")
    return F.struct(
        F.coalesce(strip(c), F.lit("")).alias("media_description"),
        F.coalesce(photos, F.lit(0)).alias("nombre_photos"),
        F.coalesce(contains_any(low, ["vidéo", "video"]), F.lit(False)).alias("has_video"),
        F.coalesce(low.contains("visite virtuelle"), F.lit(False)).alias("has_visite_virtuelle"),
    )


def absolute_url(c: Column, base: str) -> Column:
    return F.when((c == "") | c.startswith("http"), c).otherwise(F.concat(F.lit(base), c))


def clean_photo_url(c: Column) -> Column:
    """Photo address without the small-size parameters."""
    marker = "?format=auto&width="
    cut = F.when(
        c.contains(marker),
        F.concat(F.split_part(c, F.lit(marker), F.lit(1)), F.lit("?format=auto")),
    ).otherwise(c)
    return (
        F.when(cut.contains("width=390"), F.replace(cut, F.lit("width=390"), F.lit("width=1200")))
        .when(cut.contains("width=780"), F.replace(cut, F.lit("width=780"), F.lit("width=1200")))
        .otherwise(cut)
    )


def contact_photo_url(c: Column) -> Column:
    return F.when(c != "", before_query(c))


def postal_code_anywhere(title: Column, location: Column) -> Column:
    five = r"(?U)\b([0-9]{5})\b"
    return F.coalesce(first_match(title, five), first_match(location, five))


def description_length_bucket(c: Column) -> Column:
    n = F.length(c)
    return (
        F.when(n < 100, "Description courte")
        .when(n <= 500, "Description moyenne")
        .when(n > 500, "Description détaillée")
        .otherwise("Pas de description")
    )
