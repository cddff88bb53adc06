"""Field extraction from raw HTML as column expressions, driven by rules."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcela.functions.numbers import first_match, strip
from parcela.functions.text import clean_photo_url

# Entities that page texts use, with what they stand for.
ENTITIES = {"&nbsp;": "\u00a0", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


@dataclass(frozen=True)
class FieldRule:
    """Where a field is found in a page.

    ``pattern`` has one group: the element's inner HTML or the attribute value; its tag and
    attribute names, written in lower case, match in any case.  ``regex`` refines
    the text; text it does not match is kept whole.  ``multiple`` gives every hit as an array.
    ``literal`` gives a fixed text.
    """

    pattern: str = ""
    regex: str | None = None
    multiple: bool = False
    attribute: bool = False
    literal: str | None = None


def text_of(inner_html: Column) -> Column:
    """Text content: tags removed, entities decoded; plain text is passed through."""
    text = F.regexp_replace(inner_html, r"(?s)<[^>]*>", "")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.when(inner_html.contains("<") | inner_html.contains("&"), text).otherwise(inner_html)


def _both_cases(name: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name)


def markup(pattern: str) -> str:
    """A pattern whose tag and attribute names match in any case.

    Only the names are spelled in both cases: a case-insensitive pattern would compare every
    character of a page that way, and could not skip to the next ``<``.
    """
    def names(match: re.Match) -> str:
        words = [_both_cases(w) for w in match[2].split("|")]
        return f"<{match[1]}" + (words[0] if len(words) == 1 else f"(?:{'|'.join(words)})")

    pattern = re.sub(r"<(/?)(?:\(\?:)?([a-z][a-z0-9|]*)(?:(?<=[a-z0-9])\))?", names, pattern)
    return "(?s)" + re.sub(r"\b(class|href|src|alt)=", lambda m: f"{_both_cases(m[1])}=", pattern)


_TAG = r"^([a-zA-Z][a-zA-Z0-9-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
_ATTRIBUTE = r"[a-zA-Z_:][a-zA-Z0-9_:.-]*\s*=\s*(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++)"
#: A page with single-quoted or bare values, spaces around "=", or a class behind another attribute.
_UNEVEN = (r"(?i)<[a-z][^<>]*?\s(?:(?:class|href|src|alt)\s*=\s*(?:'|[^\s\"'>])|(?:class|href|src|alt)(?:\s+=|=\s)"
           r"|[a-z-]+\s*=\s*(?:\"[^\"]*\"|'[^']*')[^<>]*?\sclass\s*=)")
#: What every such page holds, wherever it stands: looked for first, as it only stops at spaces.
_SUSPECT = (r"\s(?:(?=[cChHsSaA])(?i:class|href|src|alt)(?:\s*=\s*(?:'|[^\s\"'>])|\s+=|=\s)"
            r"|(?=[cC][lL][aA][sS][sS]\s*=)(?<!<[a-zA-Z0-9]{1,10}\s))")


def canonical(html: Column) -> Column:
    """The page with every tag's attributes in one form: class first, then by name, values in double quotes.

    Rules need not know the order of attributes nor their quotes.  Pages that are in that form are left as they are.
    """
    def attribute(text: Column) -> Column:
        name = F.lower(F.regexp_extract(text, r"^([^=\s]+)", 1))
        value = F.regexp_replace(F.regexp_extract(text, r"(?s)=\s*(.*)$", 1), "^[\"']|[\"']$", "")
        for char, entity in (('"', "&quot;"), (">", "&gt;")):
            value = F.replace(value, F.lit(char), F.lit(entity))
        return F.struct((name != "class").alias("late"), name.alias("name"), value.alias("value"))

    def tag(chunk: Column) -> Column:
        pairs = F.sort_array(F.transform(
            F.regexp_extract_all(F.regexp_extract(chunk, _TAG, 2), F.lit(_ATTRIBUTE), 0), attribute))
        written = F.array_join(F.transform(pairs, lambda p: F.concat(F.lit(" "), p["name"], F.lit('="'), p["value"], F.lit('"'))), "")
        whole = F.concat(F.regexp_extract(chunk, _TAG, 1), written, F.lit(">"), F.regexp_replace(chunk, _TAG, ""))
        return F.when(chunk.rlike(_TAG) & F.regexp_extract(chunk, _TAG, 2).contains("="), whole).otherwise(chunk)

    return F.when(html.rlike(_SUSPECT) & html.rlike(_UNEVEN), F.array_join(F.transform(F.split(html, "<", -1), tag), "<")).otherwise(html)


def found(html: Column, rule: FieldRule) -> Column:
    """What the pattern of a rule finds: the first hit, or all of them."""
    if rule.literal is not None:
        return F.lit(rule.literal)
    if rule.multiple:
        return F.regexp_extract_all(html, F.lit(markup(rule.pattern)), 1)
    return first_match(html, markup(rule.pattern))


def refined(value: Column, rule: FieldRule) -> Column:
    """Text of one hit.  The regex keeps its first group; text it does not match stays whole."""
    text = value if rule.attribute or rule.literal is not None else text_of(value)
    if rule.regex:
        text = F.regexp_replace(text, f"(?s:^.*?)(?:{rule.regex})(?s:.*)$", "$1")
    return strip(text)


def field(hit: Column, rule: FieldRule) -> Column:
    """Value of a rule from what was found; null when the page has no such element."""
    if rule.multiple:
        texts = F.filter(F.transform(hit, lambda x: refined(x, rule)), lambda x: x != "")
        return F.when(F.size(texts) > 0, texts)
    return F.nullif(refined(hit, rule), F.lit(""))


def select_fields(
    pages: DataFrame, html: str, rules: dict[str, FieldRule], default: str | None = None
) -> DataFrame:
    """The pages with one column per rule.

    The hits are one projection and their texts the next, so each pattern runs once per page.
    """
    hits = pages.select(
        "*", *[found(F.col(html), rule).alias(f"_hit_{name}") for name, rule in rules.items()]
    )

    def value(name: str, rule: FieldRule) -> Column:
        text = field(F.col(f"_hit_{name}"), rule)
        return F.coalesce(text, F.lit(default)) if default is not None and not rule.multiple else text

    return hits.select(*pages.columns, *[value(n, r).alias(n) for n, r in rules.items()])


def definition_rule(label: str) -> FieldRule:
    """The ``<dd>`` that follows the ``<dt>`` holding the label."""
    return FieldRule(rf"<dt[^>]*>[^<]*(?iu:{label})[^<]*</dt>\s*<dd[^>]*>(.*?)</dd>")


# Labels of the co-ownership block.
COOWNERSHIP_LABELS = {
    "copropriete_nb_lots": "Nombre de lots",
    "copropriete_charges_previsionnelles": "Charges prévisionnelles",
    "copropriete_procedures": "Procédures",
}

# The agent block of a detail page.
AGENT_RULES = {
    "conseiller_nom_complet": FieldRule(
        r"<a[^>]*class=\"[^\"]*flex-col[^\"]*\"[^>]*>.*?<p[^>]*class=\"[^\"]*text-xl[^\"]*\"[^>]*>(.*?)</p>"
    ),
    "conseiller_telephone": FieldRule(
        r"<button[^>]*>\s*<span[^>]*>([^<]*\+33[^<]*)</span>", regex=r"(\+33[\d\s]+)"
    ),
    "conseiller_lien": FieldRule(
        r"<a[^>]*class=\"[^\"]*flex-col[^\"]*\"[^>]*href=\"([^\"]*)\"", attribute=True
    ),
    "conseiller_photo": FieldRule(
        r"<a[^>]*class=\"[^\"]*flex-col[^\"]*\"[^>]*>.*?<img[^>]*class=\"[^\"]*size-full[^\"]*\"[^>]*src=\"([^\"]*)\"",
        attribute=True,
    ),
    "conseiller_note": FieldRule(r"<[a-z][^>]*class=\"[^\"]*rating[^\"]*\"[^>]*>(.*?)</"),
    "conseiller_nombre_avis": FieldRule(r"<[a-z][^>]*class=\"[^\"]*avis[^\"]*\"[^>]*>(.*?)</"),
}

# The energy panel of a detail page.
_PANEL = r"<div[^>]*class=\"[^\"]*{kind}[^\"]*\"[^>]*>.*?<li[^>]*class=\"[^\"]*border-white[^\"]*\"[^>]*>\s*<span[^>]*>(.*?)</span>"
ENERGY_RULES = {
    "dpe_classe_active": FieldRule(_PANEL.replace("{kind}", "panel-dpe")),
    "ges_classe_active": FieldRule(_PANEL.replace("{kind}", "panel-ges")),
    "dpe_consommation_energie_primaire": FieldRule(
        r"border-epc-[A-G][^>]*>.*?<p[^>]*class=\"(?:[^\"]*\s)?flex(?:\s[^\"]*)?\"[^>]*>\s*<span[^>]*class=\"(?:[^\"]*\s)?text-base(?:\s[^\"]*)?\"[^>]*>(.*?)</span>"
    ),
    "dpe_consommation_energie_finale": FieldRule(
        r"border-epc-[A-G][^>]*>.*?</p>\s*<span[^>]*class=\"(?:[^\"]*\s)?text-base(?:\s[^\"]*)?\"[^>]*>(.*?)</span>"
    ),
    "dpe_emissions": FieldRule(
        r"border-epc-[A-G][^>]*>.*?<p[^>]*class=\"(?:[^\"]*\s)?grid(?:\s[^\"]*)?\"[^>]*>\s*<span[^>]*class=\"(?:[^\"]*\s)?text-base(?:\s[^\"]*)?\"[^>]*>(.*?)</span>"
    ),
    "ges_emissions": FieldRule(
        r"border-ges-[A-G][^>]*>.*?<p[^>]*class=\"(?:[^\"]*\s)?grid(?:\s[^\"]*)?\"[^>]*>\s*<span[^>]*class=\"(?:[^\"]*\s)?text-base(?:\s[^\"]*)?\"[^>]*>(.*?)</span>"
    ),
    "depenses_energie_min": FieldRule(
        r"<div[^>]*class=\"(?:[^\"]*\s)?text-sm(?:\s[^\"]*)?\"[^>]*>\s*<p[^>]*>(.*?)</p>", regex=r"(?U)(\d+\s*€)"
    ),
    "depenses_energie_max": FieldRule(
        r"<div[^>]*class=\"(?:[^\"]*\s)?text-sm(?:\s[^\"]*)?\"[^>]*>\s*<p[^>]*>.*?</p>\s*<p[^>]*>(.*?)</p>", regex=r"(?U)(\d+\s*€)"
    ),
    "titre_section": FieldRule(r"<section[^>]*class=\"[^\"]*flex[^\"]*\"[^>]*>.*?<h3[^>]*>(.*?)</h3>"),
    "dpe_description": FieldRule(r"<div[^>]*class=\"[^\"]*panel-dpe[^\"]*\"[^>]*>.*?<p[^>]*>(.*?)</p>"),
    "ges_description": FieldRule(r"<div[^>]*class=\"[^\"]*panel-ges[^\"]*\"[^>]*>.*?<p[^>]*>(.*?)</p>"),
    "annee_reference": FieldRule(literal="2025"),
}


def legend(html: Column, kind: str) -> Column:
    """Captions of an energy panel ("panel-dpe", "panel-ges")."""
    block = first_match(html, markup(rf"<div[^>]*class=\"[^\"]*{kind}[^\"]*\"[^>]*>(.*?)</div>"))
    hits = F.regexp_extract_all(block, F.lit(markup(r"<em[^>]*>(.*?)</em>")), 1)
    texts = F.filter(F.transform(hits, lambda x: strip(text_of(x))), lambda x: x != "")
    return F.coalesce(texts, F.array().cast("array<string>"))


def gallery_images(html: Column) -> Column:
    """The image tags of the page's gallery."""
    block = first_match(html, markup(r"<ul[^>]*class=\"[^\"]*flex-col[^\"]*\"[^>]*>(.*?)</ul>"))
    return F.regexp_extract_all(block, F.lit(markup(r"(<img[^>]+>)")), 1)


def gallery(images: Column) -> Column:
    """Photos with an address as an array of structs, numbered among all images."""
    total = F.size(images)

    def photo(tag: Column, i: Column) -> Column:
        source = F.nullif(F.regexp_extract(tag, r"(?i)\ssrc=\"([^\"]*)\"", 1), F.lit(""))
        return F.struct(
            clean_photo_url(source).alias("url"),
            source.alias("url_original"),
            F.regexp_extract(tag, r"(?i)\salt=\"([^\"]*)\"", 1).alias("alt"),
            (i + 1).alias("ordre"),
            F.format_string("Photo %d/%d", i + 1, total).alias("description"),
        )

    return F.filter(F.transform(images, photo), lambda p: p["url"].isNotNull())
