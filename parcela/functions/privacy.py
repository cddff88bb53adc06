"""Detection and masking of personal data as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcela.functions.numbers import strip

# Patterns of sensitive data.
SENSITIVE_PATTERNS = {
    "telephone": r"\b\d{10}\b",
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "carte": r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b",
}

# What a match must begin with.  Tested first, it saves the Unicode word-boundary test at every
# position of a text; it changes no match.
_FIRST = {"telephone": r"(?=\d)", "email": r"(?=[A-Za-z0-9._%+-])", "carte": r"(?=\d)"}

# Words that open a street address.
STREET_WORDS = ["rue", "avenue", "boulevard", "impasse", "place"]


def pattern(name: str) -> str:
    return f"(?U){_FIRST[name]}{SENSITIVE_PATTERNS[name]}"


def sensitive_count(c: Column, name: str) -> Column:
    """Number of matches of one pattern, 0 for null."""
    found = F.regexp_count(c, F.lit(pattern(name)))
    if name == "email":
        found = F.when(c.contains("@"), found)
    return F.coalesce(found, F.lit(0))


def has_sensitive(c: Column, name: str) -> Column:
    hit = c.rlike(pattern(name))
    return c.contains("@") & hit if name == "email" else hit


def is_sensitive(c: Column) -> Column:
    hit = F.lit(False)
    for name in SENSITIVE_PATTERNS:
        hit = hit | has_sensitive(c, name)
    return F.coalesce(hit, F.lit(False))


def anonymise_name(c: Column) -> Column:
    """First name and initial; anything without two words is "Anonyme"."""
    words = F.filter(F.split(strip(c), r"(?U)\s+"), lambda w: w != "")
    short = F.concat(
        F.try_element_at(words, F.lit(1)), F.lit(" "),
        F.left(F.try_element_at(words, F.lit(2)), F.lit(1)), F.lit("."),
    )
    return F.when(F.size(words) > 1, short).otherwise("Anonyme")


def clean_location(c: Column) -> Column:
    """Location without street number and word, nor postal codes."""
    street = rf"(?iU)\d{{1,4}}\s*({'|'.join(STREET_WORDS)})"
    return strip(F.regexp_replace(F.regexp_replace(c, street, ""), r"(?U)\d{5}", ""))
