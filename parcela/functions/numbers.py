"""Numeric, boolean and date parsing as ``Column -> Column`` expressions.

Every function stays null on input it cannot read; none raises under ANSI mode.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters found in the listing texts.
NARROW_SPACE = "\u202f"
HARD_SPACE = "\u00a0"
EURO = "€"

# Characters that count as whitespace, all of Unicode's and the ASCII separators.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Texts read as booleans.
TRUE_WORDS = ["true", "vrai", "oui", "yes", "1", "t"]
LOADER_TRUE_WORDS = ["true", "1", "yes", "oui", "vrai"]

# Score of each energy class.
CLASS_SCORES = {"A": 10, "B": 8, "C": 6, "D": 5, "E": 4, "F": 3, "G": 2}

_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_ISO = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?([+-][0-9]{2}:[0-9]{2})?)?$"
)


def double_to_decimal(c: Column, precision: int, scale: int) -> Column:
    """Decimal of a double that holds a decimal of that scale.

    A plain cast goes through the text of the double; this goes through a 64-bit integer.
    """
    units = F.rint(c * F.lit(float(10**scale))).cast("bigint").cast("decimal(15,0)")
    return (units * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal({precision},{scale})")


def strip(c: Column) -> Column:
    """Remove whitespace at both ends (``trim`` without characters removes U+0020 only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def without(c: Column, characters: str) -> Column:
    """Remove every occurrence of the characters."""
    return F.translate(c, characters, "")


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern``, null when there is none."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def to_float(c: Column) -> Column:
    """Text to double; null where the text is not a plain decimal number."""
    # the match is the whole text or nothing, so the text is made once
    return F.regexp_extract(strip(c), _FLOAT, 0).try_cast("double")


def python_round(x: Column, digits: int = 2) -> Column:
    """Round a double half-even on its exact binary value, as the listing documents do.

    ``round`` and ``bround`` look at the decimal text of the double and differ on about half a
    percent of price/surface quotients.  Here the fraction is taken as a 64-bit integer, so the
    scaled fraction is exact (from 1/16 upwards) and a tie is seen as a tie only if it is one.
    From 2^52 on a double has no fraction and stays as it is.
    """
    scale = 10**digits
    bits = 63 - scale.bit_length()
    limit = F.lit(float(2**52))
    # x is named as seldom as can be: every mention is one more copy of it in the plan and its code
    size = F.least(F.abs(x), limit)
    fraction = (size % F.lit(1.0) * F.lit(float(2**bits))).cast("bigint") * F.lit(scale)
    odd = F.shiftright(fraction, bits).bitwiseAND(F.lit(1))
    rounded = F.shiftright(fraction + F.lit(2 ** (bits - 1) - 1) + odd, bits)
    exact = F.signum(x) * (F.floor(size) * F.lit(scale) + rounded) / F.lit(float(scale))
    return F.when(F.abs(x) < limit, exact).otherwise(x)


def normalise_price(c: Column) -> Column:
    """Price text to double: currency and hard spaces dropped, comma read as point."""
    text = strip(without(c, f"{NARROW_SPACE}{HARD_SPACE}{EURO}"))
    return to_float(F.replace(text, F.lit(","), F.lit(".")))


def clean_price(c: Column) -> Column:
    """Loader variant: ordinary spaces go too, and the whole text must be one number."""
    text = strip(without(c, f" {NARROW_SPACE}{EURO}"))
    return F.when(
        text.rlike(r"^[0-9]+[,.]?[0-9]*$"),
        F.replace(text, F.lit(","), F.lit(".")).try_cast("double"),
    )


def price_to_decimal(c: Column) -> Column:
    """SQL function of the base schema: decimal price, null when unreadable."""
    text = without(c, f" {NARROW_SPACE}{EURO}")
    return F.nullif(text, F.lit("")).try_cast("decimal(12,2)")


def price_digits(c: Column) -> Column:
    """SQL function of the second schema: keeps the digits only, so "12,5" gives 125."""
    return F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit("")).try_cast("decimal(38,0)")


def normalise_number(c: Column) -> Column:
    return to_float(without(c, f"{NARROW_SPACE}{HARD_SPACE}"))


def extract_first_int(c: Column) -> Column:
    return first_match(c, r"([0-9]+)").try_cast("int")


def extract_surface(c: Column) -> Column:
    number = F.replace(first_match(c, r"([0-9]+[,.]?[0-9]*)"), F.lit(","), F.lit("."))
    value = number.try_cast("double")
    return F.when(value > 0, value)


def extract_year(c: Column, as_of_year: int) -> Column:
    year = first_match(c, r"(19[0-9]{2}|20[0-9]{2})").try_cast("int")
    return F.when(year <= as_of_year, year)


def extract_energy_class(c: Column) -> Column:
    """First letter A to G of the upper-cased text; "Classe F" gives C, as the loader does."""
    return first_match(F.upper(c), "([A-G])")


def normalise_boolean(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c)).isin(TRUE_WORDS), F.lit(False))


def number_to_boolean(c: Column) -> Column:
    return F.coalesce(c != 0, F.lit(False))


def extract_boolean(c: Column) -> Column:
    """Loader variant: no trimming."""
    return F.coalesce(F.lower(c).isin(LOADER_TRUE_WORDS), F.lit(False))


def parse_iso_timestamp(c: Column) -> Column:
    """ISO text to timestamp; ``Z`` stands for UTC; null when unreadable."""
    text = F.regexp_replace(c, "Z", "+00:00")
    return F.when(text.rlike(_ISO), F.try_to_timestamp(text))


def parse_extraction_date(c: Column, as_of: str) -> Column:
    return F.coalesce(parse_iso_timestamp(c), F.lit(as_of).cast("timestamp"))


def price_per_m2(price: Column, surface: Column) -> Column:
    """Document variant: both present, non-zero, surface positive."""
    return F.when((price != 0) & (surface > 0), python_round(price / surface))


def price_per_m2_or_given(given: Column, price: Column, surface: Column) -> Column:
    """Loader variant: a given non-zero value wins."""
    return F.coalesce(F.nullif(given, F.lit(0.0)), price_per_m2(price, surface), given)


def price_per_m2_decimal(price: Column, surface: Column) -> Column:
    """SQL variant on decimals, rounded half away from zero."""
    return F.when((price > 0) & (surface > 0), F.round(price / surface, 2).cast("decimal(12,2)"))


def surface_per_room(surface: Column, rooms: Column) -> Column:
    return F.when((surface > 0) & (rooms > 0), python_round(surface / rooms))


def digits_to_int(c: Column) -> Column:
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))


def building_age(year_text: Column, as_of_year: int) -> Column:
    return F.lit(as_of_year) - digits_to_int(year_text)


def energy_score(energy_class: Column) -> Column:
    """Score of a class letter, 0 for anything else."""
    scores = F.create_map(*[F.lit(v) for pair in CLASS_SCORES.items() for v in pair])
    return F.coalesce(F.try_element_at(scores, energy_class), F.lit(0))


def bedrooms_or_fallback(found: Column, rooms: Column) -> Column:
    """Bedrooms named in the features, else one less than the rooms; zero counts as absent."""
    return F.coalesce(F.nullif(found, F.lit(0)).cast("double"), F.when(rooms != 0, rooms - 1))


def exterior_surface(length: Column, width: Column, height: Column) -> Column:
    """Outer surface of a box; computed in 64 bits."""
    a, b, c = (x.cast("bigint") for x in (length, width, height))
    return (F.lit(2) * (a * b + a * c + b * c)).cast("decimal(15,2)")


def truncate_localisation(c: Column) -> Column:
    return F.concat(F.left(c, F.lit(3)), F.lit("***"))
