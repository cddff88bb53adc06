"""Search, paging and detail queries over the listing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "id_annonce"
PUBLIC_CONTACT = ["nom_complet", "photo", "note"]
ALL_CONTACT = ["nom_complet", "telephone", "lien", "photo", "note"]


def _like(name: str, text: str) -> Column:
    return F.ilike(F.col(name), F.lit(f"%{text}%"))


def search_filter(
    df: DataFrame,
    type_bien: str | None = None,
    min_prix: float | None = None,
    max_prix: float | None = None,
    min_surface: float | None = None,
    max_surface: float | None = None,
    localisation: str | None = None,
) -> DataFrame:
    """Listings that meet every given condition; a bound of 0 is no bound."""
    out = df
    if type_bien:
        out = out.filter(_like("type_bien", type_bien))
    for name, low, high in [("prix", min_prix, max_prix), ("surface", min_surface, max_surface)]:
        if low:
            out = out.filter(F.col(name) >= low)
        if high:
            out = out.filter(F.col(name) <= high)
    if localisation:
        out = out.filter(_like("localisation", localisation) | _like("localisation_complete", localisation))
    return out


def page_results(df: DataFrame, limit: int = 100, offset: int = 0, key: str = KEY) -> DataFrame:
    """One page, newest first."""
    return df.orderBy(F.desc(key)).offset(offset).limit(limit)


def text_search(df: DataFrame, q: str, limit: int = 100, key: str = KEY) -> DataFrame:
    hit = _like("titre", q) | _like("description", q) | _like("localisation", q)
    return df.filter(hit).orderBy(F.desc(key)).limit(limit)


def mask_contact(df: DataFrame, allowed: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Agent columns: all with permission, else name, photo and note only."""
    names = ALL_CONTACT if allowed else PUBLIC_CONTACT
    return df.select(*(keep or [KEY]), *names)


def listing_detail(tables: dict[str, DataFrame], listing: int, mask: bool = True) -> DataFrame:
    """One listing with features, images and agent, energy and co-ownership structs.

    The id narrows every table at its scan; the arrays hold the children of this listing only.
    """
    def rows(name: str) -> DataFrame:
        return tables[name].filter(F.col(KEY) == listing)

    def many(name: str, *columns: str) -> DataFrame:
        return rows(name).groupBy(KEY).agg(
            F.sort_array(F.collect_list(F.struct(*columns))).alias(name)
        )

    def one(df: DataFrame, name: str) -> DataFrame:
        columns = [c for c in df.columns if c != KEY]
        return df.select(KEY, F.struct(*columns).alias(name))

    return (
        rows("annonces")
        .join(many("caracteristiques", "valeur"), KEY, "left")
        .join(many("images", "ordre", "url"), KEY, "left")
        .join(one(mask_contact(rows("conseiller"), not mask), "conseiller"), KEY, "left")
        .join(one(rows("dpe"), "dpe"), KEY, "left")
        .join(one(rows("copropriete"), "copropriete"), KEY, "left")
    )


def all_details(tables: dict[str, DataFrame], mask: bool = True) -> DataFrame:
    """The details of every listing in long form: one row per listing, section, rank and field.

    Nothing is grouped, so a listing with very many features or images stays many rows.
    """
    def field_rows(name: str, df: DataFrame) -> DataFrame:
        names = [c for c in df.columns if c != KEY]
        pairs = [F.struct(F.lit(n).alias("champ"), F.col(n).cast("string").alias("valeur")) for n in names]
        return df.select(
            KEY, F.lit(name).alias("section"), F.lit(0).alias("ordre"), F.inline(F.array(*pairs))
        )

    singles = [
        field_rows("conseiller", mask_contact(tables["conseiller"], not mask)),
        field_rows("dpe", tables["dpe"]),
        field_rows("copropriete", tables["copropriete"]),
    ]
    listed = [
        tables["caracteristiques"].select(
            KEY, F.lit("caracteristiques").alias("section"), F.lit(0).alias("ordre"),
            F.lit("valeur").alias("champ"), "valeur"),
        tables["images"].select(
            KEY, F.lit("images").alias("section"), "ordre", F.lit("url").alias("champ"),
            F.col("url").alias("valeur")),
    ]
    out = listed[0]
    for part in [*listed[1:], *singles]:
        out = out.unionByName(part)
    return out.join(tables["annonces"].select(KEY), KEY, "left_semi").filter(F.col("valeur").isNotNull())


def listing_by_reference(df: DataFrame, reference: str) -> DataFrame:
    return df.filter(F.col("reference") == reference)


def public_sample(df: DataFrame, limit: int = 10, key: str = KEY) -> DataFrame:
    return (
        df.orderBy(F.desc(key)).limit(limit)
        .select("reference", "titre", "prix", "surface", "localisation")
    )


def distinct_types(df: DataFrame) -> DataFrame:
    return df.filter(F.col("type_bien").isNotNull()).select("type_bien").distinct()


def distinct_locations(df: DataFrame, limit: int = 50) -> DataFrame:
    """Distinct locations, the first ``limit`` in alphabetical order."""
    return (
        df.filter(F.col("localisation").isNotNull()).select("localisation").distinct()
        .orderBy("localisation").limit(limit)
    )
