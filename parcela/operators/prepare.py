"""Raw listings to cleaned rows and nested documents: narrow projections, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcela.functions import numbers as num
from parcela.functions import text as txt
from parcela.schemas import (
    BOOLEAN_PATHS, DATE_PATHS, MAPPED_PATHS, NUMERIC_PATHS, RAW_ARRAY_FIELDS, RAW_TEXT_FIELDS,
)

# Names of the preparation steps kept in the document.
STEPS = [
    "normalisation_numerique", "extraction_geographique", "extraction_caracteristiques",
    "traitement_medias", "calcul_scores", "structuration_finale",
]
SCORED_FIELDS = ["prix", "surface", "pieces", "code_postal"]


def missing_fields(values: dict[str, Column]) -> Column:
    """Names of the null values, in the given order."""
    return F.array_compact(F.array(*[F.when(v.isNull(), F.lit(n)) for n, v in values.items()]))


def quality_score(values: list[Column]) -> Column:
    filled = sum((v.isNotNull().cast("int") for v in values), F.lit(0))
    return filled / F.lit(len(values)) * F.lit(10.0)


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def prepare_listings(
    raw: DataFrame, as_of_year: int, invert_procedures: bool = True, keep: list[str] | None = None
) -> DataFrame:
    """One nested document per raw listing; ``keep`` names columns to carry along.

    ``invert_procedures`` keeps the known quirk that an empty text means a running procedure.
    Optional index columns ``dpe_score`` and ``ges_score`` are read when present.
    """
    def optional(name: str) -> Column:
        return F.col(name) if name in raw.columns else F.lit(None).cast("string")

    features, low = F.col("caracteristiques_detaillees"), F.col("_bas")
    charges = F.col("copropriete_charges_previsionnelles")
    # texts that several fields look into are made once, as columns
    parsed = raw.withColumns({
        "_bas": txt.lowered(features), "_frais": txt.charge_text(charges), "_frais_bas": F.lower(txt.charge_text(charges)),
    }).select(
        "*",
        num.normalise_price(F.col("prix")).alias("_prix"),
        num.normalise_number(F.col("surface")).alias("_surface"),
        num.normalise_number(F.col("pieces")).alias("_pieces"),
        txt.split_localisation(F.col("localisation")).alias("_lieu"),
        txt.floor_info(features, low).alias("_etage"),
        txt.bedroom_count(features, low).alias("_chambres"),
        txt.clean_images(F.col("images")).alias("_images"),
        num.digits_to_int(F.col("annee_construction")).alias("_annee"),
    )
    scored = dict(zip(
        SCORED_FIELDS,
        [F.col("_prix"), F.col("_surface"), F.col("_pieces"), F.col("_lieu.code_postal")],
        strict=True,
    ))
    procedures = _text("copropriete_procedures") != ""

    def diagnostic(kind: str) -> Column:
        label = F.col(f"{kind}_classe_active")
        return F.struct(
            label.alias("classe"),
            num.energy_score(label).alias("score"),
            num.digits_to_int(optional(f"{kind}_score")).alias("indice"),
        ).alias(kind)

    return parsed.select(
        *(keep or []),
        "reference",
        "titre",
        F.struct(
            F.col("_prix").alias("valeur"),
            F.lit("€").alias("devise"),
            num.price_per_m2(F.col("_prix"), F.col("_surface")).alias("au_m2"),
        ).alias("prix"),
        F.struct(F.col("_surface").alias("valeur"), F.lit("m²").alias("unite")).alias("surface"),
        F.struct(
            F.col("_pieces").alias("pieces"),
            num.bedrooms_or_fallback(F.col("_chambres"), F.col("_pieces")).alias("chambres"),
            F.col("type_bien"),
        ).alias("composition"),
        F.struct(
            F.col("_lieu.ville"),
            F.col("_lieu.code_postal"),
            txt.extract_district(F.col("description")).alias("quartier"),
            txt.extract_proximity(F.col("description")).alias("proximite"),
        ).alias("localisation"),
        "description",
        txt.clean_features(features, low).alias("caracteristiques"),
        F.struct(
            F.col("_annee").alias("annee_construction"),
            (F.lit(as_of_year) - F.col("_annee")).alias("age_bien"),
            F.col("_etage.etage"),
            F.col("_etage.etage_total"),
            F.col("_etage.ascenseur"),
        ).alias("batiment"),
        F.struct(diagnostic("dpe"), diagnostic("ges")).alias("diagnostics"),
        F.struct(
            num.normalise_number(F.col("copropriete_nb_lots")).alias("nb_lots"),
            txt.parse_service_charge(charges, F.col("_frais"), F.col("_frais_bas")).alias("charges"),
            (~procedures if invert_procedures else procedures).alias("procedures_en_cours"),
        ).alias("copropriete"),
        F.struct(
            F.col("_images").alias("images"),
            F.size("_images").alias("nombre_photos"),
            num.normalise_boolean(F.col("has_video")).alias("has_video"),
            num.normalise_boolean(F.col("has_visite_virtuelle")).alias("has_visite_virtuelle"),
            (F.size("_images") > 0).alias("has_photo"),
        ).alias("medias"),
        F.struct(
            F.col("conseiller_nom_complet").alias("conseiller"),
            F.col("conseiller_telephone").alias("telephone"),
            txt.contact_photo_url(F.col("conseiller_photo")).alias("photo"),
            F.col("conseiller_lien").alias("lien"),
        ).alias("contact"),
        F.col("lien").alias("url_annonce"),
        F.struct(
            F.col("date_extraction"),
            quality_score(list(scored.values())).alias("score_qualite"),
            missing_fields(scored).alias("champs_manquants"),
            F.array(*[F.lit(s) for s in STEPS]).alias("etapes_traitees"),
        ).alias("metadata"),
    )


def clean_loader_row(raw: DataFrame, as_of: str) -> DataFrame:
    """Flat cleaned row of the relational load; ``as_of`` replaces unreadable dates."""
    year = int(as_of[:4])
    parsed = raw.withColumns({
        "_prix": num.clean_price(F.col("prix")),
        "_au_m2": num.clean_price(F.col("prix_au_m2")),
        "_surface": num.extract_surface(F.col("surface")),
    })
    cleaned = {name: num.strip(_text(name)) for name in RAW_TEXT_FIELDS}
    cleaned |= {
        "prix": F.col("_prix"),
        "prix_au_m2": num.price_per_m2_or_given(F.col("_au_m2"), F.col("_prix"), F.col("_surface")),
        "surface": F.col("_surface"),
        "surface_terrain": num.extract_surface(F.col("surface_terrain")),
        "pieces": num.extract_first_int(F.col("pieces")),
        "annee_construction": num.extract_year(F.col("annee_construction"), year),
        "nombre_photos": num.extract_first_int(F.col("nombre_photos")),
        "has_video": num.extract_boolean(F.col("has_video")),
        "has_visite_virtuelle": num.extract_boolean(F.col("has_visite_virtuelle")),
        "date_extraction": num.parse_extraction_date(F.col("date_extraction"), as_of),
        "dpe_classe_active": num.extract_energy_class(F.col("dpe_classe_active")),
        "ges_classe_active": num.extract_energy_class(F.col("ges_classe_active")),
        "annee_reference": num.extract_year(F.col("annee_reference"), year),
        "copropriete_nb_lots": num.extract_first_int(F.col("copropriete_nb_lots")),
    }
    extra = [c for c in raw.columns if c not in RAW_TEXT_FIELDS and c not in RAW_ARRAY_FIELDS]
    return parsed.select(
        *extra,
        *[c.alias(n) for n, c in cleaned.items()],
        F.col("caracteristiques_detaillees").alias("caracteristiques"),
        F.col("images"),
    )


def _prune(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        fields = [_prune(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        inner = F.transform(c, lambda x: _prune(x, dtype.elementType))
        compact = F.array_compact(inner)
        return F.when(F.size(compact) > 0, compact)
    return c


def prune_empty(df: DataFrame) -> DataFrame:
    """Empty arrays become null at every depth; null keys vanish in the JSON writer.

    Zero, false and empty structs stay.
    """
    return df.select(*[_prune(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def _find(schema: T.StructType, path: str) -> T.DataType | None:
    current: T.DataType = schema
    for part in path.split("."):
        if not isinstance(current, T.StructType) or part not in current.names:
            return None
        current = current[part].dataType
    return current


def get_nested_value(df: DataFrame, path: str) -> Column:
    """The column at a dotted path, null when the schema has no such path."""
    return F.col(path) if _find(df.schema, path) is not None else F.lit(None).cast("string")


def map_fields(
    df: DataFrame,
    paths: list[str] = MAPPED_PATHS,
    numeric: list[str] = NUMERIC_PATHS,
    dates: list[str] = DATE_PATHS,
    booleans: list[str] = BOOLEAN_PATHS,
) -> DataFrame:
    """Flat projection of nested paths, typed by the rules; ``a.b`` gives column ``a_b``."""
    def typed(path: str) -> Column:
        value = get_nested_value(df, path)
        if path in numeric:
            return value.try_cast("double")
        if path in dates:
            return num.parse_iso_timestamp(value.cast("string"))
        if path in booleans:
            return num.normalise_boolean(value.cast("string"))
        return value

    return df.select(*[typed(p).alias(p.replace(".", "_")) for p in paths])


def flatten_listing(df: DataFrame, imported_at: str) -> DataFrame:
    """Seventeen flat columns of a nested listing, with EUR and m² as defaults."""
    def at(path: str) -> Column:
        return get_nested_value(df, path)

    return df.select(
        num.strip(F.coalesce(at("reference"), F.lit(""))).alias("reference"),
        F.lit(imported_at).cast("timestamp").alias("date_import"),
        at("composition.type_bien").alias("composition_type_bien"),
        at("composition.pieces").try_cast("int").alias("composition_nb_pieces"),
        at("composition.chambres").try_cast("int").alias("composition_nb_chambres"),
        at("prix.valeur").try_cast("double").alias("prix_valeur"),
        F.coalesce(at("prix.devise"), F.lit("EUR")).alias("prix_devise"),
        at("surface.valeur").try_cast("double").alias("surface_valeur"),
        F.coalesce(at("surface.unite"), F.lit("m²")).alias("surface_unite"),
        at("localisation.ville").alias("localisation_ville"),
        at("localisation.code_postal").alias("localisation_code_postal"),
        at("localisation.departement").alias("localisation_departement"),
        at("localisation.region").alias("localisation_region"),
        at("metadata.source").alias("metadata_source"),
        num.parse_iso_timestamp(at("metadata.date_extraction").cast("string")).alias(
            "metadata_date_extraction"
        ),
        at("description").alias("description"),
        F.coalesce(at("url"), at("url_annonce")).alias("url"),
    )
