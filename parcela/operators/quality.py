"""Validity filters, quality metrics, constraint and key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcela.functions.numbers import strip
from parcela.operators.quantiles import quantile_of, rank_counts

# Constraints of the base model.
BASE_RULES = {
    "chk_prix_positif": "prix > 0 OR prix IS NULL",
    "chk_surface_positif": "surface > 0 OR surface IS NULL",
    "chk_surface_terrain_positif": "surface_terrain > 0 OR surface_terrain IS NULL",
    "chk_pieces_positif": "pieces > 0 OR pieces IS NULL",
    "chk_dpe_classe": "dpe_classe_active IN ('A','B','C','D','E','F','G') OR dpe_classe_active IS NULL",
    "chk_ges_classe": "ges_classe_active IN ('A','B','C','D','E','F','G') OR ges_classe_active IS NULL",
}
# Constraints of the prepared model, on the flat view of the modules.
PREPARED_RULES = {
    "chk_prix_positif": "prix > 0 OR prix IS NULL",
    "chk_prix_m2_positif": "prix_au_m2 > 0 OR prix_au_m2 IS NULL",
    "chk_surface_positif": "surface > 0 OR surface IS NULL",
    "chk_pieces_positif": "pieces > 0 OR pieces IS NULL",
    "chk_chambres_positif": "chambres >= 0 OR chambres IS NULL",
    "chk_age_bien_positif": "age_bien >= 0 OR age_bien IS NULL",
    "chk_etage_positif": "etage >= 0 OR etage IS NULL",
    "chk_dpe_classe": "dpe_classe IN ('A','B','C','D','E','F','G') OR dpe_classe IS NULL",
    "chk_ges_classe": "ges_classe IN ('A','B','C','D','E','F','G') OR ges_classe IS NULL",
    "chk_dpe_score": "dpe_score BETWEEN 0 AND 10 OR dpe_score IS NULL",
    "chk_ges_score": "ges_score BETWEEN 0 AND 10 OR ges_score IS NULL",
}
# Constraints of the aggregate model.
AGGREGATE_RULES = {
    "chk_score_global": "score_global BETWEEN 0 AND 10 OR score_global IS NULL",
    "chk_prix_m2_positif": "prix_m2_calcule > 0 OR prix_m2_calcule IS NULL",
    "chk_rendement_positif": "rendement_annuel_estime >= 0 OR rendement_annuel_estime IS NULL",
    "chk_scores_range": (
        "score_emplacement BETWEEN 0 AND 10 AND score_modernite BETWEEN 0 AND 10 "
        "AND score_dpe BETWEEN 0 AND 10 AND score_equipements BETWEEN 0 AND 10 "
        "AND score_accessibilite BETWEEN 0 AND 10 AND score_medias BETWEEN 0 AND 10"
    ),
    "chk_segment_prix": (
        "segment_prix_m2 IN ('economique','moyen','superieur','premium','luxe') "
        "OR segment_prix_m2 IS NULL"
    ),
    "chk_segment_surface": (
        "segment_surface IN ('studio','appartement','grand_appartement','maison','grande_maison') "
        "OR segment_surface IS NULL"
    ),
    "chk_segment_age": (
        "segment_age IN ('neuf','recent','ancien','tres_ancien','patrimoine') "
        "OR segment_age IS NULL"
    ),
    "chk_positionnement": (
        "positionnement_marche IN ('tres_sous_cote','sous_cote','dans_la_moyenne','sur_cote',"
        "'tres_sur_cote','non_determine') OR positionnement_marche IS NULL"
    ),
}
RECOMMENDATION_RULES = {
    "chk_priorite": "priorite IN ('basse','moyenne','haute','critique')",
    "chk_type_recommandation": "type_recommandation IN ('prix','marketing','amelioration','ciblage')",
}
# Constraints of the commerce model.
CLIENT_RULES = {"chk_id_client": r"id_client RLIKE '^[a-z]{2}-\\d+$'"}
BOX_RULES = {
    "chk_longueur": "longueur_mm <= 1000",
    "chk_largeur": "largeur_mm <= 1000",
    "chk_hauteur": "hauteur_mm <= 1000",
}


def filter_valid(df: DataFrame, required: list[str], reference: str = "reference") -> DataFrame:
    """Rows whose required fields are filled and whose reference is not blank."""
    keep = strip(F.col(reference)) != ""
    for path in required:
        keep = keep & F.col(path).isNotNull() & (F.col(path).cast("string") != "")
    return df.filter(keep)


def add_quality_metrics(
    df: DataFrame,
    price: str = "prix_valeur",
    surface: str = "surface_valeur",
    place: str = "localisation_ville",
) -> DataFrame:
    flags = {"has_prix": price, "has_surface": surface, "has_localisation": place}
    flagged = df.withColumns({n: F.col(c).isNotNull().cast("int") for n, c in flags.items()})
    return flagged.withColumn(
        "data_quality_score", sum((F.col(n) for n in flags), F.lit(0)) / F.lit(3.0)
    )


def quality_summary(
    prepared: DataFrame,
    score: str = "metadata.score_qualite",
    missing: str = "metadata.champs_manquants",
) -> DataFrame:
    """One row: mean, median and distribution of the quality score, missing-field counts."""
    # the score has one value per number of filled fields, so the cells are few
    cells = prepared.groupBy(F.col(score).alias("score"), F.coalesce(F.size(F.col(missing)), F.lit(0)).alias("manquants")).agg(
        F.count("*").alias("_n")
    )
    s, m = F.col("score"), F.col("manquants")

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0))

    return rank_counts(cells, "score", "_n").agg(
        rows(F.lit(True)).alias("nombre"),
        F.try_divide(F.sum(s * F.col("_n")), F.sum("_n")).alias("score_moyen"),
        quantile_of("score", "_n", 0.5).alias("score_median"),
        rows(s == 10).alias("score_10"),
        rows(s >= 7.5).alias("score_75_10"),
        rows((s >= 5) & (s < 7.5)).alias("score_5_75"),
        rows(s < 5).alias("score_moins_5"),
        rows(m == 0).alias("manquants_0"),
        rows(m.between(1, 2)).alias("manquants_1_2"),
        rows(m >= 3).alias("manquants_3_plus"),
    )


def integrity_report(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows that break a rule, once per rule broken, with its name.

    As in SQL, a rule that evaluates to null is not broken.
    """
    broken = F.array_compact(
        F.array(*[F.when(~F.expr(rule), F.lit(name)) for name, rule in rules.items()])
    )
    return df.withColumn("regle", F.explode(broken))


def integrity_counts(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Number of broken rows per rule, zero included, from one pass over the data."""
    counts = df.agg(*[F.count_if(~F.expr(rule)).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "regle", "violations")


def fk_violations(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    parents = parent.select(F.col(parent_key or key).alias(key))
    return child.filter(F.col(key).isNotNull()).join(parents, key, "left_anti")
