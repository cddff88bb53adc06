"""Market statistics, scores, segments and recommendations on prepared listings.

Global statistics are one row and reach the listings as a scalar subquery, so enriching is one
narrow pass over the data: no join, no window, no shuffle of the listings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcela.functions.numbers import python_round
from parcela.functions.text import contains_any, lowered
from parcela.operators.quantiles import holds_rank, node, rank_counts, refined, value_distribution
from parcela.session import shared_dir

# Aggregated listings, or what makes them with the aggregates of the given paths only.
Aggregated = DataFrame | Callable[[tuple[str, ...]], DataFrame]

# Upper limits of the segments and their labels, the last one open.
PRICE_LIMITS = [5000, 7000, 10000, 15000]
PRICE_LABELS = ["economique", "moyen", "superieur", "premium", "luxe"]
SURFACE_LIMITS = [30, 50, 80, 120]
SURFACE_LABELS = ["studio", "appartement", "grand_appartement", "maison", "grande_maison"]
AGE_LIMITS = [5, 20, 50, 100]
AGE_LABELS = ["neuf", "recent", "ancien", "tres_ancien", "patrimoine"]
DISTRIBUTION_LIMITS = [5000, 8000, 12000]
DISTRIBUTION_LABELS = ["economique", "moyen", "superieur", "premium"]

# Labels as the documents spell them.
DOCUMENT_SPELLING = {
    "economique": "économique",
    "superieur": "supérieur",
    "tres_ancien": "très_ancien",
    "tres_sous_cote": "très_sous_cote",
    "tres_sur_cote": "très_sur_cote",
}

# Features that count as modern.
MODERN_FEATURES = ["digicode", "interphone", "chauffage central", "double vitrage"]

# Default weights of the weighted score.
WEIGHTS = {"emplacement": 0.20, "modernite": 0.15, "dpe": 0.15, "equipements": 0.10}

UNDER = ["tres_sous_cote", "sous_cote"]
OVER = ["tres_sur_cote", "sur_cote"]

# Recommendation texts.
LOWER_PRICE = "Envisager une révision du prix à la baisse"
KEEP_PRICE = "Prix attractif - maintenir la stratégie"
RENOVATE = "Priorité: rénovation énergétique"
SHOW_POTENTIAL = "Mettre en avant le potentiel de valorisation"
SPORTY_TARGET = "Cibler public jeune et sportif"
ANY_TARGET = "Convient à toutes les cibles"
MORE_PHOTOS = "Ajouter plus de photos pour mieux valoriser"
VIRTUAL_TOUR = "Envisager une visite virtuelle"


def banded(c: Column, limits: list[int], labels: list[str]) -> Column:
    """Label of the first limit the value stays below; null stays null."""
    chain = F.when(c < limits[0], labels[0])
    for limit, label in zip(limits[1:], labels[1:-1], strict=True):
        chain = chain.when(c < limit, label)
    return chain.when(c.isNotNull(), labels[-1])


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def points(condition: Column, value: float) -> Column:
    """``value`` where the condition holds, else 0."""
    return F.when(condition, F.lit(float(value))).otherwise(F.lit(0.0))


def document_label(c: Column) -> Column:
    """The accented form of a canonical label, for the document view."""
    spelled = F.create_map(*[F.lit(v) for pair in DOCUMENT_SPELLING.items() for v in pair])
    return F.coalesce(F.try_element_at(spelled, c), c)


def segment_price_m2(c: Column) -> Column:
    return banded(F.nullif(c, F.lit(0.0)), PRICE_LIMITS, PRICE_LABELS)


def segment_surface(c: Column) -> Column:
    return banded(F.nullif(c, F.lit(0.0)), SURFACE_LIMITS, SURFACE_LABELS)


def segment_age(c: Column) -> Column:
    return banded(F.nullif(c, F.lit(0)), AGE_LIMITS, AGE_LABELS)


def profitability(price: Column, surface: Column, charges: Column) -> Column:
    """Rent, yield and net yield; all null without price or surface.

    Charges are used whatever their period; the net yield is not rounded.
    """
    known = (price != 0) & (surface != 0)
    per_m2 = price / F.nullif(surface, F.lit(0.0))
    rent = per_m2 * surface * F.lit(0.05) / F.lit(12.0)
    gross = python_round((rent * F.lit(12.0) / F.nullif(price, F.lit(0.0))) * F.lit(100.0))
    gross = F.when(price > 0, gross).otherwise(F.lit(0.0))
    charged = known & (charges != 0)
    net = F.greatest(F.lit(0.0), gross - (charges / F.nullif(price, F.lit(0.0)) * F.lit(100.0)))
    return F.struct(
        F.when(known, python_round(per_m2)).alias("prix_m2"),
        F.when(known, python_round(rent)).alias("loyer_estime_mensuel"),
        F.when(known, gross).alias("rendement_annuel_estime"),
        F.when(charged, charges).alias("charges_annuelles"),
        F.when(charged, net).alias("rentabilite_nette"),
    )


def profitability_sql(price: Column, per_m2: Column, surface: Column, charges: Column) -> Column:
    """Table-function variant: without charges the net yield is the gross yield."""
    rent = per_m2 * surface * F.lit(0.05) / F.lit(12.0)
    gross = F.try_divide(rent * F.lit(12.0), price) * F.lit(100.0)
    net = F.greatest(F.lit(0.0), gross - F.try_divide(charges, price) * F.lit(100.0))
    return F.struct(
        rent.alias("loyer_estime"),
        gross.alias("rendement_annuel"),
        F.when(charges.isNotNull(), net).otherwise(gross).alias("rentabilite_nette"),
    )


def location_score(
    postal_code: Column, district: Column, proximity: Column, department: str = "suffix"
) -> Column:
    """Score 1 to 10.  ``department`` says which two digits of the postal code are compared:
    the last ones ("suffix", as the documents were scored) or the first ones ("prefix")."""
    digits = F.right(postal_code, F.lit(2)) if department == "suffix" else F.left(postal_code, F.lit(2))
    score = (
        F.lit(5.0)
        + points(digits.isin("75", "92"), 2)
        + points(digits.isin("93", "94"), 1)
        + points(district.contains("Buttes Chaumont"), 1)
        + points(proximity.contains("métro"), 1)
        + points(F.lower(proximity).contains("école"), 0.5)
    )
    return clamp(score, 1.0, 10.0)


def modernity_score(dpe_score: Column, age: Column, features: Column, lift: Column) -> Column:
    modern = F.size(F.filter(lowered(features), lambda x: contains_any(x, MODERN_FEATURES)))
    by_age = (
        F.when((age != 0) & (age < 10), 2.0).when((age != 0) & (age < 30), 1.0)
        .when(age > 50, -1.0).otherwise(0.0)
    )
    score = (
        F.lit(5.0)
        + (F.coalesce(dpe_score, F.lit(0)) - 5) * F.lit(0.5)
        + by_age
        + F.when(features.isNotNull(), modern).otherwise(0) * F.lit(0.5)
        + points(lift, 1)
    )
    return clamp(score, 1.0, 10.0)


def _priced(prepared: DataFrame) -> DataFrame:
    price, surface = F.col("prix.valeur"), F.col("surface.valeur")
    return prepared.filter((price != 0) & (surface != 0)).select(
        price.alias("prix"), surface.alias("surface"), (price / surface).alias("prix_m2")
    )


def _stable_mean(name: str) -> Column:
    """Mean of a double through a decimal sum: the same for every partitioning."""
    total = F.sum(F.col(name).cast("decimal(28,8)")).cast("double")
    return python_round(total / F.count(name))


def market_partials(prepared: DataFrame) -> DataFrame:
    """Sums, extremes and counts per bucket of the price per m² and postal code, from one scan.

    Listings without price or surface count for their postal code only (null bucket).  The partials of two
    batches are one table: their rows simply stand together.
    """
    price, surface = F.col("prix.valeur"), F.col("surface.valeur")
    known = (price != 0) & (surface != 0)
    rows = prepared.select(
        F.col("localisation.code_postal").alias("code_postal"), F.when(known, price).alias("prix"),
        F.when(known, surface).alias("surface"), F.when(known, price / surface).alias("m2"))
    rows = rows.select("*", node("m2").alias("noeud"), banded(F.col("m2"), DISTRIBUTION_LIMITS, DISTRIBUTION_LABELS).alias("tranche"))

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.col(name).cast("decimal(28,8)")), F.lit(0)).alias(f"somme_{name}")

    return rows.groupBy("noeud", "code_postal").agg(
        F.count("m2").alias("nombre"), total("m2"), total("prix"), total("surface"),
        F.min("m2").alias("m2_min"), F.max("m2").alias("m2_max"),
        (F.var_pop("m2") * F.count("m2")).alias("ecarts"),
        *[F.count_if(F.col("tranche") == name).alias(f"distribution_{name}") for name in DISTRIBUTION_LABELS])


def _nodes(partials: DataFrame) -> DataFrame:
    """Buckets with the rank after their last value and the mean of everything: a few thousand rows."""
    n, every = F.sum("nombre"), Window.partitionBy(F.lit(0))
    sums = ["somme_m2", "somme_prix", "somme_surface", *[f"distribution_{x}" for x in DISTRIBUTION_LABELS]]
    own = (F.col("somme_m2") / F.nullif(F.col("nombre"), F.lit(0))).cast("double")
    rows = partials.where("noeud IS NOT NULL").withColumn("_own", own)
    nodes = rows.groupBy("noeud").agg(
        n.alias("_n"), *[F.sum(c).alias(c) for c in sums], F.min("m2_min").alias("m2_min"), F.max("m2_max").alias("m2_max"),
        F.sum("ecarts").alias("_inner"), F.sum(F.col("nombre") * F.col("_own")).alias("_first"),
        F.sum(F.col("nombre") * F.col("_own") * F.col("_own")).alias("_second"), F.min("_own").alias("_base"))
    return nodes.withColumns({
        "_end": F.sum("_n").over(every.orderBy("noeud").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_total": F.sum("_n").over(every),
        "_mean": (F.sum("somme_m2").over(every) / F.sum("_n").over(every)).cast("double")})


def stats_of_partials(partials: DataFrame, values: DataFrame) -> DataFrame:
    """The statistics row from the partials of any number of batches; of ``values`` (m2) only the median's bucket is used."""
    nodes = _nodes(partials)
    half = {"mediane": 0.5}
    targets = nodes.filter(holds_rank(half)).select(F.col("noeud").alias("_b"), (F.col("_end") - F.col("_n")).alias("_before"), "_total")
    median = refined(values.select(F.col("m2").alias("_v"), node("m2").alias("_b")), targets, half, [])
    codes = partials.agg(F.sort_array(F.collect_set("code_postal")).alias("codes"))
    count = F.sum("_n")

    def mean(name: str) -> Column:
        return python_round(F.sum(f"somme_{name}").cast("double") / F.nullif(count, F.lit(0)))

    # a bucket's rows lie close together: their sums about the overall mean lose nothing
    about = F.col("_inner") + F.col("_second") - 2 * F.col("_mean") * F.col("_first") + F.col("_n") * F.col("_mean") * F.col("_mean")
    return nodes.agg(
        mean("m2").alias("prix_m2_moyen"), python_round(F.min("m2_min")).alias("prix_m2_min"),
        python_round(F.max("m2_max")).alias("prix_m2_max"),
        python_round(F.sqrt(F.sum(about) / F.nullif(count, F.lit(0)))).alias("ecart_type_prix_m2"),
        F.coalesce(count, F.lit(0)).alias("nombre_biens_analyses"),
        mean("surface").alias("surface_moyenne"), mean("prix").alias("prix_moyen"),
        *[F.coalesce(F.sum(f"distribution_{x}"), F.lit(0)).alias(f"distribution_{x}") for x in DISTRIBUTION_LABELS],
    ).withColumns({
        "prix_m2_median": median.select(python_round(F.col("mediane"))).scalar(),
        "arrondissements_uniques": codes.select("codes").scalar(),
    })


def market_values(prepared: DataFrame) -> DataFrame:
    """The prices per m² that :func:`stats_of_partials` looks the median up in."""
    return _priced(prepared).select(F.col("prix_m2").alias("m2"))


def market_stats(prepared: DataFrame) -> DataFrame:
    """One row of statistics over the listings with price and surface.

    One scan makes the partials, which are written to the shared folder and are what everything but the
    median is computed from; one more reads the values of the median's bucket.
    """
    spark, path = prepared.sparkSession, shared_dir(prepared.sparkSession, "market-partials")
    market_partials(prepared).write.parquet(path)
    return stats_of_partials(spark.read.parquet(path), market_values(prepared))


def _distribution(m2: Column) -> list[Column]:
    label = banded(m2, DISTRIBUTION_LIMITS, DISTRIBUTION_LABELS)
    return [F.count_if(label == name).alias(f"distribution_{name}") for name in DISTRIBUTION_LABELS]


def price_distribution(prepared: DataFrame) -> DataFrame:
    """Counts of listings in the four price bands of the market report."""
    return _priced(prepared).agg(*_distribution(F.col("prix_m2")))


def compare_to_market(per_m2: Column, mean: Column, deviation: Column) -> Column:
    """Position of a listing against the market; null without a price per m²."""
    known = per_m2 != 0
    usable = (mean != 0) & (deviation > 0)
    z = F.when(usable, (per_m2 - mean) / F.nullif(deviation, F.lit(0.0))).otherwise(F.lit(0.0))
    label = (
        F.when(~usable | usable.isNull(), "non_determine")
        .when(z < -1.5, "tres_sous_cote")
        .when(z < -0.5, "sous_cote")
        .when(z <= 0.5, "dans_la_moyenne")
        .when(z <= 1.5, "sur_cote")
        .otherwise("tres_sur_cote")
    )
    gap = F.coalesce(
        python_round((per_m2 - mean) / F.nullif(mean, F.lit(0.0)) * F.lit(100.0)), F.lit(0.0)
    )
    known = known & mean.isNotNull()
    return F.struct(
        F.when(known, python_round(z)).alias("z_score_prix_m2"),
        F.when(known, label).alias("positionnement_marche"),
        F.when(known, gap).alias("ecart_pourcentage"),
        F.when(known, mean).alias("prix_m2_marche_reference"),
    )


def recommendations(
    position: Column, dpe_class: Column, floor: Column, lift: Column, photos: Column, tour: Column
) -> Column:
    def listed(*rules: Column) -> Column:
        return F.array_compact(F.array(*rules))

    poor = dpe_class.isin("F", "G")
    no_lift = ~F.coalesce(lift, F.lit(False))
    high = (F.coalesce(floor, F.lit(0)) >= 4) & no_lift
    return F.struct(
        listed(
            F.when(position.isin(OVER), F.lit(LOWER_PRICE)).when(
                position.isin(UNDER), F.lit(KEEP_PRICE)
            )
        ).alias("prix"),
        listed(
            F.when(poor, F.lit(SHOW_POTENTIAL)),
            F.when(F.coalesce(photos, F.lit(0)) < 5, F.lit(MORE_PHOTOS)),
            F.when(~F.coalesce(tour, F.lit(False)), F.lit(VIRTUAL_TOUR)),
        ).alias("marketing"),
        listed(F.when(poor, F.lit(RENOVATE))).alias("amelioration"),
        listed(F.when(high, F.lit(SPORTY_TARGET)).otherwise(F.lit(ANY_TARGET))).alias("ciblage"),
    )


def aggregate_listings(
    prepared: DataFrame,
    as_of: str,
    stats: DataFrame | None = None,
    department: str = "suffix",
    version: str = "1.0",
    only: tuple[str, ...] | None = None,
) -> DataFrame:
    """Every listing with its ``aggregats`` struct.

    ``stats`` may be a stored row of :func:`market_stats`, which saves the first pass.  ``only`` names the aggregates a
    reader wants (``scores.global``): Spark computes a struct as a whole once two of its fields are read.
    """
    stats = market_stats(prepared) if stats is None else stats
    market = stats.select(
        F.struct("prix_m2_moyen", "ecart_type_prix_m2", "nombre_biens_analyses")
    ).scalar()
    b, d = "batiment", "diagnostics.dpe"
    scored = prepared.select(
        "*",
        market.alias("_m"),
        location_score(
            F.col("localisation.code_postal"), F.col("localisation.quartier"),
            F.col("localisation.proximite"), department,
        ).alias("_lieu"),
        modernity_score(
            F.col(f"{d}.score"), F.col(f"{b}.age_bien"), F.col("caracteristiques"),
            F.col(f"{b}.ascenseur"),
        ).alias("_moderne"),
    ).withColumn(
        "_position",
        compare_to_market(
            F.col("prix.au_m2"), F.col("_m.prix_m2_moyen"), F.col("_m.ecart_type_prix_m2")
        ),
    )
    groups = {
        "performance": lambda: profitability(
            F.col("prix.valeur"), F.col("surface.valeur"), F.col("copropriete.charges.valeur")
        ),
        "scores": lambda: F.struct(
            python_round(F.col("_lieu")).alias("emplacement"),
            python_round(F.col("_moderne")).alias("modernite"),
            python_round((F.col("_lieu") + F.col("_moderne")) / F.lit(2.0)).alias("global"),
        ),
        "segmentation": lambda: F.struct(
            segment_price_m2(F.col("prix.au_m2")).alias("prix_m2"),
            segment_surface(F.col("surface.valeur")).alias("surface"),
            segment_age(F.col(f"{b}.age_bien")).alias("age"),
        ),
        "analyse_marche": lambda: F.col("_position"),
        "recommandations": lambda: recommendations(
            F.col("_position.positionnement_marche"), F.col(f"{d}.classe"), F.col(f"{b}.etage"),
            F.col(f"{b}.ascenseur"), F.col("medias.nombre_photos"),
            F.col("medias.has_visite_virtuelle"),
        ),
        "metadata_aggregation": lambda: F.struct(
            F.lit(as_of).alias("date_aggregation"),
            F.lit(version).alias("algorithme_version"),
            F.struct(
                F.col("_m.prix_m2_moyen").alias("prix_m2_moyen"),
                F.col("_m.nombre_biens_analyses").cast("int").alias("nombre_biens_reference"),
            ).alias("marche_reference"),
        ),
    }
    wanted: dict[str, list[str]] = {} if only is not None else dict.fromkeys(groups, [])
    for group, _, name in (path.partition(".") for path in only or ()):
        wanted.setdefault(group, []).append(name)

    def made(group: str, names: list[str]) -> Column:
        whole = groups[group]()
        return F.struct(*[whole[n].alias(n) for n in names]) if names else whole

    aggregates = F.struct(*[made(group, names).alias(group) for group, names in wanted.items()])
    return scored.withColumn("aggregats", aggregates).drop("_m", "_lieu", "_moderne", "_position")


def narrowed(aggregated: Aggregated, *paths: str) -> DataFrame:
    """Aggregated listings for a reader of the named aggregates; a table is taken as it is."""
    return aggregated(paths) if callable(aggregated) else aggregated


def document_view(aggregated: DataFrame) -> DataFrame:
    """Aggregated listings with the label spelling of the JSON documents."""
    a = F.col("aggregats")
    for group, field in [
        ("segmentation", "prix_m2"), ("segmentation", "age"),
        ("analyse_marche", "positionnement_marche"),
    ]:
        a = a.withField(f"{group}.{field}", document_label(F.col(f"aggregats.{group}.{field}")))
    return aggregated.withColumn("aggregats", a)


def market_trends(aggregated: Aggregated) -> DataFrame:
    """One row: means, correlation, top-decile count and price.  Missing values count as 0."""
    rows = narrowed(aggregated, "scores.global", "performance.prix_m2").select(
        F.coalesce(F.col("aggregats.scores.global"), F.lit(0.0)).alias("score"),
        F.coalesce(F.col("aggregats.performance.prix_m2"), F.lit(0.0)).alias("prix_m2"),
    )
    cut = value_distribution(rows, "score", {"seuil": 0.9}).select("seuil").scalar()
    top = F.col("score") >= F.col("seuil")
    top_sum = F.sum(F.when(top, F.col("prix_m2")).cast("decimal(28,8)")).cast("double")
    return (
        rows.withColumn("seuil", cut)
        .agg(
            _stable_mean("score").alias("score_global_moyen"),
            _stable_mean("prix_m2").alias("prix_m2_moyen"),
            python_round(F.nullif(F.corr("score", "prix_m2"), F.lit(float("nan"))), 3).alias("correlation_score_prix"),
            F.count_if(top).alias("top_nombre_biens"),
            python_round(F.try_divide(top_sum, F.count_if(top))).alias("top_prix_m2_moyen"),
        )
    )


def segment_distribution(aggregated: DataFrame) -> DataFrame:
    """Listings per price segment, those without one left out."""
    segment = F.col("aggregats.segmentation.prix_m2")
    return aggregated.filter(segment.isNotNull()).groupBy(segment.alias("segment")).agg(
        F.count("*").alias("nombre")
    )


def optimisation_report(aggregated: Aggregated) -> dict[str, DataFrame]:
    """Three tables: under-priced, over-priced, and listings to improve."""
    position = F.col("aggregats.analyse_marche.positionnement_marche")
    gap = F.coalesce(F.col("aggregats.analyse_marche.ecart_pourcentage"), F.lit(0.0))
    advice = F.col("aggregats.recommandations.amelioration")
    placed = [F.col("reference"), position.alias("positionnement"), gap.alias("ecart_pourcentage")]
    compared = narrowed(aggregated, "analyse_marche.positionnement_marche", "analyse_marche.ecart_pourcentage")
    advised = narrowed(aggregated, "recommandations.amelioration")
    return {
        "biens_sous_cotes": compared.filter(position.isin(UNDER)).select(*placed),
        "biens_sur_cotes": compared.filter(position.isin(OVER)).select(*placed),
        "opportunites_amelioration": advised.filter(F.size(advice) > 0).select(
            "reference", advice.alias("recommandations")
        ),
    }


def yield_level(c: Column) -> Column:
    rate = F.coalesce(c, F.lit(0.0))
    return F.when(rate >= 8, "eleve").when(rate >= 5, "moyen").otherwise("faible")


def profit_ratio(c: Column) -> Column:
    rate = F.coalesce(c, F.lit(0.0))
    return (
        F.when(rate >= 6, "excellent").when(rate >= 4, "bon").when(rate >= 2, "acceptable")
        .otherwise("faible")
    )


def target_segment(price_segment: Column, age: Column, lift: Column, floor: Column) -> Column:
    return (
        F.when((age != 0) & (age < 10), "investisseurs_neuf")
        .when(price_segment.isin("premium", "luxe"), "investisseurs_haut_gamme")
        .when(~F.coalesce(lift, F.lit(False)) & (floor >= 3), "jeunes_actifs")
        .otherwise("familles")
    )


def potential_segment(dpe_score: Column, age: Column) -> Column:
    score, years = F.coalesce(dpe_score, F.lit(5)), F.coalesce(age, F.lit(0))
    return (
        F.when((score <= 3) & (years > 30), "renovation")
        .when((score >= 7) & (years < 20), "valorisation")
        .otherwise("standard")
    )


def global_segment_label(price: Column, surface: Column, age: Column) -> Column:
    return F.nullif(F.concat_ws("_", price, surface, age), F.lit(""))


def market_segment_sql(per_m2: Column, surface: Column, age: Column, dpe_score: Column) -> Column:
    """SQL function: a null value falls to the last branch, as ``IF`` chains do."""
    price = F.coalesce(banded(per_m2, PRICE_LIMITS, PRICE_LABELS), F.lit(PRICE_LABELS[-1]))
    size = F.coalesce(banded(surface, SURFACE_LIMITS, SURFACE_LABELS), F.lit(SURFACE_LABELS[-1]))
    tail = F.when(dpe_score <= 3, "renovation").when(age > 50, "ancien").otherwise("standard")
    return F.concat_ws("_", price, size, tail)


def attractiveness_score(
    dpe_score: Column, lift: Column, floor: Column, age: Column, photos: Column
) -> Column:
    score = (
        F.lit(5.0) + points(dpe_score >= 6, 2) - points(dpe_score <= 3, 2) + points(lift, 1)
        + points(floor == 1, 1) + points(age < 20, 1) - points(age > 100, 1)
        + points(photos >= 5, 1)
    )
    return clamp(score, 1.0, 10.0)


def weighted_attractiveness(
    location: Column, modernity: Column, dpe: Column, equipment: Column,
    weights: dict[str, float] = WEIGHTS, scale: float = 10,
) -> Column:
    """Weighted mean, rounded to one decimal; the sum and the mean keep two decimals on the way.

    ``scale=10`` is the published function, which saturates because the scores already run to
    10; ``scale=1`` is what it means to say.
    """
    def exact(value) -> Column:
        return F.lit(str(value)).cast("decimal(6,3)")

    parts = {"emplacement": location, "modernite": modernity, "dpe": dpe, "equipements": equipment}
    products = (c.cast("decimal(6,3)") * exact(weights[n]) for n, c in parts.items())
    total = F.round(sum(products, F.lit(0)), 2)
    weight = exact(round(sum(weights.values()), 3))
    mean = F.round(total / weight * exact(scale), 2)
    return F.round(F.greatest(F.lit(0), F.least(F.lit(10), mean)), 1).cast("decimal(3,1)")


def renovation_potential(dpe_class: Column, age: Column, price: Column) -> Column:
    high = dpe_class.isin("F", "G") & (age > 30)
    middle = dpe_class == "E"

    def pick(a, b, c) -> Column:
        return F.when(high, F.lit(a)).when(middle, F.lit(b)).otherwise(F.lit(c))

    return F.struct(
        pick("eleve", "moyen", "faible").alias("potentiel"),
        pick(0.15, 0.08, 0.02).alias("gain_valeur_estime"),
        (price * pick(0.10, 0.06, 0.02)).alias("investissement_estime"),
    )


def accessibility_score(lift: Column, floor: Column) -> Column:
    level, has_lift = F.coalesce(floor, F.lit(0)), F.coalesce(lift, F.lit(False))
    by_floor = F.when(level <= 1, 1.0).when((level >= 4) & ~has_lift, -2.0).otherwise(0.0)
    return clamp(F.lit(5.0) + points(has_lift, 2) + by_floor, 1.0, 10.0)


def media_score(photos: Column, video: Column, tour: Column) -> Column:
    score = F.lit(5.0) + points(photos >= 5, 2) + points(video, 1) + points(tour, 2)
    return clamp(score, 1.0, 10.0)


def percentile_rank_approx(z: Column) -> Column:
    shift = (F.coalesce(z, F.lit(0.0)) * F.lit(20.0)).cast("int")
    return F.greatest(F.lit(1), F.least(F.lit(99), F.lit(50) + shift))


def percentile_rank_exact(df: DataFrame, value: str, out: str = "rang_exact") -> DataFrame:
    """Share of rows with a smaller value, in percent (``percent_rank``), over the rows with a value.

    Values are counted, and ranks come from the tree of :func:`rank_counts`.  Rows without a value have no
    rank and take no part in the join.
    """
    known = df.filter(F.col(value).isNotNull())
    counts = known.groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    ranked = rank_counts(counts, "_v", "_n")
    smaller = (F.col("_end") - F.col("_n")).cast("double")
    rank = smaller / F.nullif(F.col("_total") - 1, F.lit(0)) * F.lit(100.0)
    ranked = ranked.select("_v", F.coalesce(rank, F.lit(0.0)).alias(out))
    unknown = df.filter(F.col(value).isNull()).withColumn(out, F.lit(None).cast("double"))
    return known.join(ranked, F.col(value) == F.col("_v"), "left").drop("_v").unionByName(unknown)


# How a recommendation of each type is ranked, and by when it should be done.
PRIORITY = {"amelioration": "haute", "prix": "haute", "ciblage": "moyenne"}
IMPACT = {"amelioration": "important", "prix": "important", "marketing": "moyen"}
DELAY = {"prix": "immediat", "marketing": "court_terme"}

# The action for a recommendation, by type and by a word of its text.
ACTIONS = {
    ("prix", "révision"): "Analyser les prix du marché local et ajuster le prix de 5 à 10%",
    ("prix", ""): "Maintenir le prix actuel et surveiller la concurrence",
    ("marketing", "photos"): "Organiser une séance photo professionnelle avec au moins 10 clichés",
    ("marketing", "visite virtuelle"): "Contacter un prestataire pour réaliser une visite virtuelle 3D",
    ("marketing", ""): "Réviser la description et les arguments de vente",
    ("amelioration", ""): "Établir un devis pour les travaux de rénovation énergétique",
    ("ciblage", ""): "Adapter la communication marketing pour la cible identifiée",
}
DEFAULT_ACTION = "Mettre en œuvre la recommandation dans les 15 jours"


def _by_type(kind: Column, labels: dict[str, str], default: str) -> Column:
    table = F.create_map(*[F.lit(v) for pair in labels.items() for v in pair])
    return F.coalesce(F.try_element_at(table, kind), F.lit(default))


def recommendation_priority(kind: Column) -> Column:
    return _by_type(kind, PRIORITY, "basse")


def recommendation_impact(kind: Column) -> Column:
    return _by_type(kind, IMPACT, "faible")


def recommendation_delay(kind: Column) -> Column:
    return _by_type(kind, DELAY, "moyen_terme")


def recommendation_action(kind: Column, text: Column) -> Column:
    low = F.lower(text)
    rules = [F.when((kind == k) & low.contains(word), F.lit(action)) for (k, word), action in ACTIONS.items()]
    return F.coalesce(*rules, F.lit(DEFAULT_ACTION))


def completion_stats(
    listings: DataFrame, prices: DataFrame, aggregates: DataFrame, performance: DataFrame
) -> DataFrame:
    """One row of load statistics.

    Each table is aggregated by itself and the single values are put together: the left joins of
    the published query would multiply rows and shuffle four tables for the same numbers.
    """
    def known(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
        return df.join(keys.select(key), key, "left_semi")

    def mean2(df: DataFrame, name: str) -> Column:
        one = F.round(F.avg(F.col(name).cast("decimal(18,2)")), 2).cast("double")
        return df.agg(one).scalar()

    linked = known(aggregates, listings, "id_annonce")
    return listings.agg(F.count_distinct("id_annonce").alias("total_annonces")).withColumns({
        "total_aggregats": linked.agg(F.count_distinct("id_aggregat")).scalar(),
        "prix_moyen": mean2(known(prices, listings, "id_annonce"), "valeur"),
        "score_global_moyen": mean2(linked, "score_global"),
        "rendement_moyen": mean2(known(performance, linked, "id_aggregat"), "rendement_annuel_estime"),
    }).withColumn(
        "taux_aggregation",
        F.try_divide(F.col("total_aggregats") * F.lit(100.0), F.col("total_annonces")),
    )
