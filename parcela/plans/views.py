"""Statistical views over the listing tables.

Each function takes the tables as a dict and gives a lazy DataFrame.  Child tables are aggregated
before they are joined, so a listing or value that holds a large part of the rows is reduced on
the map side and never meets a join as raw rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcela.functions.aggregates import as_double, mean_rounded, rounded_quotient, share_of
from parcela.functions.numbers import price_per_m2_decimal, surface_per_room
from parcela.functions.text import description_length_bucket
from parcela.operators.quantiles import value_distribution

Tables = dict[str, DataFrame]

KEY = "id_annonce"

# Period labels of the construction year, in order.
PERIODS = ["Avant 1900", "1900-1945", "1946-1970", "1971-1990", "1991-2010", "Après 2010"]
PERIOD_ENDS = [1899, 1945, 1970, 1990, 2010]


def _with(df: DataFrame, *names: str) -> DataFrame:
    """Rows where the named columns are not null."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names]))


def _count(name: str = "nombre_annonces") -> Column:
    return F.count("*").alias(name)


def _mean(column: str, name: str, digits: int = 2) -> Column:
    return mean_rounded(F.col(column), digits).alias(name)


def _low(column: str, name: str) -> Column:
    return as_double(F.min(column)).alias(name)


def _high(column: str, name: str) -> Column:
    return as_double(F.max(column)).alias(name)


def _all(count: str) -> Column:
    """Sum of the counts over the (few) groups of a result."""
    return F.sum(count).over(Window.partitionBy(F.lit(0)))


def stats_type_bien(t: Tables, variant: str = "rich") -> DataFrame:
    """Statistics per property type.

    ``rich`` asks for price and surface, ``price`` for the price only, ``plain`` for the type only
    and leaves the averages unrounded.
    """
    a = t["annonces"]
    if variant == "plain":
        return _with(a, "type_bien").groupBy("type_bien").agg(
            _count(),
            (F.sum("prix").cast("double") / F.nullif(F.count("prix"), F.lit(0))).alias("prix_moyen"),
            (F.sum("surface").cast("double") / F.nullif(F.count("surface"), F.lit(0))).alias(
                "surface_moyenne"
            ),
            _low("prix", "prix_min"), _high("prix", "prix_max"),
        ).orderBy(F.desc("nombre_annonces"), "type_bien")
    measures = [
        _count(), _mean("prix", "prix_moyen"), _mean("prix_au_m2", "prix_m2_moyen"),
        _low("prix", "prix_min"), _high("prix", "prix_max"),
    ]
    if variant == "rich":
        a = _with(a, "prix", "surface")
        measures += [_mean("surface", "surface_moyenne"), _mean("pieces", "pieces_moyennes", 1)]
    else:
        a = _with(a, "prix")
    return a.groupBy("type_bien").agg(*measures).orderBy(F.desc("nombre_annonces"), "type_bien")


def stats_prix_m2_par_mois(t: Tables) -> DataFrame:
    month = F.trunc("date_extraction", "month").alias("mois")
    return (
        _with(t["annonces"], "prix_au_m2").groupBy(month, "type_bien")
        .agg(_mean("prix_au_m2", "prix_m2_moyen"), _count())
        .orderBy(F.desc("mois"), "type_bien")
    )


def stats_communes_cheres(t: Tables, least: int = 5, top: int = 10) -> DataFrame:
    return (
        _with(t["annonces"], "prix", "localisation").groupBy("localisation")
        .agg(
            _count(), _mean("prix", "prix_moyen"), _mean("prix_au_m2", "prix_m2_moyen"),
            _mean("surface", "surface_moyenne"),
        )
        .filter(F.col("nombre_annonces") >= least)
        .orderBy(F.desc_nulls_last("prix_m2_moyen"), "localisation")
        .limit(top)
    )


def stats_distribution_surfaces(t: Tables) -> DataFrame:
    """Count, mean, extremes and median of the surface per type, from one scan."""
    a = t["annonces"].filter(F.col("surface") > 0)
    return (
        value_distribution(a, "surface", {"_mediane": 0.5}, by=["type_bien"])
        .select(
            "type_bien", F.col("nombre").alias("total"),
            rounded_quotient(F.col("somme"), F.col("nombre")).alias("moyenne"),
            as_double(F.col("minimum")).alias("minimum"), as_double(F.col("maximum")).alias("maximum"),
            F.round("_mediane", 2).alias("mediane"),
        )
        .orderBy(F.desc("total"), "type_bien")
    )


def stats_performance_energetique(t: Tables) -> DataFrame:
    """Per energy class, A to G.  Letters sort as the classes do; others come last."""
    d = _with(t["dpe"], "classe_energie").select(KEY, "classe_energie")
    return (
        t["annonces"].join(d, KEY).groupBy("classe_energie")
        .agg(
            _count("nombre_biens"), _mean("prix", "prix_moyen"),
            _mean("prix_au_m2", "prix_m2_moyen"), _mean("surface", "surface_moyenne"),
        )
        .orderBy(~F.col("classe_energie").isin(list("ABCDEFG")), "classe_energie")
    )


def stats_par_pieces(t: Tables, least: int = 3) -> DataFrame:
    return (
        t["annonces"].filter(F.col("pieces") > 0).groupBy("pieces")
        .agg(
            _count(), _mean("prix", "prix_moyen"), _mean("surface", "surface_moyenne"),
            _mean("prix_au_m2", "prix_m2_moyen"),
        )
        .filter(F.col("nombre_annonces") >= least)
        .orderBy("pieces")
    )


def stats_caracteristiques_populaires(t: Tables, top: int = 20) -> DataFrame:
    c = t["caracteristiques"]
    listings = c.agg(F.count_distinct(KEY)).scalar()
    return (
        c.groupBy(F.col("valeur").alias("caracteristique"))
        .agg(_count("frequence"))
        .orderBy(F.desc("frequence"), "caracteristique")
        .limit(top)
        .withColumn("pourcentage", share_of(F.col("frequence"), listings))
    )


def period_bucket(year: Column) -> Column:
    chain = F.when(year <= PERIOD_ENDS[0], PERIODS[0])
    for end, label in zip(PERIOD_ENDS[1:], PERIODS[1:-1], strict=True):
        chain = chain.when(year <= end, label)
    return chain.when(year > PERIOD_ENDS[-1], PERIODS[-1]).otherwise("Non renseigné")


def stats_annee_construction(t: Tables) -> DataFrame:
    order = F.array_position(F.array(*[F.lit(p) for p in PERIODS]), F.col("periode_construction"))
    return (
        _with(t["annonces"], "prix")
        .groupBy(period_bucket(F.col("annee_construction")).alias("periode_construction"))
        .agg(
            _count("nombre_biens"), _mean("prix", "prix_moyen"),
            _mean("prix_au_m2", "prix_m2_moyen"),
        )
        .orderBy(order == 0, order)
    )


def stats_coproprietes(t: Tables) -> DataFrame:
    lots = F.col("nb_lots")
    size = (
        F.when(lots < 10, "Petite (1-9 lots)").when(lots <= 50, "Moyenne (10-50 lots)")
        .otherwise("Grande (>50 lots)")
    )
    cp = _with(t["copropriete"], "nb_lots").select(KEY, "nb_lots")
    return (
        t["annonces"].join(cp, KEY).groupBy(size.alias("taille_copropriete"))
        .agg(_count("nombre_biens"), _mean("prix", "prix_moyen"), _mean("nb_lots", "lots_moyens", 1))
        .orderBy(F.desc("nombre_biens"), "taille_copropriete")
    )


def photo_bucket(n: Column) -> Column:
    return (
        F.when(n == 0, "Aucune photo").when(n.between(1, 5), "1-5 photos")
        .when(n.between(6, 10), "6-10 photos").when(n > 10, "Plus de 10 photos")
        .otherwise("Non renseigné")
    )


def stats_qualite_annonces(t: Tables) -> DataFrame:
    return (
        t["annonces"].groupBy(
            photo_bucket(F.col("nombre_photos")).alias("nb_photos"),
            description_length_bucket(F.col("description")).alias("longueur_description"),
        )
        .agg(_count(), _mean("prix", "prix_moyen"))
        .orderBy(F.desc("nombre_annonces"), "nb_photos", "longueur_description")
    )


def stats_rapport_surface_prix(t: Tables, least: int = 3) -> DataFrame:
    # both averages run over the same rows, so their quotient is the quotient of the sums
    ratio = F.try_divide(F.sum("prix"), F.sum("surface"))
    return (
        _with(t["annonces"], "prix", "surface", "localisation").groupBy("localisation")
        .agg(
            _count(), _mean("surface", "surface_moyenne"), _mean("prix", "prix_moyen"),
            as_double(F.round(ratio, 2)).alias("prix_m2_moyen"),
            _low("prix_au_m2", "prix_m2_min"), _high("prix_au_m2", "prix_m2_max"),
        )
        .filter(F.col("nombre_annonces") >= least)
        .orderBy(F.desc_nulls_last("prix_m2_moyen"), "localisation")
    )


def stats_conseillers(t: Tables, least: int = 2) -> DataFrame:
    c = t["conseiller"].select(KEY, "nom_complet")
    a = t["annonces"].select(KEY, "prix", "surface", "date_extraction")
    return (
        c.join(a, KEY).groupBy("nom_complet")
        .agg(
            _count(), _mean("prix", "prix_moyen_geres"),
            _mean("surface", "surface_moyenne_geres"),
            F.min("date_extraction").alias("premiere_annonce"),
            F.max("date_extraction").alias("derniere_annonce"),
        )
        .filter(F.col("nombre_annonces") >= least)
        .orderBy(F.desc("nombre_annonces"), "nom_complet")
    )


def stats_saisonnalite(t: Tables) -> DataFrame:
    return (
        t["annonces"].groupBy(
            F.month("date_extraction").alias("mois"),
            F.date_format("date_extraction", "MMMM").alias("nom_mois"),
        )
        .agg(_count("nombre_nouvelles_annonces"), _mean("prix", "prix_moyen"))
        .orderBy("mois")
    )


def stats_visites_virtuelles(t: Tables) -> DataFrame:
    return (
        t["annonces"].groupBy(F.col("has_visite_virtuelle").alias("visite_virtuelle_disponible"))
        .agg(_count(), _mean("prix", "prix_moyen"), _mean("nombre_photos", "photos_moyennes", 1))
        .withColumn("pourcentage_total", share_of(F.col("nombre_annonces"), _all("nombre_annonces")))
        .orderBy(F.desc("nombre_annonces"))
    )


def stats_comparaison_dpe(t: Tables) -> DataFrame:
    d = _with(t["dpe"], "classe_energie", "classe_climat").select(KEY, "classe_energie", "classe_climat")
    return (
        t["annonces"].join(d, KEY).groupBy("classe_energie", "classe_climat")
        .agg(
            _count("nombre_biens"), _mean("prix_au_m2", "prix_m2_moyen"),
            _mean("surface", "surface_moyenne"),
        )
        .orderBy("classe_energie", "classe_climat")
    )


def synthese_generale(t: Tables) -> DataFrame:
    """One row: one aggregate per table, put together as scalar subqueries."""
    def rows(name: str) -> Column:
        return t[name].agg(F.count("*")).scalar()

    a = t["annonces"]
    places = a.agg(F.count_distinct("localisation")).scalar()
    return a.agg(
        _count("total_annonces"), _mean("prix", "prix_moyen_general"),
        _mean("prix_au_m2", "prix_m2_moyen_general"), _mean("surface", "surface_moyenne_generale"),
        F.max("date_extraction").alias("derniere_mise_a_jour"),
    ).withColumns({
        "communes_couvertes": places,
        "total_photos": rows("images"),
        "total_conseillers": rows("conseiller"),
    })


def annonces_complete(t: Tables) -> DataFrame:
    """Listings with price and surface, their agent, energy and co-ownership columns."""
    given = F.col("prix_au_m2")
    computed = F.coalesce(given, price_per_m2_decimal(F.col("prix"), F.col("surface")))
    agent = t["conseiller"].select(
        KEY, *[F.col(n).alias(f"conseiller_{m}") for n, m in
               [("nom_complet", "nom"), ("telephone", "telephone"), ("photo", "photo"), ("note", "note")]]
    )
    energy = t["dpe"].select(KEY, "classe_energie", "indice_energie", "classe_climat", "indice_climat")
    shared = t["copropriete"].select(KEY, "nb_lots", "charges_previsionnelles", "procedures")
    return (
        _with(t["annonces"], "prix", "surface")
        .join(agent, KEY, "left").join(energy, KEY, "left").join(shared, KEY, "left")
        .withColumn("prix_au_m2_calcule", computed)
    )


def annonces_complete_counts(t: Tables) -> DataFrame:
    """Listings with their single children and the number of images and features.

    Children are counted before the join: joining both first would give images x features rows.
    """
    def count_of(name: str, out: str) -> DataFrame:
        return t[name].groupBy(KEY).agg(_count(out))

    return (
        t["annonces"]
        .join(t["conseiller"].select(
            KEY, F.col("nom_complet").alias("conseiller_nom"),
            F.col("telephone").alias("conseiller_telephone")), KEY, "left")
        .join(t["dpe"].select(KEY, "classe_energie", "classe_climat"), KEY, "left")
        .join(t["copropriete"].select(KEY, F.col("nb_lots").alias("copropriete_nb_lots")), KEY, "left")
        .join(count_of("images", "total_images"), KEY, "left")
        .join(count_of("caracteristiques", "total_caracteristiques"), KEY, "left")
        .fillna(0, ["total_images", "total_caracteristiques"])
    )


def stats_localisation(t: Tables, variant: str = "price") -> DataFrame:
    """Per location (``price`` and ``count`` differ in order and measures) or per postal code."""
    if variant == "postal":
        return (
            _with(t["annonces_preparees"], "code_postal").groupBy("code_postal", "ville")
            .agg(_count(), _mean("prix", "prix_moyen"), _mean("prix_au_m2", "prix_m2_moyen"))
            .orderBy(F.desc_nulls_last("prix_m2_moyen"), "code_postal", "ville")
        )
    a = t["annonces"]
    if variant == "price":
        return (
            a.groupBy("localisation")
            .agg(_count(), _mean("prix", "prix_moyen"), _mean("surface", "surface_moyenne"))
            .orderBy(F.desc_nulls_last("prix_moyen"), "localisation")
        )
    return (
        _with(a, "localisation").groupBy("localisation")
        .agg(
            _count(),
            (F.sum("prix").cast("double") / F.nullif(F.count("prix"), F.lit(0))).alias("prix_moyen"),
            (F.sum("prix_au_m2").cast("double") / F.nullif(F.count("prix_au_m2"), F.lit(0))).alias(
                "prix_m2_moyen"
            ),
        )
        .orderBy(F.desc("nombre_annonces"), "localisation")
    )


def stats_dpe(t: Tables, variant: str = "index") -> DataFrame:
    """Per energy class, with the average index, surface or price per m²."""
    if variant == "index":
        d = _with(t["dpe"], "classe_energie").select(KEY, "classe_energie", "indice_energie")
        return (
            t["annonces"].join(d, KEY).groupBy("classe_energie")
            .agg(_count(), _mean("prix", "prix_moyen"), _mean("indice_energie", "indice_energie_moyen"))
            .orderBy("classe_energie")
        )
    if variant == "surface":
        return (
            _with(t["annonces"], "dpe_classe_active").groupBy("dpe_classe_active")
            .agg(
                _count(),
                (F.sum("prix").cast("double") / F.nullif(F.count("prix"), F.lit(0))).alias("prix_moyen"),
                (F.sum("surface").cast("double") / F.nullif(F.count("surface"), F.lit(0))).alias(
                    "surface_moyenne"
                ),
            )
            .orderBy("dpe_classe_active")
        )
    return (
        _with(t["annonces_preparees"], "dpe_classe").groupBy("dpe_classe")
        .agg(_count(), _mean("prix", "prix_moyen"), _mean("prix_au_m2", "prix_m2_moyen"))
        .orderBy("dpe_classe")
    )


def stats_pieces(t: Tables) -> DataFrame:
    return (
        _with(t["annonces"], "pieces").groupBy("pieces")
        .agg(_count(), _mean("prix", "prix_moyen"), _mean("surface", "surface_moyenne"))
        .orderBy("pieces")
    )


def annonces_caracteristiques(t: Tables) -> DataFrame:
    """Features of each listing as one text, in alphabetical order.

    Equal features are counted before the shuffle and written out again per listing, so repeated
    values of one listing travel as one row.
    """
    counted = t["caracteristiques"].groupBy(KEY, "valeur").agg(F.count("*").cast("int").alias("_n"))
    repeated = F.array_join(F.array_repeat(F.col("valeur"), F.col("_n")), ", ")
    joined = counted.withColumn("_text", repeated).groupBy(KEY).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("valeur", "_text"))), lambda x: x["_text"]),
            ", ",
        ).alias("caracteristiques")
    )
    return t["annonces"].select(KEY, "reference", "titre", "prix").join(joined, KEY, "left")


def annonces_preparees(t: Tables) -> DataFrame:
    """Flat view of the module tables: left joins on the listing key."""
    parts = {
        "prix": {"valeur": "prix", "au_m2": "prix_au_m2"},
        "surface": {"valeur": "surface", "surface_par_piece": "surface_par_piece"},
        "composition": {n: n for n in ("pieces", "chambres", "type_bien")},
        "localisation": {
            n: n for n in ("ville", "code_postal", "quartier", "proximite", "score_emplacement")
        },
        "batiment": {
            n: n for n in
            ("annee_construction", "age_bien", "etage", "etage_total", "ascenseur", "score_modernite")
        },
        "diagnostics": {n: n for n in ("dpe_classe", "dpe_score", "ges_classe", "ges_score")},
        "copropriete_module": {n: n for n in ("nb_lots", "charges_valeur", "charges_unite")},
        "contact": {n: n for n in ("conseiller_nom", "conseiller_telephone")},
    }
    out = t["annonces_prep"].select(KEY, "reference", "titre", "score_qualite")
    for name, columns in parts.items():
        part = t[name].select(KEY, *[F.col(a).alias(b) for a, b in columns.items()])
        out = out.join(part, KEY, "left")
    return out


def annonces_preparees_from_documents(
    prepared: DataFrame, key: str = KEY, more: list[str] | None = None
) -> DataFrame:
    """The same view straight from the nested documents: one projection, no join.

    ``more`` names further columns to show.
    """
    c = F.col
    contact = (
        (F.coalesce(c("contact.conseiller"), F.lit("")) != "")
        | (F.coalesce(c("contact.telephone"), F.lit("")) != "")
        | (F.coalesce(c("contact.lien"), F.lit("")) != "")
    )
    room = surface_per_room(c("surface.valeur"), c("composition.pieces"))
    return prepared.select(
        key, "reference", "titre", c("metadata.score_qualite").alias("score_qualite"),
        c("prix.valeur").try_cast("decimal(12,2)").alias("prix"),
        c("prix.au_m2").try_cast("decimal(10,2)").alias("prix_au_m2"),
        c("surface.valeur").try_cast("decimal(8,2)").alias("surface"),
        room.try_cast("decimal(6,2)").alias("surface_par_piece"),
        c("composition.pieces").try_cast("int").alias("pieces"),
        c("composition.chambres").try_cast("int").alias("chambres"),
        "composition.type_bien", "localisation.ville", "localisation.code_postal",
        "localisation.quartier", "localisation.proximite",
        F.lit(None).cast("decimal(3,1)").alias("score_emplacement"),
        "batiment.annee_construction", "batiment.age_bien", "batiment.etage",
        "batiment.etage_total", F.coalesce(c("batiment.ascenseur"), F.lit(False)).alias("ascenseur"),
        F.lit(None).cast("decimal(3,1)").alias("score_modernite"),
        c("diagnostics.dpe.classe").alias("dpe_classe"), c("diagnostics.dpe.score").alias("dpe_score"),
        c("diagnostics.ges.classe").alias("ges_classe"), c("diagnostics.ges.score").alias("ges_score"),
        c("copropriete.nb_lots").try_cast("int").alias("nb_lots"),
        c("copropriete.charges.valeur").try_cast("decimal(8,2)").alias("charges_valeur"),
        c("copropriete.charges.unite").alias("charges_unite"),
        F.when(contact, c("contact.conseiller")).alias("conseiller_nom"),
        F.when(contact, c("contact.telephone")).alias("conseiller_telephone"),
        *(more or []),
    )


def annonces_aggregats(t: Tables) -> DataFrame:
    """Prepared view with the aggregate columns, the estimated yield among them."""
    g = t["aggregats"].select(
        KEY, "score_global", "positionnement_marche", "segment_marche", "potentiel_renovation",
        "recommandations_prix", "rendement_annuel_estime",
    )
    return t["annonces_preparees"].join(g, KEY)


def stats_performance(t: Tables) -> DataFrame:
    return t["annonces_aggregats"].agg(
        _count("total_annonces"), _mean("prix", "prix_moyen"), _mean("prix_au_m2", "prix_m2_moyen"),
        _mean("score_global", "score_moyen"), _mean("rendement_annuel_estime", "rendement_moyen"),
    )


def stats_segmentation(t: Tables) -> DataFrame:
    return (
        _with(t["annonces_aggregats"], "segment_marche").groupBy("segment_marche")
        .agg(
            _count(), _mean("prix", "prix_moyen"), _mean("score_global", "score_moyen"),
            _mean("rendement_annuel_estime", "rendement_moyen"),
        )
        .orderBy(F.desc("nombre_annonces"), "segment_marche")
    )


def aggregats_complets(t: Tables, key: str = KEY) -> DataFrame:
    """Aggregates with their listing and location; ``key`` links every table."""
    pick = {
        "performance_financiere": [
            "prix_m2_calcule", "loyer_estime_mensuel", "rendement_annuel_estime", "niveau_rendement",
        ],
        "scores_avances": ["score_emplacement", "score_modernite", "score_dpe"],
        "segmentation": ["segment_prix_m2", "segment_surface", "segment_cible"],
        "analyse_marche": [
            "positionnement_marche", "ecart_pourcentage", "z_score_prix_m2",
            "prix_m2_marche_reference",
        ],
        "localisation": ["ville", "code_postal", "quartier"],
    }
    main = t["aggregats_principaux"].select(
        key, "score_global", "segment_marche_global", "statut_optimisation"
    )
    out = t["annonces_prep"].select(key, "reference", "titre").join(main, key)
    for name, columns in pick.items():
        out = out.join(t[name].select(key, *columns), key, "left")
    return out


def stats_aggregats(t: Tables) -> DataFrame:
    v = t["v_aggregats_complets"]
    segments = {n: n for n in ("economique", "moyen", "superieur", "premium", "luxe")}
    positions = {
        "tres_sous_cote": "tres_sous_cote", "sous_cote": "sous_cote", "dans_la_moyenne": "moyenne",
        "sur_cote": "sur_cote", "tres_sur_cote": "tres_sur_cote",
    }
    # "moyen" counts a price segment, "moyenne" a market position
    return v.agg(
        _count("total_aggregats"), _mean("score_global", "score_global_moyen"),
        _mean("prix_m2_calcule", "prix_m2_moyen"), _mean("rendement_annuel_estime", "rendement_moyen"),
        *[F.count_if(F.col("segment_prix_m2") == k).alias(f"nb_{n}") for k, n in segments.items()],
        *[F.count_if(F.col("positionnement_marche") == k).alias(f"nb_{n}") for k, n in positions.items()],
    )


def recommandations_actives(t: Tables, key: str = KEY) -> DataFrame:
    active = t["recommandations"].filter(F.col("priorite").isin("haute", "critique")).select(
        key, "type_recommandation", "priorite", "description", "action_concrete"
    )
    main = t["aggregats_principaux"].select(key, "score_global")
    a = t["annonces_prep"].select(key, "reference", "titre")
    return (
        active.join(a.join(main, key), key).drop(key)
        .orderBy(F.desc("priorite"), F.desc_nulls_last("score_global"), "reference")
    )


def _priced_apart(t: Tables, labels: list[str], ascending: bool) -> DataFrame:
    gap = F.asc("ecart_pourcentage") if ascending else F.desc("ecart_pourcentage")
    return (
        t["v_aggregats_complets"].filter(F.col("positionnement_marche").isin(labels))
        .select(
            "reference", "titre", "prix_m2_calcule", "prix_m2_marche_reference",
            "ecart_pourcentage", "score_global", "segment_marche_global",
        )
        .orderBy(gap, "reference")
    )


def biens_sous_cotes(t: Tables) -> DataFrame:
    return _priced_apart(t, ["tres_sous_cote", "sous_cote"], True)


def biens_sur_cotes(t: Tables) -> DataFrame:
    return _priced_apart(t, ["tres_sur_cote", "sur_cote"], False)


def prix_par_type_et_localisation(t: Tables, least: int = 5) -> DataFrame:
    return (
        _with(t["annonces"], "prix").groupBy("type_bien", "localisation")
        .agg(_mean("prix", "prix_moyen"), _count("nb_annonces"))
        .filter(F.col("nb_annonces") >= least)
        .orderBy("type_bien", F.desc("prix_moyen"), "localisation")
    )


def caracteristiques_par_type(t: Tables, top: int | None = None) -> DataFrame:
    """Feature counts per property type; ``top`` keeps the most frequent of each type.

    Features are counted per listing and value before the join, and summed after it.
    """
    per_listing = t["caracteristiques"].groupBy(KEY, "valeur").agg(F.count("*").alias("_n"))
    counts = (
        per_listing.join(t["annonces"].select(KEY, "type_bien"), KEY)
        .groupBy("type_bien", F.col("valeur").alias("caracteristique"))
        .agg(F.sum("_n").alias("frequence"))
    )
    order = [F.desc("frequence"), F.col("caracteristique")]
    if top is not None:
        rank = F.row_number().over(Window.partitionBy("type_bien").orderBy(*order))
        counts = counts.withColumn("_rang", rank).filter(F.col("_rang") <= top).drop("_rang")
    return counts.orderBy("type_bien", *order)


def evolution_mensuelle(t: Tables) -> DataFrame:
    return (
        t["annonces"].groupBy(F.trunc("date_extraction", "month").alias("mois"))
        .agg(_count("nouvelles_annonces"), _mean("prix", "prix_moyen"))
        .orderBy(F.desc("mois"))
    )


def filtered_views(t: Tables) -> dict[str, DataFrame]:
    """The views narrowed once more, as the documentation shows them."""
    n = F.col("nombre_annonces")
    return {
        "type_bien_frequents": stats_type_bien(t).filter(n > 10),
        "pieces_1_a_5": stats_par_pieces(t).filter(F.col("pieces").between(1, 5)),
        "caracteristiques_top_10": stats_caracteristiques_populaires(t).orderBy(
            F.desc("frequence"), "caracteristique").limit(10),
        "qualite_frequente": stats_qualite_annonces(t).filter(n > 5),
        "rapport_frequent": stats_rapport_surface_prix(t).filter(n > 10),
        "conseillers_actifs": stats_conseillers(t).filter(n > 5),
        "conseillers_top_10": stats_conseillers(t).select(
            "nom_complet", "nombre_annonces", "prix_moyen_geres", "surface_moyenne_geres"
        ).orderBy(F.desc("nombre_annonces"), "nom_complet").limit(10),
        "dpe_frequents": stats_comparaison_dpe(t).filter(F.col("nombre_biens") >= 10).select(
            "classe_energie", "classe_climat", "nombre_biens", "prix_m2_moyen"),
    }


def prix_m2_du_type(t: Tables, type_bien: str) -> DataFrame:
    """Monthly price per m² of one property type."""
    return stats_prix_m2_par_mois(t).filter(F.col("type_bien") == type_bien)


def api_statistics(t: Tables) -> dict[str, DataFrame]:
    a = t["annonces"]
    priced = _with(a, "prix")

    def exact_mean(name: str) -> Column:
        return (F.sum(name).cast("double") / F.nullif(F.count(name), F.lit(0)))

    return {
        "total": a.agg(_count("total_annonces")),
        "annonces_par_type": _with(a, "type_bien").groupBy("type_bien").agg(_count("count")),
        "moyennes": priced.agg(
            exact_mean("prix").alias("prix_moyen"), exact_mean("surface").alias("surface_moyenne")
        ),
        "distribution_dpe": _with(a, "dpe_classe_active").groupBy("dpe_classe_active").agg(
            _count("count")),
    }


def part_par_type(t: Tables) -> DataFrame:
    """Share of each type in all listings, those without a type included in the total."""
    return (
        t["annonces"].groupBy("type_bien").agg(_count("count"))
        .withColumn("percentage", share_of(F.col("count"), _all("count")))
        .filter(F.col("type_bien").isNotNull())
        .orderBy(F.desc("count"), "type_bien")
    )


def stats_prix_surface(t: Tables) -> DataFrame:
    return _with(t["annonces"], "prix", "surface").agg(
        _count("total_annonces"), _mean("prix", "prix_moyen"),
        _mean("surface", "surface_moyenne"), _low("prix", "prix_min"), _high("prix", "prix_max"),
    )


def dernieres_annonces(t: Tables, n: int = 3) -> DataFrame:
    return (
        t["annonces"].select("reference", "titre", "prix", "localisation", "date_extraction")
        .orderBy(F.desc_nulls_last("date_extraction"), F.desc("reference")).limit(n)
    )


def flat_statistics(flat: DataFrame) -> dict[str, DataFrame]:
    """Counts by type and summaries of price, surface and quality of the flat listings."""
    def summary(name: str) -> DataFrame:
        c = F.col(name).cast("double")
        return flat.filter(F.col(name).isNotNull()).agg(
            F.count("*").alias("count"),
            (F.sum(F.col(name).cast("decimal(28,8)")).cast("double") / F.nullif(F.count("*"), F.lit(0))).alias("mean"),
            F.stddev_samp(c).alias("stddev"), F.min(c).alias("min"), F.max(c).alias("max"),
        )

    return {
        "types": flat.groupBy("composition_type_bien").agg(_count("count")).orderBy(
            F.desc("count"), "composition_type_bien"),
        "prix": summary("prix_valeur"),
        "surface": summary("surface_valeur"),
        "qualite": summary("data_quality_score"),
    }


def top_villes(flat: DataFrame, least: int = 5, top: int = 10) -> DataFrame:
    """Cities by average price per m²."""
    priced = flat.filter(F.col("prix_valeur").isNotNull() & (F.col("surface_valeur") > 0))
    per_m2 = (F.col("prix_valeur") / F.col("surface_valeur")).cast("decimal(28,8)")
    return (
        priced.groupBy("localisation_ville")
        .agg(
            (F.sum(per_m2).cast("double") / F.count("*")).alias("prix_m2_moyen"),
            F.count("reference").alias("nb_annonces"),
        )
        .filter(F.col("nb_annonces") >= least)
        .orderBy(F.desc("prix_m2_moyen"), "localisation_ville")
        .limit(top)
    )


def document_statistics(documents: DataFrame) -> dict[str, DataFrame]:
    """Group, top-5 and average over nested documents."""
    def counted(path: str, name: str) -> DataFrame:
        return documents.groupBy(F.col(path).alias(name)).agg(_count("count")).orderBy(
            F.desc("count"), F.asc_nulls_last(name))

    price = F.col("prix.valeur")
    return {
        "types": counted("composition.type_bien", "type_bien"),
        "villes": counted("localisation.ville", "ville").limit(5),
        "prix": documents.filter(price.isNotNull()).agg(
            (F.sum(price.cast("decimal(28,8)")).cast("double") / F.count("*")).alias("prix_moyen")),
    }


def document_count(documents: DataFrame) -> DataFrame:
    return documents.agg(_count("total"))


def first_documents(documents: DataFrame, n: int = 5, key: str = "reference") -> DataFrame:
    """The first ``n`` documents by key."""
    return documents.orderBy(key).limit(n)


def document_sample(documents: DataFrame, n: int = 3, seed: int = 0, key: str = "reference") -> DataFrame:
    """A random sample of ``n`` documents, the same for every run with one seed."""
    return documents.orderBy(F.md5(F.concat(F.lit(str(seed)), F.col(key))), key).limit(n)
