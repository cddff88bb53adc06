"""Normalised child tables from cleaned rows and nested documents.

Each table is one narrow select; ``key`` is the natural key that replaces serial ids.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcela.functions.numbers import parse_iso_timestamp, strip, surface_per_room
from parcela.functions.text import categorise_feature
from parcela.operators import market as mkt


def _decimal(c: Column, precision: int, scale: int) -> Column:
    return c.try_cast(f"decimal({precision},{scale})")


def _filled(*names: str) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(n).cast("string"), F.lit("")) != "" for n in names])


def shred_features(
    df: DataFrame, key: str = "reference", features: str = "caracteristiques", category: bool = False
) -> DataFrame:
    """One row per non-blank feature, trimmed; with its category in the prepared model."""
    texts = F.filter(F.transform(F.col(features), strip), lambda x: x != "")
    out = df.select(key, F.explode(texts).alias("valeur"))
    return out.withColumn("categorie", categorise_feature(F.col("valeur"))) if category else out


def shred_images(df: DataFrame, key: str = "reference", images: str = "images") -> DataFrame:
    """One row per non-blank image; the 1-based order also counts blank entries."""
    return (
        df.select(key, F.posexplode(images).alias("_p", "_url"))
        .select(key, strip(F.col("_url")).alias("url"), (F.col("_p") + 1).alias("ordre"))
        .filter(F.col("url") != "")
    )


def shred_media(prepared: DataFrame, key: str = "reference") -> DataFrame:
    """Images and one marker row each for a video and a virtual tour, from a single scan."""
    photos = F.transform(
        F.col("medias.images"),
        lambda url, i: F.struct(
            strip(url).alias("url"), F.lit("image").alias("type_media"), (i + 1).alias("ordre")
        ),
    )

    def marker(flag: str, url: str, kind: str) -> Column:
        entry = F.struct(F.lit(url).alias("url"), F.lit(kind).alias("type_media"), F.lit(0).alias("ordre"))
        return F.when(F.col(flag), F.array(entry)).otherwise(F.array().cast(
            "array<struct<url:string,type_media:string,ordre:int>>"
        ))

    entries = F.concat(
        F.filter(photos, lambda p: p["url"] != ""),
        marker("medias.has_video", "video_presente", "video"),
        marker("medias.has_visite_virtuelle", "visite_virtuelle_presente", "visite_virtuelle"),
    )
    return prepared.select(key, F.inline(entries))


def shred_agent(cleaned: DataFrame, key: str = "reference") -> DataFrame:
    names = ["nom_complet", "telephone", "lien", "photo", "note"]
    return cleaned.filter(
        _filled("conseiller_nom_complet", "conseiller_telephone", "conseiller_lien")
    ).select(key, *[strip(F.col(f"conseiller_{n}")).alias(n) for n in names])


def shred_contact(prepared: DataFrame, key: str = "reference") -> DataFrame:
    return prepared.filter(_filled("contact.conseiller", "contact.telephone", "contact.lien")).select(
        key,
        F.col("contact.conseiller").alias("conseiller_nom"),
        F.col("contact.telephone").alias("conseiller_telephone"),
        F.col("contact.photo").alias("conseiller_photo"),
        F.col("contact.lien").alias("conseiller_lien"),
    )


def shred_energy(cleaned: DataFrame, key: str = "reference") -> DataFrame:
    """Energy classes of the listings that have one; the indices are not in the source."""
    return cleaned.filter(_filled("dpe_classe_active", "ges_classe_active")).select(
        key,
        F.col("dpe_classe_active").alias("classe_energie"),
        F.lit(None).cast("int").alias("indice_energie"),
        F.col("ges_classe_active").alias("classe_climat"),
        F.lit(None).cast("int").alias("indice_climat"),
    )


def shred_coownership(cleaned: DataFrame, key: str = "reference") -> DataFrame:
    """Co-ownership rows of the listings with lots, charges or procedures; 0 lots counts as none."""
    names = ["nb_lots", "charges_previsionnelles", "procedures"]
    some = (F.coalesce(F.col("copropriete_nb_lots"), F.lit(0)) != 0) | _filled(
        "copropriete_charges_previsionnelles", "copropriete_procedures"
    )
    return cleaned.filter(some).select(key, *[F.col(f"copropriete_{n}").alias(n) for n in names])


def shred_coownership_module(prepared: DataFrame, key: str = "reference") -> DataFrame:
    return prepared.select(
        key,
        F.col("copropriete.nb_lots").try_cast("int").alias("nb_lots"),
        _decimal(F.col("copropriete.charges.valeur"), 8, 2).alias("charges_valeur"),
        F.col("copropriete.charges.unite").alias("charges_unite"),
        F.col("copropriete.charges.periode").alias("charges_periode"),
        F.coalesce(F.col("copropriete.procedures_en_cours"), F.lit(False)).alias("procedures_en_cours"),
    )


def shred_modules(prepared: DataFrame, key: str = "reference") -> dict[str, DataFrame]:
    """The module tables of the prepared model."""
    c = F.col
    room = surface_per_room(c("surface.valeur"), c("composition.pieces"))
    return {
        "annonces": prepared.select(
            *dict.fromkeys([key, "reference"]),
            "titre", "description", "url_annonce",
            parse_iso_timestamp(c("metadata.date_extraction")).alias("date_extraction"),
            c("metadata.score_qualite").alias("score_qualite"),
            c("metadata.champs_manquants").alias("champs_manquants"),
            c("metadata.etapes_traitees").alias("etapes_traitees"),
        ),
        "prix": prepared.select(
            key,
            _decimal(c("prix.valeur"), 12, 2).alias("valeur"),
            c("prix.devise").alias("devise"),
            _decimal(c("prix.au_m2"), 10, 2).alias("au_m2"),
            F.lit(None).cast("decimal(10,2)").alias("loyer_estime_mensuel"),
            F.lit(None).cast("decimal(5,2)").alias("rendement_annuel_estime"),
        ),
        "surface": prepared.select(
            key,
            _decimal(c("surface.valeur"), 8, 2).alias("valeur"),
            c("surface.unite").alias("unite"),
            _decimal(room, 6, 2).alias("surface_par_piece"),
        ),
        "composition": prepared.select(
            key,
            c("composition.pieces").try_cast("int").alias("pieces"),
            c("composition.chambres").try_cast("int").alias("chambres"),
            c("composition.type_bien").alias("type_bien"),
        ),
        "localisation": prepared.select(
            key, "localisation.ville", "localisation.code_postal", "localisation.quartier",
            "localisation.proximite", F.lit(None).cast("decimal(3,1)").alias("score_emplacement"),
        ),
        "batiment": prepared.select(
            key, "batiment.annee_construction", "batiment.age_bien", "batiment.etage",
            "batiment.etage_total",
            F.coalesce(c("batiment.ascenseur"), F.lit(False)).alias("ascenseur"),
            F.lit(None).cast("decimal(3,1)").alias("score_modernite"),
        ),
        "diagnostics": prepared.select(
            key,
            *[
                c(f"diagnostics.{kind}.{name}").alias(f"{kind}_{name}")
                for kind in ("dpe", "ges")
                for name in ("classe", "score", "indice")
            ],
        ),
        "copropriete": shred_coownership_module(prepared, key),
        "caracteristiques": shred_features(prepared, key, category=True),
        "medias": shred_media(prepared, key),
        "contact": shred_contact(prepared, key),
    }


def shred_aggregates(aggregated: mkt.Aggregated, key: str = "reference") -> dict[str, DataFrame]:
    """The detail tables of the aggregate model; ``key`` stands for the aggregate's id."""
    c = F.col
    perf, seg, pos = "aggregats.performance", "aggregats.segmentation", "aggregats.analyse_marche"
    b = "batiment"
    age, lift, floor = c(f"{b}.age_bien"), c(f"{b}.ascenseur"), c(f"{b}.etage")
    net = F.coalesce(c(f"{perf}.rentabilite_nette"), F.lit(0.0))
    gross = F.coalesce(c(f"{perf}.rendement_annuel_estime"), F.lit(0.0))
    z = F.coalesce(c(f"{pos}.z_score_prix_m2"), F.lit(0.0))
    meta = "aggregats.metadata_aggregation"
    segments = [f"segmentation.{n}" for n in ("prix_m2", "surface", "age")]

    return {
        "aggregats_principaux": mkt.narrowed(
            aggregated, "metadata_aggregation.date_aggregation", "metadata_aggregation.algorithme_version", "scores.global", *segments
        ).select(
            key,
            parse_iso_timestamp(c(f"{meta}.date_aggregation")).alias("date_aggregation"),
            c(f"{meta}.algorithme_version").alias("algorithme_version"),
            _decimal(c("aggregats.scores.global"), 3, 1).alias("score_global"),
            mkt.global_segment_label(
                c(f"{seg}.prix_m2"), c(f"{seg}.surface"), c(f"{seg}.age")
            ).alias("segment_marche_global"),
            F.lit("a_analyser").alias("statut_optimisation"),
        ),
        "performance_financiere": mkt.narrowed(aggregated, *[f"performance.{n}" for n in (
            "prix_m2", "loyer_estime_mensuel", "rendement_annuel_estime", "rentabilite_nette", "charges_annuelles")]).select(
            key,
            _decimal(c(f"{perf}.prix_m2"), 10, 2).alias("prix_m2_calcule"),
            _decimal(c(f"{perf}.loyer_estime_mensuel"), 10, 2).alias("loyer_estime_mensuel"),
            _decimal(gross, 5, 2).alias("rendement_annuel_estime"),
            _decimal(net, 5, 2).alias("rentabilite_nette"),
            _decimal(c(f"{perf}.charges_annuelles"), 8, 2).alias("charges_annuelles"),
            mkt.profit_ratio(net).alias("ratio_rentabilite"),
            mkt.yield_level(gross).alias("niveau_rendement"),
        ),
        "scores_avances": mkt.narrowed(aggregated, "scores.emplacement", "scores.modernite").select(
            key,
            _decimal(c("aggregats.scores.emplacement"), 3, 1).alias("score_emplacement"),
            _decimal(c("aggregats.scores.modernite"), 3, 1).alias("score_modernite"),
            # the documents hold no separate energy score: the modernity score stands in
            _decimal(c("aggregats.scores.modernite"), 3, 1).alias("score_dpe"),
            F.lit(6.0).cast("decimal(3,1)").alias("score_equipements"),
            _decimal(mkt.accessibility_score(lift, floor), 3, 1).alias("score_accessibilite"),
            _decimal(
                mkt.media_score(
                    c("medias.nombre_photos"), c("medias.has_video"), c("medias.has_visite_virtuelle")
                ), 3, 1,
            ).alias("score_medias"),
            *[
                F.lit(str(w)).cast("decimal(3,2)").alias(f"ponderation_{n}")
                for n, w in mkt.WEIGHTS.items()
            ],
        ),
        "segmentation": mkt.narrowed(aggregated, *segments).select(
            key,
            c(f"{seg}.prix_m2").alias("segment_prix_m2"),
            c(f"{seg}.surface").alias("segment_surface"),
            c(f"{seg}.age").alias("segment_age"),
            mkt.target_segment(c(f"{seg}.prix_m2"), age, lift, floor).alias("segment_cible"),
            mkt.potential_segment(c("diagnostics.dpe.score"), age).alias("segment_potentiel"),
        ),
        "analyse_marche": mkt.narrowed(
            aggregated, *[f"analyse_marche.{n}" for n in ("positionnement_marche", "z_score_prix_m2", "ecart_pourcentage", "prix_m2_marche_reference")],
            "metadata_aggregation.marche_reference",
        ).select(
            key,
            c(f"{pos}.positionnement_marche").alias("positionnement_marche"),
            _decimal(z, 5, 2).alias("z_score_prix_m2"),
            _decimal(c(f"{pos}.ecart_pourcentage"), 8, 2).alias("ecart_pourcentage"),
            _decimal(c(f"{pos}.prix_m2_marche_reference"), 10, 2).alias("prix_m2_marche_reference"),
            c(f"{meta}.marche_reference.nombre_biens_reference").alias("nombre_biens_reference"),
            F.lit(None).cast("decimal(10,2)").alias("ecart_type_marche"),
            mkt.percentile_rank_approx(z).alias("rang_percentile"),
        ),
        "recommandations": shred_recommendations(aggregated, key),
    }


def shred_recommendations(aggregated: mkt.Aggregated, key: str = "reference") -> DataFrame:
    """One row per recommendation, with its priority, action, impact and delay."""
    kinds = ["prix", "marketing", "amelioration", "ciblage"]

    def tagged(name: str) -> Column:
        texts = F.coalesce(F.col(f"aggregats.recommandations.{name}"), F.array().cast("array<string>"))
        return F.transform(
            texts,
            lambda text: F.struct(F.lit(name).alias("type_recommandation"), text.alias("description")),
        )

    kind, text = F.col("type_recommandation"), F.col("description")
    return (
        mkt.narrowed(aggregated, *[f"recommandations.{k}" for k in kinds])
        .select(key, F.inline(F.concat(*[tagged(k) for k in kinds])))
        .filter(text != "")
        .withColumns({
            "priorite": mkt.recommendation_priority(kind),
            "action_concrete": mkt.recommendation_action(kind, text),
            "impact_estime": mkt.recommendation_impact(kind),
            "delai_recommandation": mkt.recommendation_delay(kind),
        })
    )


def flat_aggregates(aggregated: mkt.Aggregated, key: str = "reference") -> DataFrame:
    """The wide aggregate table of the prepared model: one row per listing."""
    c = F.col
    perf, seg, pos = "aggregats.performance", "aggregats.segmentation", "aggregats.analyse_marche"
    reno = mkt.renovation_potential(
        c("diagnostics.dpe.classe"), c("batiment.age_bien"), c("prix.valeur")
    )
    texts = {
        f"recommandations_{k}": F.to_json(c(f"aggregats.recommandations.{k}"))
        for k in ("prix", "marketing", "amelioration", "ciblage")
    }
    read = mkt.narrowed(
        aggregated, *[f"performance.{n}" for n in ("prix_m2", "loyer_estime_mensuel", "rendement_annuel_estime", "rentabilite_nette")],
        *[f"scores.{n}" for n in ("emplacement", "modernite", "global")], *[f"segmentation.{n}" for n in ("prix_m2", "surface", "age")],
        *[f"analyse_marche.{n}" for n in ("positionnement_marche", "z_score_prix_m2", "ecart_pourcentage", "prix_m2_marche_reference")],
        *[f"recommandations.{k}" for k in ("prix", "marketing", "amelioration", "ciblage")],
    )
    return read.select(
        key,
        _decimal(c(f"{perf}.prix_m2"), 10, 2).alias("prix_m2_calcule"),
        _decimal(c(f"{perf}.loyer_estime_mensuel"), 10, 2).alias("loyer_estime_mensuel"),
        _decimal(c(f"{perf}.rendement_annuel_estime"), 5, 2).alias("rendement_annuel_estime"),
        _decimal(c(f"{perf}.rentabilite_nette"), 5, 2).alias("rentabilite_nette"),
        *[
            _decimal(c(f"aggregats.scores.{n}"), 3, 1).alias(f"score_{n}")
            for n in ("emplacement", "modernite", "global")
        ],
        *[c(f"{seg}.{n}").alias(f"segment_{n}") for n in ("prix_m2", "surface", "age")],
        mkt.market_segment_sql(
            c("prix.au_m2"), c("surface.valeur"), c("batiment.age_bien"), c("diagnostics.dpe.score")
        ).alias("segment_marche"),
        c(f"{pos}.positionnement_marche").alias("positionnement_marche"),
        _decimal(c(f"{pos}.z_score_prix_m2"), 5, 2).alias("z_score_prix_m2"),
        _decimal(c(f"{pos}.ecart_pourcentage"), 8, 2).alias("ecart_pourcentage"),
        _decimal(c(f"{pos}.prix_m2_marche_reference"), 10, 2).alias("prix_m2_marche_reference"),
        reno["potentiel"].alias("potentiel_renovation"),
        reno["gain_valeur_estime"].cast("decimal(5,3)").alias("gain_valeur_estime"),
        _decimal(reno["investissement_estime"], 10, 2).alias("investissement_estime"),
        *[v.alias(n) for n, v in texts.items()],
    )
