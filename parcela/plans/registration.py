"""Views under their published names, for people who query with SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from parcela.plans import commerce, views
from parcela.plans.catalogue import register_views

Tables = dict[str, DataFrame]
View = Callable[[Tables], DataFrame]

# Published names of the views over the base tables.
BASE_VIEWS: dict[str, View] = {
    "v_stats_type_bien": views.stats_type_bien,
    "v_stats_prix_m2_par_mois": views.stats_prix_m2_par_mois,
    "v_stats_communes_cheres": views.stats_communes_cheres,
    "v_stats_distribution_surfaces": views.stats_distribution_surfaces,
    "v_stats_performance_energetique": views.stats_performance_energetique,
    "v_stats_par_pieces": views.stats_par_pieces,
    "v_stats_caracteristiques_populaires": views.stats_caracteristiques_populaires,
    "v_stats_annee_construction": views.stats_annee_construction,
    "v_stats_coproprietes": views.stats_coproprietes,
    "v_stats_qualite_annonces": views.stats_qualite_annonces,
    "v_stats_rapport_surface_prix": views.stats_rapport_surface_prix,
    "v_stats_conseillers": views.stats_conseillers,
    "v_stats_saisonnalite": views.stats_saisonnalite,
    "v_stats_visites_virtuelles": views.stats_visites_virtuelles,
    "v_stats_comparaison_dpe": views.stats_comparaison_dpe,
    "v_synthese_generale": views.synthese_generale,
    "annonces_complete": views.annonces_complete,
    "v_stats_localisation": views.stats_localisation,
    "v_stats_dpe": views.stats_dpe,
    "v_stats_pieces": views.stats_pieces,
    "v_annonces_caracteristiques": views.annonces_caracteristiques,
}

# The same for the prepared and aggregated model; later views read earlier ones.
AGGREGATE_VIEWS: dict[str, View] = {
    "annonces_aggregats": views.annonces_aggregats,
    "v_stats_performance": views.stats_performance,
    "v_stats_segmentation": views.stats_segmentation,
    "v_stats_dpe_classe": lambda t: views.stats_dpe(t, "price"),
    "v_stats_code_postal": lambda t: views.stats_localisation(t, "postal"),
    "v_aggregats_complets": views.aggregats_complets,
    "v_stats_aggregats": views.stats_aggregats,
    "v_recommandations_actives": views.recommandations_actives,
    "v_biens_sous_cotes": views.biens_sous_cotes,
    "v_biens_sur_cotes": views.biens_sur_cotes,
}

# The same for the commerce model.
COMMERCE_VIEWS: dict[str, View] = {
    "v1": commerce.commandes_par_client,
    "v2": commerce.chiffre_affaires_par_client,
    "v3": commerce.chiffre_affaires_par_mois,
    "v4": commerce.meilleures_boites_quantite,
    "v5": commerce.meilleures_boites_chiffre,
    "v6": commerce.chiffre_affaires_par_matiere,
    "v7": commerce.chiffre_affaires_par_couleur,
    "v8": commerce.commandes_par_jour_semaine,
    "boites_details": commerce.boites_details,
}


def register_model(tables: Tables, model: dict[str, View]) -> list[str]:
    """Register the tables and every view of a model as temp views; gives the names.

    The views are plans: nothing runs until a query reads one.
    """
    known = dict(tables)
    for name, view in model.items():
        known[name] = view(known)
    return register_views(known)
