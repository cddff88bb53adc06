"""Explicit schemas of the data model, as DDL texts where no type object is needed."""

from __future__ import annotations

from pyspark.sql import types as T

# Text fields of a raw listing.
RAW_TEXT_FIELDS = [
    "reference", "titre", "titre_complet", "prix", "prix_detaille", "prix_au_m2", "localisation",
    "localisation_complete", "surface", "surface_terrain", "pieces", "type_bien", "description",
    "annee_construction", "honoraires", "image_url", "nombre_photos", "has_video",
    "has_visite_virtuelle", "media_info", "lien", "date_extraction", "dpe_classe_active",
    "ges_classe_active", "depenses_energie_min", "depenses_energie_max", "annee_reference",
    "copropriete_nb_lots", "copropriete_charges_previsionnelles", "copropriete_procedures",
    "conseiller_nom_complet", "conseiller_telephone", "conseiller_lien", "conseiller_photo",
    "conseiller_note",
]
RAW_ARRAY_FIELDS = ["caracteristiques_detaillees", "images"]

RAW_LISTING = T.StructType(
    [T.StructField(name, T.StringType()) for name in RAW_TEXT_FIELDS]
    + [T.StructField(name, T.ArrayType(T.StringType())) for name in RAW_ARRAY_FIELDS]
)

# Fields of the fuller scrape output, and those a valid row must have.
OUTPUT_FIELDS = [
    "date_extraction", "reference", "type_bien", "type_transaction", "code_postal", "titre",
    "titre_complet", "prix", "prix_detaille", "prix_au_m2", "localisation",
    "localisation_complete", "surface", "surface_terrain", "pieces", "chambres", "description",
    "caracteristiques_detaillees", "equipements", "annee_construction", "honoraires", "image_url",
    "images", "toutes_les_photos", "nombre_photos", "has_video", "has_visite_virtuelle",
    "media_info", "lien", "dpe_classe_active", "ges_classe_active",
    "dpe_consommation_energie_primaire", "dpe_consommation_energie_finale", "dpe_emissions",
    "ges_emissions", "depenses_energie_min", "depenses_energie_max", "annee_reference",
    "copropriete_nb_lots", "copropriete_charges_previsionnelles", "copropriete_procedures",
    "conseiller_nom_complet", "conseiller_telephone", "conseiller_lien", "conseiller_photo",
    "conseiller_note", "conseiller_nombre_avis", "badges",
]
REQUIRED_OUTPUT_FIELDS = [
    "reference", "titre", "prix", "localisation", "code_postal", "lien", "date_extraction",
]

SNAPSHOT = (
    "reference STRING, titre STRING, prix STRING, localisation STRING, surface STRING, "
    "pieces STRING, image_url STRING, media_info STRING, lien STRING, date_extraction STRING"
)

PREPARED_LISTING = (
    "reference STRING, titre STRING, "
    "prix STRUCT<valeur DOUBLE, devise STRING, au_m2 DOUBLE>, "
    "surface STRUCT<valeur DOUBLE, unite STRING>, "
    "composition STRUCT<pieces DOUBLE, chambres DOUBLE, type_bien STRING>, "
    "localisation STRUCT<ville STRING, code_postal STRING, quartier STRING, proximite STRING>, "
    "description STRING, caracteristiques ARRAY<STRING>, "
    "batiment STRUCT<annee_construction INT, age_bien INT, etage INT, etage_total INT, "
    "ascenseur BOOLEAN>, "
    "diagnostics STRUCT<dpe STRUCT<classe STRING, score INT, indice INT>, "
    "ges STRUCT<classe STRING, score INT, indice INT>>, "
    "copropriete STRUCT<nb_lots DOUBLE, charges STRUCT<valeur DOUBLE, unite STRING, "
    "periode STRING>, procedures_en_cours BOOLEAN>, "
    "medias STRUCT<images ARRAY<STRING>, nombre_photos INT, has_video BOOLEAN, "
    "has_visite_virtuelle BOOLEAN, has_photo BOOLEAN>, "
    "contact STRUCT<conseiller STRING, telephone STRING, photo STRING, lien STRING>, "
    "url_annonce STRING, "
    "metadata STRUCT<date_extraction STRING, score_qualite DOUBLE, "
    "champs_manquants ARRAY<STRING>, etapes_traitees ARRAY<STRING>>"
)

AGGREGATES = (
    "STRUCT<performance STRUCT<prix_m2 DOUBLE, loyer_estime_mensuel DOUBLE, "
    "rendement_annuel_estime DOUBLE, charges_annuelles DOUBLE, rentabilite_nette DOUBLE>, "
    "scores STRUCT<emplacement DOUBLE, modernite DOUBLE, global DOUBLE>, "
    "segmentation STRUCT<prix_m2 STRING, surface STRING, age STRING>, "
    "analyse_marche STRUCT<z_score_prix_m2 DOUBLE, positionnement_marche STRING, "
    "ecart_pourcentage DOUBLE, prix_m2_marche_reference DOUBLE>, "
    "recommandations STRUCT<prix ARRAY<STRING>, marketing ARRAY<STRING>, "
    "amelioration ARRAY<STRING>, ciblage ARRAY<STRING>>, "
    "metadata_aggregation STRUCT<date_aggregation STRING, algorithme_version STRING, "
    "marche_reference STRUCT<prix_m2_moyen DOUBLE, nombre_biens_reference INT>>>"
)
AGGREGATED_LISTING = f"{PREPARED_LISTING}, aggregats {AGGREGATES}"

ENVELOPE = (
    "source STRING, data STRING, timestamp STRING, type STRING, format_origine STRING, "
    "taille_fichier STRING"
)

CATALOGUE_CSV = (
    "dbms STRING, table_catalog STRING, table_schema STRING, table_name STRING, "
    "column_name STRING, ordinal_position INT, data_type STRING, character_maximum_length INT, "
    "constraint_type STRING, table_schema_2 STRING, table_name_2 STRING, column_name_2 STRING"
)

# Path map and rules of the aggregated document.
MAPPED_PATHS = [
    "reference", "titre", "prix.valeur", "prix.devise", "prix.au_m2", "surface.valeur",
    "surface.unite", "composition.pieces", "composition.chambres", "composition.type_bien",
    "localisation.ville", "localisation.code_postal", "description", "caracteristiques",
    "batiment.annee_construction", "batiment.age_bien", "batiment.ascenseur",
    "diagnostics.dpe.classe", "diagnostics.dpe.score", "diagnostics.ges.classe",
    "diagnostics.ges.score", "copropriete.charges", "copropriete.procedures_en_cours",
    "medias.images", "medias.nombre_photos", "medias.has_video", "medias.has_visite_virtuelle",
    "medias.has_photo", "contact.conseiller", "contact.telephone", "contact.photo",
    "contact.lien", "url_annonce", "metadata.date_extraction", "metadata.score_qualite",
    "metadata.etapes_traitees", "aggregats.performance.prix_m2",
    "aggregats.performance.loyer_estime_mensuel", "aggregats.performance.rendement_annuel_estime",
    "aggregats.scores.emplacement", "aggregats.scores.modernite", "aggregats.scores.global",
    "aggregats.segmentation.prix_m2", "aggregats.segmentation.surface",
    "aggregats.segmentation.age", "aggregats.analyse_marche.z_score_prix_m2",
    "aggregats.analyse_marche.positionnement_marche",
    "aggregats.analyse_marche.ecart_pourcentage",
    "aggregats.analyse_marche.prix_m2_marche_reference", "aggregats.recommandations.prix",
    "aggregats.recommandations.marketing", "aggregats.recommandations.amelioration",
    "aggregats.recommandations.ciblage", "aggregats.metadata_aggregation.date_aggregation",
    "aggregats.metadata_aggregation.algorithme_version",
    "aggregats.metadata_aggregation.marche_reference.prix_m2_moyen",
    "aggregats.metadata_aggregation.marche_reference.nombre_biens_reference",
]
REQUIRED_PATHS = ["reference", "titre"]
DATE_PATHS = ["metadata.date_extraction", "aggregats.metadata_aggregation.date_aggregation"]
NUMERIC_PATHS = [
    "prix.valeur", "prix.au_m2", "surface.valeur", "composition.pieces", "composition.chambres",
    "batiment.annee_construction", "batiment.age_bien", "diagnostics.dpe.score",
    "diagnostics.ges.score", "metadata.score_qualite", "aggregats.performance.prix_m2",
    "aggregats.performance.loyer_estime_mensuel", "aggregats.performance.rendement_annuel_estime",
    "aggregats.scores.emplacement", "aggregats.scores.modernite", "aggregats.scores.global",
    "aggregats.analyse_marche.z_score_prix_m2", "aggregats.analyse_marche.ecart_pourcentage",
    "aggregats.analyse_marche.prix_m2_marche_reference",
    "aggregats.metadata_aggregation.marche_reference.prix_m2_moyen",
    "aggregats.metadata_aggregation.marche_reference.nombre_biens_reference",
]
BOOLEAN_PATHS = [
    "batiment.ascenseur", "copropriete.procedures_en_cours", "medias.has_video",
    "medias.has_visite_virtuelle", "medias.has_photo",
]
