"""Order and revenue queries of the commerce model.

Order lines are summed per order or box before any join, so the joins meet one row per key on
both sides and a client, order or box with a large part of the lines is reduced on the map side.
Money factors are decimals before they are multiplied: sums do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcela.functions.numbers import exterior_surface

Tables = dict[str, DataFrame]


def line_amount() -> Column:
    """Unit price x (1 - discount) x quantity.

    In this order the first product still fits a 64-bit decimal.
    """
    quantity = F.col("quantite").cast("decimal(8,2)")
    price = F.col("prix_unitaire").cast("decimal(12,2)")
    kept = F.lit(1).cast("decimal(1,0)") - F.col("taux_remise").cast("decimal(4,3)")
    return price * kept * quantity


def _revenue(name: str = "chiffre_affaires") -> Column:
    return F.sum("_montant").cast("double").alias(name)


def _per(lines: DataFrame, *keys: str) -> DataFrame:
    return lines.groupBy(*keys).agg(F.sum(line_amount()).alias("_montant"))


def commandes_par_client(t: Tables) -> DataFrame:
    """Orders per client, clients without orders included."""
    orders = (
        t["commandes"].groupBy("id_client").agg(F.count("id_commande").alias("nombre_commandes"))
    )
    return (
        t["clients"].select("id_client", "nom_client").join(orders, "id_client", "left")
        .fillna(0, ["nombre_commandes"])
        .orderBy(F.desc("nombre_commandes"), "id_client")
    )


def chiffre_affaires_par_client(t: Tables) -> DataFrame:
    per_order = _per(t["lignes_commande"], "id_commande")
    per_client = (
        per_order.join(t["commandes"].select("id_commande", "id_client"), "id_commande")
        .groupBy("id_client").agg(F.sum("_montant").alias("_montant"))
    )
    return (
        per_client.join(t["clients"].select("id_client", "nom_client"), "id_client")
        .select("id_client", "nom_client", F.col("_montant").cast("double").alias("chiffre_affaires"))
        .orderBy(F.desc("chiffre_affaires"), "id_client")
    )


def chiffre_affaires_par_mois(t: Tables, year: int = 2024) -> DataFrame:
    """Revenue per month of one year; the year is a date range, so it reaches the scan."""
    day = F.col("date_commande")
    orders = t["commandes"].filter(
        (day >= F.lit(f"{year}-01-01").cast("date")) & (day < F.lit(f"{year + 1}-01-01").cast("date"))
    ).select("id_commande", F.date_format(day, "yyyy-MM").alias("mois"))
    return (
        _per(t["lignes_commande"], "id_commande").join(orders, "id_commande")
        .groupBy("mois").agg(_revenue()).orderBy("mois")
    )


def _named(t: Tables, boxes: DataFrame) -> DataFrame:
    """Material and colour names of rows that hold ``id_boite``.

    Materials and colours are short lists; whether they are broadcast is left to their size.
    """
    keys = t["boites"].select("id_boite", "id_matiere", "id_couleur")
    return (
        boxes.join(keys, "id_boite")
        .join(t["matieres"], "id_matiere").join(t["couleurs"], "id_couleur")
        .drop("id_matiere", "id_couleur")
    )


def meilleures_boites_quantite(t: Tables, top: int = 5) -> DataFrame:
    sold = t["lignes_commande"].groupBy("id_boite").agg(
        F.sum(F.col("quantite").cast("decimal(18,2)")).cast("double").alias("quantite_vendue")
    )
    return (
        _named(t, sold).select("id_boite", "nom_matiere", "nom_couleur", "quantite_vendue")
        .orderBy(F.desc("quantite_vendue"), "id_boite").limit(top)
    )


def meilleures_boites_chiffre(t: Tables, top: int = 5) -> DataFrame:
    sold = t["lignes_commande"].groupBy("id_boite").agg(
        F.sum(line_amount()).cast("double").alias("chiffre_affaires")
    )
    return (
        _named(t, sold).select("id_boite", "nom_matiere", "nom_couleur", "chiffre_affaires")
        .orderBy(F.desc("chiffre_affaires"), "id_boite").limit(top)
    )


def _per_dimension(t: Tables, dimension: str, key: str, name: str) -> DataFrame:
    """Distinct orders and revenue per material or colour.

    Lines are reduced to one row per order and dimension value; counting those rows is counting
    distinct orders.
    """
    value = t["boites"].select("id_boite", key)
    per_order = (
        t["lignes_commande"].join(value, "id_boite").groupBy(key, "id_commande")
        .agg(F.sum(line_amount()).alias("_montant"))
        .join(t["commandes"].select("id_commande"), "id_commande", "left_semi")
    )
    totals = per_order.groupBy(key).agg(
        F.count("*").alias("nombre_commandes"), F.sum("_montant").alias("_montant")
    )
    return (
        totals.join(t[dimension], key)
        .groupBy(name)
        .agg(F.sum("nombre_commandes").alias("nombre_commandes"), _revenue())
        .orderBy(F.desc("chiffre_affaires"), name)
    )


def chiffre_affaires_par_matiere(t: Tables) -> DataFrame:
    return _per_dimension(t, "matieres", "id_matiere", "nom_matiere")


def chiffre_affaires_par_couleur(t: Tables) -> DataFrame:
    return _per_dimension(t, "couleurs", "id_couleur", "nom_couleur")


def commandes_par_jour_semaine(t: Tables) -> DataFrame:
    return (
        t["commandes"].groupBy(F.date_format("date_commande", "EEEE").alias("jour_semaine"))
        .agg(F.count("id_commande").alias("nombre_commandes"))
        .orderBy(F.desc("nombre_commandes"), "jour_semaine")
    )


def quantite_moyenne_par_boite(t: Tables) -> DataFrame:
    per_box = t["lignes_commande"].groupBy("id_boite").agg(
        (F.sum(F.col("quantite").cast("decimal(18,2)")).cast("double")
         / F.nullif(F.count("quantite"), F.lit(0))).alias("moyenne_quantite")
    )
    return (
        _named(t, per_box).select("id_boite", "nom_matiere", "nom_couleur", "moyenne_quantite")
        .orderBy(F.desc("moyenne_quantite"), "id_boite")
    )


def with_exterior_surface(boxes: DataFrame) -> DataFrame:
    """Boxes with their outer surface, computed rather than kept by a trigger."""
    sides = [F.col(f"{n}_mm") for n in ("longueur", "largeur", "hauteur")]
    return boxes.withColumn("surface_exterieure_mm2", exterior_surface(*sides))


def boites_details(t: Tables) -> DataFrame:
    return (
        with_exterior_surface(t["boites"])
        .join(t["matieres"], "id_matiere").join(t["couleurs"], "id_couleur")
        .select(
            "id_boite", "nom_matiere", "nom_couleur", "longueur_mm", "largeur_mm", "hauteur_mm",
            "surface_exterieure_mm2",
        )
    )


def boites_par_matiere(t: Tables) -> DataFrame:
    return boites_details(t).groupBy("nom_matiere").agg(F.count("*").alias("nb_boites"))


def boites_par_couleur(t: Tables) -> DataFrame:
    return boites_details(t).groupBy("nom_couleur").agg(F.count("*").alias("nb_boites"))


def commandes_par_jour(t: Tables) -> DataFrame:
    return (
        t["commandes"].groupBy("date_commande").agg(F.count("*").alias("nb_commandes"))
        .orderBy("date_commande")
    )


def boites_par_client(t: Tables) -> DataFrame:
    """Boxes sold per client name."""
    per_order = t["lignes_commande"].groupBy("id_commande").agg(
        F.sum(F.col("quantite").cast("decimal(18,2)")).alias("_n")
    )
    per_client = (
        per_order.join(t["commandes"].select("id_commande", "id_client"), "id_commande")
        .groupBy("id_client").agg(F.sum("_n").alias("_n"))
    )
    return (
        per_client.join(t["clients"].select("id_client", "nom_client"), "id_client")
        .groupBy("nom_client").agg(F.sum("_n").cast("double").alias("total_boites"))
        .orderBy(F.desc("total_boites"), "nom_client")
    )


def ventes_par_jour(t: Tables) -> DataFrame:
    return (
        _per(t["lignes_commande"], "id_commande")
        .join(t["commandes"].select("id_commande", "date_commande"), "id_commande")
        .groupBy("date_commande").agg(_revenue("total_ventes")).orderBy("date_commande")
    )
