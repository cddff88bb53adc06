"""Listing and commerce tables derived from the driver tables.

The driver has no listings, so each order stands for one listing: its columns follow from the
order's key, its customer and its lines by integer arithmetic that any SQL engine repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.functions.numbers import double_to_decimal, price_per_m2_decimal

AS_OF = "2025-11-15T00:00:00"
AS_OF_YEAR = 2025
DATA_YEAR = 1998

NN, NB = "\u202f", "\u00a0"
KINDS_OF_HOME = ["Appartement", "Maison", "Villa", "Studio", "Loft"]
DEPARTMENTS = [75, 92, 93, 94, 77]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _pick(n: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n + 1).cast("int"))


def _letter(n: Column) -> Column:
    return F.substring(F.lit("ABCDEFG"), (n % 7 + 1).cast("int"), F.lit(1))


def _null_when(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")


def annonces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned base listings."""
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    seg, pri = F.col("c_mktsegment"), F.col("o_orderpriority")
    price = _null_when(k % 11 == 0, double_to_decimal(F.col("o_totalprice"), 12, 2))
    surface = _null_when(k % 17 == 3, (k * 37 % 191 + 9).cast("decimal(8,2)"))
    base = _orders(spark, sf_dir).select(
        k.alias("id_annonce"),
        _cat("R", _s(k)).alias("reference"),
        _cat(pri, " à ", seg).alias("titre"),
        price.alias("prix"),
        surface.alias("surface"),
        _null_when(k % 4 == 0, ((k % 13 + 1) * 50).cast("decimal(8,2)")).alias("surface_terrain"),
        _null_when(k % 19 == 2, (k % 7 + 1).cast("int")).alias("pieces"),
        _null_when(k % 41 == 0, pri).alias("type_bien"),
        _null_when(k % 23 == 5, _cat(seg, " (", _s(ck % 20 + 75001), ")")).alias("localisation"),
        _cat(_s(k % 300), " rue ", seg, " ", _s(ck % 20 + 75001)).alias("localisation_complete"),
        _null_when(k % 29 == 0, F.repeat(_cat(pri, " "), (k % 60).cast("int"))).alias("description"),
        _null_when(k % 37 == 1, (k * 13 % 175 + 1850).cast("int")).alias("annee_construction"),
        _null_when(k % 43 == 0, (k % 15).cast("int")).alias("nombre_photos"),
        (k % 5 == 0).alias("has_video"),
        (k % 3 == 0).alias("has_visite_virtuelle"),
        F.col("o_orderdate").alias("date_extraction"),
        _null_when(k % 13 == 0, _letter(k)).alias("dpe_classe_active"),
        _letter(k * 3).alias("ges_classe_active"),
    )
    per_m2 = price_per_m2_decimal(F.col("prix"), F.col("surface"))
    return base.withColumn("prix_au_m2", _null_when(F.col("id_annonce") % 31 == 0, per_m2))


def base_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six tables of the base model."""
    k = F.col("o_orderkey")
    owned = _orders(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return {
        "annonces": annonces(spark, sf_dir),
        "caracteristiques": lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_orderkey").alias("id_annonce"), F.col("p_name").alias("valeur")
        ),
        "images": lines.select(
            F.col("l_orderkey").alias("id_annonce"),
            _cat("https://img.example/", _s(F.col("l_partkey")), ".jpg").alias("url"),
            F.col("l_linenumber").alias("ordre"),
        ),
        "conseiller": owned.filter(k % 10 != 9).select(
            k.alias("id_annonce"), F.col("c_name").alias("nom_complet"),
            _cat("+33 6 ", _s(F.col("o_custkey"))).alias("telephone"),
            _cat("https://site.example/conseiller/", _s(F.col("o_custkey"))).alias("lien"),
            _cat("https://img.example/p/", _s(F.col("o_custkey")), ".jpeg").alias("photo"),
            _s(F.col("o_custkey") % 5 + 1).alias("note"),
        ),
        "dpe": orders.select(
            k.alias("id_annonce"),
            _null_when(k % 13 == 0, _letter(k)).alias("classe_energie"),
            _null_when(k % 9 == 0, (k * 7 % 400 + 50).cast("int")).alias("indice_energie"),
            _null_when(k % 21 == 4, _letter(k * 3)).alias("classe_climat"),
            (k * 5 % 90).cast("int").alias("indice_climat"),
        ),
        "copropriete": orders.filter(k % 2 == 0).select(
            k.alias("id_annonce"),
            _null_when(k % 14 == 0, (k * 7 % 120).cast("int")).alias("nb_lots"),
            _cat(_s(k % 1000 + 100), " € / an").alias("charges_previsionnelles"),
            F.when(k % 6 == 0, "en cours").otherwise("").alias("procedures"),
        ),
    }


def commerce_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    part = table(spark, sf_dir, "part")
    size = F.col("p_size")
    return {
        "clients": table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("id_client"), F.col("c_name").alias("nom_client")
        ),
        "commandes": table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("id_commande"), F.col("o_custkey").alias("id_client"),
            F.col("o_orderdate").cast("date").alias("date_commande"),
        ),
        "lignes_commande": table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("id_commande"), F.col("l_partkey").alias("id_boite"),
            double_to_decimal(F.col("l_quantity"), 8, 2).alias("quantite"),
            double_to_decimal(F.col("l_extendedprice"), 12, 2).alias("prix_unitaire"),
            double_to_decimal(F.col("l_discount"), 4, 3).alias("taux_remise"),
        ),
        "boites": part.select(
            F.col("p_partkey").alias("id_boite"), F.col("p_brand").alias("id_matiere"),
            F.col("p_type").alias("id_couleur"), (size * 23 + 40).alias("longueur_mm"),
            (size * 7 % 300 + 30).alias("largeur_mm"), (size % 11 * 20 + 15).alias("hauteur_mm"),
        ),
        "matieres": part.select(
            F.col("p_brand").alias("id_matiere"), F.col("p_brand").alias("nom_matiere")
        ).distinct(),
        "couleurs": part.select(
            F.col("p_type").alias("id_couleur"), F.col("p_type").alias("nom_couleur")
        ).distinct(),
    }


def owned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What raw listings are made of, dealt over all cores: few bytes a row, much text work."""
    owned = _orders(spark, sf_dir).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "c_name", "c_mktsegment")
    scan = table(spark, sf_dir, "orders").rdd.getNumPartitions()
    return owned.repartition(max(4 * spark.sparkContext.defaultParallelism, 4 * scan), "o_orderkey")


def raw_listings(owned: DataFrame) -> DataFrame:
    """Raw listings: texts as a scraper leaves them, with ``id_annonce`` beside them."""
    k, ck, seg = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_mktsegment")
    home = _pick(k % 5, KINDS_OF_HOME)
    code = _s(_pick(ck % 5, DEPARTMENTS) * 1000 + ck * 7 % 100)
    number = F.translate(F.format_number("o_totalprice", 2), ",.", f"{NN},")
    price = _cat(number, f"{NB}€")
    size = _s(k * 37 % 191 + 9)
    day = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    per_m2 = f"9{NN}744{NB}€ / m²"
    place = _cat(seg, " (", code, ")")

    def feature(condition: Column, text: Column | str) -> Column:
        return F.when(condition, F.lit(text) if isinstance(text, str) else text)

    features = F.array_compact(F.array(
        feature(k % 16 == 8, "0 chambre"),
        feature(k % 4 != 0, _cat(_s(k % 4), " chambres")),
        _cat(_s(k % 7 + 1), " pièces"),
        _cat(size, " m²"),
        F.lit("Cave"),
        feature(k % 2 == 0, _cat("Étage ", _s(k % 8), " sur ", _s(k % 3 + 8))),
        feature(k % 10 == 3, _cat("Étage ", _s(k % 3 + 1), "/9")),
        feature(k % 6 == 0, "Ascenseur"),
        feature(k % 6 == 1, "Sans ascenseur"),
        feature(k % 3 == 0, "Digicode"),
        feature(k % 4 == 1, "Interphone"),
        feature(k % 5 == 2, "Chauffage central"),
        feature(k % 7 == 3, "Double vitrage"),
        feature(k % 9 == 0, "  "),
        feature(k % 9 == 4, " Cuisine équipée "),
        feature(k % 8 == 5, "Balcon"),
        F.lit("Construit en 1900"),
        F.lit("Cave"),
    ))
    images = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(6)), lambda i: i < k % 7),
        lambda i: F.when((i == 0) & (k % 12 == 0), F.lit("")).otherwise(_cat(
            "https://img.example/property/", _s(k), "-", _s(i % 4), ".jpg?format=auto&width=",
            F.when(i % 2 == 0, "390").otherwise("780"),
        )),
    )
    description = F.when(k % 31 == 7, "").otherwise(_cat(
        "Bien proche ", F.when(k % 3 == 0, "Buttes Chaumont").otherwise("du centre"), ", ",
        F.when(k % 4 == 0, _cat("Quartier  ", seg, " Nord"))
        .when(k % 4 == 1, "Quartier Buttes Chaumont").otherwise("rue animée"), ", ",
        F.when(k % 5 == 0, _cat("métro Ligne ", _s(k % 14)))
        .when(k % 5 == 1, _cat("MÉTRO Gare ", _s(k % 9)))
        .when(k % 5 == 2, "école et métro. Parc")
        .when(k % 5 == 3, _cat("métro École ", _s(k % 7))).otherwise("bus"),
        ". ", F.repeat(F.lit("Lumineux  séjour "), (k % 45).cast("int")),
    ))
    charges = (
        F.when(k % 8 == 0, "")
        .when(k % 8 == 1, _cat(f"1{NN}", _s(k % 900 + 100), f"{NB}€ / an"))
        .when(k % 8 == 2, _cat(_s(k % 400), " € / trim"))
        .when(k % 8 == 3, _cat(_s(k % 99), ",50 €/mois"))
        .when(k % 8 == 4, _cat(_s(k % 777), " €"))
        .when(k % 8 == 5, _cat(_s(k % 500), " par lot"))
        .when(k % 8 == 6, _cat("Charges annuel ", _s(k % 1000)))
        .otherwise("néant")
    )
    return owned.select(
        k.alias("id_annonce"),
        _cat("R", _s(k)).alias("reference"),
        _cat(home, " à ", place).alias("titre"),
        _cat(home, " à ", place, "  ").alias("titre_complet"),
        F.when(k % 11 == 0, "").when(k % 53 == 1, "Prix sur demande").when(k % 53 == 2, per_m2)
        .otherwise(price).alias("prix"),
        price.alias("prix_detaille"),
        F.when(k % 6 == 0, per_m2).when(k % 6 == 1, _cat(_s(k % 9000 + 1000), ",5 €"))
        .otherwise("").alias("prix_au_m2"),
        F.when(k % 23 == 5, "").when(k % 23 == 6, seg).otherwise(place).alias("localisation"),
        _cat(_s(k % 300), " rue ", seg, " ", code).alias("localisation_complete"),
        F.when(k % 17 == 3, "").when(k % 29 == 4, _cat(size, ",5"))
        .when(k % 29 == 5, _cat(size, ".25")).otherwise(size).alias("surface"),
        F.when(k % 4 == 0, "").when(k % 4 == 1, _cat(_s(k % 900), " m²"))
        .otherwise(_cat("Terrain de ", _s(k % 900), ".5 m²")).alias("surface_terrain"),
        F.when(k % 19 == 2, "").otherwise(_s(k % 7 + 1)).alias("pieces"),
        home.alias("type_bien"),
        description.alias("description"),
        F.when(k % 37 == 1, "").when(k % 37 == 2, "vers 1900")
        .otherwise(_s(k * 13 % 175 + 1850)).alias("annee_construction"),
        F.lit("").alias("honoraires"),
        _cat("https://img.example/property/", _s(k), ".jpg?format=auto&width=300").alias("image_url"),
        F.when(k % 13 == 5, "").otherwise(_s(k % 7)).alias("nombre_photos"),
        _pick(k % 5, ["true", "Oui ", "non", "1", ""]).alias("has_video"),
        _pick(k % 4, ["Vrai", " oui", "0", ""]).alias("has_visite_virtuelle"),
        F.when(k % 3 == 0, _cat(_s(k % 7), " photos"))
        .when(k % 3 == 1, _cat(_s(k % 7), " Photo, 1 vidéo"))
        .otherwise("Visite virtuelle et VIDEO").alias("media_info"),
        F.when(k % 8 == 0, _cat("/annonce/", F.lower(home), "/r", _s(k)))
        .otherwise(_cat("https://site.example/annonce/", F.lower(home), "/r", _s(k))).alias("lien"),
        F.when(k % 61 == 3, "hier").when(k % 7 == 0, _cat(day, "Z"))
        .when(k % 7 == 1, _cat(day, ".197754")).otherwise(day).alias("date_extraction"),
        F.when(k % 9 == 0, "").when(k % 9 == 1, "Classe F").otherwise(_letter(k)).alias("dpe_classe_active"),
        F.when(k % 10 == 7, "n/a").otherwise(_letter(k * 3)).alias("ges_classe_active"),
        F.lit("").alias("depenses_energie_min"),
        F.lit("").alias("depenses_energie_max"),
        _s(k % 12 + 2018).alias("annee_reference"),
        F.when(k % 3 == 0, "").otherwise(_s(k * 7 % 120)).alias("copropriete_nb_lots"),
        charges.alias("copropriete_charges_previsionnelles"),
        F.when(k % 6 == 0, "Procédure en cours").otherwise("").alias("copropriete_procedures"),
        F.when(k % 25 == 0, "").otherwise(_cat("Jean ", F.col("c_name"))).alias("conseiller_nom_complet"),
        F.when(k % 25 == 0, "").otherwise(_cat("+33 6 ", _s(ck))).alias("conseiller_telephone"),
        F.when(k % 25 == 0, "").otherwise(
            _cat("https://site.example/conseiller/", _s(ck))).alias("conseiller_lien"),
        _cat("https://img.example/p/", _s(ck), ".jpeg?format=auto&width=144").alias("conseiller_photo"),
        F.lit("").alias("conseiller_note"),
        features.alias("caracteristiques_detaillees"),
        images.alias("images"),
    )


def detail_pages(raw: DataFrame) -> DataFrame:
    """One HTML page per raw listing, holding its fields in the markup of a detail page."""
    c = F.col
    photos = F.array_join(F.transform(
        F.filter("images", lambda u: u != ""),
        lambda u, i: _cat('<li><img class="x" src="', u, '" alt="vue ', _s(i), '"></li>'),
    ), "")
    features = F.array_join(
        F.transform("caracteristiques_detaillees", lambda x: _cat("<li> • ", x, "</li>")), "\n"
    )
    k = c("id_annonce")
    html = _cat(
        '<html><body><a href="', c("lien"), '"><h2 class="t">', c("titre"), "</h2></a>",
        '<p class="text-lg">', c("prix_detaille"), "</p>",
        '<span class="badge">Nouveau</span><span class="badge"> ', c("type_bien"), " </span>",
        "<ul class=\"specs\">", features, "</ul>",
        '<img src="', c("image_url"), '">',
        '<ul class="flex-col">', photos, "</ul>",
        F.when(c("copropriete_nb_lots") != "", _cat(
            "<dl class=\"flex\"><dt>Nombre de lots</dt>\n<dd>", c("copropriete_nb_lots"), "</dd>",
            "<dt>Charges prévisionnelles</dt><dd> ", c("copropriete_charges_previsionnelles"),
            " </dd></dl>")).otherwise(""),
        F.when(c("conseiller_nom_complet") != "", _cat(
            '<a class="flex-col" href="/conseiller/', _s(k % 50), '"><img class="size-full" src="',
            c("conseiller_photo"), '"><p class="text-xl">', c("conseiller_nom_complet"), "</p></a>",
            "<button><span>Tel ", c("conseiller_telephone"), "</span></button>",
            '<span class="rating">', _s(k % 5), '</span><span class="avis">', _s(k % 40),
            " avis</span>")).otherwise(""),
        F.when(k % 3 != 0, _cat(
            '<section class="flex"><h3>Performances</h3><div class="panel-dpe"><p>Indice ', _s(k % 9),
            '</p><em>très performant</em><li class="border-white"><span>',
            _letter(k), "</span></li><em> très consommateur </em></div>",
            '<div class="panel-ges"><p>Climat</p><em>peu d\'émissions</em><li class="border-white"><span>',
            _letter(k * 3), "</span></li></div>",
            '<aside class="border-epc-C"><p class="flex"><span class="text-base">', _s(k % 400 + 50),
            '</span></p><span class="text-base">', _s(k % 300 + 40),
            '</span><p class="grid"><span class="text-base">', _s(k % 70), "</span></p></aside>",
            '<aside class="border-ges-A"><p class="grid"><span class="text-base">', _s(k % 60),
            "</span></p></aside>",
            '<div class="text-sm"><p>entre ', _s(k % 900 + 100), " € par an</p><p>et ",
            _s(k % 900 + 1100), " € par an</p></div></section>")).otherwise(""),
        "</body></html>",
    )
    return raw.select(k, html.alias("html"))
