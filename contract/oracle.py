"""The SQL each registered query is compared with.

The statements are written for the comparison engine from the reference semantics and share no
code with the Spark side.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

NN, NB = "chr(8239)", "chr(160)"


def avg(column: str, digits: int = 2) -> str:
    """Average rounded half up, by integer arithmetic on hundredths."""
    unit = 10 ** (2 - digits)
    cents = f"SUM(CAST(({column}) * 100 AS HUGEINT))"
    n = f"COUNT({column})"
    return f"CAST((2 * {cents} + {unit} * {n}) // NULLIF(2 * {unit} * {n}, 0) AS DOUBLE) / {10**digits}"


def ratio(part: str, total: str) -> str:
    """Percentage rounded half up to two digits."""
    return f"CAST((20000 * {part} + {total}) // (2 * {total}) AS DOUBLE) / 100"


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def py2(expression: str, digits: int = 2) -> str:
    """Rounding of the exact binary value, half to even."""
    return f"CAST(printf('%.{digits}f', {expression}) AS DOUBLE)"


# --- base tables ----------------------------------------------------------------------------
OWNED = """
o AS (SELECT o_orderkey AS k, o_custkey AS ck, o_orderpriority AS pri, o_totalprice AS tp,
             o_orderdate AS d, c_name, c_mktsegment AS seg
      FROM orders JOIN customer ON o_custkey = c_custkey)"""

ANNONCES = OWNED + """,
a0 AS (SELECT k AS id_annonce, 'R' || k AS reference, pri || ' à ' || seg AS titre,
  CASE WHEN k % 11 <> 0 THEN CAST(tp AS DECIMAL(12,2)) END AS prix,
  CASE WHEN k % 17 <> 3 THEN CAST(9 + (k * 37) % 191 AS DECIMAL(8,2)) END AS surface,
  CASE WHEN k % 4 <> 0 THEN CAST((k % 13 + 1) * 50 AS DECIMAL(8,2)) END AS surface_terrain,
  CASE WHEN k % 19 <> 2 THEN CAST(1 + k % 7 AS INTEGER) END AS pieces,
  CASE WHEN k % 41 <> 0 THEN pri END AS type_bien,
  CASE WHEN k % 23 <> 5 THEN seg || ' (' || (75001 + ck % 20) || ')' END AS localisation,
  (k % 300) || ' rue ' || seg || ' ' || (75001 + ck % 20) AS localisation_complete,
  CASE WHEN k % 29 <> 0 THEN repeat(pri || ' ', k % 60) END AS description,
  CASE WHEN k % 37 <> 1 THEN CAST(1850 + (k * 13) % 175 AS INTEGER) END AS annee_construction,
  CASE WHEN k % 43 <> 0 THEN CAST(k % 15 AS INTEGER) END AS nombre_photos,
  k % 5 = 0 AS has_video, k % 3 = 0 AS has_visite_virtuelle, d AS date_extraction,
  CASE WHEN k % 13 <> 0 THEN substr('ABCDEFG', CAST(1 + k % 7 AS INTEGER), 1) END AS dpe_classe_active,
  substr('ABCDEFG', CAST(1 + (k * 3) % 7 AS INTEGER), 1) AS ges_classe_active
  FROM o),
annonces AS (SELECT *, CASE WHEN id_annonce % 31 <> 0 THEN CAST(
    ((200 * CAST(prix * 100 AS BIGINT) + CAST(surface * 100 AS BIGINT))
     // (2 * CAST(surface * 100 AS BIGINT))) * 0.01 AS DECIMAL(12,2)) END AS prix_au_m2 FROM a0),
caracteristiques AS (SELECT l_orderkey AS id_annonce, p_name AS valeur
  FROM lineitem JOIN part ON l_partkey = p_partkey),
images AS (SELECT l_orderkey AS id_annonce, 'https://img.example/' || l_partkey || '.jpg' AS url,
  l_linenumber AS ordre FROM lineitem),
conseiller AS (SELECT k AS id_annonce, c_name AS nom_complet, '+33 6 ' || ck AS telephone,
  'https://site.example/conseiller/' || ck AS lien, 'https://img.example/p/' || ck || '.jpeg' AS photo,
  CAST(ck % 5 + 1 AS VARCHAR) AS note FROM o WHERE k % 10 <> 9),
dpe AS (SELECT o_orderkey AS id_annonce,
  CASE WHEN o_orderkey % 13 <> 0 THEN substr('ABCDEFG', CAST(1 + o_orderkey % 7 AS INTEGER), 1) END AS classe_energie,
  CASE WHEN o_orderkey % 9 <> 0 THEN CAST(50 + (o_orderkey * 7) % 400 AS INTEGER) END AS indice_energie,
  CASE WHEN o_orderkey % 21 <> 4 THEN substr('ABCDEFG', CAST(1 + (o_orderkey * 3) % 7 AS INTEGER), 1) END AS classe_climat,
  CAST((o_orderkey * 5) % 90 AS INTEGER) AS indice_climat FROM orders),
copropriete AS (SELECT o_orderkey AS id_annonce,
  CASE WHEN o_orderkey % 14 <> 0 THEN CAST((o_orderkey * 7) % 120 AS INTEGER) END AS nb_lots,
  (o_orderkey % 1000 + 100) || ' € / an' AS charges_previsionnelles,
  CASE WHEN o_orderkey % 6 = 0 THEN 'en cours' ELSE '' END AS procedures
  FROM orders WHERE o_orderkey % 2 = 0)"""


def base(name: str, sql: str) -> None:
    SQL[name] = f"WITH {ANNONCES}\n{sql}"


A_STATS = f"COUNT(*) AS nombre_annonces, {avg('prix')} AS prix_moyen"
M2 = f"{avg('prix_au_m2')} AS prix_m2_moyen"
SURF = f"{avg('surface')} AS surface_moyenne"
LOW_HIGH = f"{dbl('MIN(prix)')} AS prix_min, {dbl('MAX(prix)')} AS prix_max"

RICH = (f"SELECT type_bien, {A_STATS}, {M2}, {LOW_HIGH}, {SURF}, {avg('pieces', 1)} AS pieces_moyennes "
        "FROM annonces WHERE prix IS NOT NULL AND surface IS NOT NULL GROUP BY type_bien")
base("v01_stats_type_bien", RICH)
base("v01b_stats_type_bien_prix", f"SELECT type_bien, {A_STATS}, {M2}, {LOW_HIGH} FROM annonces WHERE prix IS NOT NULL GROUP BY type_bien")
base("v01c_stats_type_bien_simple", f"SELECT type_bien, COUNT(*) AS nombre_annonces, {dbl('SUM(prix)')} / COUNT(prix) AS prix_moyen, {dbl('SUM(surface)')} / COUNT(surface) AS surface_moyenne, {LOW_HIGH} FROM annonces WHERE type_bien IS NOT NULL GROUP BY type_bien")
MONTHLY = f"SELECT CAST(date_trunc('month', date_extraction) AS DATE) AS mois, type_bien, {M2}, COUNT(*) AS nombre_annonces FROM annonces WHERE prix_au_m2 IS NOT NULL GROUP BY 1, 2"
base("v02_stats_prix_m2_par_mois", MONTHLY)
base("v35_prix_m2_du_type", f"SELECT * FROM ({MONTHLY}) WHERE type_bien = '1-URGENT'")
base("v03_stats_communes_cheres", f"SELECT localisation, {A_STATS}, {M2}, {SURF} FROM annonces WHERE prix IS NOT NULL AND localisation IS NOT NULL GROUP BY localisation HAVING COUNT(*) >= 5 ORDER BY prix_m2_moyen DESC NULLS LAST, localisation LIMIT 10")
base("v04_stats_distribution_surfaces", f"SELECT type_bien, COUNT(*) AS total, {avg('surface')} AS moyenne, {dbl('MIN(surface)')} AS minimum, {dbl('MAX(surface)')} AS maximum, round(quantile_cont(CAST(surface AS DOUBLE), 0.5), 2) AS mediane FROM annonces WHERE surface > 0 GROUP BY type_bien")
base("v05_stats_performance_energetique", f"SELECT classe_energie, COUNT(*) AS nombre_biens, {avg('prix')} AS prix_moyen, {M2}, {SURF} FROM annonces JOIN dpe USING (id_annonce) WHERE classe_energie IS NOT NULL GROUP BY classe_energie")
PIECES = f"SELECT pieces, {A_STATS}, {SURF}, {M2} FROM annonces WHERE pieces > 0 GROUP BY pieces HAVING COUNT(*) >= 3"
base("v06_stats_par_pieces", PIECES)
base("v35_pieces_1_a_5", f"SELECT * FROM ({PIECES}) WHERE pieces BETWEEN 1 AND 5")
POPULAR = f"SELECT valeur AS caracteristique, COUNT(*) AS frequence, {ratio('COUNT(*)', '(SELECT COUNT(DISTINCT id_annonce) FROM caracteristiques)')} AS pourcentage FROM caracteristiques GROUP BY valeur ORDER BY frequence DESC, caracteristique LIMIT "
base("v07_stats_caracteristiques_populaires", POPULAR + "20")
base("v35_caracteristiques_top_10", POPULAR + "10")
base("v08_stats_annee_construction", f"""SELECT CASE WHEN annee_construction < 1900 THEN 'Avant 1900'
  WHEN annee_construction BETWEEN 1900 AND 1945 THEN '1900-1945'
  WHEN annee_construction BETWEEN 1946 AND 1970 THEN '1946-1970'
  WHEN annee_construction BETWEEN 1971 AND 1990 THEN '1971-1990'
  WHEN annee_construction BETWEEN 1991 AND 2010 THEN '1991-2010'
  WHEN annee_construction > 2010 THEN 'Après 2010' ELSE 'Non renseigné' END AS periode_construction,
  COUNT(*) AS nombre_biens, {avg('prix')} AS prix_moyen, {M2}
  FROM annonces WHERE prix IS NOT NULL GROUP BY 1""")
base("v09_stats_coproprietes", f"""SELECT CASE WHEN nb_lots < 10 THEN 'Petite (1-9 lots)'
  WHEN nb_lots BETWEEN 10 AND 50 THEN 'Moyenne (10-50 lots)' WHEN nb_lots > 50 THEN 'Grande (>50 lots)'
  ELSE 'Non renseigné' END AS taille_copropriete, COUNT(*) AS nombre_biens, {avg('prix')} AS prix_moyen,
  {avg('nb_lots', 1)} AS lots_moyens FROM annonces JOIN copropriete USING (id_annonce)
  WHERE nb_lots IS NOT NULL GROUP BY 1""")
LENGTHS = """CASE WHEN length({0}) < 100 THEN 'Description courte' WHEN length({0}) BETWEEN 100 AND 500 THEN 'Description moyenne'
  WHEN length({0}) > 500 THEN 'Description détaillée' ELSE 'Pas de description' END"""
QUALITY = f"""SELECT CASE WHEN nombre_photos = 0 THEN 'Aucune photo' WHEN nombre_photos BETWEEN 1 AND 5 THEN '1-5 photos'
  WHEN nombre_photos BETWEEN 6 AND 10 THEN '6-10 photos' WHEN nombre_photos > 10 THEN 'Plus de 10 photos'
  ELSE 'Non renseigné' END AS nb_photos, {LENGTHS.format('description')} AS longueur_description, {A_STATS}
  FROM annonces GROUP BY 1, 2"""
base("v10_stats_qualite_annonces", QUALITY)
base("v35_qualite_frequente", f"SELECT * FROM ({QUALITY}) WHERE nombre_annonces > 5")
RAPPORT = f"""SELECT localisation, COUNT(*) AS nombre_annonces, {SURF}, {avg('prix')} AS prix_moyen,
  CAST((200 * SUM(CAST(prix * 100 AS HUGEINT)) + SUM(CAST(surface * 100 AS HUGEINT))) // (2 * SUM(CAST(surface * 100 AS HUGEINT))) AS DOUBLE) / 100 AS prix_m2_moyen,
  {dbl('MIN(prix_au_m2)')} AS prix_m2_min, {dbl('MAX(prix_au_m2)')} AS prix_m2_max
  FROM annonces WHERE prix IS NOT NULL AND surface IS NOT NULL AND localisation IS NOT NULL
  GROUP BY localisation HAVING COUNT(*) >= 3"""
base("v11_stats_rapport_surface_prix", RAPPORT)
base("v35_rapport_frequent", f"SELECT * FROM ({RAPPORT}) WHERE nombre_annonces > 10")
AGENTS = f"""SELECT nom_complet, COUNT(*) AS nombre_annonces, {avg('prix')} AS prix_moyen_geres,
  {avg('surface')} AS surface_moyenne_geres, MIN(date_extraction) AS premiere_annonce,
  MAX(date_extraction) AS derniere_annonce FROM conseiller JOIN annonces USING (id_annonce)
  GROUP BY nom_complet HAVING COUNT(*) >= 2"""
base("v12_stats_conseillers", AGENTS)
base("v35_conseillers_actifs", f"SELECT * FROM ({AGENTS}) WHERE nombre_annonces > 5")
base("v35_conseillers_top_10", f"SELECT nom_complet, nombre_annonces, prix_moyen_geres, surface_moyenne_geres FROM ({AGENTS}) ORDER BY nombre_annonces DESC, nom_complet LIMIT 10")
base("v13_stats_saisonnalite", f"SELECT CAST(month(date_extraction) AS INTEGER) AS mois, strftime(date_extraction, '%B') AS nom_mois, COUNT(*) AS nombre_nouvelles_annonces, {avg('prix')} AS prix_moyen FROM annonces GROUP BY 1, 2")
base("v14_stats_visites_virtuelles", f"SELECT has_visite_virtuelle AS visite_virtuelle_disponible, {A_STATS}, {ratio('COUNT(*)', '(SELECT COUNT(*) FROM annonces)')} AS pourcentage_total, {avg('nombre_photos', 1)} AS photos_moyennes FROM annonces GROUP BY 1")
DPE2 = f"SELECT classe_energie, classe_climat, COUNT(*) AS nombre_biens, {M2}, {SURF} FROM annonces JOIN dpe USING (id_annonce) WHERE classe_energie IS NOT NULL AND classe_climat IS NOT NULL GROUP BY 1, 2"
base("v15_stats_comparaison_dpe", DPE2)
base("v35_dpe_frequents", f"SELECT classe_energie, classe_climat, nombre_biens, prix_m2_moyen FROM ({DPE2}) WHERE nombre_biens >= 10")
base("v35_type_bien_frequents", f"SELECT * FROM ({RICH}) WHERE nombre_annonces > 10")
base("v16_synthese_generale", f"""SELECT (SELECT COUNT(*) FROM annonces) AS total_annonces,
  (SELECT COUNT(DISTINCT localisation) FROM annonces) AS communes_couvertes,
  (SELECT {avg('prix')} FROM annonces) AS prix_moyen_general, (SELECT {avg('prix_au_m2')} FROM annonces) AS prix_m2_moyen_general,
  (SELECT {avg('surface')} FROM annonces) AS surface_moyenne_generale, (SELECT COUNT(*) FROM images) AS total_photos,
  (SELECT COUNT(*) FROM conseiller) AS total_conseillers, (SELECT MAX(date_extraction) FROM annonces) AS derniere_mise_a_jour""")
LISTING = """a.id_annonce, a.reference, a.titre, CAST(a.prix AS DOUBLE) AS prix, CAST(a.surface AS DOUBLE) AS surface,
  CAST(a.surface_terrain AS DOUBLE) AS surface_terrain, a.pieces, a.type_bien, a.localisation, a.localisation_complete,
  a.annee_construction, a.nombre_photos, a.has_video, a.has_visite_virtuelle, a.date_extraction, a.dpe_classe_active,
  a.ges_classe_active, CAST(a.prix_au_m2 AS DOUBLE) AS prix_au_m2"""
base("v17_annonces_complete", f"""SELECT {LISTING}, c.nom_complet AS conseiller_nom, c.telephone AS conseiller_telephone,
  c.photo AS conseiller_photo, c.note AS conseiller_note, d.classe_energie, d.indice_energie, d.classe_climat, d.indice_climat,
  cp.nb_lots, cp.charges_previsionnelles, cp.procedures,
  CASE WHEN a.prix_au_m2 IS NULL AND a.surface > 0 THEN CAST((200 * CAST(a.prix * 100 AS BIGINT) + CAST(a.surface * 100 AS BIGINT))
     // (2 * CAST(a.surface * 100 AS BIGINT)) AS DOUBLE) / 100 ELSE CAST(a.prix_au_m2 AS DOUBLE) END AS prix_au_m2_calcule
  FROM annonces a LEFT JOIN conseiller c USING (id_annonce) LEFT JOIN dpe d USING (id_annonce)
  LEFT JOIN copropriete cp USING (id_annonce) WHERE a.prix IS NOT NULL AND a.surface IS NOT NULL""")
base("v18_annonces_complete_comptes", f"""SELECT {LISTING}, c.nom_complet AS conseiller_nom, c.telephone AS conseiller_telephone,
  d.classe_energie, d.classe_climat, cp.nb_lots AS copropriete_nb_lots,
  (SELECT COUNT(*) FROM images i WHERE i.id_annonce = a.id_annonce) AS total_images,
  (SELECT COUNT(*) FROM caracteristiques x WHERE x.id_annonce = a.id_annonce) AS total_caracteristiques
  FROM annonces a LEFT JOIN conseiller c USING (id_annonce) LEFT JOIN dpe d USING (id_annonce) LEFT JOIN copropriete cp USING (id_annonce)""")
base("v19_stats_localisation", f"SELECT localisation, {A_STATS}, {SURF} FROM annonces GROUP BY localisation")
base("v19b_stats_localisation_nombre", f"SELECT localisation, COUNT(*) AS nombre_annonces, {dbl('SUM(prix)')} / NULLIF(COUNT(prix), 0) AS prix_moyen, {dbl('SUM(prix_au_m2)')} / NULLIF(COUNT(prix_au_m2), 0) AS prix_m2_moyen FROM annonces WHERE localisation IS NOT NULL GROUP BY localisation")
base("v20_stats_dpe", f"SELECT classe_energie, {A_STATS}, {avg('indice_energie')} AS indice_energie_moyen FROM annonces JOIN dpe USING (id_annonce) WHERE classe_energie IS NOT NULL GROUP BY classe_energie")
base("v20b_stats_dpe_surface", f"SELECT dpe_classe_active, COUNT(*) AS nombre_annonces, {dbl('SUM(prix)')} / COUNT(prix) AS prix_moyen, {dbl('SUM(surface)')} / COUNT(surface) AS surface_moyenne FROM annonces WHERE dpe_classe_active IS NOT NULL GROUP BY 1")
base("v21_stats_pieces", f"SELECT pieces, {A_STATS}, {SURF} FROM annonces WHERE pieces IS NOT NULL GROUP BY pieces")
base("v22_annonces_caracteristiques", f"SELECT a.id_annonce, a.reference, a.titre, {dbl('a.prix')} AS prix, STRING_AGG(c.valeur, ', ' ORDER BY c.valeur) AS caracteristiques FROM annonces a LEFT JOIN caracteristiques c USING (id_annonce) GROUP BY a.id_annonce, a.reference, a.titre, a.prix")
base("v32_prix_par_type_et_localisation", f"SELECT type_bien, localisation, {avg('prix')} AS prix_moyen, COUNT(*) AS nb_annonces FROM annonces WHERE prix IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) >= 5")
BY_TYPE = "SELECT type_bien, valeur AS caracteristique, COUNT(*) AS frequence FROM caracteristiques JOIN annonces USING (id_annonce) GROUP BY 1, 2"
base("v33_caracteristiques_par_type", BY_TYPE)
base("v33b_top_caracteristiques_par_type", f"SELECT type_bien, caracteristique, frequence FROM ({BY_TYPE}) QUALIFY row_number() OVER (PARTITION BY type_bien ORDER BY frequence DESC, caracteristique) <= 5")
base("v34_evolution_mensuelle", f"SELECT CAST(date_trunc('month', date_extraction) AS DATE) AS mois, COUNT(*) AS nouvelles_annonces, {avg('prix')} AS prix_moyen FROM annonces GROUP BY 1")
base("v36_api_total", "SELECT COUNT(*) AS total_annonces FROM annonces")
base("v36_api_annonces_par_type", "SELECT type_bien, COUNT(*) AS count FROM annonces WHERE type_bien IS NOT NULL GROUP BY 1")
base("v36_api_moyennes", f"SELECT {dbl('SUM(prix)')} / COUNT(prix) AS prix_moyen, {dbl('SUM(surface)')} / COUNT(surface) AS surface_moyenne FROM annonces WHERE prix IS NOT NULL")
base("v36_api_distribution_dpe", "SELECT dpe_classe_active, COUNT(*) AS count FROM annonces WHERE dpe_classe_active IS NOT NULL GROUP BY 1")
base("v37_part_par_type", f"SELECT type_bien, COUNT(*) AS count, {ratio('COUNT(*)', '(SELECT COUNT(*) FROM annonces)')} AS percentage FROM annonces WHERE type_bien IS NOT NULL GROUP BY 1")
base("v38_stats_prix_surface", f"SELECT COUNT(*) AS total_annonces, {avg('prix')} AS prix_moyen, {SURF}, {LOW_HIGH} FROM annonces WHERE prix IS NOT NULL AND surface IS NOT NULL")
base("v39_dernieres_annonces", f"SELECT reference, titre, {dbl('prix')} AS prix, localisation, date_extraction FROM annonces ORDER BY date_extraction DESC NULLS LAST, reference DESC LIMIT 3")

SHOWN = "id_annonce, reference, CAST(prix AS DOUBLE) AS prix, CAST(surface AS DOUBLE) AS surface, type_bien, localisation"
base("q10_search_filter", f"SELECT {SHOWN} FROM annonces WHERE type_bien ILIKE '%urgent%' AND prix >= 100000 AND prix <= 300000 AND surface <= 150 AND (localisation ILIKE '%build%' OR localisation_complete ILIKE '%build%')")
base("q11_page_results", f"SELECT {SHOWN} FROM annonces ORDER BY id_annonce DESC LIMIT 50 OFFSET 25")
base("q12_text_search", f"SELECT {SHOWN} FROM annonces WHERE titre ILIKE '%machin%' OR description ILIKE '%machin%' OR localisation ILIKE '%machin%' ORDER BY id_annonce DESC LIMIT 100")
SQL["q12b_indexed_text_search"] = SQL["q12_text_search"]
base("q13_all_details", """SELECT id_annonce, 'caracteristiques' AS section, 0 AS ordre, 'valeur' AS champ, valeur FROM caracteristiques WHERE id_annonce IN (SELECT id_annonce FROM annonces)
  UNION ALL SELECT id_annonce, 'images', ordre, 'url', url FROM images WHERE id_annonce IN (SELECT id_annonce FROM annonces) """ + "".join(
    f"UNION ALL SELECT id_annonce, '{t}', 0, '{c}', CAST({c} AS VARCHAR) FROM {t} WHERE {c} IS NOT NULL "
    for t, columns in {"conseiller": ["nom_complet", "photo", "note"], "dpe": ["classe_energie", "indice_energie", "classe_climat", "indice_climat"],
                       "copropriete": ["nb_lots", "charges_previsionnelles", "procedures"]}.items() for c in columns))
base("q13b_listing_detail", """SELECT a.id_annonce, a.reference,
  (SELECT STRING_AGG(valeur, ', ' ORDER BY valeur) FROM caracteristiques c WHERE c.id_annonce = a.id_annonce) AS caracteristiques,
  CAST((SELECT COUNT(*) FROM images i WHERE i.id_annonce = a.id_annonce) AS INTEGER) AS nb_images, x.nom_complet AS conseiller, x.note,
  d.classe_energie, cp.nb_lots FROM annonces a LEFT JOIN conseiller x USING (id_annonce) LEFT JOIN dpe d USING (id_annonce) LEFT JOIN copropriete cp USING (id_annonce) WHERE a.id_annonce = 42""")
base("q14_listing_by_reference", f"SELECT {SHOWN} FROM annonces WHERE reference = 'R42'")
base("q15_public_sample", f"SELECT reference, titre, {dbl('prix')} AS prix, {dbl('surface')} AS surface, localisation FROM annonces ORDER BY id_annonce DESC LIMIT 10")
base("q16_distinct_types", "SELECT DISTINCT type_bien FROM annonces WHERE type_bien IS NOT NULL")
base("q16b_distinct_locations", "SELECT DISTINCT localisation FROM annonces WHERE localisation IS NOT NULL ORDER BY localisation LIMIT 50")
base("q08_integrity_report", """SELECT id_annonce, 'chk_annee' AS regle FROM annonces WHERE annee_construction > 2000
  UNION ALL SELECT id_annonce, 'chk_prix_positif' FROM annonces WHERE prix <= 0
  UNION ALL SELECT id_annonce, 'chk_surface_positif' FROM annonces WHERE surface <= 0
  UNION ALL SELECT id_annonce, 'chk_pieces_positif' FROM annonces WHERE pieces <= 0""")
base("q09_fk_violations", "SELECT id_annonce, nb_lots FROM copropriete c WHERE NOT EXISTS (SELECT 1 FROM annonces a WHERE a.id_annonce = c.id_annonce AND a.prix IS NOT NULL)")
base("p26_truncate_localisation", "SELECT id_annonce, substr(localisation, 1, 3) || '***' AS localisation_secure FROM annonces")
base("s10_run_sql", "SELECT type_bien, COUNT(*) AS nombre FROM annonces WHERE prix > 200000 GROUP BY 1")
base("s14_table_count_report", " UNION ALL ".join(
    f"SELECT '{t}' AS nom_table, COUNT(*) AS nombre, 'ok' AS statut FROM {t}"
    for t in ("annonces", "caracteristiques", "images", "conseiller", "dpe", "copropriete")))
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")
COLUMNS = """columns AS (SELECT table_name, column_name, CAST(ordinal_position AS INTEGER) AS position, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'DOUBLE[]' THEN 'array<double>' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  WHEN 'DATE' THEN 'date' WHEN 'TINYINT' THEN 'tinyint' WHEN 'BOOLEAN' THEN 'boolean' ELSE data_type END AS type
  FROM information_schema.columns WHERE table_name IN (""" + ", ".join(f"'{t}'" for t in TABLES) + "))"
SQL["s12_profile_tables"] = f"WITH {COLUMNS}, n AS (" + " UNION ALL ".join(f"SELECT '{t}' AS nom_table, COUNT(*) AS nombre FROM {t}" for t in TABLES) + """)
  SELECT nom_table, column_name AS colonne, position, type, true AS nullable, nombre FROM n JOIN columns ON nom_table = table_name"""
SQL["s13_describe_catalogue_csv"] = f"""WITH {COLUMNS} SELECT 'spark' AS dbms, CAST(NULL AS VARCHAR) AS table_catalog, 'public' AS table_schema, table_name, column_name,
  position AS ordinal_position, type AS data_type, CASE WHEN type = 'string' THEN 255 END AS character_maximum_length, CASE WHEN position = 1 THEN 'PRIMARY KEY' END AS constraint_type,
  CAST(NULL AS VARCHAR) AS table_schema_2, CAST(NULL AS VARCHAR) AS table_name_2, CAST(NULL AS VARCHAR) AS column_name_2 FROM columns"""

# --- commerce -------------------------------------------------------------------------------
MONEY = "CAST(l_quantity AS DECIMAL(8,2)) * CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,3)))"
REVENUE = f"CAST(SUM({MONEY}) AS DOUBLE)"
SQL["c01_commandes_par_client"] = "SELECT c_custkey AS id_client, c_name AS nom_client, COUNT(o_orderkey) AS nombre_commandes FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2"
SQL["s11_catalogue_commandes_par_client"] = SQL["c01_commandes_par_client"]
JOINED = "lineitem JOIN orders ON l_orderkey = o_orderkey"
SQL["c02_chiffre_affaires_par_client"] = f"SELECT c_custkey AS id_client, c_name AS nom_client, {REVENUE} AS chiffre_affaires FROM {JOINED} JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"
PER_MONTH = f"SELECT strftime(o_orderdate, '%Y-%m') AS mois, {REVENUE} AS chiffre_affaires FROM {JOINED} {{0}} GROUP BY 1"
SQL["c03_chiffre_affaires_par_mois"] = PER_MONTH.format("WHERE year(o_orderdate) = 1998")
SQL["s11_catalogue_chiffre_affaires_par_mois"] = PER_MONTH.format("")
BOXES = "lineitem JOIN part ON l_partkey = p_partkey"
BOX = "p_partkey AS id_boite, p_brand AS nom_matiere, p_type AS nom_couleur"
SQL["c04_meilleures_boites_quantite"] = f"SELECT {BOX}, CAST(SUM(l_quantity) AS DOUBLE) AS quantite_vendue FROM {BOXES} GROUP BY 1, 2, 3 ORDER BY quantite_vendue DESC, id_boite LIMIT 5"
SQL["c05_meilleures_boites_chiffre"] = f"SELECT {BOX}, {REVENUE} AS chiffre_affaires FROM {BOXES} GROUP BY 1, 2, 3 ORDER BY chiffre_affaires DESC, id_boite LIMIT 5"
for _name, _column, _out in [("c06_chiffre_affaires_par_matiere", "p_brand", "nom_matiere"), ("c07_chiffre_affaires_par_couleur", "p_type", "nom_couleur")]:
    SQL[_name] = f"SELECT {_column} AS {_out}, CAST(COUNT(DISTINCT o_orderkey) AS BIGINT) AS nombre_commandes, {REVENUE} AS chiffre_affaires FROM {JOINED} JOIN part ON l_partkey = p_partkey GROUP BY 1"
SQL["c08_commandes_par_jour_semaine"] = "SELECT strftime(o_orderdate, '%A') AS jour_semaine, COUNT(o_orderkey) AS nombre_commandes FROM orders GROUP BY 1"
SQL["s11_catalogue_commandes_par_jour_semaine"] = SQL["c08_commandes_par_jour_semaine"]
SQL["c09_quantite_moyenne_par_boite"] = f"SELECT {BOX}, SUM(l_quantity) / COUNT(l_quantity) AS moyenne_quantite FROM {BOXES} GROUP BY 1, 2, 3"
SIDES = "p_size * 23 + 40 AS longueur_mm, p_size * 7 % 300 + 30 AS largeur_mm, p_size % 11 * 20 + 15 AS hauteur_mm"
OUTER = "CAST(2 * (longueur_mm * largeur_mm + longueur_mm * hauteur_mm + largeur_mm * hauteur_mm) AS DOUBLE) AS surface_exterieure_mm2"
SQL["c10_boites_details"] = f"SELECT *, {OUTER} FROM (SELECT {BOX}, {SIDES} FROM part)"
SQL["p25_exterior_surface"] = f"SELECT id_boite, {OUTER} FROM (SELECT {BOX}, {SIDES} FROM part)"
SQL["q08b_box_integrity"] = f"WITH b AS (SELECT {SIDES} FROM part) " + " UNION ALL ".join(
    f"SELECT 'chk_{n}' AS regle, COUNT(*) FILTER ({n}_mm > 1000) AS violations FROM b" for n in ("longueur", "largeur", "hauteur"))
SQL["c11_boites_par_matiere"] = "SELECT p_brand AS nom_matiere, COUNT(*) AS nb_boites FROM part GROUP BY 1"
SQL["s11_catalogue_boites_par_matiere"] = SQL["c11_boites_par_matiere"]
for _number, _name in (("02", "chiffre_affaires_par_client"), ("04", "meilleures_boites_quantite"), ("05", "meilleures_boites_chiffre"),
                       ("06", "chiffre_affaires_par_matiere"), ("07", "chiffre_affaires_par_couleur"), ("09", "quantite_moyenne_par_boite")):
    SQL[f"s11_catalogue_{_name}"] = SQL[f"c{_number}_{_name}"]
SQL["c11b_boites_par_couleur"] = "SELECT p_type AS nom_couleur, COUNT(*) AS nb_boites FROM part GROUP BY 1"
SQL["c12_commandes_par_jour"] = "SELECT CAST(o_orderdate AS DATE) AS date_commande, COUNT(*) AS nb_commandes FROM orders GROUP BY 1"
SQL["c12b_boites_par_client"] = f"SELECT c_name AS nom_client, CAST(SUM(l_quantity) AS DOUBLE) AS total_boites FROM {JOINED} JOIN customer ON o_custkey = c_custkey GROUP BY 1"
SQL["c12c_ventes_par_jour"] = f"SELECT CAST(o_orderdate AS DATE) AS date_commande, {REVENUE} AS total_ventes FROM {JOINED} GROUP BY 1"

# --- raw listings ---------------------------------------------------------------------------
RAW = OWNED + f""",
r0 AS (SELECT *, list_extract(['Appartement', 'Maison', 'Villa', 'Studio', 'Loft'], CAST(k % 5 + 1 AS INTEGER)) AS home,
  CAST(list_extract([75, 92, 93, 94, 77], CAST(ck % 5 + 1 AS INTEGER)) * 1000 + (ck * 7) % 100 AS VARCHAR) AS code,
  translate(format('{{:,.2f}}', tp), ',.', {NN} || ',') || {NB} || '€' AS price,
  CAST(9 + (k * 37) % 191 AS VARCHAR) AS size, strftime(d, '%Y-%m-%dT%H:%M:%S') AS jour,
  '9' || {NN} || '744' || {NB} || '€ / m²' AS m2 FROM o),
raw AS (SELECT k AS id_annonce, k, ck, d, 'R' || k AS reference, home || ' à ' || seg || ' (' || code || ')' AS titre,
  CASE WHEN k % 11 = 0 THEN '' WHEN k % 53 = 1 THEN 'Prix sur demande' WHEN k % 53 = 2 THEN m2 ELSE price END AS prix,
  price AS prix_detaille,
  CASE WHEN k % 6 = 0 THEN m2 WHEN k % 6 = 1 THEN (k % 9000 + 1000) || ',5 €' ELSE '' END AS prix_au_m2,
  CASE WHEN k % 23 = 5 THEN '' WHEN k % 23 = 6 THEN seg ELSE seg || ' (' || code || ')' END AS localisation,
  (k % 300) || ' rue ' || seg || ' ' || code AS localisation_complete, seg, code,
  CASE WHEN k % 17 = 3 THEN '' WHEN k % 29 = 4 THEN size || ',5' WHEN k % 29 = 5 THEN size || '.25' ELSE size END AS surface,
  CASE WHEN k % 4 = 0 THEN '' WHEN k % 4 = 1 THEN (k % 900) || ' m²' ELSE 'Terrain de ' || (k % 900) || '.5 m²' END AS surface_terrain,
  CASE WHEN k % 19 = 2 THEN '' ELSE CAST(k % 7 + 1 AS VARCHAR) END AS pieces, home AS type_bien,
  CASE WHEN k % 31 = 7 THEN '' ELSE 'Bien proche ' || CASE WHEN k % 3 = 0 THEN 'Buttes Chaumont' ELSE 'du centre' END || ', '
    || CASE WHEN k % 4 = 0 THEN 'Quartier  ' || seg || ' Nord' WHEN k % 4 = 1 THEN 'Quartier Buttes Chaumont' ELSE 'rue animée' END || ', '
    || CASE k % 5 WHEN 0 THEN 'métro Ligne ' || (k % 14) WHEN 1 THEN 'MÉTRO Gare ' || (k % 9) WHEN 2 THEN 'école et métro. Parc'
       WHEN 3 THEN 'métro École ' || (k % 7) ELSE 'bus' END || '. ' || repeat('Lumineux  séjour ', k % 45) END AS description,
  CASE WHEN k % 37 = 1 THEN '' WHEN k % 37 = 2 THEN 'vers 1900' ELSE CAST((k * 13) % 175 + 1850 AS VARCHAR) END AS annee_construction,
  'https://img.example/property/' || k || '.jpg?format=auto&width=300' AS image_url,
  CASE WHEN k % 13 = 5 THEN '' ELSE CAST(k % 7 AS VARCHAR) END AS nombre_photos,
  list_extract(['true', 'Oui ', 'non', '1', ''], CAST(k % 5 + 1 AS INTEGER)) AS has_video,
  list_extract(['Vrai', ' oui', '0', ''], CAST(k % 4 + 1 AS INTEGER)) AS has_visite_virtuelle,
  CASE k % 3 WHEN 0 THEN (k % 7) || ' photos' WHEN 1 THEN (k % 7) || ' Photo, 1 vidéo' ELSE 'Visite virtuelle et VIDEO' END AS media_info,
  CASE WHEN k % 8 = 0 THEN '' ELSE 'https://site.example' END || '/annonce/' || lower(home) || '/r' || k AS lien,
  CASE WHEN k % 61 = 3 THEN 'hier' WHEN k % 7 = 0 THEN jour || 'Z' WHEN k % 7 = 1 THEN jour || '.197754' ELSE jour END AS date_extraction,
  CASE WHEN k % 9 = 0 THEN '' WHEN k % 9 = 1 THEN 'Classe F' ELSE substr('ABCDEFG', CAST(k % 7 + 1 AS INTEGER), 1) END AS dpe_classe_active,
  CASE WHEN k % 10 = 7 THEN 'n/a' ELSE substr('ABCDEFG', CAST((k * 3) % 7 + 1 AS INTEGER), 1) END AS ges_classe_active,
  CAST(k % 12 + 2018 AS VARCHAR) AS annee_reference,
  CASE WHEN k % 3 = 0 THEN '' ELSE CAST((k * 7) % 120 AS VARCHAR) END AS copropriete_nb_lots,
  CASE k % 8 WHEN 0 THEN '' WHEN 1 THEN '1' || {NN} || (k % 900 + 100) || {NB} || '€ / an' WHEN 2 THEN (k % 400) || ' € / trim'
    WHEN 3 THEN (k % 99) || ',50 €/mois' WHEN 4 THEN (k % 777) || ' €' WHEN 5 THEN (k % 500) || ' par lot'
    WHEN 6 THEN 'Charges annuel ' || (k % 1000) ELSE 'néant' END AS charges,
  CASE WHEN k % 6 = 0 THEN 'Procédure en cours' ELSE '' END AS procedures,
  CASE WHEN k % 25 = 0 THEN '' ELSE 'Jean ' || c_name END AS conseiller_nom,
  CASE WHEN k % 25 = 0 THEN '' ELSE '+33 6 ' || ck END AS conseiller_telephone,
  CASE WHEN k % 25 = 0 THEN '' ELSE 'https://site.example/conseiller/' || ck END AS conseiller_lien,
  'https://img.example/p/' || ck || '.jpeg?format=auto&width=144' AS conseiller_photo,
  list_filter([CASE WHEN k % 16 = 8 THEN '0 chambre' END, CASE WHEN k % 4 <> 0 THEN (k % 4) || ' chambres' END,
    (k % 7 + 1) || ' pièces', size || ' m²', 'Cave', CASE WHEN k % 2 = 0 THEN 'Étage ' || (k % 8) || ' sur ' || (k % 3 + 8) END,
    CASE WHEN k % 10 = 3 THEN 'Étage ' || (k % 3 + 1) || '/9' END, CASE WHEN k % 6 = 0 THEN 'Ascenseur' END,
    CASE WHEN k % 6 = 1 THEN 'Sans ascenseur' END, CASE WHEN k % 3 = 0 THEN 'Digicode' END, CASE WHEN k % 4 = 1 THEN 'Interphone' END,
    CASE WHEN k % 5 = 2 THEN 'Chauffage central' END, CASE WHEN k % 7 = 3 THEN 'Double vitrage' END, CASE WHEN k % 9 = 0 THEN '  ' END,
    CASE WHEN k % 9 = 4 THEN ' Cuisine équipée ' END, CASE WHEN k % 8 = 5 THEN 'Balcon' END, 'Construit en 1900', 'Cave'],
    lambda x: x IS NOT NULL) AS feats,
  list_transform(range(0, k % 7), lambda i: CASE WHEN i = 0 AND k % 12 = 0 THEN '' ELSE 'https://img.example/property/' || k || '-' || (i % 4)
    || '.jpg?format=auto&width=' || CASE WHEN i % 2 = 0 THEN '390' ELSE '780' END END) AS imgs
  FROM r0)"""


def raw(name: str, columns: str, tail: str = "") -> None:
    SQL[name] = f"WITH {RAW}\nSELECT {columns} FROM raw {tail}"


def number(text: str) -> str:
    """Text to double where the text is one plain number."""
    return f"CASE WHEN regexp_full_match({text}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)') THEN CAST({text} AS DOUBLE) END"


def first(text: str, pattern: str, options: str = "") -> str:
    flags = f", '{options}'" if options else ""
    return f"NULLIF(regexp_extract({text}, '{pattern}', 1{flags}), '')"


HARD = "[\\x{202F}\\x{00A0}]"
WS = "[\\s\\x{00A0}\\x{202F}]"


def doc_price(c: str) -> str:
    return number(f"replace(trim(regexp_replace({c}, '[\\x{{202F}}\\x{{00A0}}€]', '', 'g')), ',', '.')")


def loader_price(c: str) -> str:
    text = f"trim(regexp_replace({c}, '[ \\x{{202F}}€]', '', 'g'), chr(160) || ' ')"
    return f"CASE WHEN regexp_full_match({text}, '[0-9]+[,.]?[0-9]*') THEN CAST(replace({text}, ',', '.') AS DOUBLE) END"


def doc_number(c: str) -> str:
    return number(f"regexp_replace({c}, '{HARD}', '', 'g')")


def first_int(c: str) -> str:
    return f"TRY_CAST({first(c, '([0-9]+)')} AS INTEGER)"


def loader_surface(c: str) -> str:
    value = f"TRY_CAST(replace({first(c, '([0-9]+[,.]?[0-9]*)')}, ',', '.') AS DOUBLE)"
    return f"CASE WHEN {value} > 0 THEN {value} END"


def year(c: str) -> str:
    value = f"TRY_CAST({first(c, '(19[0-9]{2}|20[0-9]{2})')} AS INTEGER)"
    return f"CASE WHEN {value} <= 2025 THEN {value} END"


def letter(c: str) -> str:
    return first(f"upper({c})", "([A-G])")


TRUE1 = "('true', 'vrai', 'oui', 'yes', '1', 't')"
TRUE2 = "('true', '1', 'yes', 'oui', 'vrai')"
STAMP = "CASE WHEN k % 61 = 3 THEN NULL WHEN k % 7 = 1 THEN d + INTERVAL 197754 MICROSECOND ELSE d END"
SCORE = "CASE {0} WHEN 'A' THEN 10 WHEN 'B' THEN 8 WHEN 'C' THEN 6 WHEN 'D' THEN 5 WHEN 'E' THEN 4 WHEN 'F' THEN 3 WHEN 'G' THEN 2 ELSE 0 END"
DIGITS = "CASE WHEN regexp_full_match({0}, '[0-9]+') THEN CAST({0} AS INTEGER) END"

raw("p01_normalise_price", f"id_annonce, {doc_price('prix')} AS prix, {doc_price('prix_au_m2')} AS au_m2")
raw("p02_clean_price", f"id_annonce, {loader_price('prix')} AS prix, {loader_price('prix_au_m2')} AS au_m2")


def sql_price(c: str) -> str:
    text = f"NULLIF(replace(replace(replace({c}, '€', ''), {NN}, ''), ' ', ''), '')"
    return f"CASE WHEN regexp_full_match({text}, '[0-9]+\\.?[0-9]*') THEN CAST({text} AS DOUBLE) END"


raw("p03_price_to_decimal", f"id_annonce, {sql_price('prix')} AS prix, {sql_price('surface')} AS surface")


def digits_only(c: str) -> str:
    return f"CAST(NULLIF(regexp_replace({c}, '[^0-9]', '', 'g'), '') AS DOUBLE)"


raw("p04_price_digits", f"id_annonce, {digits_only('prix')} AS prix, {digits_only('prix_au_m2')} AS au_m2")
raw("p05_normalise_number", f"id_annonce, {doc_number('surface')} AS surface, {doc_number('pieces')} AS pieces")
raw("p06_extract_first_int", f"id_annonce, {first_int('media_info')} AS photos, {first_int('copropriete_nb_lots')} AS lots")
raw("p07_extract_surface", f"id_annonce, {loader_surface('surface')} AS surface, {loader_surface('surface_terrain')} AS terrain")
raw("p08_extract_year", f"id_annonce, {year('annee_construction')} AS annee, {year('annee_reference')} AS reference_annee")
raw("p09_extract_energy_class", f"id_annonce, {letter('dpe_classe_active')} AS dpe, {letter('ges_classe_active')} AS ges")
raw("p10_normalise_boolean", f"id_annonce, lower(trim(has_video)) IN {TRUE1} AS video, lower(trim(has_visite_virtuelle)) IN {TRUE1} AS visite")
raw("p11_extract_boolean", f"id_annonce, lower(has_video) IN {TRUE2} AS video, lower(has_visite_virtuelle) IN {TRUE2} AS visite")
raw("p12_parse_iso_timestamp", f"id_annonce, {STAMP} AS horodatage, {number('surface')} AS nombre")
raw("p13_parse_extraction_date", f"id_annonce, COALESCE({STAMP}, TIMESTAMP '2025-11-15 00:00:00') AS horodatage")
raw("p16_building_age", f"id_annonce, 2025 - {DIGITS.format('annee_construction')} AS age")
raw("p17_energy_score", f"id_annonce, {SCORE.format('dpe_classe_active')} AS dpe, {SCORE.format('ges_classe_active')} AS ges")
raw("p18_energy_index", f"id_annonce, {DIGITS.format('annee_construction')} AS indice, {DIGITS.format('nombre_photos')} AS photos")
BEDROOMS = "CASE WHEN k % 16 = 8 THEN 0 WHEN k % 4 <> 0 THEN CAST(k % 4 AS INTEGER) END"
raw("p19_bedrooms_or_fallback", f"id_annonce, COALESCE(NULLIF({BEDROOMS}, 0), CASE WHEN k % 19 <> 2 THEN k % 7 END)::DOUBLE AS chambres")
SQL["p20_collapse_whitespace"] = "SELECT doc_id, md5(t) AS empreinte, CAST(length(t) AS INTEGER) AS longueur FROM (SELECT doc_id, regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g') AS t FROM documents)"
VILLE = "CASE WHEN localisation <> '' THEN seg END"
POSTAL = "CASE WHEN k % 23 NOT IN (5, 6) THEN code END"
raw("t01_split_localisation", f"id_annonce, {VILLE} AS ville, {POSTAL} AS code_postal")
QUARTIER = first("description", f"Quartier{WS}+([^,.]+)")
raw("t02_extract_district", f"id_annonce, {QUARTIER} AS quartier")
METRO = first("description", f"métro{WS}+([^,.]+)", "i")
PROXIMITE = f"NULLIF(concat_ws(', ', CASE WHEN contains(description, 'Buttes Chaumont') THEN 'Buttes Chaumont' END, 'métro ' || {METRO}), '')"
raw("t03_extract_proximity", f"id_annonce, {PROXIMITE} AS proximite")
FLOOR = "CAST(CASE WHEN k % 10 = 3 THEN k % 3 + 1 WHEN k % 2 = 0 THEN k % 8 END AS INTEGER)"
FLOORS = "CAST(CASE WHEN k % 10 = 3 THEN 9 WHEN k % 2 = 0 THEN k % 3 + 8 END AS INTEGER)"
LIFT = "k % 6 IN (0, 1)"
raw("t04_floor_info", f"id_annonce, {FLOOR} AS etage, {FLOORS} AS etage_total, {LIFT} AS ascenseur")
raw("t05_bedroom_count", f"id_annonce, {BEDROOMS} AS chambres")
COVERED = " OR ".join(f"contains(lower(x), '{w}')" for w in ("chambre", "pièces", "m²", "étage", "construit"))
# ordered removal of repeats: keep an item where its first position is its own
CLEAN_FEATS = f"list_filter(list_filter(feats, lambda x: NOT ({COVERED})), lambda x, i: list_position(list_filter(feats, lambda y: NOT ({COVERED.replace('(x)', '(y)')})), x) = i)"
raw("t06_clean_features", f"id_annonce, array_to_string({CLEAN_FEATS}, '|') AS caracteristiques")
CUT = "list_transform(imgs, lambda x: split_part(x, '?', 1))"
CLEAN_IMGS = f"list_filter({CUT}, lambda x, i: list_position({CUT}, x) = i)"
raw("t07_clean_images", f"id_annonce, array_to_string({CLEAN_IMGS}, '|') AS images, CAST(len({CLEAN_IMGS}) AS INTEGER) AS nombre")
CH_V = "CAST(CASE k % 8 WHEN 1 THEN 1000 + k % 900 + 100 WHEN 2 THEN k % 400 WHEN 3 THEN k % 99 + 0.5 WHEN 4 THEN k % 777 WHEN 5 THEN k % 500 WHEN 6 THEN k % 1000 END AS DOUBLE)"
CH_V = CH_V.replace("1000 + k % 900 + 100", "CAST('1' || (k % 900 + 100) AS BIGINT)")
CH_U = "CASE k % 8 WHEN 1 THEN '€ / an' WHEN 2 THEN '€ / trim' WHEN 3 THEN '€ / mois' WHEN 4 THEN '€' WHEN 6 THEN '€ / an' END"
CH_P = "CASE k % 8 WHEN 1 THEN 'annuel' WHEN 2 THEN 'trimestriel' WHEN 3 THEN 'mensuel' WHEN 4 THEN 'annuel' WHEN 6 THEN 'annuel' END"
raw("t08_parse_service_charge", f"id_annonce, {CH_V} AS valeur, {CH_U} AS unite, {CH_P} AS periode")
raw("t09_extract_charge_amount", f"id_annonce, {CH_V} AS charges")
CATEGORY = """CASE WHEN {0} LIKE '%chauffage%' OR {0} LIKE '%climatisation%' THEN 'chauffage'
  WHEN {0} LIKE '%cuisine%' OR {0} LIKE '%salle de bain%' OR {0} LIKE '%salle d''eau%' THEN 'equipements'
  WHEN {0} LIKE '%parking%' OR {0} LIKE '%garage%' OR {0} LIKE '%cave%' THEN 'dependances'
  WHEN {0} LIKE '%terrasse%' OR {0} LIKE '%balcon%' OR {0} LIKE '%jardin%' THEN 'exterieur'
  WHEN {0} LIKE '%digicode%' OR {0} LIKE '%interphone%' OR {0} LIKE '%alarme%' THEN 'securite' ELSE 'autres' END"""
SQL["t10_categorise_feature"] = f"WITH {RAW}, f AS (SELECT unnest(feats) AS v FROM raw) SELECT {CATEGORY.format('lower(v)')} AS categorie, COUNT(*) AS nombre FROM f GROUP BY 1"
raw("t11_parse_media_text", "id_annonce, media_info AS media_description, CAST(CASE WHEN k % 3 <> 2 THEN k % 7 ELSE 0 END AS INTEGER) AS nombre_photos, k % 3 <> 0 AS has_video, k % 3 = 2 AS has_visite_virtuelle")
raw("t12_absolute_url", "id_annonce, CASE WHEN k % 8 = 0 THEN 'https://listings.example' || lien ELSE lien END AS lien")
raw("t13_clean_photo_url", "id_annonce, 'https://img.example/property/' || k || '.jpg?format=auto' AS url, CASE WHEN k % 7 > 0 THEN CASE WHEN k % 12 = 0 THEN '' ELSE 'https://img.example/property/' || k || '-0.jpg?width=1200' END END AS premiere")
raw("t14_contact_photo_url", "id_annonce, 'https://img.example/p/' || ck || '.jpeg' AS photo")
raw("t15_postal_code_anywhere", "id_annonce, code")
HOME_FEATS = "list_filter(list_transform(feats, lambda x: trim(x)), lambda x: x <> '')"
raw("t16_extract_listing_fields", f"""id_annonce, titre, CASE WHEN k % 8 = 0 THEN 'https://listings.example' ELSE '' END || lien AS lien,
  prix_detaille AS prix, image_url, 'Nouveau|' || type_bien AS badges, array_to_string({HOME_FEATS}, '|') AS caracteristiques,
  CAST(k AS VARCHAR) AS reference, seg || ' (' || code || ')' AS localisation, code AS code_postal, type_bien,
  (9 + (k * 37) % 191) || ' m²' AS surface, (k % 7 + 1) || ' pièces' AS pieces,
  CASE WHEN k % 16 = 8 THEN '0 chambres' WHEN k % 4 <> 0 THEN (k % 4) || ' chambres' END AS chambres""")
raw("t17_extract_coownership_fields", "id_annonce, copropriete_nb_lots, CASE WHEN copropriete_nb_lots <> '' THEN charges ELSE '' END AS copropriete_charges_previsionnelles, '' AS copropriete_procedures")
SQL["t18_word_count"] = "SELECT mot, COUNT(*) AS nombre FROM (SELECT unnest(string_split(text, ' ')) AS mot FROM documents) GROUP BY 1"
SQL["t19_description_length_bucket"] = f"SELECT {LENGTHS.format('text')} AS longueur, COUNT(*) AS nombre FROM documents GROUP BY 1"
AGENT = "CASE WHEN k % 25 = 0 THEN '' ELSE {0} END"
raw("t20_extract_agent_fields", f"""id_annonce, conseiller_nom AS conseiller_nom_complet, conseiller_telephone,
  {AGENT.format("'https://listings.example/conseiller/' || (k % 50)")} AS conseiller_lien, {AGENT.format('conseiller_photo')} AS conseiller_photo,
  {AGENT.format('CAST(k % 5 AS VARCHAR)')} AS conseiller_note, {AGENT.format("(k % 40) || ' avis'")} AS conseiller_nombre_avis""")
SQL["t21_extract_gallery"] = f"""WITH {RAW}, p AS (SELECT k, list_filter(imgs, lambda x: x <> '') AS g FROM raw),
  e AS (SELECT k, len(g) AS n, unnest(g) AS u, unnest(range(0, len(g))) AS i FROM p)
  SELECT k AS id_annonce, replace(regexp_replace(u, '&width=.*', ''), 'x', 'x') AS url, u AS url_original, 'vue ' || i AS alt,
  CAST(i + 1 AS INTEGER) AS ordre, 'Photo ' || (i + 1) || '/' || n AS description FROM e"""
PANEL = "CASE WHEN k % 3 <> 0 THEN {0} ELSE '' END"
raw("t22_extract_energy_panel", f"""id_annonce, {PANEL.format("substr('ABCDEFG', CAST(k % 7 + 1 AS INTEGER), 1)")} AS dpe_classe_active,
  {PANEL.format("substr('ABCDEFG', CAST((k * 3) % 7 + 1 AS INTEGER), 1)")} AS ges_classe_active,
  {PANEL.format('CAST(k % 400 + 50 AS VARCHAR)')} AS dpe_consommation_energie_primaire, {PANEL.format('CAST(k % 300 + 40 AS VARCHAR)')} AS dpe_consommation_energie_finale,
  {PANEL.format('CAST(k % 70 AS VARCHAR)')} AS dpe_emissions, {PANEL.format('CAST(k % 60 AS VARCHAR)')} AS ges_emissions,
  {PANEL.format("(k % 900 + 100) || ' €'")} AS depenses_energie_min, {PANEL.format("(k % 900 + 1100) || ' €'")} AS depenses_energie_max,
  {PANEL.format("'Indice ' || (k % 9)")} AS dpe_description, {PANEL.format("'Climat'")} AS ges_description, {PANEL.format("'Performances'")} AS titre_section,
  '2025' AS annee_reference, {PANEL.format("'très performant|très consommateur'")} AS legende_dpe, {PANEL.format("'peu d''émissions'")} AS legende_ges""")
UNESCAPE = "replace(replace(replace(replace(replace(replace({0}, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', chr(39)), '&amp;', '&')"
TITLE = UNESCAPE.format("regexp_replace(regexp_extract(html, '(?is)<h1>(.*?)</h1>', 1), '<[^>]*>', '', 'gs')")
AD = UNESCAPE.format("regexp_replace(regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1), '<[^>]*>', '', 'gs')")
SQL["t23_extract_fields"] = f"""SELECT page_id, titre, langue, liens, honoraires, bloc_annonce, absent,
  concat_ws('|', CASE WHEN titre = '' THEN 'titre' END, CASE WHEN langue = '' THEN 'langue' END, CASE WHEN liens IS NULL THEN 'liens' END, CASE WHEN bloc_annonce = '' THEN 'bloc_annonce' END, 'absent') AS champs_manquants
  FROM (SELECT page_id, trim({TITLE}) AS titre, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS langue,
    NULLIF(array_to_string(list_filter(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda x: x <> ''), '|'), '') AS liens, '' AS honoraires,
    trim(CASE WHEN regexp_matches({AD}, '^[0-9A-Za-z_]+') THEN regexp_extract({AD}, '^([0-9A-Za-z_]+)', 1) ELSE {AD} END) AS bloc_annonce, '' AS absent FROM pages)"""
CHARGED = f"{CH_V}"
raw("p24_clean_loader_row", f"""id_annonce, reference, titre, titre AS titre_complet, {loader_price('prix')} AS prix, prix_detaille,
  COALESCE({loader_price('prix_au_m2')}, CASE WHEN {loader_price('prix')} <> 0 THEN {py2(f"{loader_price('prix')} / {loader_surface('surface')}")} END) AS prix_au_m2,
  localisation, localisation_complete, {loader_surface('surface')} AS surface, {loader_surface('surface_terrain')} AS surface_terrain,
  {first_int('pieces')} AS pieces, type_bien, {year('annee_construction')} AS annee_construction, '' AS honoraires, image_url,
  {first_int('nombre_photos')} AS nombre_photos, lower(has_video) IN {TRUE2} AS has_video, lower(has_visite_virtuelle) IN {TRUE2} AS has_visite_virtuelle,
  media_info, lien, COALESCE({STAMP}, TIMESTAMP '2025-11-15 00:00:00') AS date_extraction, {letter('dpe_classe_active')} AS dpe_classe_active,
  {letter('ges_classe_active')} AS ges_classe_active, '' AS depenses_energie_min, '' AS depenses_energie_max, {year('annee_reference')} AS annee_reference,
  {first_int('copropriete_nb_lots')} AS copropriete_nb_lots, charges AS copropriete_charges_previsionnelles, procedures AS copropriete_procedures,
  conseiller_nom AS conseiller_nom_complet, conseiller_telephone, conseiller_lien, conseiller_photo, '' AS conseiller_note""")
raw("g02_anonymise_names", "id_annonce, CASE WHEN k % 25 = 0 THEN 'Anonyme' ELSE 'Jean C.' END AS conseiller_nom")
raw("g03_clean_location", "id_annonce, seg AS localisation_complete")
raw("s01_read_listings_json", "reference, prix, surface, localisation, array_to_string(imgs, '|') AS images")
SQL["s01b_read_json_arrays"] = f"SELECT *, CAST(1 AS BIGINT) AS rebuts FROM ({SQL['s01_read_listings_json']})"
raw("s06_project_output_fields", "reference, '2025-11-15T00:00:00' AS date_extraction, 'acheter' AS type_transaction, 'ancien' AS type_bien, CASE WHEN k % 23 = 5 THEN code ELSE COALESCE(" + POSTAL + ", '') END AS code_postal, prix, '' AS badges")
raw("s15_list_input_files", "CAST(COUNT(*) AS BIGINT) AS lignes, CAST(0 AS BIGINT) AS vides")
raw("q05_filter_valid", "id_annonce, reference", f"WHERE k % 37 <> 0 AND prix <> '' AND localisation <> '' AND {POSTAL} IS NOT NULL")
raw("p03b_sql_functions", f"""id_annonce, {sql_price('prix')} AS v1, {digits_only('prix')} AS v2,
  CAST(2 * ((k % 90) * 20 + (k % 90) * 30 + 600) AS DOUBLE) AS exterieur,
  CASE WHEN k % 20000 < 5000 THEN 'economique' WHEN k % 20000 < 7000 THEN 'moyen' WHEN k % 20000 < 10000 THEN 'superieur' WHEN k % 20000 < 15000 THEN 'premium' ELSE 'luxe' END
  || '_' || CASE WHEN k % 150 < 30 THEN 'studio' WHEN k % 150 < 50 THEN 'appartement' WHEN k % 150 < 80 THEN 'grand_appartement' WHEN k % 150 < 120 THEN 'maison' ELSE 'grande_maison' END
  || '_' || CASE WHEN k % 11 <= 3 THEN 'renovation' WHEN k % 120 > 50 THEN 'ancien' ELSE 'standard' END AS segment,
  CASE WHEN k % 7 IN (5, 6) AND k % 90 > 30 THEN 'eleve' WHEN k % 7 = 4 THEN 'moyen' ELSE 'faible' END AS potentiel""")

# --- prepared listings ----------------------------------------------------------------------
PREP = RAW + f""",
p0 AS (SELECT *, {doc_price('prix')} AS pv, {doc_number('surface')} AS sv, {doc_number('pieces')} AS rooms, {VILLE} AS ville,
  {POSTAL} AS code_postal, {QUARTIER} AS quartier, {PROXIMITE} AS proximite, {CLEAN_FEATS} AS cf, {CLEAN_IMGS} AS ci,
  {DIGITS.format('annee_construction')} AS annee, {FLOOR} AS etage, {FLOORS} AS etage_total, {LIFT} AS ascenseur,
  {SCORE.format('dpe_classe_active')} AS dpe_score, {SCORE.format('ges_classe_active')} AS ges_score, {BEDROOMS} AS beds,
  {CH_V} AS ch_v, {CH_U} AS ch_u, {CH_P} AS ch_p, {doc_number('copropriete_nb_lots')} AS lots,
  lower(trim(has_video)) IN {TRUE1} AS video, lower(trim(has_visite_virtuelle)) IN {TRUE1} AS visite FROM raw),
prep AS (SELECT *, CASE WHEN pv <> 0 AND sv > 0 THEN {py2('pv / sv')} END AS au_m2, 2025 - annee AS age,
  COALESCE(NULLIF(beds, 0)::DOUBLE, CASE WHEN rooms <> 0 THEN rooms - 1 END) AS chambres,
  CASE WHEN sv > 0 AND rooms > 0 THEN {py2('sv / rooms')} END AS par_piece, CAST(len(ci) AS INTEGER) AS photos,
  ((pv IS NOT NULL)::INT + (sv IS NOT NULL)::INT + (rooms IS NOT NULL)::INT + (code_postal IS NOT NULL)::INT) * 2.5::DOUBLE AS qualite,
  list_filter([CASE WHEN pv IS NULL THEN 'prix' END, CASE WHEN sv IS NULL THEN 'surface' END, CASE WHEN rooms IS NULL THEN 'pieces' END,
    CASE WHEN code_postal IS NULL THEN 'code_postal' END], lambda x: x IS NOT NULL) AS manquants FROM p0)"""


def prep(name: str, columns: str, tail: str = "") -> None:
    SQL[name] = f"WITH {PREP}\nSELECT {columns} FROM prep {tail}"


def band(c: str, limits: list[int], labels: list[str]) -> str:
    whens = " ".join(f"WHEN {c} < {n} THEN '{label}'" for n, label in zip(limits, labels, strict=False))
    return f"CASE {whens} WHEN {c} IS NOT NULL THEN '{labels[-1]}' END"


L_PRICE = ["economique", "moyen", "superieur", "premium", "luxe"]
L_SURF = ["studio", "appartement", "grand_appartement", "maison", "grande_maison"]
L_AGE = ["neuf", "recent", "ancien", "tres_ancien", "patrimoine"]
SEG_P = band("NULLIF(au_m2, 0)", [5000, 7000, 10000, 15000], L_PRICE)
SEG_S = band("NULLIF(sv, 0)", [30, 50, 80, 120], L_SURF)
SEG_A = band("NULLIF(age, 0)", [5, 20, 50, 100], L_AGE)
FLAT = f"""id_annonce, reference, titre, qualite AS score_qualite, {dbl('pv')} AS prix, au_m2 AS prix_au_m2, sv AS surface,
  par_piece AS surface_par_piece, CAST(rooms AS INTEGER) AS pieces, CAST(chambres AS INTEGER) AS chambres, type_bien, ville, code_postal,
  quartier, proximite, CAST(NULL AS DOUBLE) AS score_emplacement, annee AS annee_construction, CAST(age AS INTEGER) AS age_bien, etage, etage_total,
  ascenseur, CAST(NULL AS DOUBLE) AS score_modernite, dpe_classe_active AS dpe_classe, dpe_score, ges_classe_active AS ges_classe, ges_score,
  CAST(lots AS INTEGER) AS nb_lots, ch_v AS charges_valeur, ch_u AS charges_unite,
  CASE WHEN k % 25 <> 0 THEN conseiller_nom END AS conseiller_nom, CASE WHEN k % 25 <> 0 THEN conseiller_telephone END AS conseiller_telephone"""
prep("q01_prepare_listings", f"{FLAT}, photos AS nombre_photos, video AS has_video, photos > 0 AS has_photo, array_to_string(cf, '|') AS caracteristiques")
prep("v23_annonces_preparees", FLAT)
prep("q02_missing_fields", "id_annonce, array_to_string(manquants, '|') AS champs_manquants")
prep("q03_quality_score", "id_annonce, qualite AS score_qualite")
prep("q04_prune_empty", "id_annonce, len(cf) = 0 AS sans_caracteristiques, photos = 0 AS sans_images, len(manquants) = 0 AS sans_manquants, video AS has_video")
prep("q06_add_quality_metrics", "reference, CAST(pv IS NOT NULL AS INTEGER) AS has_prix, CAST(sv IS NOT NULL AS INTEGER) AS has_surface, CAST(ville IS NOT NULL AS INTEGER) AS has_localisation, ((pv IS NOT NULL)::INT + (sv IS NOT NULL)::INT + (ville IS NOT NULL)::INT) / 3.0::DOUBLE AS data_quality_score")
prep("q07_quality_summary", """COUNT(*) AS nombre, SUM(qualite) / COUNT(*) AS score_moyen, COUNT(*) FILTER (qualite = 10) AS score_10, COUNT(*) FILTER (qualite >= 7.5) AS score_75_10,
  COUNT(*) FILTER (qualite >= 5 AND qualite < 7.5) AS score_5_75, COUNT(*) FILTER (qualite < 5) AS score_moins_5, COUNT(*) FILTER (len(manquants) = 0) AS manquants_0,
  COUNT(*) FILTER (len(manquants) BETWEEN 1 AND 2) AS manquants_1_2, COUNT(*) FILTER (len(manquants) >= 3) AS manquants_3_plus, median(qualite) AS score_median""")
_PREP_RULES = {
    "chk_prix_positif": "pv <= 0", "chk_prix_m2_positif": "au_m2 <= 0", "chk_surface_positif": "sv <= 0", "chk_pieces_positif": "rooms <= 0",
    "chk_chambres_positif": "chambres < 0", "chk_age_bien_positif": "age < 0", "chk_etage_positif": "etage < 0",
    "chk_dpe_classe": "dpe_classe_active NOT IN ('A','B','C','D','E','F','G')", "chk_ges_classe": "ges_classe_active NOT IN ('A','B','C','D','E','F','G')",
    "chk_dpe_score": "dpe_score NOT BETWEEN 0 AND 10", "chk_ges_score": "ges_score NOT BETWEEN 0 AND 10",
}
SQL["q08c_prepared_integrity"] = f"WITH {PREP}\n" + " UNION ALL ".join(
    f"SELECT '{n}' AS regle, COUNT(*) FILTER ({w}) AS violations FROM prep" for n, w in _PREP_RULES.items())
prep("p15_surface_per_room", "id_annonce, par_piece")
prep("p21_flatten_listing", f"""reference, TIMESTAMP '2025-11-15 00:00:00' AS date_import, type_bien AS composition_type_bien, CAST(rooms AS INTEGER) AS composition_nb_pieces,
  CAST(chambres AS INTEGER) AS composition_nb_chambres, pv AS prix_valeur, '€' AS prix_devise, sv AS surface_valeur, 'm²' AS surface_unite, ville AS localisation_ville,
  code_postal AS localisation_code_postal, CAST(NULL AS VARCHAR) AS localisation_departement, CAST(NULL AS VARCHAR) AS localisation_region,
  CAST(NULL AS VARCHAR) AS metadata_source, {STAMP} AS metadata_date_extraction, description, lien AS url""")
prep("p23_get_nested_value", "id_annonce, dpe_classe_active AS classe, CAST(NULL AS VARCHAR) AS region")
prep("s03_write_parquet", "id_annonce, pv AS valeur, ville")
prep("s04_write_csv", "id_annonce, annee AS annee_construction, CAST(age AS INTEGER) AS age_bien, etage, etage_total, ascenseur, CAST(NULL AS DOUBLE) AS score_modernite")
prep("s05_write_json", "id_annonce, pv AS valeur, au_m2, array_to_string(cf, '|') AS caracteristiques")
prep("s09_validate_documents", f"id_annonce, CASE WHEN k % 19 = 0 THEN 'champ requis manquant: titre' END AS erreur, {STAMP} AS date_extraction, TIMESTAMP '2025-11-15 00:00:00' AS imported_at, TIMESTAMP '2025-11-15 00:00:00' AS date_import")
prep("n07_module_prix", "id_annonce, pv AS valeur, '€' AS devise, au_m2, CAST(NULL AS DOUBLE) AS loyer_estime_mensuel, CAST(NULL AS DOUBLE) AS rendement_annuel_estime")
prep("n07_module_surface", "id_annonce, sv AS valeur, 'm²' AS unite, par_piece AS surface_par_piece")
prep("n07_module_composition", "id_annonce, CAST(rooms AS INTEGER) AS pieces, CAST(chambres AS INTEGER) AS chambres, type_bien")
prep("n07_module_localisation", "id_annonce, ville, code_postal, quartier, proximite, CAST(NULL AS DOUBLE) AS score_emplacement")
prep("n07_module_batiment", "id_annonce, annee AS annee_construction, CAST(age AS INTEGER) AS age_bien, etage, etage_total, ascenseur, CAST(NULL AS DOUBLE) AS score_modernite")
prep("n07_module_diagnostics", "id_annonce, dpe_classe_active AS dpe_classe, dpe_score, CAST(NULL AS INTEGER) AS dpe_indice, ges_classe_active AS ges_classe, ges_score, CAST(NULL AS INTEGER) AS ges_indice")
STEPS = "normalisation_numerique|extraction_geographique|extraction_caracteristiques|traitement_medias|calcul_scores|structuration_finale"
prep("n07_module_annonces", f"id_annonce, reference, titre, lien AS url_annonce, {STAMP} AS date_extraction, qualite AS score_qualite, array_to_string(manquants, '|') AS champs_manquants, '{STEPS}' AS etapes_traitees")
prep("n06b_shred_coownership_module", "id_annonce, CAST(lots AS INTEGER) AS nb_lots, ch_v AS charges_valeur, ch_u AS charges_unite, ch_p AS charges_periode, procedures = '' AS procedures_en_cours")
SQL["n01_shred_features"] = f"WITH {RAW}, f AS (SELECT id_annonce, trim(unnest(feats)) AS valeur FROM raw) SELECT id_annonce, valeur, {CATEGORY.format('lower(valeur)')} AS categorie FROM f WHERE valeur <> ''"
SQL["n02_shred_images"] = f"WITH {RAW}, f AS (SELECT id_annonce, unnest(imgs) AS url, unnest(range(1, len(imgs) + 1)) AS ordre FROM raw) SELECT id_annonce, url, CAST(ordre AS INTEGER) AS ordre FROM f WHERE url <> ''"
SQL["n03_shred_media"] = f"""WITH {PREP}, f AS (SELECT id_annonce, unnest(ci) AS url, unnest(range(1, len(ci) + 1)) AS ordre FROM prep)
  SELECT id_annonce, url, 'image' AS type_media, CAST(ordre AS INTEGER) AS ordre FROM f WHERE url <> ''
  UNION ALL SELECT id_annonce, 'video_presente', 'video', 0 FROM prep WHERE video
  UNION ALL SELECT id_annonce, 'visite_virtuelle_presente', 'visite_virtuelle', 0 FROM prep WHERE visite"""
raw("n04_shred_agent", "id_annonce, conseiller_nom AS nom_complet, conseiller_telephone AS telephone, conseiller_lien AS lien, conseiller_photo AS photo, '' AS note", "WHERE k % 25 <> 0")
raw("n04b_shred_contact", "id_annonce, conseiller_nom, conseiller_telephone, split_part(conseiller_photo, '?', 1) AS conseiller_photo, conseiller_lien", "WHERE k % 25 <> 0")
raw("n05_shred_energy", f"id_annonce, {letter('dpe_classe_active')} AS classe_energie, CAST(NULL AS INTEGER) AS indice_energie, {letter('ges_classe_active')} AS classe_climat, CAST(NULL AS INTEGER) AS indice_climat", f"WHERE {letter('dpe_classe_active')} IS NOT NULL OR {letter('ges_classe_active')} IS NOT NULL")
raw("n06_shred_coownership", f"id_annonce, {first_int('copropriete_nb_lots')} AS nb_lots, charges AS charges_previsionnelles, procedures", f"WHERE COALESCE({first_int('copropriete_nb_lots')}, 0) <> 0 OR charges <> '' OR procedures <> ''")
prep("m01_segment_price_m2", f"id_annonce, {SEG_P} AS segment")
prep("m02_segment_surface", f"id_annonce, {SEG_S} AS segment")
prep("m03_segment_age", f"id_annonce, {SEG_A} AS segment")
KNOWN = "pv <> 0 AND sv <> 0"
RENT = "(pv / sv * sv * 0.05::DOUBLE / 12::DOUBLE)"
GROSS = py2(f"{RENT} * 12::DOUBLE / pv * 100::DOUBLE")
NET = f"greatest(0::DOUBLE, {GROSS} - (ch_v / pv * 100::DOUBLE))"
PERF = f"""CASE WHEN {KNOWN} THEN {py2('pv / sv')} END AS prix_m2, CASE WHEN {KNOWN} THEN {py2(RENT)} END AS loyer_estime_mensuel,
  CASE WHEN {KNOWN} THEN {GROSS} END AS rendement_annuel_estime, CASE WHEN {KNOWN} AND ch_v <> 0 THEN ch_v END AS charges_annuelles,
  CASE WHEN {KNOWN} AND ch_v <> 0 THEN {NET} END AS rentabilite_nette"""
prep("m04_profitability", f"id_annonce, {PERF}")
SQL_GROSS = "(au_m2 * sv * 0.05::DOUBLE / 12::DOUBLE * 12::DOUBLE / pv * 100::DOUBLE)"
prep("m05_profitability_sql", f"id_annonce, au_m2 * sv * 0.05::DOUBLE / 12::DOUBLE AS loyer_estime, {SQL_GROSS} AS rendement_annuel, CASE WHEN ch_v IS NOT NULL THEN CASE WHEN {SQL_GROSS} IS NULL THEN 0 ELSE greatest(0::DOUBLE, {SQL_GROSS} - ch_v / pv * 100::DOUBLE) END ELSE {SQL_GROSS} END AS rentabilite_nette")


def place_score(digits: str) -> str:
    return (f"least(10::DOUBLE, greatest(1::DOUBLE, 5::DOUBLE + CASE WHEN {digits} IN ('75', '92') THEN 2 WHEN {digits} IN ('93', '94') THEN 1 ELSE 0 END"
            " + CASE WHEN contains(quartier, 'Buttes Chaumont') THEN 1 ELSE 0 END + CASE WHEN contains(proximite, 'métro') THEN 1 ELSE 0 END"
            " + CASE WHEN contains(lower(proximite), 'école') THEN 0.5::DOUBLE ELSE 0 END))")


EMPL = place_score("right(code_postal, 2)")
prep("m06_location_score", f"id_annonce, {EMPL} AS score_suffix, {place_score('left(code_postal, 2)')} AS score_prefix")
MODERN = " OR ".join(f"contains(lower(x), '{w}')" for w in ("digicode", "interphone", "chauffage central", "double vitrage"))
MODE = f"""least(10::DOUBLE, greatest(1::DOUBLE, 5::DOUBLE + (dpe_score - 5) * 0.5::DOUBLE
  + CASE WHEN age <> 0 AND age < 10 THEN 2 WHEN age <> 0 AND age < 30 THEN 1 WHEN age > 50 THEN -1 ELSE 0 END
  + len(list_filter(cf, lambda x: {MODERN})) * 0.5::DOUBLE + CASE WHEN ascenseur THEN 1 ELSE 0 END))"""
prep("m07_modernity_score", f"id_annonce, {MODE} AS score")

MARKET = f"""
priced AS (SELECT pv, sv, pv / sv AS m2 FROM prep WHERE {KNOWN}),
mkt AS (SELECT {py2('SUM(CAST(m2 AS DECIMAL(28,8)))::DOUBLE / COUNT(*)')} AS mean, {py2('stddev_pop(m2)')} AS dev, COUNT(*) AS n FROM priced)"""
STABLE = "CAST(SUM(CAST({0} AS DECIMAL(28,8))) AS DOUBLE) / COUNT(*)"
DISTRIBUTION = "COUNT(*) FILTER (m2 < 5000) AS distribution_economique, COUNT(*) FILTER (m2 >= 5000 AND m2 < 8000) AS distribution_moyen, COUNT(*) FILTER (m2 >= 8000 AND m2 < 12000) AS distribution_superieur, COUNT(*) FILTER (m2 >= 12000) AS distribution_premium"
SQL["m08_market_stats"] = f"""WITH {PREP}, {MARKET} SELECT (SELECT mean FROM mkt) AS prix_m2_moyen, {py2('MIN(m2)')} AS prix_m2_min, {py2('MAX(m2)')} AS prix_m2_max,
  (SELECT dev FROM mkt) AS ecart_type_prix_m2, COUNT(*) AS nombre_biens_analyses, {py2(STABLE.format('sv'))} AS surface_moyenne, {py2(STABLE.format('pv'))} AS prix_moyen,
  {DISTRIBUTION}, {py2('median(m2)')} AS prix_m2_median, (SELECT STRING_AGG(c, '|' ORDER BY c) FROM (SELECT DISTINCT code_postal AS c FROM prep WHERE code_postal IS NOT NULL)) AS arrondissements_uniques FROM priced"""
SQL["m09_price_distribution"] = f"WITH {PREP}, {MARKET} SELECT {DISTRIBUTION} FROM priced"

# --- aggregated listings --------------------------------------------------------------------
AGG = PREP + "," + MARKET + f""",
g0 AS (SELECT *, (SELECT mean FROM mkt) AS mean, (SELECT dev FROM mkt) AS dev, (SELECT n FROM mkt) AS nref, {EMPL} AS empl, {MODE} AS mode_,
  {SEG_P} AS seg_p, {SEG_S} AS seg_s, {SEG_A} AS seg_a, {PERF} FROM prep),
g1 AS (SELECT *, (au_m2 - mean) / dev AS zz FROM g0),
agg AS (SELECT *, CASE WHEN au_m2 <> 0 THEN {py2('zz')} END AS z,
  CASE WHEN au_m2 <> 0 THEN CASE WHEN zz < -1.5 THEN 'tres_sous_cote' WHEN zz < -0.5 THEN 'sous_cote' WHEN zz <= 0.5 THEN 'dans_la_moyenne' WHEN zz <= 1.5 THEN 'sur_cote' ELSE 'tres_sur_cote' END END AS pos,
  CASE WHEN au_m2 <> 0 THEN {py2('(au_m2 - mean) / mean * 100::DOUBLE')} END AS gap, CASE WHEN au_m2 <> 0 THEN mean END AS mref, {py2('(empl + mode_) / 2')} AS gscore FROM g1),
reco AS (SELECT id_annonce, reference, titre, gscore, unnest([
    {{'t': 'prix', 'd': CASE WHEN pos IN ('tres_sur_cote', 'sur_cote') THEN 'Envisager une révision du prix à la baisse' WHEN pos IN ('tres_sous_cote', 'sous_cote') THEN 'Prix attractif - maintenir la stratégie' END}},
    {{'t': 'marketing', 'd': CASE WHEN dpe_classe_active IN ('F', 'G') THEN 'Mettre en avant le potentiel de valorisation' END}},
    {{'t': 'marketing', 'd': CASE WHEN photos < 5 THEN 'Ajouter plus de photos pour mieux valoriser' END}},
    {{'t': 'marketing', 'd': CASE WHEN NOT visite THEN 'Envisager une visite virtuelle' END}},
    {{'t': 'amelioration', 'd': CASE WHEN dpe_classe_active IN ('F', 'G') THEN 'Priorité: rénovation énergétique' END}},
    {{'t': 'ciblage', 'd': CASE WHEN COALESCE(etage, 0) >= 4 AND NOT ascenseur THEN 'Cibler public jeune et sportif' ELSE 'Convient à toutes les cibles' END}}]) AS x FROM agg),
recommandations AS (SELECT id_annonce, reference, titre, gscore, x.t AS type_recommandation, x.d AS description,
  CASE x.t WHEN 'amelioration' THEN 'haute' WHEN 'prix' THEN 'haute' WHEN 'ciblage' THEN 'moyenne' ELSE 'basse' END AS priorite,
  CASE x.t WHEN 'amelioration' THEN 'important' WHEN 'prix' THEN 'important' WHEN 'marketing' THEN 'moyen' ELSE 'faible' END AS impact_estime,
  CASE x.t WHEN 'prix' THEN 'immediat' WHEN 'marketing' THEN 'court_terme' ELSE 'moyen_terme' END AS delai_recommandation,
  CASE x.t WHEN 'prix' THEN CASE WHEN contains(x.d, 'révision') THEN 'Analyser les prix du marché local et ajuster le prix de 5 à 10%' ELSE 'Maintenir le prix actuel et surveiller la concurrence' END
    WHEN 'marketing' THEN CASE WHEN contains(x.d, 'photos') THEN 'Organiser une séance photo professionnelle avec au moins 10 clichés'
      WHEN contains(x.d, 'visite virtuelle') THEN 'Contacter un prestataire pour réaliser une visite virtuelle 3D' ELSE 'Réviser la description et les arguments de vente' END
    WHEN 'amelioration' THEN 'Établir un devis pour les travaux de rénovation énergétique' ELSE 'Adapter la communication marketing pour la cible identifiée' END AS action_concrete
  FROM reco WHERE x.d IS NOT NULL)"""


def agg(name: str, columns: str, tail: str = "", table: str = "agg") -> None:
    SQL[name] = f"WITH {AGG}\nSELECT {columns} FROM {table} {tail}"


agg("m10_compare_to_market", "id_annonce, z AS z_score_prix_m2, pos AS positionnement_marche, gap AS ecart_pourcentage, mref AS prix_m2_marche_reference")
SQL["m11_recommendations"] = f"""WITH {AGG} SELECT a.id_annonce, """ + ", ".join(
    f"COALESCE((SELECT STRING_AGG(description, '|' ORDER BY CASE WHEN contains(description, 'valorisation') THEN 1 WHEN contains(description, 'photos') THEN 2 ELSE 3 END) FROM recommandations r WHERE r.id_annonce = a.id_annonce AND type_recommandation = '{t}'), '') AS {t}"
    for t in ("prix", "marketing", "amelioration", "ciblage")) + " FROM agg a"
ACCENT = "replace(replace(replace(replace({0}, 'economique', 'économique'), 'superieur', 'supérieur'), 'tres_', 'très_'), 'x', 'x')"
agg("m12_aggregate_listings", f"id_annonce, empl AS emplacement, mode_ AS modernite, gscore AS global, prix_m2, {ACCENT.format('seg_p')} AS segment_prix, {ACCENT.format('seg_a')} AS segment_age, {ACCENT.format('pos')} AS position, CAST(nref AS INTEGER) AS nombre_reference")
agg("m13_market_trends", f"""{py2(STABLE.format('gscore'))} AS score_global_moyen, {py2(STABLE.format('COALESCE(prix_m2, 0)'))} AS prix_m2_moyen,
  {py2('corr(gscore, COALESCE(prix_m2, 0))', 3)} AS correlation_score_prix,
  COUNT(*) FILTER (gscore >= (SELECT quantile_cont(gscore, 0.9) FROM agg)) AS top_nombre_biens,
  {py2("CAST(SUM(CAST(COALESCE(prix_m2, 0) AS DECIMAL(28,8))) FILTER (gscore >= (SELECT quantile_cont(gscore, 0.9) FROM agg)) AS DOUBLE) / COUNT(*) FILTER (gscore >= (SELECT quantile_cont(gscore, 0.9) FROM agg))")} AS top_prix_m2_moyen""")
agg("m13b_segment_distribution", "seg_p AS segment, COUNT(*) AS nombre", "WHERE seg_p IS NOT NULL GROUP BY 1")
SQL["i14_medallion_layers"] = SQL["m13b_segment_distribution"]
SQL["i14b_medallion_statistics"] = SQL["m08_market_stats"]
agg("m14_biens_sous_cotes", "reference, pos AS positionnement, gap AS ecart_pourcentage", "WHERE pos IN ('tres_sous_cote', 'sous_cote')")
agg("m14_biens_sur_cotes", "reference, pos AS positionnement, gap AS ecart_pourcentage", "WHERE pos IN ('tres_sur_cote', 'sur_cote')")
agg("m14_opportunites_amelioration", "reference, 'Priorité: rénovation énergétique' AS recommandations", "WHERE dpe_classe_active IN ('F', 'G')")
RATE = "COALESCE(rendement_annuel_estime, 0)"
NETR = "COALESCE(rentabilite_nette, 0)"
LEVEL = f"CASE WHEN {RATE} >= 8 THEN 'eleve' WHEN {RATE} >= 5 THEN 'moyen' ELSE 'faible' END"
PROFIT = f"CASE WHEN {NETR} >= 6 THEN 'excellent' WHEN {NETR} >= 4 THEN 'bon' WHEN {NETR} >= 2 THEN 'acceptable' ELSE 'faible' END"
agg("m15_yield_level", f"id_annonce, {LEVEL} AS niveau, {PROFIT} AS ratio")
TARGET = "CASE WHEN age <> 0 AND age < 10 THEN 'investisseurs_neuf' WHEN seg_p IN ('premium', 'luxe') THEN 'investisseurs_haut_gamme' WHEN NOT ascenseur AND etage >= 3 THEN 'jeunes_actifs' ELSE 'familles' END"
POTENTIAL = "CASE WHEN dpe_score <= 3 AND COALESCE(age, 0) > 30 THEN 'renovation' WHEN dpe_score >= 7 AND COALESCE(age, 0) < 20 THEN 'valorisation' ELSE 'standard' END"
agg("m16_target_segment", f"id_annonce, {TARGET} AS cible")
prep("m17_potential_segment", f"id_annonce, {POTENTIAL} AS potentiel")
LABEL = "NULLIF(concat_ws('_', seg_p, seg_s, seg_a), '')"
agg("m18_global_segment_label", f"id_annonce, {LABEL} AS segment")
SEG_SQL = (f"COALESCE({band('au_m2', [5000, 7000, 10000, 15000], L_PRICE)}, 'luxe') || '_' || COALESCE({band('sv', [30, 50, 80, 120], L_SURF)}, 'grande_maison') || '_' || "
           "CASE WHEN dpe_score <= 3 THEN 'renovation' WHEN age > 50 THEN 'ancien' ELSE 'standard' END")
prep("m19_market_segment_sql", f"id_annonce, {SEG_SQL} AS segment")
prep("m20_attractiveness_score", """id_annonce, greatest(1::DOUBLE, least(10::DOUBLE, 5::DOUBLE + CASE WHEN dpe_score >= 6 THEN 2 ELSE 0 END - CASE WHEN dpe_score <= 3 THEN 2 ELSE 0 END
  + CASE WHEN ascenseur THEN 1 ELSE 0 END + CASE WHEN etage = 1 THEN 1 ELSE 0 END + CASE WHEN age < 20 THEN 1 ELSE 0 END - CASE WHEN age > 100 THEN 1 ELSE 0 END
  + CASE WHEN photos >= 5 THEN 1 ELSE 0 END)) AS score""")


def weighted(scale: int) -> str:
    # scores are multiples of 1/4 and weights of 1/20: all in whole units of 1/80, weight sum 48/80
    units = f"(CAST(empl * 4 AS BIGINT) * 4 + CAST(mode_ * 4 AS BIGINT) * 3 + dpe_score * 12 + 48)"
    total = f"((200 * {units} + 80) // 160)"
    hundredths = f"((200 * {scale} * {total} + 60) // 120)"
    return f"CAST((least(1000, {hundredths}) + 5) // 10 AS DOUBLE) / 10"


agg("m21_weighted_attractiveness", f"id_annonce, {weighted(10)} AS score_10, {weighted(1)} AS score_1")
HIGH = "dpe_classe_active IN ('F', 'G') AND age > 30"


def renovation(a: str, b: str, c: str) -> str:
    return f"CASE WHEN {HIGH} THEN {a} WHEN dpe_classe_active = 'E' THEN {b} ELSE {c} END"


RENO = {"p": renovation("'eleve'", "'moyen'", "'faible'"), "g": renovation("0.15::DOUBLE", "0.08::DOUBLE", "0.02::DOUBLE"),
        "i": "pv * " + renovation("0.10::DOUBLE", "0.06::DOUBLE", "0.02::DOUBLE")}
prep("m22_renovation_potential", f"id_annonce, {RENO['p']} AS potentiel, {RENO['g']} AS gain_valeur_estime, {RENO['i']} AS investissement_estime")
ACCESS = "5::DOUBLE + CASE WHEN ascenseur THEN 2 ELSE 0 END + CASE WHEN COALESCE(etage, 0) <= 1 THEN 1 WHEN etage >= 4 AND NOT ascenseur THEN -2 ELSE 0 END"
MEDIA = "least(10::DOUBLE, 5::DOUBLE + CASE WHEN photos >= 5 THEN 2 ELSE 0 END + CASE WHEN video THEN 1 ELSE 0 END + CASE WHEN visite THEN 2 ELSE 0 END)"
prep("m23_accessibility_score", f"id_annonce, {ACCESS} AS score")
prep("m24_media_score", f"id_annonce, {MEDIA} AS score")
RANK = "greatest(1, least(99, 50 + CAST(trunc(COALESCE(z, 0) * 20::DOUBLE) AS INTEGER)))"
agg("m25_percentile_rank_approx", f"id_annonce, {RANK} AS rang")
SQL["m25b_percentile_rank_exact"] = f"""WITH {PREP}, ranked AS (SELECT id_annonce, au_m2, CAST(rank() OVER (ORDER BY au_m2) - 1 AS DOUBLE) / (COUNT(*) OVER () - 1) * 100::DOUBLE AS rang_exact FROM prep WHERE au_m2 IS NOT NULL)
  SELECT id_annonce, au_m2, rang_exact FROM ranked UNION ALL SELECT id_annonce, au_m2, NULL FROM prep WHERE au_m2 IS NULL"""
agg("p22_map_fields", f"reference, pv AS prix_valeur, au_m2 AS prix_au_m2, sv AS surface_valeur, rooms AS composition_pieces, ascenseur AS batiment_ascenseur, CAST(dpe_score AS DOUBLE) AS diagnostics_dpe_score, video AS medias_has_video, {STAMP} AS metadata_date_extraction, qualite AS metadata_score_qualite, gscore AS aggregats_scores_global, seg_s AS aggregats_segmentation_surface")


def dec(c: str, scale: int) -> str:
    """Decimal of the given scale, rounded half up on the text of the double, as a double."""
    return f"CAST(CAST(CAST({c} AS VARCHAR) AS DECIMAL(18,{scale})) AS DOUBLE)"


G1 = dec("gscore", 1)
NET2 = dec(NETR, 2)
agg("n08_aggregats_principaux", f"id_annonce, TIMESTAMP '2025-11-15 00:00:00' AS date_aggregation, '1.0' AS algorithme_version, {G1} AS score_global, {LABEL} AS segment_marche_global, 'a_analyser' AS statut_optimisation")
agg("n08_performance_financiere", f"id_annonce, prix_m2 AS prix_m2_calcule, loyer_estime_mensuel, {RATE}::DOUBLE AS rendement_annuel_estime, {NET2} AS rentabilite_nette, charges_annuelles, {PROFIT} AS ratio_rentabilite, {LEVEL} AS niveau_rendement")
agg("n08_scores_avances", f"id_annonce, {dec('empl', 1)} AS score_emplacement, {dec('mode_', 1)} AS score_modernite, {dec('mode_', 1)} AS score_dpe, 6::DOUBLE AS score_equipements, {ACCESS} AS score_accessibilite, {MEDIA} AS score_medias, 0.20::DOUBLE AS ponderation_emplacement, 0.15::DOUBLE AS ponderation_modernite, 0.15::DOUBLE AS ponderation_dpe, 0.10::DOUBLE AS ponderation_equipements")
agg("n08_segmentation", f"id_annonce, seg_p AS segment_prix_m2, seg_s AS segment_surface, seg_a AS segment_age, {TARGET} AS segment_cible, {POTENTIAL} AS segment_potentiel")
agg("n08_analyse_marche", f"id_annonce, pos AS positionnement_marche, COALESCE(z, 0)::DOUBLE AS z_score_prix_m2, gap AS ecart_pourcentage, mref AS prix_m2_marche_reference, CAST(nref AS INTEGER) AS nombre_biens_reference, CAST(NULL AS DOUBLE) AS ecart_type_marche, {RANK} AS rang_percentile")
agg("n09_shred_recommendations", "id_annonce, type_recommandation, description, priorite, action_concrete, impact_estime, delai_recommandation", table="recommandations")
agg("r06_recommendation_labels", "type_recommandation, priorite, impact_estime, delai_recommandation, action_concrete, COUNT(*) AS nombre", "GROUP BY 1, 2, 3, 4, 5", "recommandations")
PV2 = "CAST(CAST(pv AS VARCHAR) AS DECIMAL(14,2))"
AU2 = "CAST(CAST(au_m2 AS VARCHAR) AS DECIMAL(14,2))"
GL2 = "CAST(CAST(gscore AS VARCHAR) AS DECIMAL(14,1))"
RD2 = "CAST(CAST(rendement_annuel_estime AS VARCHAR) AS DECIMAL(14,2))"
prep("v19c_stats_localisation_code", f"code_postal, ville, COUNT(*) AS nombre_annonces, {avg(PV2)} AS prix_moyen, {avg(AU2)} AS prix_m2_moyen", "WHERE code_postal IS NOT NULL GROUP BY 1, 2")
prep("v20c_stats_dpe_prix", f"dpe_classe_active AS dpe_classe, COUNT(*) AS nombre_annonces, {avg(PV2)} AS prix_moyen, {avg(AU2)} AS prix_m2_moyen", "GROUP BY 1")
PRICE_JSON = "CASE WHEN pos IN ('tres_sur_cote', 'sur_cote') THEN '[\"Envisager une révision du prix à la baisse\"]' WHEN pos IN ('tres_sous_cote', 'sous_cote') THEN '[\"Prix attractif - maintenir la stratégie\"]' ELSE '[]' END"
agg("v24_annonces_aggregats", f"{FLAT}, {G1} AS score_global, pos AS positionnement_marche, {SEG_SQL} AS segment_marche, {RENO['p']} AS potentiel_renovation, {PRICE_JSON} AS recommandations_prix, rendement_annuel_estime")
agg("v25_stats_performance", f"COUNT(*) AS total_annonces, {avg(PV2)} AS prix_moyen, {avg(AU2)} AS prix_m2_moyen, {avg(GL2)} AS score_moyen, {avg(RD2)} AS rendement_moyen")
agg("v26_stats_segmentation", f"{SEG_SQL} AS segment_marche, COUNT(*) AS nombre_annonces, {avg(PV2)} AS prix_moyen, {avg(GL2)} AS score_moyen, {avg(RD2)} AS rendement_moyen", "GROUP BY 1")
agg("v27_aggregats_complets", f"""id_annonce, reference, titre, {G1} AS score_global, {LABEL} AS segment_marche_global, 'a_analyser' AS statut_optimisation, prix_m2 AS prix_m2_calcule,
  loyer_estime_mensuel, {RATE}::DOUBLE AS rendement_annuel_estime, {LEVEL} AS niveau_rendement, {dec('empl', 1)} AS score_emplacement, {dec('mode_', 1)} AS score_modernite, {dec('mode_', 1)} AS score_dpe,
  seg_p AS segment_prix_m2, seg_s AS segment_surface, {TARGET} AS segment_cible, pos AS positionnement_marche, gap AS ecart_pourcentage, COALESCE(z, 0)::DOUBLE AS z_score_prix_m2,
  mref AS prix_m2_marche_reference, ville, code_postal, quartier""")
RATE2 = f"CAST(CAST({RATE} AS VARCHAR) AS DECIMAL(14,2))"
PM2 = "CAST(CAST(prix_m2 AS VARCHAR) AS DECIMAL(14,2))"
agg("v28_stats_aggregats", f"COUNT(*) AS total_aggregats, {avg(GL2)} AS score_global_moyen, {avg(PM2)} AS prix_m2_moyen, {avg(RATE2)} AS rendement_moyen, "
    + ", ".join(f"COUNT(*) FILTER (seg_p = '{s}') AS nb_{s}" for s in L_PRICE) + ", "
    + ", ".join(f"COUNT(*) FILTER (pos = '{p}') AS nb_{n}" for p, n in [("tres_sous_cote", "tres_sous_cote"), ("sous_cote", "sous_cote"), ("dans_la_moyenne", "moyenne"), ("sur_cote", "sur_cote"), ("tres_sur_cote", "tres_sur_cote")]))
agg("v29_recommandations_actives", f"reference, titre, type_recommandation, priorite, description, action_concrete, {G1} AS score_global", "WHERE priorite IN ('haute', 'critique')", "recommandations")
APART = f"reference, titre, prix_m2 AS prix_m2_calcule, mref AS prix_m2_marche_reference, gap AS ecart_pourcentage, {G1} AS score_global, {LABEL} AS segment_marche_global"
agg("v30_biens_sous_cotes", APART, "WHERE pos IN ('tres_sous_cote', 'sous_cote')")
agg("v31_biens_sur_cotes", APART, "WHERE pos IN ('tres_sur_cote', 'sur_cote')")
agg("m26_completion_stats", f"""COUNT(DISTINCT id_annonce) AS total_annonces, COUNT(*) FILTER (k % 3 <> 0) AS total_aggregats, {avg(PV2)} AS prix_moyen,
  {avg(f'CASE WHEN k % 3 <> 0 THEN {GL2} END')} AS score_global_moyen, {avg(f'CASE WHEN k % 3 <> 0 THEN {RATE2} END')} AS rendement_moyen,
  CAST(COUNT(*) FILTER (k % 3 <> 0) AS DOUBLE) * 100 / COUNT(*) AS taux_aggregation""")
prep("v40_flat_types", "type_bien AS composition_type_bien, COUNT(*) AS count", "GROUP BY 1")


def summary(c: str) -> str:
    return f"COUNT({c}) AS count, CAST(SUM(CAST({c} AS DECIMAL(28,8))) AS DOUBLE) / COUNT({c}) AS mean, round(stddev_samp({c}), 6) AS stddev, MIN({c}) AS min, MAX({c}) AS max"


prep("v40_flat_prix", summary("pv"))
prep("v40_flat_surface", summary("sv"))
prep("v40_flat_qualite", summary("(((pv IS NOT NULL)::INT + (sv IS NOT NULL)::INT + (ville IS NOT NULL)::INT) / 3.0::DOUBLE)"))
prep("v41_top_villes", f"ville AS localisation_ville, round({STABLE.format('(pv / sv)')}, 6) AS prix_m2_moyen, COUNT(*) AS nb_annonces", "WHERE pv IS NOT NULL AND sv > 0 GROUP BY 1 HAVING COUNT(*) >= 5 ORDER BY 2 DESC, 1 LIMIT 10")
prep("v42_document_types", "type_bien, COUNT(*) AS count", "GROUP BY 1")
prep("v42_document_villes", "ville, COUNT(*) AS count", "GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 5")
prep("v42_document_prix", f"{STABLE.format('pv')} AS prix_moyen", "WHERE pv IS NOT NULL")
raw("v43_document_count", "COUNT(*) AS total")
raw("v43_document_sample", "reference, titre", "ORDER BY md5('0' || reference), reference LIMIT 3")
raw("v43_first_documents", "reference, titre", "ORDER BY reference LIMIT 5")
SQL["s02_read_snapshots"] = f"""WITH {RAW}, runs AS (SELECT unnest([0, 1, 2]) AS i)
  SELECT TIMESTAMP '2025-11-10 02:15:00' + INTERVAL 1 DAY * CAST(i AS INTEGER) AS horodatage, COUNT(*) AS lignes,
  CAST(SUM(CASE WHEN k % 3 <> 2 THEN k % 7 ELSE 0 END) AS BIGINT) AS photos, MIN(reference) AS premiere FROM raw JOIN runs ON k % 3 <> i GROUP BY i"""
SQL["p14_price_per_m2"] = f"""WITH {ANNONCES}, {PREP.split('),', 1)[1]}, x AS (SELECT id_annonce, {loader_price('prix_au_m2')} AS given, {loader_price('prix')} AS p, {loader_surface('surface')} AS s FROM raw)
  SELECT a.id_annonce, CASE WHEN a.prix > 0 AND a.surface > 0 THEN CAST((200 * CAST(a.prix * 100 AS BIGINT) + CAST(a.surface * 100 AS BIGINT)) // (2 * CAST(a.surface * 100 AS BIGINT)) AS DOUBLE) / 100 END AS sql,
  {py2('a.prix::DOUBLE / a.surface::DOUBLE')} AS document, COALESCE(x.given, CASE WHEN x.p <> 0 THEN {py2('x.p / x.s')} END) AS chargeur
  FROM annonces a JOIN x USING (id_annonce)"""

# --- loads ----------------------------------------------------------------------------------
LOAD = ANNONCES + """,
known AS (SELECT reference FROM annonces WHERE id_annonce % 3 = 0),
b0 AS (SELECT *, CASE WHEN id_annonce % 37 = 0 THEN '' ELSE reference END AS ref FROM annonces WHERE id_annonce % 2 = 0),
b AS (SELECT * FROM b0 UNION ALL SELECT * FROM b0 WHERE id_annonce % 8 = 0)"""
FRESH = "SELECT DISTINCT ref, titre, CAST(prix AS DOUBLE) AS prix FROM b WHERE ref <> '' AND ref NOT IN (SELECT reference FROM known)"
SQL["s07_load_counts"] = f"""WITH {LOAD}, fresh AS ({FRESH}) SELECT 'inserted' AS statut, (SELECT COUNT(*) FROM fresh) AS nombre
  UNION ALL SELECT 'skipped', (SELECT COUNT(*) FROM b WHERE ref <> '') - (SELECT COUNT(*) FROM fresh) UNION ALL SELECT 'error', (SELECT COUNT(*) FROM b WHERE ref = '')"""
SQL["s07c_upsert_new_by_key"] = f"""WITH {LOAD} SELECT ref AS reference, titre, prix FROM ({FRESH})
  UNION ALL SELECT reference, titre, CAST(prix AS DOUBLE) FROM annonces WHERE id_annonce % 3 = 0"""
SQL["s07b_new_rows"] = f"WITH {LOAD} SELECT ref AS reference, titre, prix FROM ({FRESH})"
agg("s08_insert_aggregates_if_absent", f"reference, {G1} AS score_global", "WHERE k % 3 = 0 AND k % 10 <> 6")

# --- queues and streams ---------------------------------------------------------------------
KINDS = ["api", "file", "web", "database"]
GOOD = "event_id % 17 <> 3"
SQL["i01_collect_source"] = f"SELECT 'file' AS source, event_type AS origine, props AS contenu, 'standard_v1' AS format, true AS normalized FROM events WHERE event_id % 4 = 1 AND {GOOD}"
for _i, _kind in enumerate(KINDS):
    SQL[f"i02_normalise_{_kind}"] = f"SELECT '{_kind}' AS source, 'standard_v1' AS format, 'normalization' AS processing_step, event_type AS origine, COUNT(*) AS nombre FROM events WHERE event_id % 4 = {_i} AND {GOOD} GROUP BY event_type"
KIND_OF = "list_extract(['api', 'file', 'web', 'database'], CAST(event_id % 4 + 1 AS INTEGER))"
SQL["i02b_rejected_lines"] = f"SELECT {KIND_OF} AS source, COUNT(*) AS nombre FROM events WHERE event_id % 17 = 3 GROUP BY 1"
SQL["i02c_any_json"] = """SELECT forme, COUNT(*) AS messages, COUNT(*) FILTER (forme NOT IN ('suite', 'apostrophes', 'reste', 'coupe')) AS gardes
  FROM (SELECT ['objet', 'cle_double', 'tableau', 'nombre', 'texte', 'suite', 'apostrophes', 'reste', 'non_nombre', 'coupe'][CAST(event_id % 10 + 1 AS INTEGER)] AS forme FROM events) GROUP BY 1"""
SQL["i03_union_sources"] = f"SELECT {KIND_OF} AS source, COUNT(*) AS nombre FROM events WHERE {GOOD} GROUP BY 1"
SQL["i04_aggregate_stream"] = f"SELECT CAST(COUNT(*) AS BIGINT) AS total_records, 'api|database|file|web' AS sources FROM events WHERE {GOOD}"
LOG = """WITH log AS (SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS id, date_trunc('hour', ts) AS created_at, COUNT(*) AS total_records,
  '["' || STRING_AGG(DISTINCT event_type, '","' ORDER BY event_type) || '"]' AS sources FROM events GROUP BY 1, 2)"""
SQL["i05_aggregation_log"] = f"{LOG} SELECT id, created_at, total_records, sources FROM log"
SQL["i06_latest_aggregations"] = f"{LOG} SELECT id, CAST(total_records AS VARCHAR) AS total_records, sources, 'stream_auto' AS aggregation_type, strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS aggregation_time, created_at FROM log ORDER BY created_at DESC LIMIT 5"
SQL["i07_aggregation_report"] = f"{LOG} SELECT COUNT(*) AS total_aggregations, CAST(SUM(total_records) AS BIGINT) AS total_records_processed, CAST(SUM(total_records) AS DOUBLE) / COUNT(*) AS avg_records_per_aggregation, MIN(created_at) AS first_aggregation, MAX(created_at) AS last_aggregation, (SELECT COUNT(DISTINCT event_type) FROM events) AS unique_sources FROM log"
SQL["i07b_distinct_sources"] = "SELECT DISTINCT event_type AS source FROM events"
SQL["i08_hourly_activity"] = f"{LOG} SELECT created_at AS hour, COUNT(*) AS count FROM log WHERE created_at >= TIMESTAMP '2024-01-19 12:00:00' GROUP BY 1 ORDER BY 1 DESC LIMIT 6"
SQL["i09_purge_old"] = f"{LOG} SELECT id, created_at FROM log WHERE created_at >= TIMESTAMP '2024-01-10 12:00:00'"
SQL["i09c_purge_stored"] = f"""{LOG} SELECT id, to_json({{'aggregation_timestamp': strftime(created_at, '%Y-%m-%dT%H:%M:%S'), 'total_records': total_records, 'sources': CAST(sources AS JSON),
  'aggregation_type': 'stream_auto', 'environment': 'prod', 'queue': 'queue_normalized', 'initial_count': total_records, 'records_processed': total_records}})::VARCHAR AS metadata, created_at FROM log WHERE created_at >= TIMESTAMP '2024-01-10 12:00:00'"""
SQL["i09b_purge_counts"] = f"{LOG} SELECT COUNT(*) AS avant, COUNT(*) FILTER (created_at >= TIMESTAMP '2024-01-10 12:00:00') AS apres, COUNT(*) FILTER (created_at < TIMESTAMP '2024-01-10 12:00:00') AS supprimes FROM log"
SQL["i15_archive_processed_files"] = "SELECT event_type AS origine, COUNT(*) AS messages, true AS archive FROM events GROUP BY 1"
SQL["i10_queue_depths"] = """SELECT queue, n AS elements, CASE WHEN n = 0 THEN 'vide' WHEN n < 10 THEN 'faible' ELSE 'charge' END AS etat
  FROM (SELECT q.queue, COUNT(e.event_id) AS n FROM (VALUES ('click'), ('view'), ('purchase'), ('absent')) q(queue) LEFT JOIN events e ON e.event_type = q.queue GROUP BY 1)"""
SQL["i11_export_latest_sample"] = f"{LOG} SELECT id AS aggregation_id, CAST(total_records AS VARCHAR) AS data_count, '2025-11-15T00:00:00' AS export_timestamp FROM log ORDER BY created_at DESC LIMIT 1"
for _name in ("i12_stream_dedup", "i12b_stream_dedup_3_batches", "i12c_stream_dedup_30_batches"):
    SQL[_name] = """WITH RECURSIVE k AS (SELECT user_id, MIN(ts) AS ts FROM events GROUP BY 1 UNION ALL
  SELECT k.user_id, MIN(e.ts) AS ts FROM k JOIN events e ON e.user_id = k.user_id AND e.ts >= k.ts + INTERVAL 1 DAY GROUP BY k.user_id)
  SELECT user_id, ts FROM k"""
SQL["i13b_windowed_counts_batch"] = """WITH w AS (SELECT event_type, value, date_trunc('hour', ts) + INTERVAL 30 MINUTE * CAST(minute(ts) >= 30 AS INTEGER) AS s FROM events),
  x AS (SELECT event_type, value, s AS debut FROM w UNION ALL SELECT event_type, value, s - INTERVAL 30 MINUTE FROM w)
  SELECT debut, debut + INTERVAL 1 HOUR AS fin, event_type, COUNT(*) AS nombre, CAST(SUM(CAST(value AS DECIMAL(28,4))) AS DOUBLE) AS total FROM x GROUP BY 1, 2, 3"""
SQL["i13_windowed_counts"] = """WITH w AS (SELECT event_type, value, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01 00:00:00') AS debut FROM events)
  SELECT debut, debut + INTERVAL 6 HOUR AS fin, event_type, COUNT(*) AS nombre, CAST(SUM(CAST(value AS DECIMAL(28,4))) AS DOUBLE) AS total FROM w
  GROUP BY 1, 2, 3"""
SQL["i13c_session_counts"] = """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS o FROM events),
  s AS (SELECT user_id, ts, SUM(o) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM g)
  SELECT user_id, MIN(ts) AS debut, MAX(ts) + INTERVAL 6 HOUR AS fin, CAST(COUNT(*) AS BIGINT) AS nombre FROM s GROUP BY user_id, n"""

# --- privacy --------------------------------------------------------------------------------
# letters and marks become one ASCII letter, so that the ASCII word boundary is the Unicode one
MASKED = "regexp_replace({0}, '[\\p{{L}}\\p{{M}}]', 'x', 'g')"
PHONE = "\\b\\d{10}\\b"
MAIL = "\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Z|a-z]{2,}\\b"
CARD = "\\b\\d{4}[-\\s\\x{00A0}\\x{202F}]?\\d{4}[-\\s\\x{00A0}\\x{202F}]?\\d{4}[-\\s\\x{00A0}\\x{202F}]?\\d{4}\\b"
SQL["g01_detect_sensitive"] = f"""SELECT doc_id, nb_telephone + nb_email + nb_carte > 0 AS sensible, nb_telephone, nb_email, nb_carte FROM (SELECT doc_id,
  CAST(len(regexp_extract_all({MASKED.format('text')}, '{PHONE}')) AS INTEGER) AS nb_telephone, CAST(len(regexp_extract_all(text, '{MAIL}')) AS INTEGER) AS nb_email,
  CAST(len(regexp_extract_all({MASKED.format('text')}, '{CARD}')) AS INTEGER) AS nb_carte FROM documents)"""


def audit(column: str, table: str) -> str:
    masked = MASKED.format(column)
    return " UNION ALL ".join(
        f"SELECT '{column}' AS colonne, '{n}' AS motif, COUNT(*) FILTER (regexp_matches({t}, '{p}')) AS nombre FROM {table}"
        for n, t, p in [("telephone", masked, PHONE), ("email", column, MAIL), ("carte", masked, CARD)])


SQL["g06_audit_sensitive_data"] = audit("text", "conversations") + " UNION ALL " + audit("role", "conversations")
CUTOFF = "TIMESTAMP '1997-06-15 00:00:00'"
KEPT = f"kept AS (SELECT id_annonce FROM annonces WHERE date_extraction >= {CUTOFF} OR date_extraction IS NULL)"


def retention(names: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS nom_table, COUNT(*) AS avant, COUNT(*) FILTER (id_annonce IN (SELECT id_annonce FROM kept)) AS apres, COUNT(*) FILTER (id_annonce NOT IN (SELECT id_annonce FROM kept)) AS supprimes FROM {t}"
        for t in names)


SQL["g04_apply_retention"] = f"WITH {ANNONCES}, {KEPT} " + retention(("annonces", "caracteristiques", "images", "conseiller", "dpe", "copropriete"))
SQL["g04c_retention_stored"] = SQL["g04_apply_retention"]
SQL["g04b_retained_rows"] = f"SELECT nom_table, apres AS nombre, 'ok' AS statut FROM ({SQL['g04_apply_retention']})"
SQL["g07_compliance_report"] = (
    f"WITH {ANNONCES}, {KEPT}, r AS ({retention(('annonces', 'caracteristiques', 'images', 'conseiller', 'dpe', 'copropriete'))}), "
    + "u AS (" + " UNION ALL ".join(f"SELECT '{t}.' || colonne AS colonne, motif, nombre FROM ({audit(c, t)})" for t, c in (("conversations", "text"), ("documents", "text"), ("pages", "html")))
    + ") SELECT 'retention' AS volet, nom_table AS objet, 'supprimes' AS mesure, supprimes AS nombre FROM r UNION ALL SELECT 'audit', colonne, motif, nombre FROM u")
base("g05_annonces_anonymisees", f"SELECT id_annonce, reference, titre, {dbl('prix')} AS prix, {dbl('surface')} AS surface, substr(localisation, 1, 3) || '***' AS localisation_secure, type_bien FROM annonces WHERE date_extraction >= {CUTOFF}")
ASKED = "asked AS (SELECT c_name AS nom_complet, CASE WHEN c_custkey % 40 = 0 THEN 'suppression' ELSE 'acces' END AS type_demande FROM customer WHERE c_custkey % 20 = 0)"
SQL["g08_access_subject"] = f"WITH {ANNONCES}, {ASKED} SELECT * FROM conseiller WHERE nom_complet IN (SELECT nom_complet FROM asked)"
SQL["g08b_erase_subject"] = f"WITH {ANNONCES}, {ASKED} SELECT * FROM conseiller WHERE nom_complet NOT IN (SELECT nom_complet FROM asked)"
SQL["g08c_rectify_subject"] = f"WITH {ANNONCES}, {ASKED} SELECT id_annonce, nom_complet, CASE WHEN nom_complet IN (SELECT nom_complet FROM asked) THEN 'corrigé' ELSE telephone END AS telephone, lien, photo, note FROM conseiller"
SQL["g08d_rights_counts"] = f"WITH {ANNONCES}, {ASKED} SELECT type_demande, COUNT(DISTINCT q.nom_complet) AS demandes, COUNT(c.id_annonce) AS lignes FROM asked q LEFT JOIN conseiller c USING (nom_complet) GROUP BY 1"
SQL["g09_access_audit"] = "SELECT CAST(user_id AS VARCHAR) AS user_name, 'annonces' AS table_name, event_type AS action_type, CAST(ts AS DATE) AS jour, COUNT(*) AS acces FROM events GROUP BY 1, 2, 3, 4"
base("g10_mask_contact", "SELECT id_annonce, nom_complet, photo, note FROM conseiller")
base("g11_drop_direct_identifiers", "SELECT id_annonce, 'Anonyme' AS nom_complet, lien, note FROM conseiller")
base("g12_retention_by_layer", f"""SELECT 'brut' AS nom_table, COUNT(*) AS nombre, 'ok' AS statut FROM annonces WHERE date_extraction >= {CUTOFF} OR date_extraction IS NULL
  UNION ALL SELECT 'agrege', COUNT(*), 'ok' FROM (SELECT DISTINCT date_trunc('month', date_extraction) AS mois FROM annonces) WHERE mois >= TIMESTAMP '1996-06-15 00:00:00' OR mois IS NULL""")
PEOPLE = """people AS (SELECT CASE WHEN c_custkey % 35 = 0 THEN ' ' ELSE c_name END AS nom, c_name AS nom_complet,
  CASE WHEN c_custkey % 15 = 0 THEN 'sans arobase' ELSE 'client' || c_custkey || '@site.example' END AS email,
  CASE c_custkey % 4 WHEN 0 THEN 'suppression' WHEN 1 THEN 'acces' WHEN 2 THEN 'rectification' ELSE 'autre' END AS type_demande FROM customer WHERE c_custkey % 5 = 0),
valid AS (SELECT * FROM people WHERE trim(nom) <> '' AND contains(email, '@') AND type_demande <> 'autre')"""
SQL["g08e_valid_requests"] = f"WITH {PEOPLE} SELECT * FROM valid"
SQL["g08f_erase_stored"] = f"""WITH {ANNONCES}, {PEOPLE}, marked AS (SELECT nom_complet, nom_complet IN (SELECT nom_complet FROM valid WHERE type_demande = 'suppression') AS gone FROM conseiller)
  SELECT couche, COUNT(*) FILTER (NOT gone) AS lignes, COUNT(DISTINCT nom_complet) FILTER (NOT gone) AS personnes, COUNT(*) FILTER (gone) AS supprimes
  FROM (SELECT 'brut' AS couche, * FROM marked UNION ALL SELECT 'argent', * FROM marked UNION ALL SELECT DISTINCT 'or', * FROM marked) GROUP BY 1"""
SQL["g08g_rectify_stored"] = f"""WITH {ANNONCES}, {PEOPLE} SELECT id_annonce, nom_complet, CASE WHEN nom_complet IN (SELECT nom_complet FROM valid WHERE type_demande = 'rectification')
  THEN 'corrigé' ELSE telephone END AS telephone, lien, photo, note FROM conseiller"""
