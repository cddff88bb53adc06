WITH vendu AS (
  SELECT id_boite, SUM(CAST(quantite AS DECIMAL(18,2))) AS quantite FROM lignes_commande GROUP BY id_boite
)
SELECT b.id_boite, m.nom_matiere, c.nom_couleur, CAST(v.quantite AS DOUBLE) AS quantite_vendue
FROM vendu v JOIN boites b ON v.id_boite = b.id_boite
JOIN matieres m ON b.id_matiere = m.id_matiere JOIN couleurs c ON b.id_couleur = c.id_couleur
ORDER BY quantite_vendue DESC, b.id_boite LIMIT 5
