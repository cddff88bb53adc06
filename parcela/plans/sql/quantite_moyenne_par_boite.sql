WITH vendu AS (
  SELECT id_boite, CAST(SUM(CAST(quantite AS DECIMAL(18,2))) AS DOUBLE) / COUNT(quantite) AS moyenne
  FROM lignes_commande GROUP BY id_boite HAVING COUNT(quantite) > 0
)
SELECT b.id_boite, m.nom_matiere, c.nom_couleur, v.moyenne AS moyenne_quantite
FROM vendu v JOIN boites b ON v.id_boite = b.id_boite
JOIN matieres m ON b.id_matiere = m.id_matiere JOIN couleurs c ON b.id_couleur = c.id_couleur
ORDER BY moyenne_quantite DESC, b.id_boite
