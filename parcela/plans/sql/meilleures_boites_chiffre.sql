WITH vendu AS (
  SELECT id_boite,
         SUM(CAST(prix_unitaire AS DECIMAL(12,2))
             * (CAST(1 AS DECIMAL(1,0)) - CAST(taux_remise AS DECIMAL(4,3)))
             * CAST(quantite AS DECIMAL(8,2))) AS montant
  FROM lignes_commande GROUP BY id_boite
)
SELECT b.id_boite, m.nom_matiere, c.nom_couleur, CAST(v.montant AS DOUBLE) AS chiffre_affaires
FROM vendu v JOIN boites b ON v.id_boite = b.id_boite
JOIN matieres m ON b.id_matiere = m.id_matiere JOIN couleurs c ON b.id_couleur = c.id_couleur
ORDER BY chiffre_affaires DESC, b.id_boite LIMIT 5
