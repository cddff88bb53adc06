WITH par_commande AS (
  SELECT b.id_couleur, l.id_commande,
         SUM(CAST(prix_unitaire AS DECIMAL(12,2))
             * (CAST(1 AS DECIMAL(1,0)) - CAST(taux_remise AS DECIMAL(4,3)))
             * CAST(quantite AS DECIMAL(8,2))) AS montant
  FROM lignes_commande l JOIN boites b ON l.id_boite = b.id_boite
  GROUP BY b.id_couleur, l.id_commande
)
SELECT d.nom_couleur, COUNT(*) AS nombre_commandes, CAST(SUM(p.montant) AS DOUBLE) AS chiffre_affaires
FROM par_commande p LEFT SEMI JOIN commandes co ON p.id_commande = co.id_commande
JOIN couleurs d ON p.id_couleur = d.id_couleur
GROUP BY d.nom_couleur
ORDER BY chiffre_affaires DESC, d.nom_couleur
