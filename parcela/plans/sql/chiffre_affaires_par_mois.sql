WITH par_commande AS (
  SELECT id_commande,
         SUM(CAST(prix_unitaire AS DECIMAL(12,2))
             * (CAST(1 AS DECIMAL(1,0)) - CAST(taux_remise AS DECIMAL(4,3)))
             * CAST(quantite AS DECIMAL(8,2))) AS montant
  FROM lignes_commande GROUP BY id_commande
)
SELECT date_format(co.date_commande, 'yyyy-MM') AS mois,
       CAST(SUM(p.montant) AS DOUBLE) AS chiffre_affaires
FROM commandes co JOIN par_commande p ON co.id_commande = p.id_commande
GROUP BY date_format(co.date_commande, 'yyyy-MM')
ORDER BY mois
