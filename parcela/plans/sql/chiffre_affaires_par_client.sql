WITH par_commande AS (
  SELECT id_commande,
         SUM(CAST(prix_unitaire AS DECIMAL(12,2))
             * (CAST(1 AS DECIMAL(1,0)) - CAST(taux_remise AS DECIMAL(4,3)))
             * CAST(quantite AS DECIMAL(8,2))) AS montant
  FROM lignes_commande GROUP BY id_commande
), par_client AS (
  SELECT co.id_client, SUM(p.montant) AS montant
  FROM commandes co JOIN par_commande p ON co.id_commande = p.id_commande GROUP BY co.id_client
)
SELECT c.id_client, c.nom_client, CAST(p.montant AS DOUBLE) AS chiffre_affaires
FROM clients c JOIN par_client p ON c.id_client = p.id_client
ORDER BY chiffre_affaires DESC, c.id_client
