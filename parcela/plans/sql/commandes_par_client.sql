SELECT c.id_client, c.nom_client, COALESCE(o.n, 0) AS nombre_commandes
FROM clients c
LEFT JOIN (SELECT id_client, COUNT(*) AS n FROM commandes GROUP BY id_client) o
  ON c.id_client = o.id_client
ORDER BY nombre_commandes DESC, c.id_client
