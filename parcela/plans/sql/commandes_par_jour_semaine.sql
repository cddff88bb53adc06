SELECT date_format(date_commande, 'EEEE') AS jour_semaine, COUNT(id_commande) AS nombre_commandes
FROM commandes
GROUP BY date_format(date_commande, 'EEEE')
ORDER BY nombre_commandes DESC, jour_semaine
