SELECT m.nom_matiere, COUNT(*) AS nb_boites
FROM boites b JOIN matieres m ON b.id_matiere = m.id_matiere
GROUP BY m.nom_matiere
ORDER BY nb_boites DESC, m.nom_matiere
