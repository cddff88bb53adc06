"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (cores), BENCH_QUERIES (comma-separated names
or prefixes, all headline queries by default).  Each query is run twice into a no-op sink; the
better run counts.  The stored layers (raw listings, pages, silver, gold) are written once, each
timed on its own, and read by the queries behind them.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))

HEADLINE = [
    "v01_stats_type_bien", "v03_stats_communes_cheres", "v04_stats_distribution_surfaces",
    "v07_stats_caracteristiques_populaires", "v12_stats_conseillers", "v16_synthese_generale",
    "v18_annonces_complete_comptes", "v22_annonces_caracteristiques", "v23_annonces_preparees",
    "v27_aggregats_complets", "v33_caracteristiques_par_type", "c01_commandes_par_client",
    "c02_chiffre_affaires_par_client", "c03_chiffre_affaires_par_mois",
    "c04_meilleures_boites_quantite", "c06_chiffre_affaires_par_matiere", "q01_prepare_listings",
    "q10_search_filter", "q12_text_search", "n01_shred_features", "n09_shred_recommendations",
    "p24_clean_loader_row", "m08_market_stats", "m12_aggregate_listings", "m13_market_trends",
    "m25b_percentile_rank_exact", "s07_load_counts", "t16_extract_listing_fields",
    "t18_word_count", "i04_aggregate_stream", "i12_stream_dedup", "i13c_session_counts",
    "g01_detect_sensitive", "g04_apply_retention",
]


def main() -> None:
    from contract.registry import QUERIES, source
    from parcela.session import build_session

    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def timed(run) -> float:
        start = time.perf_counter()
        run()
        return time.perf_counter() - start

    def run(name: str) -> None:
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    chosen = HEADLINE
    if os.environ.get("BENCH_QUERIES"):
        prefixes = tuple(os.environ["BENCH_QUERIES"].split(","))
        chosen = [n for n in QUERIES if n.startswith(prefixes)]

    run("c01_commandes_par_client")  # warm-up
    tables = source(spark, SF_DIR)
    layers = {"raw": "raw", "pages": "html", "silver": "silver", "gold": "gold_listings"}
    seconds = {f"store_{n}": timed(lambda a=a: getattr(tables, a)) for n, a in layers.items()}
    for name in chosen:
        seconds[name] = min(timed(lambda n=name: run(n)) for _ in range(2))
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": {n: round(s, 3) for n, s in seconds.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")), "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
