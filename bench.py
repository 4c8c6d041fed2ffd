"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Every query is fully materialised through the ``noop`` sink (all rows and
columns computed, nothing collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "A1_stacked_value_counts", "A4_scaled_counts", "A5_histogram_equal_width",
    "A6_describe_exact", "A7_corr_matrix", "J2_asof_fridays", "W9_centered_ma",
    "T7_detect_language", "T14_tfidf_smooth_sentences", "T15_tfidf_log2_documents",
    "S7_frequency_summary", "S8_textrank_summary", "S14_luhn_summary",
    "G4_core_numbers", "G6_local_clustering", "G12_pagerank_weighted_bipartite",
    "C1_pairwise_euclidean", "C5_silhouette_euclidean", "M6_knn_classify",
    "Z2_seasonal_decompose", "Z4_acf",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tessera.session import get_spark
    from tessera.plans import catalog
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2, app="tessera-bench",
                      extra={"spark.driver.memory": "16g"})
    qs = catalog.queries()
    names = [n for n in HEADLINE if n in qs]
    if len(sys.argv) > 1:
        names = [n for n in qs if any(n.startswith(p) for p in sys.argv[1:])]
    times = {}
    for name in names:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
