"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the local threads; names on the
command line replace the headline queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from skyroute.plans import catalog
from skyroute.session import local_session

HEADLINE = (
    "graph_size", "graph_edges", "list_edges", "edges_longer_than", "max_degrees",
    "top_incoming", "top_outgoing", "top_pagerank", "pagerank_hops", "sssp_costs",
    "cheapest_paths", "landmark_costs", "class_balance", "string_index",
    "assemble_features", "metrics_report", "roc_curve", "nb_scores", "dt_scores",
    "svc_scores", "rf_scores", "gbt_scores", "cv_grid",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, spark__ui__showConsoleProgress="false")
    catalog.QUERIES["flights_count"](spark, sf_dir).collect()  # warm up
    seconds = {}
    for name in names:
        began = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
