"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is forced to completion with the ``noop`` sink (full computation, no
collect to the driver).  The warm-up run of the cheapest query is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "inventory",          # full assessment: sections, features, metrics, scores, predictions
    "section_features",   # per-section feature rows (explode + regex counters)
    "near_dup_clusters",  # MinHash + lossless banding + leader rounds
    "near_dup_clusters_templated",  # unlike documents of one template: large buckets, many rounds
    "conversion_plan",    # plans with their file names
    "end_to_end",         # extract → transform (plans, classify, topics)
    "topic_map",          # ordered map fragments
    "report_html",        # report fragments incl. clusters
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from quire.queries import QUERIES
    from quire.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="quire-bench")
    QUERIES["route_format"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
