"""Time the headline queries and print one JSON line.

Each query runs twice: once to let the JVM load and compile its code, once for the clock.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the number of local cores. Results
are computed in full and thrown away by Spark's ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riftspan import checks  # noqa: E402
from riftspan.session import local_session  # noqa: E402

HEADLINE = [
    "interesting_reads",
    "mate_rescue_semi",
    "scan_two_pass",
    "blocked_anti",
    "dedup_first",
    "qname_islands",
    "pe_sr_explode",
    "interval_overlap_join",
    "evidence_support",
    "sv_clusters",
    "cluster_consensus",
    "sv_numbering",
    "fragment_windows",
    "coverage_windows",
    "gc_content",
    "contig_medians",
    "norm_depth",
    "snv_flank_counts",
    "baf_list",
    "stats_summary",
    "winsorize",
    "multi_join",
]


def main() -> None:
    """Run the benchmark."""
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "riftspan-bench", shuffle_partitions=int(cpus))
    spark.range(1_000_000).selectExpr("sum(id)").collect()
    timings = {}
    for name in names:
        for _ in range(2):
            begin = time.perf_counter()
            checks.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(timings.values()), 3), "unit": "sec", "warmup_runs": 1, "queries": timings, "sf": scale}))


if __name__ == "__main__":
    main()
