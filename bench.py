"""Benchmark the headline queries.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8) and prints one JSON line.  All queries are
run once to warm up, then each is timed (``BENCH_REPEAT`` runs, best kept); each
run executes the whole plan into Spark's ``noop`` sink, so the time is the
distributed work and not a driver-side collect.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from solospan.operators import exclusive  # noqa: E402
from solospan.queries import QUERIES  # noqa: E402
from solospan.session import local_session  # noqa: E402
from solospan.sources import derived  # noqa: E402

HEADLINE = [
    "exclusive_ranges_ip",  # 16 sets of IPv4 ranges (auto plan)
    "exclusive_ranges_window",  # grid input, plain per-set window
    "exclusive_ranges",  # grid input, auto plan
    "exclusive_ranges_events",  # one set per user
    "exclusive_ranges_bucketed",  # one huge set, forced small buckets
    "exclusive_ranges_skewed",  # a set with a third of all rows and a hot point
    "coverage_depth",
    "merge_touching",
    "glue_ranges",
    "numbered_listing",
    "parse_ranges",
    "parse_rejects",
]


def extra_queries():
    """Plans of interest that are not registered under these names."""
    return {
        # one set, default targets: the auto plan picks the bucket layout
        # only when the set exceeds the per-task target
        "ip_one_set_auto": lambda s, sf: exclusive.exclusive_ranges(derived.ip_ranges(s, sf, sets=None)),
        "ip_one_set_buckets_64k": lambda s, sf: exclusive.exclusive_ranges(
            derived.ip_ranges(s, sf, sets=None), strategy="bucketed", target_rows=65536
        ),
    }


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="solospan-bench")
    qs = {**{k: QUERIES[k] for k in HEADLINE}, **extra_queries()}
    times = {}
    for q in qs.values():  # warm-up pass over every query (JIT, caches)
        run(q(spark, sf_dir))
    for name, q in qs.items():
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(q(spark, sf_dir))
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
