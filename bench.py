"""Time the headline queries; print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_WARMUP_DIR (default /root/testdata/sf0.001; empty to
skip). Each query is planned and run to completion into Spark's ``noop``
sink (every row computed, nothing collected); a query's time includes its
planning and its own writes; ``build`` is the part of it until the frame
is there (frames a query stores on the way, tables it loads), the rest is
the run of the frame. Before timing, the same
queries run once, untimed, on the small warm-up tables, so JVM code
compilation and Python worker start-up are not charged to whichever query
happens to come first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kickledger.plans import catalog  # noqa: E402
from kickledger.session import build_session  # noqa: E402

HEADLINE = [
    "league_valuation_evolution",
    "club_valuation_evolution",
    "first_league_total",
    "first_league_max",
    "player_top100",
    "csv_ingest",
    "load_valuations",
    "month_partition_write",
    "backfill_rollup",
    "extract_link",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    for name in HEADLINE if warm_dir else []:
        catalog.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times, build = {}, {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        frame = catalog.QUERIES[name](spark, sf_dir)
        t1 = time.perf_counter()
        frame.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        build[name] = round(t1 - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "build": build, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))


if __name__ == "__main__":
    main()
