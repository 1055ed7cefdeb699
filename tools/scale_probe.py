"""Throughput of the rollups as the input grows: k copies of the given lineitem.

Usage: python tools/scale_probe.py [sf_dir] [k ...]

The copies are identical (same keys, k times the rows per group); every
copy is its own scan task, so the run also shows how the plans spread over
cores.
"""

from __future__ import annotations

import functools
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kickledger.operators import reports, rollups  # noqa: E402
from kickledger.session import build_session  # noqa: E402
from kickledger.sources import testdata as td  # noqa: E402


def copies(spark, sf: str, k: int):
    return functools.reduce(lambda a, b: a.unionByName(b), [td.valuations(spark, sf) for _ in range(k)])


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.1"
    ks = [int(a) for a in args[1:]] or [1, 2, 4, 8]
    spark = build_session("local[8]", 8)
    clubs, players = td.clubs(spark, sf), td.players(spark, sf)
    jobs = {
        "league_rollup": lambda v: rollups.league_valuation_evolution(v, clubs, td.START, td.END),
        "club_rollup": lambda v: rollups.club_valuation_evolution(v, clubs, td.START, td.END),
        "player_top100": lambda v: reports.player_top100(v, players, clubs),
    }
    for name, job in jobs.items():  # warm-up
        job(copies(spark, sf, 1)).write.format("noop").mode("overwrite").save()
    print("| query | copies | rows | seconds | rows per second |")
    print("| --- | --- | --- | --- | --- |")
    for k in ks:
        v = copies(spark, sf, k)
        rows = 600_000 * k if sf.endswith("0.1") else None
        for name, job in jobs.items():
            t0 = time.perf_counter()
            job(v).write.format("noop").mode("overwrite").save()
            sec = time.perf_counter() - t0
            rate = f"{rows / sec:,.0f}" if rows else "-"
            print(f"| {name} | {k} | {rows or '-':,} | {sec:.2f} | {rate} |" if rows else
                  f"| {name} | {k} | - | {sec:.2f} | - |")


if __name__ == "__main__":
    main()
