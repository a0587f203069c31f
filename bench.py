"""Benchmark the headline queries.

Runs each headline query of the registry at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed to completion through the ``noop`` sink (every row is
produced, nothing is collected to the driver); the best of ``$BENCH_REPEAT``
runs (default 2) is recorded, after one untimed warm-up query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "join_harmonic_nearest_tempo",
    "nearest_tempo_per_request",
    "recommend_batch",
    "top3_per_request",
    "tempo_key_histogram",
    "cluster_stats",
    "profile_columns",
    "find_release_year",
    "artist_tags",
    "resolve_seed_list",
    "extremes_by_attribute",
    "assemble_catalog",
    "assign_nearest_centroid",
    "cosine_topn",
    "timbre_mean_std",
    "classification_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = os.environ.get("BENCH_ONLY")
    from cadenza.session import build_session
    from cadenza.plans.registry import load_all

    spark = build_session(f"local[{cpus}]", "cadenza-bench", {"spark.sql.shuffle.partitions": str(max(8, cpus * 2))})
    entries = load_all()
    names = [n for n in HEADLINE if n in entries and (not only or re.search(only, n))]
    # untimed warm-up: JVM start, first codegen and file listing are not query cost
    entries["tempo_key_histogram"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            entries[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
           "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
