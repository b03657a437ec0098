"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line. Each query is forced with a ``noop`` write (every row is
computed, nothing is collected to the driver); one warm-up query first, then
the median of $BENCH_REPEAT runs per query (default 1)."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["catalog_upsert", "history_merge", "hot_themes", "similar_users", "similar_users_events",
            "neighbor_list", "user_profile", "similar_tags", "tag_recall", "profile_expand",
            "profile_lists", "serving_merge", "als_ratings"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    names = sys.argv[1:] or HEADLINE

    from feedrec.plans.queries import QUERIES
    from feedrec.session import build_session, drop_run_tables

    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="feedrec-bench-"))

    def run(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    run("hot_themes")  # warm-up: JVM, codegen caches, file listing
    out = {}
    for n in names:
        out[n] = round(statistics.median(run(n) for _ in range(repeat)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "headline_total", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf}))
    drop_run_tables(spark)
    spark.stop()


if __name__ == "__main__":
    main()
