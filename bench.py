"""Times the headline queries and prints one JSON line.

Every query builds all of its inputs itself: plans shared between queries of a session
are dropped before each timing.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marginalia.plans import registry, shared  # noqa: E402
from marginalia.session import local_session  # noqa: E402

HEADLINE = [
    "canonical_routes", "nav_tree", "locale_winner", "event_replay", "link_resolution", "rag_chunks", "chunk_stats",
    "section_coalesce", "clean_corpus", "heading_path", "body_fallback", "metadata_scan", "manifest_docs",
    "frontmatter_rows", "unique_slug", "fallback_positions", "asset_pool", "change_detection",
    "incremental_candidates", "state_upsert", "tick_counts", "table_assemble", "block_rollup",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    todo = registry.queries()
    # Unmeasured passes over the smallest data start the JVM and compile the code paths.
    warm = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    for name in ("canonical_routes", "rag_chunks", "incremental_candidates"):
        todo[name](spark, warm if os.path.isdir(warm) else folder).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        shared.forget()
        start = time.perf_counter()
        todo[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
