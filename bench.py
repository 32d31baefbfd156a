"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   input folder (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_QUERIES  comma-separated subset, or ``all``
"""

from __future__ import annotations

import json
import os
import sys
import time

from check import session
from corpusflow.queries import QUERIES

HEADLINE = ["bm25_topk", "knn_topk", "dense_text_topk", "hybrid_search", "ann_recall", "mmr_rerank",
            "multi_query_union", "parent_retrieve", "recursive_chunk", "semantic_chunk", "smart_chunk",
            "header_chunk", "embed_documents", "embedding_cache_misses", "compress_context",
            "semantic_cache_replay", "telemetry_rows", "telemetry_summary", "cost_by_tier"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    # Untimed: starts the JVM code paths and the Python workers.
    for name in ("knn_topk", "hybrid_search"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
