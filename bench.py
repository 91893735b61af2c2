"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores,
BENCH_QUERIES a comma-separated choice ("all" for every registered query). A few queries run
untimed on the smallest tables first, so that the timings show Spark and not the JVM's start.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loomtext.plans import all_queries  # noqa: E402
from loomtext.session import local_session  # noqa: E402

HEADLINE = [
    "tokenize_and_clean",
    "ngrams",
    "fit_idf",
    "tfidf_docs",
    "cosine_scores",
    "search_topk",
    "search_with_fallback",
    "ngram_space_metrics",
    "bm25_topk",
    "rrf_fuse",
    "dedupe_in_group",
    "seeded_shuffle",
    "parse_llm_json",
    "explode_llm_items",
    "embed_text",
    "vector_topk",
    "self_retrieval",
    "ivf_topk",
    "pca_project",
    "stratified_split",
    "fit_intent",
    "classification_report",
    "chunk_text",
    "chunk_text_windows",
    "chunk_size_sweep",
    "retrieve_chunks",
    "rag_answers",
    "citation_audit",
    "insert_chunks",
    "stream_triage",
]


WARM_UP = ["search_topk", "rag_answers", "ngram_space_metrics", "self_retrieval", "fit_intent"]


def run(query, spark, sf_dir: str) -> None:
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    queries = all_queries()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    spark = local_session(cpus, "bench")
    smallest = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(smallest):
        for name in WARM_UP:
            run(queries[name], spark, smallest)

    times: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        run(queries[name], spark, sf_dir)
        times[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
