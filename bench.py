"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from larder.plans import catalog
from larder.session import local_session

HEADLINE = [
    "Q2_list_recipes",
    "Q4_corpus_statistics",
    "A2_top_ingredients_per_cuisine",
    "A3_ingredient_frequency",
    "A5_ingredients_with_titles",
    "A6_difficulty_profile",
    "T2_multi_field",
    "T5_fuzzy",
    "T14_ingredient_list",
    "T15_boolean_filter",
    "V5_semantic_top_k",
    "V8_hybrid",
    "D1_build_documents",
    "E1_E4_E7_E11_ingredients",
    "L15_L18_load_status",
    "L20_bridge_rows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "larder-bench", os.environ.get("BENCH_MEMORY", "16g"))
    queries, times = catalog.queries(), {}
    names = sys.argv[1:] or HEADLINE
    queries["A4_top_20_ingredients"](spark, sf_dir).collect()  # start the JVM's and Spark's lazy parts
    for name in names:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    result = {
        "metric": "headline query time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").split("sf")[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
