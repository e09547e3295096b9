"""Time the headline queries; prints one JSON line.

Every query is run to the end (all rows and columns) with a sink that drops
them. A first run at the smallest scale warms the JVM up and is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

from askgraph.plans.queries import QUERIES
from askgraph.session import get_session

HEADLINE = [
    "ingest_posts",
    "question_user_weights",
    "user_question_bags",
    "question_weight_maps",
    "user_links",
    "user_links_from_maps",
    "circle_networks",
    "feed_top5",
    "feed",
    "feed_json",
    "answer_participation",
    "candidates",
    "recommendations",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        "askgraph-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=max(8, int(cpus) * 2),
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "20g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(folder), "sf0.001")
    if os.path.isdir(warm):
        for name in names:
            run(spark, name, warm)
    times = {}
    for name in names:
        times[name] = round(run(spark, name, folder), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
