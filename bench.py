"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plazalens.plans.queries import QUERIES  # noqa: E402
from plazalens.session import configure  # noqa: E402

HEADLINE = (
    "mentions_abuse_summary mentions_abuse_distinct hashtags_summary insults_summary users_abuse_summary clean_text "
    "clean_model_text token_map extract_insults find_all_rescan tidy_posts dedup_posts hourly_mentions classify_posts stream_summary"
).split()
# Rows a query works on, for the throughput figures
WORKED = {"clean_text": "documents", "extract_insults": "documents", "mentions_abuse_summary": "lineitem", "tidy_posts": "orders"}
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        # the first run warms up
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    rates = {
        q: round(spark.read.parquet(f"{sf_dir}/{table}.parquet").count() / seconds[q])
        for q, table in WORKED.items()
        if q in seconds
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
