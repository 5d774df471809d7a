"""Time every registered query and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS
(default 8) the local threads, BENCH_RUNS (default 3) the timed runs of each
query after a warm-up. A result is computed in full and written nowhere.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rowscribe.plans.catalog import QUERIES  # noqa: E402
from rowscribe.sources.sinks import dry_run  # noqa: E402

#: Input rows that the published rates refer to, by table of the headline query.
HEADLINE = {
    "f4_chat": "conversations",
    "f2_alpaca": "conversations",
    "f3_movie": "part",
    "t2_encode": "conversations",
    "t2_encode_documents": "documents",
    "o2_batches": "documents",
    "l1_log_lines": "events",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(query) -> float:
        start = time.perf_counter()
        dry_run(query(spark, sf_dir))
        return time.perf_counter() - start

    seconds = {}
    for name, query in QUERIES.items():
        once(query)
        seconds[name] = round(statistics.median(once(query) for _ in range(runs)), 4)

    rates = {
        name: round(spark.read.parquet(f"{sf_dir}/{table}.parquet").count() / seconds[name])
        for name, table in HEADLINE.items()
    }
    print(
        json.dumps(
            {
                "metric": "total time of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "input_rows_per_sec": rates,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
