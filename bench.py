"""Times the registered queries, and the heavier ones again on a larger corpus.

BENCH_SF_DIR      tables to read (default /root/testdata/sf0.1)
BENCH_CPUS        local cores (default 8)
BENCH_REPLICAS    size of the larger corpus, in copies with ids of their own (default 100)

Each query is run once to warm up, then three times; the median counts. Results
are computed whole and dropped by Spark's no-op sink. Prints one JSON line.
"""

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from turnmill.plans import training_rows
from turnmill.plans.queries import QUERIES
from turnmill.sources import write_training_text

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPLICAS = int(os.environ.get("BENCH_REPLICAS", "100"))
RUNS = 3

LARGE = (
    "assemble_messages",
    "benchmark_rollup",
    "count_tokens",
    "plan_batches",
    "render_chatml",
    "render_with_fallback",
    "reply_rules",
    "training_rows",
    "truncate_tokens",
    "verdict_summary",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("turnmill-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(run) -> float:
    run()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def write_larger_corpus(spark: SparkSession, path: str) -> None:
    for table, key in (("conversations", "conv_id"), ("documents", "doc_id")):
        copies = REPLICAS if table == "conversations" else max(1, REPLICAS // 10)
        rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
        (
            rows.repartition(int(CPUS) * 4)
            .withColumn("replica", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
            .withColumn(key, F.col(key) + F.col("replica").cast("bigint") * 10_000_000)
            .drop("replica")
            .write.parquet(f"{path}/{table}.parquet")
        )


def main() -> None:
    only = set(sys.argv[1:])
    spark = session()
    queries = {}

    def measure(name, run):
        if not only or name in only:
            queries[name] = seconds(run)
            print(f"{name} {queries[name]}", file=sys.stderr)

    def drained(query, path):
        return lambda: query(spark, path).write.format("noop").mode("overwrite").save()

    for name, query in QUERIES.items():
        measure(name, drained(query, SF_DIR))

    with tempfile.TemporaryDirectory(prefix="turnmill-bench-") as larger:
        if REPLICAS > 1:
            write_larger_corpus(spark, larger)
            for name in LARGE:
                measure(f"{name}_x{REPLICAS}", drained(QUERIES[name], larger))

            def write_files():
                turns = spark.read.parquet(f"{larger}/conversations.parquet")
                out = tempfile.mkdtemp(dir=larger)
                write_training_text(training_rows(turns), f"{out}/rows", int(CPUS))

            measure(f"write_training_text_x{REPLICAS}", write_files)

    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
                "replicas": REPLICAS,
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
