"""Times the headline queries and prints one JSON line.

Every query is built and fully computed (into Spark's ``noop`` sink) once to warm up and then
``BENCH_RUNS`` times; the median counts. ``strategies`` gives input rows per second for the dedup
strategies, including the write of their tables, over a stored feed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from millrace import build_session, scratch_path
from millrace.session import clear_scratch
from millrace.functions.keys import epoch_seconds
from millrace.operators.table import upsert
from millrace.operators.writes import write_parquet
from millrace.plans.compare import compare_strategies, read_all
from millrace.plans.queries import QUERIES
from millrace.sources.derived import message_feed

HEADLINE = [
    "filter_mean_having",
    "modulo_group_mean",
    "row_and_distinct_counts",
    "orders_without_lines",
    "orders_sorted",
    "multi_file_mean",
    "partition_pruned_read",
    "schema_evolved_read",
    "time_travel_read",
    "compacted_mean",
    "codec_round_trip",
    "jsonl_read",
    "composite_hash",
    "bronze_enrich",
    "bronze_metrics",
    "eager_dedup",
    "latest_by_message",
    "upsert_latest_event",
    "silver_from_bronze",
    "bronze_date_replaced",
    "feed_totals",
    "duplicate_sequences",
    "out_of_order_by_partition",
    "first_arrivals",
    "feed_quality",
    "strategy_comparison",
    "stream_dedup",
    "stream_upsert",
    "upsert_older_loses",
    "strategy_storage",
    "csv_header_to_table",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    read_all(QUERIES[name](spark, sf_dir))
    return time.perf_counter() - start


def line_feed(lineitem):
    """Order lines as messages: six times as many rows as events, with repeated keys.

    Created at the start of the shipping year, so that a date holds as many rows as in a real feed.
    """
    created = epoch_seconds(F.date_trunc("year", "l_shipdate").cast("timestamp_ntz"))
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("message_id"),
        F.col("l_orderkey").alias("sequence_id"),
        F.col("l_linenumber").cast("long").alias("partition_id"),
        created.alias("created_at"),
        created.alias("arrival_ts"),
        F.col("l_partkey").alias("arrival_index"),
        "l_extendedprice",
        "l_returnflag",
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        conf={"spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    times = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        seconds(spark, name, sf_dir)
        times[name] = statistics.median(seconds(spark, name, sf_dir) for _ in range(runs))

    strategies = {}
    feeds = {
        "events": message_feed(spark.read.parquet(f"{sf_dir}/events.parquet")),
        "lineitem": line_feed(spark.read.parquet(f"{sf_dir}/lineitem.parquet")),
    }
    for source, rows in feeds.items():
        path = write_parquet(rows.repartition(int(cpus)), scratch_path(spark, "bench-feed"))
        feed = spark.read.parquet(path)
        measured = [
            {r["strategy"]: r for r in compare_strategies(feed, scratch_path(spark, "bench")).collect()}
            for _ in range(runs + 1)
        ]
        strategies[source] = {
            name: {
                "seconds": round(t := statistics.median(run[name]["seconds"] for run in measured[1:]), 3),
                "input_rows": row["input_records"],
                "input_rows_per_second": round(row["input_records"] / t),
                "rows_out": row["records"],
                "bytes": row["bytes"],
            }
            for name, row in measured[0].items()
        }
    upserts = {}
    for source, rows in feeds.items():
        # A tenth of the messages merged into a table that holds the others; filling it isn't timed.
        late = F.pmod(F.xxhash64("message_id"), F.lit(10)) == 0
        old = write_parquet(rows.filter(~late).repartition(int(cpus)), scratch_path(spark, "bench-old"))
        new = write_parquet(rows.filter(late).repartition(int(cpus)), scratch_path(spark, "bench-new"))
        taken = []
        for _ in range(runs + 1):
            path = scratch_path(spark, "bench-upsert")
            upsert(spark.read.parquet(old), path)
            start = time.perf_counter()
            upsert(spark.read.parquet(new), path)
            taken.append(time.perf_counter() - start)
        count = spark.read.parquet(new).count()
        upserts[source] = {"seconds": round(t := statistics.median(taken[1:]), 3), "batch_rows": count, "batch_rows_per_second": round(count / t)}
    clear_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of median seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(t, 3) for name, t in times.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "strategies": strategies,
                "upsert_into_filled_table": upserts,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
