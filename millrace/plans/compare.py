"""Comparisons of strategies, codecs, layouts and evolution as metric rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.values import overhead_percent, percent, ratio, throughput
from millrace.operators.dedup import add_hashes, eager_dedup, latest_by_message, strategy_outputs
from millrace.operators.relational import with_literal
from millrace.operators.sizes import dataset_files, dataset_size
from millrace.operators.table import live_files, read_table, upsert, write_table
from millrace.operators.writes import CODECS, write_parquet, write_partitioned


def timed(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def read_all(df: DataFrame) -> None:
    """Compute every row and column of ``df`` and store nothing."""
    df.write.format("noop").mode("overwrite").save()


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def strategy_counts(df: DataFrame) -> DataFrame:
    """Rows each strategy keeps, as a share of the input and against the others; nothing is stored."""
    counts = [
        rows.agg(F.count(F.lit(1)).alias("records")).withColumn("strategy", F.lit(name))
        for name, rows in strategy_outputs(df).items()
    ]
    return with_shares(_stack(counts))


def with_shares(counts: DataFrame) -> DataFrame:
    """Shares over ``(strategy, records)``, where bronze holds the whole input.

    The dedup strategies agree if all but bronze kept the same number of rows.
    """
    bronze = F.col("strategy") == "bronze_append"
    eager = F.col("strategy") == "eager_dedup"
    records = F.col("records")
    # A window over a handful of strategy rows, so that nothing is computed twice.
    whole = Window.partitionBy(F.lit(0))
    inputs = F.max(F.when(bronze, records)).over(whole)
    eagers = F.max(F.when(eager, records)).over(whole)
    fewest = F.min(F.when(~bronze, records)).over(whole)
    most = F.max(F.when(~bronze, records)).over(whole)
    return counts.select(
        "strategy",
        "records",
        percent(records, inputs).alias("percent_of_input"),
        (records - eagers).alias("preserved_duplicates"),
        ratio(records, eagers).alias("times_eager"),
        (fewest == most).alias("dedups_agree"),
    )


def compare_strategies(df: DataFrame, folder: str, payload: Sequence[str] | None = None) -> DataFrame:
    """Run and store every strategy: rows, seconds, input rows per second, bytes, overhead over eager.

    ``df`` should be stored data; each strategy reads it once.
    """
    spark = df.sparkSession
    input_rows = df.count()
    runs: dict[str, Callable[[str], int]] = {
        "eager_dedup": lambda path: write_table(eager_dedup(df), path, "overwrite"),
        "bronze_append": lambda path: write_table(
            add_hashes(df, payload), path, "append", partition_by=["partition_date"]
        ),
        "merge_last_write": lambda path: write_table(latest_by_message(df), path, "overwrite"),
        "merge_table": lambda path: upsert(df, path, with_hash=True),
    }
    rows = []
    for name, run in runs.items():
        path = f"{folder}/{name}"
        seconds = timed(lambda: run(path))
        rows.append(
            dataset_size(live_files(spark, path)).select(
                F.lit(name).alias("strategy"),
                F.lit(read_table(spark, path).count()).alias("records"),
                F.lit(input_rows).alias("input_records"),
                F.lit(seconds).alias("seconds"),
                "files",
                "bytes",
            )
        )
    # One row per strategy: the sizes are listed once and then only looked at.
    measured = spark.createDataFrame(_stack(rows).collect())
    eager = F.struct("seconds", "bytes")
    base = measured.filter("strategy = 'eager_dedup'").select(eager.alias("eager")).scalar()
    return measured.withColumn("_eager", base).select(
        *measured.columns,
        throughput(F.col("input_records"), F.col("seconds")).alias("input_rows_per_second"),
        overhead_percent(F.col("bytes"), F.col("_eager.bytes")).alias("bytes_over_eager_percent"),
        overhead_percent(F.col("seconds"), F.col("_eager.seconds")).alias("seconds_over_eager_percent"),
    )


def compare_codecs(df: DataFrame, folder: str, codecs: Sequence[str] = CODECS) -> DataFrame:
    """Per codec: files, bytes, share of the first codec's bytes, seconds to write and to read."""
    spark = df.sparkSession
    rows = []
    for codec in codecs:
        path = f"{folder}/{codec}"
        written = timed(lambda: write_parquet(df, path, codec))
        read = timed(lambda: read_all(spark.read.schema(df.schema).parquet(path)))
        rows.append(
            dataset_size(dataset_files(spark, path)).select(
                F.lit(codec).alias("codec"),
                "files",
                "bytes",
                F.lit(written).alias("write_seconds"),
                F.lit(read).alias("read_seconds"),
            )
        )
    sizes = spark.createDataFrame(_stack(rows).collect())
    base = sizes.filter(F.col("codec") == codecs[0]).select("bytes").scalar()
    return sizes.withColumn("bytes_ratio", ratio(F.col("bytes"), base))


def compare_layouts(df: DataFrame, folder: str, by: str, value: str) -> DataFrame:
    """Flat against partitioned storage: files, bytes, and a read of one value of ``by``."""
    spark = df.sparkSession
    flat, parts = f"{folder}/flat", f"{folder}/partitioned"
    write_parquet(df, flat)
    write_partitioned(df, parts, by)
    rows = []
    for layout, path in (("flat", flat), ("partitioned", parts)):
        one = spark.read.schema(df.schema).parquet(path).filter(F.col(by) == value)
        seconds = timed(lambda: read_all(one))
        rows.append(
            dataset_size(dataset_files(spark, path)).select(
                F.lit(layout).alias("layout"),
                "files",
                "bytes",
                F.lit(one.count()).alias("rows_read"),
                F.lit(seconds).alias("read_seconds"),
            )
        )
    return _stack(rows)


def compare_evolution(
    df: DataFrame, added: DataFrame, column: str, default, folder: str
) -> DataFrame:
    """Add a column by rewriting all rows, or by appending rows that have it to a versioned table."""
    spark = df.sparkSession
    plain, table = f"{folder}/plain", f"{folder}/table"
    write_parquet(df, f"{plain}/v1")
    write_table(df, table, "overwrite")
    before = {
        "rewrite": dataset_files(spark, f"{plain}/v1"),
        "append": live_files(spark, table),
    }
    before = {name: dataset_size(files).first()["bytes"] for name, files in before.items()}
    seconds = {
        "rewrite": timed(lambda: write_parquet(with_literal(df, column, default), f"{plain}/v2")),
        "append": timed(
            lambda: write_table(with_literal(added, column, default), table, merge_schema=True)
        ),
    }
    stored = {
        "rewrite": (dataset_files(spark, plain), spark.read.parquet(f"{plain}/v2")),
        "append": (live_files(spark, table), read_table(spark, table)),
    }
    return _stack(
        [
            rows.agg(
                F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col(column).isNull()).alias("rows_without_column"),
            ).select(
                F.lit(name).alias("approach"),
                "rows",
                "rows_without_column",
                F.lit(before[name]).alias("bytes_before"),
                F.lit(dataset_size(files).first()["bytes"]).alias("bytes_after"),
                F.lit(seconds[name]).alias("seconds"),
            )
            for name, (files, rows) in stored.items()
        ]
    )


def compare_table_overhead(df: DataFrame, folder: str) -> DataFrame:
    """Plain Parquet against a versioned table with one codec: seconds and bytes, ledger included."""
    spark: SparkSession = df.sparkSession
    plain, table = f"{folder}/plain", f"{folder}/table"
    writes = {
        "parquet": timed(lambda: write_parquet(df, plain, "snappy")),
        "table": timed(lambda: write_table(df, table, "overwrite")),
    }
    reads = {
        "parquet": timed(lambda: read_all(spark.read.schema(df.schema).parquet(plain))),
        "table": timed(lambda: read_all(read_table(spark, table))),
    }
    rows = []
    for name, path in (("parquet", plain), ("table", table)):
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        ).select("path", "length")
        rows.append(
            dataset_size(files).select(
                F.lit(name).alias("format"),
                "files",
                "bytes",
                F.lit(writes[name]).alias("write_seconds"),
                F.lit(reads[name]).alias("read_seconds"),
            )
        )
    sizes = spark.createDataFrame(_stack(rows).collect())
    base = sizes.filter("format = 'parquet'").select("bytes").scalar()
    return sizes.withColumn("overhead_percent", overhead_percent(F.col("bytes"), base))
