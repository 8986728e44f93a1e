"""Row positions: dense numbering, first rows and slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.bounds import broadcast_if_small
from millrace.operators.relational import sort_keys
from millrace.session import scratch_path

# Up to this many rows a plain top-n is cheaper than numbering all rows; the rows are the same.
TOP_N_ROWS = 10_000


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_index") -> DataFrame:
    """``df`` with a gap-free position from 0 in the given order.

    No task ever sees all rows: the rows are range-sorted into files, each file counts its rows, and
    a row's position is the count of all earlier files plus its place in its own file. The sorted
    files are written to the shared folder, so both passes see one and the same order even if
    executors are lost in between.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "row-index")
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    df.orderBy(*sort_keys(df, *columns)).write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    placed = stored.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_place"),
    )
    per_file = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    # File names carry the task number, padded to five digits only.
    task = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("long")
    earlier = Window.orderBy(task, F.col("_file")).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_file.select(
        "_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    return (
        placed.join(broadcast_if_small(starts), "_file")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_file", "_place", "_start")
    )


def slice_rows(df: DataFrame, order: Sequence[str | Column], offset: int, length: int) -> DataFrame:
    """``length`` rows from position ``offset`` in the given order.

    Rows that tie are in the order of a hash of the row, however many rows are asked for: a short slice
    near the start is a plain top-n and any other one numbers the rows, over the same keys.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    end = offset + length
    if end <= TOP_N_ROWS:
        return df.orderBy(*sort_keys(df, *columns)).offset(offset).limit(length)
    indexed = with_row_index(df, order, "_index")
    inside = (F.col("_index") >= offset) & (F.col("_index") < end)
    return indexed.filter(inside).drop("_index")


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return slice_rows(df, order, 0, n)


def range_slice(number: Column, low: Column, high: Column, slices: int) -> Column:
    """Which of ``slices`` equal key ranges between ``low`` and ``high`` holds ``number``.

    Every row gets a slice, also where the range does not divide evenly.
    """
    return F.floor((number - low) * slices / (high - low + 1)).cast("int")
