"""File counts and sizes of stored datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dataset_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Path and length of every Parquet file below the paths; the contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(list(paths))
        .select("path", "length")
    )


def dataset_size(files: DataFrame) -> DataFrame:
    """Number of files and their bytes, in one row."""
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )

