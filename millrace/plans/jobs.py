"""Small jobs: CSV to table, checked write, incremental batches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.operators.quality import check_column_names, outcome
from millrace.operators.table import write_table
from millrace.operators.writes import write_with_fallback
from millrace.sources.files import read_csv


def csv_to_table(
    spark: SparkSession,
    csv_path: str,
    table_path: str,
    schema: T.StructType | None = None,
    header: bool = True,
) -> int:
    """Overwrite a table with the rows of a CSV; returns the new version."""
    return write_table(read_csv(spark, csv_path, schema, header), table_path, mode="overwrite")


def checked_write(df: DataFrame, expected: Iterable[str], primary: str, fallback: str) -> dict:
    """Check the column names, write with a fallback; a record of how it went, never an exception."""

    def job() -> dict:
        return write_with_fallback(check_column_names(df, expected), primary, fallback)

    return outcome(job)


def append_batches(frames: Iterable[DataFrame], path: str) -> int | None:
    """One commit per frame, the first overwriting; returns the last version."""
    version = None
    for i, frame in enumerate(frames):
        version = write_table(frame, path, mode="append" if i else "overwrite")
    return version
