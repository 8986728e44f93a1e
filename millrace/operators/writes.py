"""Plain Parquet writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import pin

# Codecs to compare.
CODECS = ("uncompressed", "snappy", "gzip")


def write_parquet(df: DataFrame, path: str, codec: str | None = None) -> str:
    """Overwrite ``path`` with the rows of ``df``; ``path`` must not be one ``df`` reads."""
    writer = df.write.mode("overwrite")
    if codec:
        writer = writer.option("compression", codec)
    writer.parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: str | Sequence[str], gather: bool = True) -> str:
    """One directory per value of ``by``, written in one job.

    ``gather`` shuffles by the partition columns first, so that each value ends in few files; AQE
    splits a value that is too large for one task. Without it every task may write a file per value.
    """
    by = [by] if isinstance(by, str) else list(by)
    if gather:
        df = df.hint("rebalance", *[F.col(c) for c in by])
    writing = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writing.partitionBy(*by).parquet(path)
    return path


def replace_dates(df: DataFrame, path: str, by: str = "partition_date") -> str:
    """Overwrite only the partitions that occur in ``df``; the others stay."""
    df.hint("rebalance", F.col(by)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(by).parquet(path)
    return path


def write_with_fallback(df: DataFrame, primary: str, fallback: str, stable: bool = False) -> dict:
    """Write to ``primary`` or, if that fails, to ``fallback``; says which one it was.

    The rows are made once, by a checkpoint, so that both attempts store the same also where rows
    change when computed twice (random values, the clock). ``stable=True`` saves that for stored rows.
    """
    rows = df if stable else pin(df)
    try:
        write_parquet(rows, primary)
        return {"location": primary, "attempt": "primary"}
    except Exception:  # any failure of the first location sends the rows to the second
        write_parquet(rows, fallback)
        return {"location": fallback, "attempt": "fallback"}
