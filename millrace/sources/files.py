"""Parquet, CSV and JSON Lines readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import MESSAGE

CORRUPT = "_corrupt_record"


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet file or folder; filters and column selection reach the files."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def scan_files(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Every Parquet file below ``path`` in one scan; directory names are not columns."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("recursiveFileLookup", True).parquet(path)


def scan_partitioned(
    spark: SparkSession, path: str, schema: T.StructType | None = None, **equal
) -> DataFrame:
    """A folder with ``column=value`` directories, pruned by equality on those columns.

    Pass ``schema`` to keep text such as ``007`` from being read as a number.
    """
    rows = scan_parquet(spark, path, schema)
    for column, value in equal.items():
        rows = rows.filter(F.col(column) == F.lit(value))
    return rows


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    header: bool = True,
) -> DataFrame:
    """CSV whose lines may be too long (the rest is cut) or too short (the rest is null).

    Types are inferred in a pass of their own over all lines unless ``schema`` is given.
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def csv_quality(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Lines, ragged lines (too long, too short or of wrong type), and values present per column.

    All columns are counted, so that the scan parses all of them and sees every ragged line.
    """
    marked = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(marked)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    return rows.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(CORRUPT).alias("ragged"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"{f.name}_present") for f in schema],
    )


def read_jsonl(
    spark: SparkSession, path: str, schema: T.StructType = MESSAGE, mode: str = "FAILFAST"
) -> DataFrame:
    """JSON Lines of a declared schema; a line that is not JSON is an error."""
    return spark.read.schema(schema).option("mode", mode).json(path)


def latest_path(spark: SparkSession, pattern: str) -> str:
    """The last file or Spark output folder, by name, that matches a glob; no file is opened."""
    try:
        listed = spark.read.format("binaryFile").load(pattern)
    except AnalysisException as error:
        raise FileNotFoundError(f"nothing matches {pattern}") from error
    # A part file stands for the folder one Spark job wrote.
    whole = F.regexp_replace("path", r"/part-[^/]*$", "")
    found = listed.agg(F.max(whole).alias("path")).first()["path"]
    if found is None:
        raise FileNotFoundError(f"nothing matches {pattern}")
    return found
