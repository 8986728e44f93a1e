"""Writing good rows and refused ones in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.quality import SchemaMismatch

REFUSED = "refused"
REASONS = "reasons"
ORIGINAL = "original"


@dataclass
class Split:
    """Rows of each kind of one write, and where they are."""

    path: str
    accepted: int
    refused: int


def row_problems(
    df: DataFrame, schema: T.StructType, required: Sequence[str] = (), checks: Mapping[str, Column] | None = None
) -> Column:
    """What keeps a row out, as an array of texts; empty for a good row.

    A value that its column's type can't hold, a null in a required column, and each named check that doesn't hold (false
    or null) is a reason of its own; a row has all of its reasons.
    """
    have = set(df.columns)
    missing = [f.name for f in schema if f.name not in have]
    if missing:
        raise SchemaMismatch([f"{name}: missing" for name in missing])
    found = []
    for field in schema:
        value = F.col(f"`{field.name}`")
        held = value.try_cast(field.dataType)
        found.append(F.when(value.isNotNull() & held.isNull(), F.lit(f"{field.name}: not a {field.dataType.simpleString()}")))
        if field.name in required:
            found.append(F.when(value.isNull(), F.lit(f"{field.name}: null in a required column")))
    for name, holds in (checks or {}).items():
        found.append(F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)))
    return F.filter(F.array(*found), lambda reason: reason.isNotNull())


def split_write(
    df: DataFrame, path: str, schema: T.StructType, required: Sequence[str] = (), checks: Mapping[str, Column] | None = None
) -> Split:
    """Write ``df`` once: good rows in the types of ``schema``, refused rows with all their reasons and as they came.

    One pass, no shuffle, no second reading: both kinds are partitions of one write, ``refused=false`` and
    ``refused=true``. A bad row no longer fails the job; columns that the schema lacks are kept with the refused
    rows only. Read the two with :func:`accepted_rows` and :func:`refused_rows`. Counts come from the writing
    stage, where each finished task counts once.
    """
    for name in (REFUSED, REASONS, ORIGINAL):
        if name in schema.names:
            raise SchemaMismatch([f"{name}: reserved column name"])
    problems = row_problems(df, schema, required, checks)
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    marked = df.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema], whole.alias(ORIGINAL), problems.alias(REASONS)
    )
    bad = F.size(REASONS) > 0
    rows = marked.withColumn(REFUSED, bad).withColumn(ORIGINAL, F.when(bad, F.col(ORIGINAL)))
    counted = Observation()
    rows = rows.observe(counted, F.count_if(~F.col(REFUSED)).alias("accepted"), F.count_if(F.col(REFUSED)).alias("refused"))
    rows.write.partitionBy(REFUSED).parquet(path)
    return Split(path, counted.get.get("accepted", 0), counted.get.get("refused", 0))


def _stored(spark: SparkSession, path: str, columns: T.StructType, refused: bool) -> DataFrame:
    stored = T.StructType([*columns.fields, T.StructField(REFUSED, T.BooleanType())])
    return spark.read.schema(stored).parquet(path).where(F.col(REFUSED) == refused).drop(REFUSED)


def accepted_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The good rows of a split write; opens their files only."""
    return _stored(spark, path, schema, False)


def refused_rows(spark: SparkSession, path: str) -> DataFrame:
    """``reasons`` and ``original`` (the row as JSON) of each refused row; opens their files only."""
    fields = [T.StructField(REASONS, T.ArrayType(T.StringType())), T.StructField(ORIGINAL, T.StringType())]
    return _stored(spark, path, T.StructType(fields), True)
