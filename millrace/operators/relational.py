"""Filters, projections, aggregates, ordering and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.quality import SchemaMismatch, schema_problems


def where_above(df: DataFrame, column: str, bound) -> DataFrame:
    """Rows with ``column > bound``; nulls are dropped."""
    return df.filter(F.col(column) > F.lit(bound))


def where_equal(df: DataFrame, **values) -> DataFrame:
    """Rows equal to every given value. On a partition column this prunes directories."""
    for column, value in values.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df


def columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names)


def with_literal(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def group_mean(df: DataFrame, keys: str | Sequence[str], value: str) -> DataFrame:
    """Mean of ``value`` per key, under the name of the input column.

    Null values are skipped, a group of nulls gives null, a null key is a group of its own.
    The average is computed in two steps, before and after the shuffle, so that a key holding most
    of the rows costs one row per task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.avg(value).alias(value))


def having_above(df: DataFrame, column: str, bound) -> DataFrame:
    """A filter on an aggregate's result."""
    return where_above(df, column, bound)


def filtered_group_mean(
    df: DataFrame, filter_column: str, above, key: str, value: str, mean_above
) -> DataFrame:
    """Filter, mean per group, filter on the mean."""
    return having_above(group_mean(where_above(df, filter_column, above), key, value), value, mean_above)


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, column: str, name: str = "distinct_values") -> DataFrame:
    """Exact number of different values; null counts as one."""
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias(name))


def sort_keys(df: DataFrame, *columns: Column) -> list[Column]:
    """Sort columns, then a hash of the whole row.

    Rows that tie on every sort column go to one task of a range partitioning; the hash lets it cut
    inside a frequent value, and makes the order of ties repeatable.
    """
    return [*columns, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]


def ordered(df: DataFrame, column: str, *tie_breakers: str) -> DataFrame:
    """Ascending order, nulls first."""
    return df.orderBy(*sort_keys(df, *[F.col(c).asc_nulls_first() for c in (column, *tie_breakers)]))


def concat_rows(*frames: DataFrame) -> DataFrame:
    """All rows of frames with one schema; raises if names or types differ."""
    first = frames[0]
    for other in frames[1:]:
        problems = schema_problems(other.schema, first.schema, widen=False)
        if problems:
            raise SchemaMismatch(problems)
    return reduce(DataFrame.unionByName, frames)


def concat_evolving(*frames: DataFrame) -> DataFrame:
    """All rows of frames; a column that a frame lacks is null in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def set_difference(left: DataFrame, right: DataFrame, on: str, right_on: str | None = None) -> DataFrame:
    """Different values of ``left.on`` that ``right`` lacks; null equals null.

    One grouping over both sides instead of an anti join: a value repeated a billion times on either
    side is combined to one row per task before the shuffle. (An optimizer moves a join below
    ``distinct``, and would send all copies of a left value to one task.)
    """
    sides = left.select(F.col(on), F.lit(False).alias("_right")).union(
        right.select(F.col(right_on or on), F.lit(True).alias("_right"))
    )
    return sides.groupBy(on).agg(F.max("_right").alias("_found")).filter(~F.col("_found")).select(on)


def top_rows_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, n: int) -> DataFrame:
    """The first ``n`` rows of every key, with their ``position`` from 1.

    Spark limits each group before the shuffle as well (``WindowGroupLimit``), so a hot key sends
    at most ``n`` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("position", F.row_number().over(window)).filter(F.col("position") <= n)
