"""Inputs that Spark derives: the sales table, draws with replacement, a message feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.keys import epoch_seconds
from millrace.functions.values import pick, pick_from

# Fixed values of the sales table.
REGIONS = ("US-EAST", "US-WEST", "EU", "APAC")
SEGMENTS = ("BASIC", "PREMIUM", "ENTERPRISE")
FIRST_DAY = "2024-01-01 00:00:00"
SPAN_SECONDS = 31_536_000
SEED = 42


def sales_columns(df: DataFrame, row_id: str, rows: Column, seed: int = SEED) -> DataFrame:
    """The sales table over the ids of ``df``: evenly spaced times, picked categories, cycling value.

    ``rows`` is the table's size, which sets the spacing. Categories depend on id and seed only.
    """
    number = F.col(row_id).cast("long")
    spacing = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(SPAN_SECONDS) / rows))
    start = F.lit(FIRST_DAY).cast("timestamp_ntz")
    return df.select(
        number.alias("id"),
        (start + F.make_dt_interval(secs=(number * spacing).cast("decimal(18,6)"))).alias("timestamp"),
        pick_from(number, seed, REGIONS).alias("region"),
        pick_from(number, seed + 1, SEGMENTS).alias("user_segment"),
        ((number * 2) % 10_000).alias("value"),
    )


def sales(spark: SparkSession, rows: int, seed: int = SEED) -> DataFrame:
    return sales_columns(spark.range(rows), "id", F.lit(rows).cast("long"), seed)


def draws(df: DataFrame, draw_id: str, population: Column | int, seed: int = SEED) -> DataFrame:
    """One number in ``[0, population)`` per row of ``df``, drawn with replacement."""
    return df.select(F.col(draw_id).alias("draw"), pick(F.col(draw_id), seed, population).alias("drawn"))


def draws_from_range(spark: SparkSession, population: int, k: int, seed: int = SEED) -> DataFrame:
    return draws(spark.range(k), "id", population, seed)


def message_feed(
    events: DataFrame, redeliver_every: int = 10, late_by: int = 25, lose_every: int | None = None
) -> DataFrame:
    """A message feed over an event table: every event, some delivered twice, some lost.

    Each ``redeliver_every``-th event arrives again ``late_by`` positions (and 30 minutes) later,
    and each ``lose_every``-th one never. One pass: an event yields as many rows as deliveries.
    """
    number = F.col("event_id")
    copies = F.when(number % redeliver_every == 0, 2).otherwise(1)
    if lose_every:
        copies = F.when(number % lose_every == 0, 0).otherwise(copies)
    deliveries = events.select(
        "*", F.posexplode(F.array_repeat(F.lit(True), copies)).alias("_delivery", "_delivered")
    )
    again = F.col("_delivery") > 0
    created = epoch_seconds(F.col("ts"))
    return deliveries.select(
        F.lit("message_received").alias("event"),
        number.cast("string").alias("message_id"),
        number.alias("sequence_id"),
        (F.col("user_id") % 3).alias("partition_id"),
        created.alias("created_at"),
        F.when(again, created + 1800).otherwise(created).alias("arrival_ts"),
        F.when(again, (number + late_by) * 2 + 1).otherwise(number * 2).alias("arrival_index"),
        "user_id",
        "event_type",
        "value",
        "props",
    )
