"""Deduplication of messages and last-write-wins merging of frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.keys import (
    KEY_FIELDS,
    composite_key,
    epoch_date,
    payload_columns,
    payload_key,
)
from millrace.functions.values import percent

ARRIVAL = ("arrival_index",)
WRITE_ORDER = ("created_at", "arrival_index")


def _one_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    # Planned with WindowGroupLimit on both sides of the shuffle: a task sends one row per key.
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str] = ARRIVAL) -> DataFrame:
    """The earliest row of each key; null order values come last."""
    return _one_per_key(df, keys, [F.col(c).asc_nulls_last() for c in order])


def keep_last(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str] = WRITE_ORDER) -> DataFrame:
    """The latest row of each key; null order values lose."""
    return _one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def eager_dedup(df: DataFrame, separator: str = "|", order: Sequence[str] = ARRIVAL) -> DataFrame:
    """First arrival of each composite key, with its ``composite_hash``.

    The key columns themselves are shuffled and compared; the hash, eight times as long, is made
    for the surviving rows only. Without a separator different keys can have one hash, and then
    the hash must decide.
    """
    keys = list(KEY_FIELDS) if separator else [composite_key(separator=separator)]
    return keep_first(df, keys, order).withColumn("composite_hash", composite_key(separator=separator))


def dedup_metrics(df: DataFrame, separator: str = "|") -> DataFrame:
    """Rows in, rows out, rows dropped and their share for :func:`eager_dedup`, in one row."""
    keys = [F.col(c) for c in KEY_FIELDS] if separator else [composite_key(separator=separator)]
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    initial = F.coalesce(F.sum("_n"), F.lit(0))
    final = F.count(F.lit(1))
    return per_key.agg(
        initial.alias("initial_records"),
        final.alias("final_records"),
        (initial - final).alias("dropped_duplicates"),
        percent(initial - final, initial, default=0.0).alias("dedup_rate_percent"),
    )


def add_hashes(df: DataFrame, payload: Sequence[str] | None = None, separator: str = "|") -> DataFrame:
    """Bronze form: every row kept, with composite hash, payload hash and partition date.

    ``payload`` names the business columns the payload hash covers, all but the delivery columns by
    default; the key columns always belong to it.
    """
    covered = payload_columns(payload if payload is not None else df.columns)
    return df.withColumns(
        {
            "composite_hash": composite_key(separator=separator),
            "payload_hash": payload_key(covered),
            "partition_date": epoch_date(F.col("created_at")),
        }
    )


def key_profile(bronze: DataFrame) -> DataFrame:
    """Rows and different payloads of every composite hash in a bronze frame.

    Grouped twice, by key and payload and then by key, each time combined before the shuffle: a hot
    key spreads over its payloads first. The hashes travel as 32 bytes, not as 64 digits.
    """
    return (
        bronze.groupBy(F.unhex("composite_hash").alias("_key"), F.unhex("payload_hash").alias("_payload"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("_key")
        .agg(F.sum("_n").alias("deliveries"), F.count(F.lit(1)).alias("payloads"))
        .select(F.lower(F.hex("_key")).alias("composite_hash"), "deliveries", "payloads")
    )


def bronze_metrics(bronze: DataFrame) -> DataFrame:
    """Total rows, unique keys, unique payloads and potential duplicates of a bronze frame.

    The payload hash covers the key, so payloads per key add up to the unique ones; a key profile has
    all numbers without expanding the rows.
    """
    deliveries = F.coalesce(F.sum("deliveries"), F.lit(0))
    return key_profile(bronze).agg(
        deliveries.alias("total_records"),
        F.count(F.lit(1)).alias("unique_composite_keys"),
        F.coalesce(F.sum("payloads"), F.lit(0)).alias("unique_payloads"),
        (deliveries - F.count(F.lit(1))).alias("potential_duplicates"),
    )


def changed_payloads(bronze: DataFrame) -> DataFrame:
    """Keys delivered with more than one payload: reused ids or late corrections."""
    return key_profile(bronze).filter("payloads > 1")


def latest_by_message(
    df: DataFrame, order: Sequence[str] = WRITE_ORDER, separator: str = "|"
) -> DataFrame:
    """Last write per ``message_id``, with its ``composite_hash``."""
    return keep_last(df, ["message_id"], order).withColumn(
        "composite_hash", composite_key(separator=separator)
    )


def silver(bronze: DataFrame) -> DataFrame:
    """Deduplicated form of a bronze frame: first arrival of each composite hash."""
    return keep_first(bronze, ["composite_hash"])


def strategy_outputs(df: DataFrame) -> dict[str, DataFrame]:
    """What each strategy would store of the same input."""
    return {
        "eager_dedup": eager_dedup(df),
        "bronze_append": add_hashes(df),
        "merge_last_write": latest_by_message(df),
        "merge_table": latest_by_message(df),
    }
