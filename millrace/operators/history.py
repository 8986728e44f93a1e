"""Stored partial results of a bronze table: payload history per key, and metrics kept date by date."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.dedup import WRITE_ORDER
from millrace.operators.table import drop_partitions, read_table, replace_partitions, snapshot, write_table

#: Seconds of ``created_at`` that one task looks through per key.
BUCKET_SECONDS = 86_400.0


def payload_history(
    bronze: DataFrame,
    key: Sequence[str] = ("composite_hash",),
    payload: str = "payload_hash",
    order: Sequence[str] = WRITE_ORDER,
    bucket_seconds: float = BUCKET_SECONDS,
) -> DataFrame:
    """Validity of each payload of a key: ``valid_from, valid_to`` and the deliveries that confirmed it.

    In write order (the first column of ``order`` is in seconds) equal payloads that follow each other are one row. It holds
    from its first delivery to that of the next payload; ``valid_to`` is null for the one that still holds. A payload that
    comes back after another one is a new row. A redelivery of what already holds confirms it; of deliveries at one and
    the same place the smaller payload counts as earlier. Deliveries of unknown time come first, with a null ``valid_from``.

    A key's deliveries are cut into time buckets and reduced to runs there, so that a hot key is spread over tasks;
    runs are then joined across buckets. What that second step holds of a key is a row per change and bucket.
    """
    key, order = list(key), list(order)
    at = F.col(order[0])
    rows = bronze.select(*key, payload, *order, F.floor(at / F.lit(bucket_seconds)).alias("_bucket"))
    place = [F.col(c).asc_nulls_first() for c in (*order, payload)]
    inside = Window.partitionBy(*key, "_bucket").orderBy(*place)
    changed = ~F.lag(payload).over(inside).eqNullSafe(F.col(payload)) | (F.row_number().over(inside) == 1)
    runs = rows.withColumn("_changed", changed.cast("long")).withColumn("_run", F.sum("_changed").over(inside))
    runs = runs.groupBy(*key, "_bucket", "_run").agg(
        F.first(payload).alias(payload), F.min(at).alias("_from"), F.count(F.lit(1)).alias("_deliveries")
    )
    whole = Window.partitionBy(*key).orderBy(F.col("_bucket").asc_nulls_first(), "_run")
    changed = ~F.lag(payload).over(whole).eqNullSafe(F.col(payload)) | (F.row_number().over(whole) == 1)
    joined = runs.withColumn("_changed", changed.cast("long")).withColumn("_state", F.sum("_changed").over(whole))
    # A state has the time of its first delivery; unknown times come first.
    begin = F.when(F.count("_from") == F.count(F.lit(1)), F.min("_from"))
    states = joined.groupBy(*key, "_state").agg(
        F.first(payload).alias(payload), begin.alias("valid_from"), F.sum("_deliveries").alias("deliveries")
    )
    following = Window.partitionBy(*key).orderBy("_state")
    return states.withColumn("valid_to", F.lead("valid_from").over(following)).select(*key, payload, "valid_from", "valid_to", "deliveries")


def refresh_metrics(bronze: DataFrame, path: str, dates: Sequence[datetime.date | None]) -> int:
    """Bring the stored partial counts of these dates up to date; returns the version of the table at ``path``.

    Only the named dates of ``bronze`` are read (``None`` is the unknown date): its partition directories are pruned. A
    date's partial is its number of deliveries per key and payload; it replaces the date's earlier one, and a date that
    has no rows any more loses it. Read the metrics with :func:`stored_metrics`.
    """
    spark = bronze.sparkSession
    day = F.col("partition_date")
    known = day.isin([d for d in dates if d is not None])
    wanted = (known | day.isNull()) if None in dates else known
    rows = bronze.where(wanted)
    partial = rows.groupBy("partition_date", "composite_hash", "payload_hash").agg(F.count(F.lit(1)).alias("deliveries"))
    found = snapshot(spark, path)
    if found is None:
        return write_table(partial, path, partition_by=["partition_date"])
    version = replace_partitions(partial, path)
    # At most as many as the named dates; reads no column but the directories'.
    present = {row[0] for row in rows.select("partition_date").distinct().collect()}
    gone = [d for d in dates if d not in present]
    return drop_partitions(spark, path, gone) if gone else version


def stored_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The numbers of ``operators.dedup.bronze_metrics`` from the stored partials; reads no bronze row.

    Keys are counted as sets, so one that came on several dates counts once. Grouped by key and payload, then by
    key, each time combined before the shuffle; hashes travel as 32 bytes.
    """
    partial = read_table(spark, path)
    per_key = (
        partial.groupBy(F.unhex("composite_hash").alias("_key"), F.unhex("payload_hash").alias("_payload"))
        .agg(F.sum("deliveries").alias("_n"))
        .groupBy("_key")
        .agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_payloads"))
    )
    total = F.coalesce(F.sum("_n"), F.lit(0))
    return per_key.agg(
        total.alias("total_records"),
        F.count(F.lit(1)).alias("unique_composite_keys"),
        F.coalesce(F.sum("_payloads"), F.lit(0)).alias("unique_payloads"),
        (total - F.count(F.lit(1))).alias("potential_duplicates"),
    )
