"""Analysis of a message feed: missing, duplicate, late and out-of-order messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.keys import epoch_date
from millrace.functions.values import percent, ratio
from millrace.operators.bounds import broadcast_if_small
from millrace.operators.relational import set_difference, top_rows_per_key

BUCKET_ROWS = 1_000_000
#: Consecutive sequence ids that one task checks for gaps.
BUCKET_IDS = 1_000_000
#: Size parameter of latency sketches, and the share of ranks that a quantile may be off.
SKETCH_SIZE = 400
RANK_ERROR = 0.02


def missing_sequences(produced: DataFrame, received: DataFrame) -> DataFrame:
    """Sequence ids that were produced but never received."""
    return set_difference(produced, received, "sequence_id")


def missing_ranges(
    received: DataFrame,
    by: Sequence[str] = (),
    first: int | None = None,
    last: int | None = None,
    bucket_ids: int = BUCKET_IDS,
) -> DataFrame:
    """Runs of sequence ids that never came: ``first_missing, last_missing, missing`` (per ``by``), one row however long.

    Gaps are looked for between the smallest and the largest id received, and from ``first`` and up to ``last``
    where these are given (ids outside them then don't count). The produced ids need not be known.

    Ids are cut into buckets of ``bucket_ids`` consecutive ones. Each bucket lists the gaps inside it and
    leaves one island, its smallest and largest id; islands are stitched together in buckets a thousand times as
    wide, and so on. Buckets of the last level are so wide that the ids of 64 bits fill a few million,
    so no task ever sorts all ids, and a partition that has all of them is spread like any other. Ids
    that came often are thinned before the shuffle. Null ids are unknown and fill no gap.
    """
    by = list(by)
    known = received.select(*by, F.col("sequence_id").alias("_low")).where("_low IS NOT NULL")
    if first is not None:
        known = known.where(F.col("_low") >= first)
    if last is not None:
        known = known.where(F.col("_low") <= last)
    known = known.distinct()
    if edges := [e for e in (first - 1 if first is not None else None, last + 1 if last is not None else None) if e is not None]:
        # One row per partition and edge, without ids where nothing came.
        sides = known.select(*by).distinct() if by else known.sparkSession.range(1).select()
        ends = sides.select(*by, F.explode(F.array(*[F.lit(e).cast("long") for e in edges])).alias("_low"))
        known = known.unionByName(ends)
    islands = known.withColumn("_high", F.col("_low"))
    gaps = None
    for width in (bucket_ids, bucket_ids * 1000, bucket_ids * 1000**2, None):
        keys = [*by]
        if width is not None:
            islands = islands.withColumn("_bucket", F.floor(F.col("_low") / F.lit(width)))
            keys.append("_bucket")
        window = Window.partitionBy(*keys).orderBy("_low")
        placed = islands.withColumn("_before", F.lag("_high").over(window))
        own = placed.where(F.col("_low") - F.col("_before") > 1).select(
            *by, (F.col("_before") + 1).alias("first_missing"), (F.col("_low") - 1).alias("last_missing")
        )
        gaps = own if gaps is None else gaps.unionByName(own)
        if width is not None:
            islands = islands.groupBy(*keys).agg(F.min("_low").alias("_low"), F.max("_high").alias("_high")).drop("_bucket")
    return gaps.withColumn("missing", F.col("last_missing") - F.col("first_missing") + 1)


def feed_totals(produced: DataFrame, received: DataFrame) -> DataFrame:
    """Produced, received and missing counts in one row.

    One grouping by sequence id over both sides instead of a join: each side is combined before
    the shuffle.
    """
    sides = produced.select("sequence_id", F.lit(1).alias("_p"), F.lit(0).alias("_r")).unionByName(
        received.select("sequence_id", F.lit(0).alias("_p"), F.lit(1).alias("_r"))
    )
    per_id = sides.groupBy("sequence_id").agg(F.sum("_p").alias("_p"), F.sum("_r").alias("_r"))
    return per_id.agg(
        F.coalesce(F.sum("_p"), F.lit(0)).alias("total_produced"),
        F.coalesce(F.sum("_r"), F.lit(0)).alias("total_received"),
        F.count_if((F.col("_p") > 0) & (F.col("_r") == 0)).alias("missing"),
    )


def duplicate_sequences(received: DataFrame) -> DataFrame:
    """Sequence ids received more than once, with their number of deliveries."""
    counts = received.groupBy("sequence_id").agg(F.count(F.lit(1)).alias("deliveries"))
    return counts.filter("deliveries > 1")


def order_summary(received: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per partition: ``received, steps_back``, and the ids that came first and last (``first_id, last_id, last_index``).

    A feed has few partitions, so the order is not checked in one window per partition. Arrivals are
    cut into buckets of ``bucket_rows`` consecutive indexes; steps back are counted inside each
    bucket, and then between the last row of a bucket and the first of the next non-empty one. A
    sequence is unsorted exactly if some neighbour is smaller, so this loses nothing.
    """
    rows = received.select(
        "partition_id",
        "sequence_id",
        "arrival_index",
        (F.col("arrival_index") - F.pmod("arrival_index", F.lit(bucket_rows))).alias("_bucket"),
    )
    inside = Window.partitionBy("partition_id", "_bucket").orderBy("arrival_index")
    steps = rows.withColumn("_before", F.lag("sequence_id").over(inside))
    buckets = steps.groupBy("partition_id", "_bucket").agg(
        F.count(F.lit(1)).alias("_received"),
        F.count_if(F.col("_before") > F.col("sequence_id")).alias("_back"),
        F.min_by("sequence_id", "arrival_index").alias("_first"),
        F.max_by("sequence_id", "arrival_index").alias("_last"),
        F.max("arrival_index").alias("_index"),
    )
    across = Window.partitionBy("partition_id").orderBy("_bucket")
    joined = buckets.withColumn("_last_before", F.lag("_last").over(across))
    return joined.groupBy("partition_id").agg(
        F.sum("_received").alias("received"),
        (F.sum("_back") + F.count_if(F.col("_last_before") > F.col("_first"))).alias("steps_back"),
        F.min_by("_first", "_bucket").alias("first_id"),
        F.max_by("_last", "_bucket").alias("last_id"),
        F.max("_index").alias("last_index"),
    )


def out_of_order(received: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per partition: messages received, steps back in arrival order, and whether there is any."""
    found = order_summary(received, bucket_rows)
    return found.select("partition_id", "received", "steps_back", (F.col("steps_back") > 0).alias("out_of_order"))


def first_arrivals(received: DataFrame, n: int = 15) -> DataFrame:
    """The first ``n`` sequence ids of each partition in arrival order, and whether more follow."""
    head = top_rows_per_key(
        received.select("partition_id", "arrival_index", "sequence_id"),
        ["partition_id"],
        [F.col("arrival_index").asc_nulls_last()],
        n + 1,
    )
    listed = F.sort_array(F.collect_list(F.struct("position", "sequence_id")))
    return head.groupBy("partition_id").agg(
        F.transform(F.slice(listed, 1, n), lambda row: row["sequence_id"]).alias("first_sequence_ids"),
        (F.max("position") > n).alias("more"),
    )


def feed_quality(received: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per partition: duplicate rate, delivery latency and share of steps back in arrival order.

    A message is told by its ``message_id``; messages without one are one unknown message.
    """
    latency = F.col("arrival_ts") - F.col("created_at")
    per_key = received.groupBy("partition_id", "message_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(latency).alias("_latency"),
        F.count(latency).alias("_timed"),
        F.max(latency).alias("_slowest"),
    )
    per_partition = per_key.groupBy("partition_id").agg(
        F.sum("_n").alias("_received"),
        F.count(F.lit(1)).alias("unique_messages"),
        ratio(F.sum("_latency"), F.sum("_timed")).alias("mean_latency_s"),
        F.max("_slowest").alias("max_latency_s"),
    )
    order = out_of_order(received, bucket_rows).withColumnRenamed("partition_id", "_partition")
    matched = per_partition["partition_id"].eqNullSafe(order["_partition"])
    return per_partition.join(order, matched).select(
        "partition_id",
        "received",
        "unique_messages",
        percent(F.col("received") - F.col("unique_messages"), F.col("received")).alias("duplicate_percent"),
        "mean_latency_s",
        "max_latency_s",
        percent(F.col("steps_back"), F.col("received")).alias("out_of_order_percent"),
    )


def latency_sketches(received: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """Per partition and date of ``created_at``: a quantile sketch of the delivery latency, its count and its ends.

    Sketches have a bounded size and can be merged: store them, and no percentile of any dates or partitions reads
    a message again. Messages without both times have no latency.
    """
    rows = received.select(
        "partition_id",
        epoch_date(F.col("created_at")).alias("partition_date"),
        (F.col("arrival_ts") - F.col("created_at")).alias("_latency"),
    )
    return rows.where("_latency IS NOT NULL").groupBy("partition_id", "partition_date").agg(
        F.kll_sketch_agg_double("_latency", size).alias("sketch"),
        F.count(F.lit(1)).alias("messages"),
        F.min("_latency").alias("min_latency_s"),
        F.max("_latency").alias("max_latency_s"),
    )


def latency_quantiles(
    sketches: DataFrame, by: Sequence[str] = ("partition_id",), quantiles: Sequence[float] = (0.5, 0.95, 0.99)
) -> DataFrame:
    """Merged sketches: ``quantile, latency_s`` per ``by``, with the messages and the least and greatest latency.

    At least 99 of 100 latencies lie within :data:`RANK_ERROR` of the wanted rank (for sketches of the default size).
    """
    merged = sketches.groupBy(*by).agg(
        F.kll_merge_agg_double("sketch").alias("_sketch"),
        F.sum("messages").alias("messages"),
        F.min("min_latency_s").alias("min_latency_s"),
        F.max("max_latency_s").alias("max_latency_s"),
    )
    at = [F.struct(F.lit(q).alias("quantile"), F.kll_sketch_get_quantile_double("_sketch", F.lit(q)).alias("latency_s")) for q in quantiles]
    return merged.select(*by, "messages", "min_latency_s", "max_latency_s", F.inline(F.array(*at)))


def quantile_ranks(received: DataFrame, quantiles: DataFrame, by: Sequence[str] = ("partition_id",)) -> DataFrame:
    """``quantiles`` with ``rank_error``: how far each latency's rank among all messages is from the wanted one.

    For checks of a sketch: it reads every message, joined to the few quantiles of its group. The rank of a latency
    that many messages share is a range; the error is the distance to it.
    """
    by = list(by)
    rows = received.withColumn("partition_date", epoch_date(F.col("created_at")))
    rows = rows.select(*by, (F.col("arrival_ts") - F.col("created_at")).alias("_latency")).where("_latency IS NOT NULL")
    wanted = quantiles.select(*[F.col(c).alias(f"_{c}") for c in by], "quantile", "latency_s")
    matched = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] or [F.lit(True)]
    # A row per group and quantile, no more than were asked for.
    held = rows.join(broadcast_if_small(wanted), matched).groupBy(*by, "quantile").agg(
        (F.count_if(F.col("_latency") < F.col("latency_s")) / F.count(F.lit(1))).alias("_low"),
        (F.count_if(F.col("_latency") <= F.col("latency_s")) / F.count(F.lit(1))).alias("_high"),
    )
    error = F.greatest(F.col("_low") - F.col("quantile"), F.col("quantile") - F.col("_high"), F.lit(0.0))
    held = held.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("quantile").alias("_q"), error.alias("rank_error"))
    return quantiles.join(held, [*matched, F.col("quantile") == F.col("_q")]).drop("_q", *[f"_{c}" for c in by])


def dates_after(bronze: DataFrame, date, unknown: bool = True) -> DataFrame:
    """Bronze rows of dates not yet processed; prunes the partition directories.

    Rows of unknown date belong to no processed date; ``unknown=False`` leaves them out, and
    ``on_date(bronze, None)`` has them alone.
    """
    later = F.col("partition_date") > F.lit(date)
    return bronze.filter(later | F.col("partition_date").isNull() if unknown else later)


def on_date(bronze: DataFrame, date) -> DataFrame:
    """Bronze rows of one date; of unknown date for ``None``."""
    known = F.col("partition_date")
    return bronze.filter(known.isNull() if date is None else known == F.lit(date))
