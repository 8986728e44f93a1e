"""Streams of message files: reading, arrival order and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.keys import KEY_FIELDS, composite_key, epoch_date, epoch_time
from millrace.operators.dedup import ARRIVAL, WRITE_ORDER, keep_first
from millrace.operators.feed import BUCKET_ROWS, order_summary
from millrace.operators.positions import with_row_index
from millrace.operators.table import (
    BUCKETS,
    Snapshot,
    read_table,
    rows_of_keys,
    snapshot,
    upsert,
    write_table,
)
from millrace.schemas import MESSAGE
from millrace.session import pin
from millrace.streaming.marks import Marks

EVENT_TIME = "event_time"
SALT = "_salt"
SALTS = 8
#: Buckets of a state table of one row per feed partition.
STATE_BUCKETS = 4


def read_message_stream(
    spark: SparkSession, path: str, schema: T.StructType = MESSAGE, files_per_batch: int | None = None
) -> DataFrame:
    """JSON Lines files as they appear in a folder."""
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def with_arrival(df: DataFrame) -> DataFrame:
    """``arrival_ts`` (the clock) and ``arrival_order`` for rows read from files.

    Arrival order is file time, file name, and place in the file: parallel tasks share no counter.
    It sorts rows; :func:`with_arrival_index` turns it into numbers from 1 where a batch needs them.
    A stream knows only the file of a row; :func:`arrival_index_stream` tells its rows apart batch by batch.
    """
    meta = F.col("_metadata")
    order = [
        meta["file_modification_time"].alias("file_time"),
        meta["file_path"].alias("file"),
        meta["file_block_start"].alias("block"),
    ]
    if not df.isStreaming:
        # The lower 33 bits count the rows within one task; a file block lies in one task.
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        order.append(place.alias("place"))
    now = F.unix_micros(F.current_timestamp()).cast("double") / F.lit(1e6)
    return df.select("*", now.alias("arrival_ts"), F.struct(*order).alias("arrival_order"))


def with_arrival_index(df: DataFrame, order: Sequence[str] = ("arrival_order",)) -> DataFrame:
    """Gap-free ``arrival_index`` from 1 over a finished batch."""
    indexed = with_row_index(df, order, "_index")
    return indexed.withColumn("arrival_index", F.col("_index") + 1).drop("_index")


def with_event_time(stream: DataFrame) -> DataFrame:
    """Event time from ``created_at``; a watermark needs an instant, not a zone-less timestamp."""
    return stream.withColumn(EVENT_TIME, epoch_time(F.col("created_at")))


def _with_salt(stream: DataFrame, keys: Sequence[str], salts: int) -> DataFrame:
    """A salt from the rest of the row and, for a stream of files, from the row's place.

    Byte-equal redeliveries of one message lie in different files, so they are split too.
    """
    parts = [F.col(f"`{c}`") for c in stream.columns if c not in keys]
    place = ["_metadata.file_path", "_metadata.file_block_start"]
    try:
        stream.select(*place)
        parts += [F.col(c) for c in place]
    except AnalysisException:  # not a stream of files
        pass
    return stream.withColumn(SALT, F.pmod(F.xxhash64(*parts), F.lit(salts)) if parts else F.lit(0))


def drop_seen(stream: DataFrame, keys: Sequence[str] = KEY_FIELDS, salts: int = SALTS) -> DataFrame:
    """Drop each key seen before, ever. Exact; the state grows with the number of keys.

    A stream cannot thin a key before its shuffle, so a hot key would meet in one task. Rows are
    therefore deduplicated in two steps, by key and a salt from the rest of the row, then by key: at
    most ``salts`` rows of a key ever reach the second step. Raise ``salts`` with the share of the
    hottest key times the number of tasks; ``salts=1`` saves the first step where no key is hot.
    """
    keys = list(keys)
    if salts > 1:
        stream = _with_salt(stream, keys, salts).dropDuplicates([*keys, SALT]).drop(SALT)
    return stream.dropDuplicates(keys).withColumn("composite_hash", composite_key(keys))


def drop_seen_within(
    stream: DataFrame, delay: str, keys: Sequence[str] = KEY_FIELDS, salts: int = SALTS
) -> DataFrame:
    """Drop each key seen before, with state bounded by a watermark; salted like :func:`drop_seen`.

    ``delay`` must exceed the longest delivery delay: a row older than the watermark is dropped even
    if its key is new, and a key that returns with a newer event time after its state has expired
    may pass again. :func:`late_rows` counts what was dropped so.
    """
    keys = list(keys)
    timed = with_event_time(stream).withWatermark(EVENT_TIME, delay)
    if salts > 1:
        salted = _with_salt(timed, keys, salts)
        timed = salted.dropDuplicatesWithinWatermark([*keys, SALT]).drop(SALT)
    return (
        timed.dropDuplicatesWithinWatermark(keys)
        .drop(EVENT_TIME)
        .withColumn("composite_hash", composite_key(keys))
    )


def append_available(stream: DataFrame, path: str, checkpoint: str):
    """Write everything available now to Parquet and stop; returns the finished query."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def late_rows(query) -> int:
    """Rows a finished query dropped as older than its watermark."""
    return sum(
        operator.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def _each_batch(stream: DataFrame, path: str, checkpoint: str, write):
    """Run ``write(batch, writer, batch_id, found)`` once per micro-batch, also if the batch is replayed.

    ``found`` is the table's snapshot, read once per batch; the write builds on it.
    """
    writer = f"stream:{checkpoint}"

    def once(batch: DataFrame, batch_id: int) -> None:
        found = snapshot(batch.sparkSession, path)
        if found is None or found.writers.get(writer, -1) < batch_id:
            write(batch, writer, batch_id, found)

    query = (
        stream.writeStream.foreachBatch(once)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: Sequence[str] = ("message_id",),
    order: Sequence[str] = WRITE_ORDER,
    buckets: int = BUCKETS,
    with_hash: bool = False,
):
    """Last-write-wins merge of every micro-batch into a versioned table, bucket by bucket."""

    def write(batch: DataFrame, writer: str, batch_id: int, found: Snapshot | None) -> None:
        upsert(batch, path, key, order, buckets, with_hash, writer=writer, batch_id=batch_id)

    return _each_batch(stream, path, checkpoint, write)


def first_arrival_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = KEY_FIELDS,
    order: Sequence[str] = ARRIVAL,
    by_date: bool = False,
    buckets: int = BUCKETS,
    marks: Marks | None = None,
):
    """Append the first arrival of each new key to a versioned table.

    Unlike :func:`drop_seen` it defines which row survives within a micro-batch, and a key that
    floods a batch is thinned before the shuffle. What has been seen is the table itself, in hash
    buckets of the key: a batch looks only into the buckets that it touches. A batch that brings
    nothing new commits nothing.

    With ``by_date`` the table is partitioned by the date of ``created_at`` instead, and a batch looks
    only into its own dates. A redelivery carries its message's ``created_at``, so it is still found;
    a key used again on another date counts as new.

    With ``marks`` only buckets that may hold a key of the batch are opened: Bloom filters beside the table tell which keys
    it can't hold, and the exact join decides about the rest.
    """
    keys = list(keys)
    dates = ["partition_date"] if by_date else []
    if marks is not None and (by_date or list(marks.keys) != keys or marks.buckets != buckets):
        raise ValueError("marks must have the keys and buckets of the table, which is not partitioned by date")

    def write(batch: DataFrame, writer: str, batch_id: int, found: Snapshot | None) -> None:
        spark = batch.sparkSession
        if by_date:
            batch = batch.withColumn("partition_date", epoch_date(F.col("created_at")))
        fresh = keep_first(batch, keys + dates, order).withColumn("composite_hash", composite_key(keys))
        if found is not None:
            fresh = pin(fresh if marks is None else fresh.withColumn("_row", F.monotonically_increasing_id()))
            if marks is not None:
                marked = pin(marks.maybe_seen(fresh, path, found, writer))
                fresh = marked.drop("_row", "_maybe")
                table = rows_of_keys(marked.where("_maybe"), path, keys, found)
            elif by_date:
                # At most as many values as the batch has dates.
                own = [row[0] for row in fresh.select(*dates).distinct().collect()]
                known = F.col("partition_date").isin([d for d in own if d is not None])
                table = read_table(spark, path).filter(known | F.col("partition_date").isNull())
            else:
                table = rows_of_keys(fresh, path, keys, found)
            fresh = pin(unseen(fresh, table, keys + dates))
            if marks is not None:
                marks.write_report(marked, fresh, batch_id)
            if fresh.isEmpty():
                return
        if marks is not None:
            fresh = pin(fresh)
            marks.add(fresh, 0 if found is None else found.version + 1)
        write_table(
            fresh,
            path,
            partition_by=dates,
            writer=writer,
            batch_id=batch_id,
            bucket_by=() if by_date else keys,
            buckets=buckets,
            found=found,
        )

    return _each_batch(stream, path, checkpoint, write)


def arrival_index_stream(stream: DataFrame, path: str, checkpoint: str, by_time: bool = True):
    """Append every message of a stream of files to a versioned table with a gap-free ``arrival_index`` from 1.

    The counter survives micro-batches and restarts: within a batch a message's number follows from the counts
    of earlier files and its place in its own, and the batch starts where the table's last version ends. That
    mark is committed with the rows, so a batch that is replayed gets the numbers it had, or is known as done.

    The order inside a batch is that of file time, file name and place; ``by_time=False`` leaves the time out,
    for files whose names tell the order. ``arrival_ts`` is the time of the batch. Columns of these names are replaced.
    """
    own = [c for c in stream.columns if c not in ("arrival_ts", "arrival_index", "arrival_order")]
    stamped = with_arrival(stream.select(*own, "_metadata")).drop("_metadata")

    def write(batch: DataFrame, writer: str, batch_id: int, found: Snapshot | None) -> None:
        start = found.total_rows if found else 0
        order = [f"arrival_order.{field}" for field in ("file_time", "file", "block")[0 if by_time else 1 :]]
        # The lower 33 bits count the rows within one task; a file block lies in one task.
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        numbered = with_row_index(batch.withColumn("_row_place", place), [*map(F.col, order), F.col("_row_place")], "_index")
        rows = numbered.select(*own, "arrival_ts", (F.col("_index") + F.lit(start + 1)).alias("arrival_index"))
        write_table(rows, path, writer=writer, batch_id=batch_id, found=found)

    return _each_batch(stamped, path, checkpoint, write)


def order_stream(stream: DataFrame, path: str, checkpoint: str, bucket_rows: int = BUCKET_ROWS):
    """Keep, per partition of a stream, what tells its order: one state row, updated batch by batch.

    A state row has the messages received, the steps back and the id that came last; a batch adds its own counts
    (see :func:`order_summary`, which spreads a hot partition over tasks) and one more step where its first id is smaller
    than the last one before it. Batches must follow each other in ``arrival_index``, as those of
    :func:`arrival_index_stream` do. State rows are merged into a versioned table together with the batch's
    number, so a replayed batch counts once. Read it with :func:`order_state`.
    """

    def write(batch: DataFrame, writer: str, batch_id: int, found: Snapshot | None) -> None:
        fresh = order_summary(batch, bucket_rows)
        if found is not None:
            names = ["partition_id", "received", "steps_back", "last_id"]
            # One row per partition of the feed.
            state = read_table(batch.sparkSession, path).select(*[F.col(n).alias(f"_{n}") for n in names])
            joined = fresh.join(state, F.col("partition_id").eqNullSafe(F.col("_partition_id")), "left")
            step = F.coalesce((F.col("_last_id") > F.col("first_id")).cast("long"), F.lit(0))
            fresh = joined.select(
                "partition_id",
                (F.col("received") + F.coalesce("_received", F.lit(0))).alias("received"),
                (F.col("steps_back") + F.coalesce("_steps_back", F.lit(0)) + step).alias("steps_back"),
                "first_id",
                F.coalesce("last_id", "_last_id").alias("last_id"),
                "last_index",
            )
        upsert(fresh, path, ["partition_id"], ["last_index"], STATE_BUCKETS, writer=writer, batch_id=batch_id)

    return _each_batch(stream, path, checkpoint, write)


def order_state(spark: SparkSession, path: str) -> DataFrame:
    """The state of :func:`order_stream` in the form of ``operators.feed.out_of_order``."""
    state = read_table(spark, path)
    return state.select("partition_id", "received", "steps_back", (F.col("steps_back") > 0).alias("out_of_order"))


def unseen(fresh: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``fresh`` (one per key) whose key the table lacks; null keys equal null keys."""
    names = [f"_seen_{i}" for i in range(len(keys))]
    seen = table.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    return fresh.join(seen, [fresh[k].eqNullSafe(seen[n]) for k, n in zip(keys, names)], "left_anti")
