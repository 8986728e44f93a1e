from __future__ import annotations

import datetime
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import feed as ops
from millrace.plans.explain import plan_text
from millrace.sources.derived import message_feed

RECEIVED = "partition_id long, sequence_id long, arrival_index long"


def brute_force(data):
    report = {}
    for partition in {p for p, _, _ in data}:
        ids = [s for p, s, _ in sorted(data, key=lambda r: r[2]) if p == partition]
        back = sum(a > b for a, b in zip(ids, ids[1:]))
        report[partition] = (len(ids), back, ids != sorted(ids))
    return report


@pytest.mark.parametrize("bucket", [1, 7, 100, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_out_of_order_equals_brute_force(spark, bucket, seed):
    chance = random.Random(seed)
    indexes = chance.sample(range(1, 2000), 400)
    data = [(chance.randrange(4), i + chance.choice([0, 0, 0, -30]), i) for i in indexes]
    data += [(9, s, 5000 + s) for s in range(50)]  # in order
    found = ops.out_of_order(spark.createDataFrame(data, RECEIVED), bucket)
    assert {r[0]: tuple(r[1:]) for r in rows(found)} == brute_force(data)


def test_equal_neighbours_are_in_order(spark):
    df = spark.createDataFrame([(0, 1, 1), (0, 1, 2), (0, 2, 3)], RECEIVED)
    assert rows(ops.out_of_order(df)) == [(0, 3, 0, False)]


def test_known_inversions(spark, sf_dir):
    # 332, 312 and 349 steps back were counted independently at this scale.
    events = spark.read.parquet(f"{os.path.dirname(sf_dir.rstrip('/'))}/sf0.01/events.parquet")
    found = rows(ops.out_of_order(message_feed(events), 500), "partition_id", "steps_back")
    assert found == [(0, 332), (1, 312), (2, 349)]


def test_buckets_spread_few_partitions(feed):
    plan = plan_text(ops.out_of_order(feed), "simple")
    assert "hashpartitioning(partition_id" in plan and "_bucket" in plan.split("Exchange")[-1]


def test_missing_and_totals(spark):
    produced = spark.range(1, 11).select(F.col("id").alias("sequence_id"))
    received = spark.createDataFrame([(1,), (2,), (2,), (4,)] + [(i,) for i in range(5, 10)], "sequence_id long")
    assert rows(ops.missing_sequences(produced, received)) == [(10,), (3,)]
    assert tuple(ops.feed_totals(produced, received).first()) == (10, 9, 2)
    assert rows(ops.duplicate_sequences(received)) == [(2, 2)]


def test_nothing_missing(spark):
    ids = spark.range(5).select(F.col("id").alias("sequence_id"))
    assert ops.missing_sequences(ids, ids).isEmpty()
    assert tuple(ops.feed_totals(ids, ids).first()) == (5, 5, 0)


def test_first_arrivals_cut_and_marked(spark):
    data = [(0, 100 - i, i) for i in range(20)] + [(1, 7, 3), (1, 5, 1)]
    found = {r["partition_id"]: r for r in ops.first_arrivals(spark.createDataFrame(data, RECEIVED)).collect()}
    assert found[0]["first_sequence_ids"] == [100 - i for i in range(15)] and found[0]["more"]
    assert found[1]["first_sequence_ids"] == [5, 7] and not found[1]["more"]


def test_quality_of_a_hot_partition(spark):
    schema = "message_id string, created_at double, arrival_ts double, " + RECEIVED
    data = [(str(i // 2), 0.0, float(i % 2), 0, i // 2, i) for i in range(100)]
    data += [("x", None, 1.0, None, 1, 200)]
    found = {r["partition_id"]: r for r in ops.feed_quality(spark.createDataFrame(data, schema)).collect()}
    hot = found[0]
    assert (hot["received"], hot["unique_messages"], hot["duplicate_percent"]) == (100, 50, 50.0)
    assert (hot["mean_latency_s"], hot["max_latency_s"], hot["out_of_order_percent"]) == (0.5, 1.0, 0.0)
    assert found[None]["mean_latency_s"] is None and found[None]["received"] == 1


def test_lossy_feed(events):
    lossy = message_feed(events, lose_every=97)
    assert lossy.select("sequence_id").distinct().count() == events.count() - 11


def test_unknown_dates_are_not_lost(spark):
    from millrace.operators.feed import dates_after, on_date

    bronze = spark.sql("SELECT id, IF(id = 3, NULL, DATE '2024-01-01' + CAST(id AS INT)) AS partition_date FROM range(5)")
    day = datetime.date(2024, 1, 2)
    assert rows(dates_after(bronze, day), "id") == [(2,), (3,), (4,)]
    assert rows(dates_after(bronze, day, unknown=False), "id") == [(2,), (4,)]
    assert rows(on_date(bronze, None), "id") == [(3,)]
    assert rows(on_date(bronze, day), "id") == [(1,)]


def test_messages_are_told_by_message_id(spark):
    from millrace.operators.feed import feed_quality

    feed = spark.createDataFrame(
        [("m", 1, 0, 0.0, 1.0, 1), ("m", 2, 0, 0.0, 1.0, 2), (None, 3, 0, None, 1.0, 3)],
        "message_id string, sequence_id long, partition_id long, created_at double, arrival_ts double, arrival_index long",
    )
    assert rows(feed_quality(feed), "received", "unique_messages") == [(3, 2)]


def test_picks_differ_beyond_31_bits(spark):
    from millrace.functions.values import pick

    far = spark.sql("SELECT id, id + 2147483647 AS other FROM range(200)")
    picks = far.select(pick(F.col("id"), 1, 10**12).alias("a"), pick(F.col("other"), 1, 10**12).alias("b")).collect()
    assert sum(r["a"] == r["b"] for r in picks) == 0
    assert max(r["a"] for r in picks) > 2**33
