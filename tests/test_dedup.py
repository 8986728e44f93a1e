from __future__ import annotations

import hashlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.keys import (
    composite_key,
    epoch_date,
    epoch_seconds,
    epoch_time,
    payload_columns,
    payload_key,
)
from millrace.operators import dedup
from millrace.plans import compare
from millrace.plans.explain import plan_text

MESSAGES = "message_id string, sequence_id long, partition_id long, created_at double, arrival_index long, value long"


def messages(spark, *data):
    return spark.createDataFrame(list(data), MESSAGES)


def test_hash_of_joined_parts(spark):
    df = messages(spark, ("m", 1, 11, 0.0, 1, 5), ("m", 11, 1, 0.0, 2, 5))
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert rows(df, composite_key()) == sorted([(digest("m|1|11"),), (digest("m|11|1"),)])
    assert rows(df, composite_key(separator="")) == [(digest("m111"),)] * 2


def test_null_key_parts_stay_apart(spark):
    df = messages(
        spark,
        (None, 1, 1, 0.0, 1, 5),
        ("m", None, 1, 0.0, 2, 5),
        ("m", 1, None, 0.0, 3, 5),
        (None, None, None, 0.0, 4, 5),
        ("None", 1, 1, 0.0, 5, 5),
        ("", 1, 1, 0.0, 6, 5),
    )
    assert df.select(composite_key().alias("h")).distinct().count() == 6
    assert dedup.eager_dedup(df.unionByName(df)).count() == 6


def test_literal_key_merges_colliding_messages(spark):
    df = messages(spark, ("m", 1, 11, 0.0, 1, 5), ("m", 11, 1, 0.0, 2, 6))
    assert dedup.eager_dedup(df).count() == 2
    assert rows(dedup.eager_dedup(df, separator=""), "arrival_index") == [(1,)]
    assert dedup.dedup_metrics(df, separator="").first()["final_records"] == 1


def test_payload_hash_sees_business_columns_only(spark):
    df = messages(spark, ("m", 1, 1, 0.0, 1, 5), ("m", 1, 1, 0.0, 2, 5), ("m", 1, 1, 0.0, 3, 6))
    bronze = dedup.add_hashes(df)
    by_value = rows(bronze.groupBy("value").agg(F.count_distinct("payload_hash")))
    assert by_value == [(5, 1), (6, 1)]
    profile = rows(dedup.changed_payloads(bronze), "deliveries", "payloads")
    assert profile == [(3, 2)]
    assert payload_columns(["value", "arrival_ts"]) == [
        "message_id", "partition_id", "sequence_id", "value",
    ]


def test_payload_hash_ignores_column_order(spark):
    df = spark.createDataFrame([("x", 1)], "a string, b long")
    expected = hashlib.sha256(b'{"a":"x","b":1}').hexdigest()
    assert df.select(payload_key(["b", "a"])).first()[0] == expected


def test_dates_ignore_the_session_zone(spark):
    df = spark.createDataFrame([(0.0,), (86399.9,), (86400.0,), (-0.5,), (None,)], "s double")
    found = [str(r[0]) for r in df.select(epoch_date(F.col("s"))).collect()]
    assert found == ["1970-01-01", "1970-01-01", "1970-01-02", "1969-12-31", "None"]


def test_epoch_seconds_across_a_clock_change(spark):
    # 02:30 does not exist on this day in the tests' session zone.
    wall = F.lit("2024-03-10 02:30:00.250001").cast("timestamp_ntz")
    seconds = spark.range(1).select(epoch_seconds(wall).alias("s"))
    assert seconds.first()[0] == 1710037800.250001
    micros = seconds.select(F.unix_micros(epoch_time(F.col("s")))).first()[0]
    assert micros == 1710037800250001


def test_keep_first_and_last_order_rules(spark):
    df = messages(
        spark,
        ("a", 1, 0, 5.0, 2, 20),
        ("a", 1, 0, 5.0, 1, 10),
        ("a", 1, 0, None, 9, 90),
        ("b", 1, 0, None, None, 1),
        ("b", 1, 0, None, 3, 3),
        ("c", 1, 0, None, None, 7),
    )
    assert rows(dedup.keep_first(df, ["message_id"]), "message_id", "value") == [
        ("a", 10), ("b", 3), ("c", 7),
    ]
    assert rows(dedup.latest_by_message(df), "message_id", "value") == [
        ("a", 20), ("b", 3), ("c", 7),
    ]


def test_eager_dedup_is_idempotent_and_exact(feed, events):
    once = dedup.eager_dedup(feed)
    again = dedup.eager_dedup(once.drop("composite_hash"))
    columns = ["message_id", "arrival_index", "composite_hash"]
    assert rows(once, *columns) == rows(again, *columns)
    hashes = feed.select(composite_key().alias("h")).distinct().count()
    assert once.count() == hashes == events.count()


def test_dedup_gives_the_table_back_whatever_the_layout(feed, events):
    expected = rows(events, "event_id", "user_id", "value")
    for layout in (feed, feed.repartition(1), feed.repartition(13).orderBy(F.rand(5))):
        once = dedup.eager_dedup(layout)
        assert rows(once, "sequence_id", "user_id", "value") == expected


def test_hot_key_is_thinned_before_the_shuffle(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("message_id"),
        F.lit(1).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("partition_id"),
        F.col("id").cast("double").alias("created_at"),
        F.col("id").alias("arrival_index"),
    )
    for result, kept in ((dedup.eager_dedup(df), 0), (dedup.latest_by_message(df), 29_997)):
        assert plan_text(result, "simple").count("WindowGroupLimit") == 2
        assert result.count() == 20_001
        assert result.filter("message_id = 'hot'").first()["arrival_index"] == kept


def test_no_python_in_the_plans(feed):
    for df in (dedup.eager_dedup(feed), dedup.add_hashes(feed), dedup.latest_by_message(feed)):
        plan = plan_text(df)
        assert "Python" not in plan and "MapInPandas" not in plan


def test_eager_dedup_hashes_after_the_shuffle(feed):
    plan = plan_text(dedup.eager_dedup(feed), "simple")
    assert plan.index("sha2") < plan.index("Exchange") and plan.count("sha2") == 1


def test_empty_feed_metrics(feed):
    nothing = feed.filter("false")
    assert tuple(dedup.dedup_metrics(nothing).first()) == (0, 0, 0, 0.0)
    assert tuple(dedup.bronze_metrics(dedup.add_hashes(nothing)).first()) == (0, 0, 0, 0)


def test_bronze_keeps_every_row(feed):
    bronze = dedup.add_hashes(feed)
    assert bronze.count() == feed.count()
    metrics = dedup.bronze_metrics(bronze).first()
    distinct = bronze.agg(F.count_distinct("composite_hash"), F.count_distinct("payload_hash")).first()
    assert (metrics["unique_composite_keys"], metrics["unique_payloads"]) == tuple(distinct)


def test_stored_strategies_agree(spark, feed, path):
    stored = path + "-feed"
    feed.write.parquet(stored)
    found = {r["strategy"]: r for r in compare.compare_strategies(spark.read.parquet(stored), path).collect()}
    kept = {name: row["records"] for name, row in found.items()}
    assert kept == {
        "eager_dedup": 1000, "bronze_append": 1100, "merge_last_write": 1000, "merge_table": 1000,
    }
    bronze, eager = found["bronze_append"], found["eager_dedup"]
    assert bronze["bytes_over_eager_percent"] == pytest.approx((bronze["bytes"] / eager["bytes"] - 1) * 100)
    assert eager["seconds_over_eager_percent"] == 0.0
    assert eager["input_rows_per_second"] == pytest.approx(1100 / eager["seconds"])


def test_bronze_metrics_do_not_expand(spark, feed):
    from millrace.operators.dedup import add_hashes, bronze_metrics
    from millrace.plans.explain import operator_count

    metrics = bronze_metrics(add_hashes(feed))
    assert operator_count(metrics, "Expand") == 0
    assert bronze_metrics(add_hashes(feed.limit(0))).first()["total_records"] == 0
