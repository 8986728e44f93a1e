"""Counters and state across micro-batches, gap ranges, sketches, stored partials, packing and split writes."""

from __future__ import annotations

import datetime
import json
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_streaming import START, Feed, message

from millrace.operators import feed as ops
from millrace.operators import history, packing, split, table
from millrace.operators.dedup import add_hashes, bronze_metrics
from millrace.operators.quality import SchemaMismatch
from millrace.plans.explain import plan_text
from millrace.streaming import feed as streams

RECEIVED = "partition_id long, sequence_id long, arrival_index long"


@pytest.fixture
def source(tmp_path):
    return Feed(tmp_path / "in")


# Arrival numbers in a stream


def test_arrival_numbers_go_on_over_batches_and_restarts(spark, source, tmp_path):
    path, state = str(tmp_path / "table"), str(tmp_path / "state")
    sent = [f"m{i}" for i in range(23)]
    for part in (sent[:7], sent[7:8], sent[8:20]):
        source.add(*[message(key, i, 0) for i, key in enumerate(part)])
    streams.arrival_index_stream(source.stream(spark), path, state)  # three micro-batches
    source.add(*[message(key, 0, 0) for key in sent[20:]])
    streams.arrival_index_stream(source.stream(spark), path, state)  # after a restart
    found = {r["message_id"]: r["arrival_index"] for r in table.read_table(spark, path).collect()}
    assert found == {key: i + 1 for i, key in enumerate(sent)}
    assert table.read_table(spark, path).where("arrival_ts IS NULL").isEmpty()
    assert table.current_version(spark, path) == 3


def test_replayed_batch_keeps_its_numbers(spark, source, tmp_path):
    import shutil

    path, state = str(tmp_path / "table"), str(tmp_path / "state")
    source.add(message("a", 0, 0), message("b", 0, 0))
    streams.arrival_index_stream(source.stream(spark), path, state)
    # The stream loses what it knew of its last commit, as after a crash between the table's commit and its own.
    shutil.rmtree(f"{state}/commits")
    source.add(message("c", 0, 0))
    streams.arrival_index_stream(source.stream(spark), path, state)
    assert rows(table.read_table(spark, path), "message_id", "arrival_index") == [("a", 1), ("b", 2), ("c", 3)]


# Order in a stream


def test_order_state_equals_the_batch_check(spark, source, tmp_path):
    path, state = str(tmp_path / "table"), str(tmp_path / "state")
    chance = random.Random(4)
    sent = [(chance.choice([0, 0, 0, 1, None]), i + chance.choice([0, 0, -9]), i) for i in range(200)]
    lines = [message("m", 0, i) | {"partition_id": p, "sequence_id": s} for p, s, i in sent]
    for low, high in ((0, 60), (60, 61), (61, 130)):
        source.add(*lines[low:high])
    streams.order_stream(source.stream(spark), path, state, bucket_rows=7)
    source.add(*lines[130:])
    streams.order_stream(source.stream(spark), path, state, bucket_rows=7)
    expected = ops.out_of_order(spark.createDataFrame(sent, RECEIVED))
    assert rows(streams.order_state(spark, path)) == rows(expected)
    # One row per partition, however many messages came.
    assert table.read_table(spark, path).count() == 3


# Ranges of missing ids


def brute_ranges(data, first=None, last=None):
    found = []
    for partition in {p for p, _ in data}:
        ids = {s for p, s in data if p == partition and s is not None and (first is None or s >= first) and (last is None or s <= last)}
        ids |= {e for e in (first - 1 if first is not None else None, last + 1 if last is not None else None) if e is not None} if ids else set()
        ordered = sorted(ids)
        found += [(partition, a + 1, b - 1, b - a - 1) for a, b in zip(ordered, ordered[1:]) if b - a > 1]
    return sorted(found, key=str)


@pytest.mark.parametrize("bucket", [1, 10, 1000])
@pytest.mark.parametrize("edges", [(None, None), (0, 600), (5, None)])
def test_ranges_equal_brute_force(spark, bucket, edges):
    chance = random.Random(bucket)
    data = [(chance.randrange(3), chance.randrange(-20, 500)) for _ in range(250)]
    data += [(7, 3_000_000_000), (7, 5), (7, None), (8, 100), (8, 101), (8, 101)]
    df = spark.createDataFrame(data, "partition_id long, sequence_id long")
    found = ops.missing_ranges(df, ["partition_id"], *edges, bucket_ids=bucket)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_ranges(data, *edges)


def test_a_gap_of_a_billion_is_one_row(spark):
    df = spark.createDataFrame([(1,), (1_000_000_002,)], "sequence_id long")
    assert rows(ops.missing_ranges(df)) == [(2, 1_000_000_001, 1_000_000_000)]
    assert ops.missing_ranges(df.limit(0)).isEmpty()
    assert rows(ops.missing_ranges(df.limit(0), first=1, last=3)) == [(1, 3, 3)]


def test_one_partition_is_spread_over_tasks(spark):
    df = spark.range(100_000).select((F.col("id") % 1).alias("partition_id"), F.col("id").alias("sequence_id"))
    plan = plan_text(ops.missing_ranges(df, ["partition_id"], bucket_ids=100), "simple")
    assert "_bucket" in plan and "hashpartitioning(partition_id#" in plan
    assert ops.missing_ranges(df, ["partition_id"], bucket_ids=100).isEmpty()


# Latency sketches


def test_merged_sketches_stay_within_the_bound(spark):
    rank = (F.col("id") * 7919) % 60_000
    df = spark.range(60_000).select(
        (F.col("id") % 3).alias("partition_id"),
        (F.lit(START) + F.col("id") * 20).alias("created_at"),
        (F.lit(START) + F.col("id") * 20 + F.pow(rank / 600, F.lit(2))).alias("arrival_ts"),
    )
    sketches = ops.latency_sketches(df)
    assert sketches.select("partition_date").distinct().count() > 10
    for by in (["partition_id"], ["partition_date"], []):
        found = ops.latency_quantiles(sketches, by, (0.01, 0.5, 0.9, 0.99))
        checked = ops.quantile_ranks(df, found, by)
        assert checked.count() == found.count() and checked.where(F.col("rank_error") > ops.RANK_ERROR).isEmpty()
    assert ops.latency_quantiles(sketches, []).agg(F.max("messages")).first()[0] == 60_000


def test_latency_of_unknown_times_and_empty_feeds(spark):
    schema = "partition_id long, created_at double, arrival_ts double"
    df = spark.createDataFrame([(1, None, 2.0), (1, 2.0, None), (None, 1.0, 4.0)], schema)
    found = ops.latency_quantiles(ops.latency_sketches(df), quantiles=(0.5,))
    assert [tuple(r) for r in found.collect()] == [(None, 1, 3.0, 3.0, 0.5, 3.0)]
    assert ops.quantile_ranks(df, found).first()["rank_error"] == 0.0
    assert ops.latency_quantiles(ops.latency_sketches(df.limit(0))).isEmpty()


# Metrics by date


def bronze_rows(spark, data):
    """(key, payload, day) as bronze; a null day is an unknown time."""
    schema = "message_id string, sequence_id long, partition_id long, value long, created_at double, arrival_index long"
    listed = [(k, 1, 0, v, None if d is None else START + 86_400 * d, i) for i, (k, v, d) in enumerate(data)]
    return add_hashes(spark.createDataFrame(listed, schema), ["value"])


def test_metrics_by_date_equal_a_full_recount(spark, tmp_path):
    chance = random.Random(1)
    data = [(f"k{chance.randrange(40)}", chance.randrange(3), chance.choice([0, 1, 2, 3, None])) for _ in range(300)]
    path, stored = str(tmp_path / "bronze"), str(tmp_path / "metrics")
    bronze = bronze_rows(spark, data)
    table.write_table(bronze, path, partition_by=["partition_date"])
    dates = [r[0] for r in bronze.select("partition_date").distinct().collect()]
    for day in sorted(dates, key=str):
        history.refresh_metrics(table.read_table(spark, path), stored, [day])
    assert rows(history.stored_metrics(spark, stored)) == rows(bronze_metrics(bronze))
    # Late rows of a date: only that date is counted anew.
    late = bronze_rows(spark, [("k1", 9, 2), ("new", 1, 2)])
    table.write_table(late, path)
    day = late.first()["partition_date"]
    history.refresh_metrics(table.read_table(spark, path), stored, [day])
    assert rows(history.stored_metrics(spark, stored)) == rows(bronze_metrics(table.read_table(spark, path)))
    # A date that was dropped.
    table.drop_partitions(spark, path, [day, None])
    history.refresh_metrics(table.read_table(spark, path), stored, [day, None])
    assert rows(history.stored_metrics(spark, stored)) == rows(bronze_metrics(table.read_table(spark, path)))


def test_a_refresh_reads_its_own_dates(spark, tmp_path, monkeypatch):
    path, stored = str(tmp_path / "bronze"), str(tmp_path / "metrics")
    table.write_table(bronze_rows(spark, [("a", 1, 0), ("b", 1, 1), ("c", 1, 2)]), path, partition_by=["partition_date"])
    plans = []
    write = history.write_table
    monkeypatch.setattr(history, "write_table", lambda df, *a, **k: plans.append(plan_text(df, "simple")) or write(df, *a, **k))
    history.refresh_metrics(table.read_table(spark, path), stored, [datetime.date(2023, 11, 15)])
    assert re.search(r"PartitionFilters: \[[^]]*partition_date[^]]*2023-11-15", plans[0])
    assert history.stored_metrics(spark, stored).first()["total_records"] == 1


# Payload history


def brute_history(data):
    out = []
    for key in {k for k, *_ in data}:
        own = sorted(((at is not None, at or 0, i, p) for k, p, at, i in data if k == key))
        runs = []
        for known, at, _, payload in own:
            if runs and runs[-1][0] == payload:
                runs[-1][2] += 1
            else:
                runs.append([payload, at if known else None, 1])
        following = [r[1] for r in runs[1:]] + [None]
        out += [(key, p, start, end, n) for (p, start, n), end in zip(runs, following)]
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket", [1.0, 50.0, 1e6])
def test_payload_history_equals_brute_force(spark, bucket):
    chance = random.Random(9)
    data = [("hot", chance.choice("aab"), float(chance.randrange(300)), i) for i in range(400)]
    data += [(f"k{i % 5}", chance.choice("xyz"), chance.choice([None, 1.0, 2.0, 70.0]), i) for i in range(60)]
    data += [("tie", "b", 1.0, 1), ("tie", "a", 1.0, 1), ("tie", "a", 1.0, 1), ("back", "a", 1.0, 1), ("back", "b", 2.0, 2), ("back", "a", 3.0, 3)]
    df = spark.createDataFrame(data, "composite_hash string, payload_hash string, created_at double, arrival_index long")
    found = history.payload_history(df, bucket_seconds=bucket)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_history(data)
    assert history.payload_history(df.limit(0)).isEmpty()


# Packing


def test_packing_leaves_large_files_alone(spark, path):
    big = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1)
    table.write_table(big, path)
    for i in range(12):
        table.write_table(spark.range(200_000 + 10 * i, 200_010 + 10 * i).select("id", F.lit("x").alias("text")).repartition(2), path)
    before = {r["path"]: r["length"] for r in table.live_files(spark, path).collect()}
    done = packing.pack_small(spark, path, target_bytes=4 << 20)
    after = {r["path"]: r["length"] for r in table.live_files(spark, path).collect()}
    large = max(before, key=before.get)
    assert (done.files_before, done.files_after, len(after)) == (len(before), 2, 2)
    assert large in after and done.bytes_untouched == before[large] and done.bytes_packed == sum(before.values()) - before[large]
    assert table.read_table(spark, path).count() == table.read_table(spark, path).select("id").distinct().count() == 200_120
    assert table.read_table(spark, path, version=0).count() == 200_000
    again = packing.pack_small(spark, path, target_bytes=4 << 20)
    assert (again.version, again.bytes_packed) == (done.version, 0)
    with pytest.raises(ValueError):
        packing.pack_small(spark, f"{path}-none")


def test_packing_keeps_partitions_and_hidden_rows_out(spark, path):
    df = spark.range(40).select("id", (F.col("id") % 4).cast("string").alias("part"))
    for low in range(0, 40, 10):
        table.write_table(df.where(F.col("id").between(low, low + 9)), path, partition_by=["part"])
    table.drop_partitions(spark, path, ["3"])
    table.replace_partitions(spark.createDataFrame([(99, "2")], "id long, part string"), path)
    expected = rows(table.read_table(spark, path))
    done = packing.pack_small(spark, path)
    assert rows(table.read_table(spark, path)) == expected and done.files_after < done.files_before
    table.upsert(spark.createDataFrame([(1, "b", 2.0)], "id long, v string, at double"), f"{path}-up", ["id"], ["at"])
    table.upsert(spark.createDataFrame([(1, "a", 1.0), (2, "c", 1.0)], "id long, v string, at double"), f"{path}-up", ["id"], ["at"])
    expected = rows(table.read_table(spark, f"{path}-up"))
    packing.pack_small(spark, f"{path}-up")
    assert rows(table.read_table(spark, f"{path}-up")) == expected
    table.upsert(spark.createDataFrame([(1, "d", 3.0)], "id long, v string, at double"), f"{path}-up", ["id"], ["at"])
    assert ("d",) in rows(table.read_table(spark, f"{path}-up"), "v") and table.read_table(spark, f"{path}-up").count() == 2


# Split writes

LINE = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("day", T.DateType())])


def test_split_write_keeps_every_row_once_with_all_reasons(spark, path):
    data = [("1", "2.5", "2024-01-02", "u"), ("x", "-1", None, "v"), (None, "3", "2024-13-01", None), ("4", None, None, "w"), ("1", "2.5", "2024-01-02", "u")]
    df = spark.createDataFrame(data, "id string, price string, day string, extra string")
    checks = {"price: negative": F.col("price").try_cast("double") >= 0}
    done = split.split_write(df, path, LINE, ["id"], checks)
    assert (done.accepted, done.refused) == (2, 3)
    assert rows(split.accepted_rows(spark, path, LINE)) == [(1, 2.5, datetime.date(2024, 1, 2))] * 2
    found = {json.loads(r["original"])["extra"]: (r["reasons"], json.loads(r["original"])) for r in split.refused_rows(spark, path).collect()}
    assert found["v"] == (["id: not a bigint", "price: negative"], {"id": "x", "price": "-1", "day": None, "extra": "v"})
    assert found[None][0] == ["id: null in a required column", "day: not a date"]
    assert found["w"][0] == ["price: negative"]


def test_split_write_of_an_empty_frame_and_bad_schemas(spark, path):
    df = spark.createDataFrame([], "id string, price string, day string")
    assert split.split_write(df, path, LINE).accepted == 0
    with pytest.raises(SchemaMismatch):
        split.split_write(df.drop("day"), f"{path}-2", LINE)
    with pytest.raises(SchemaMismatch):
        split.split_write(df, f"{path}-2", T.StructType([T.StructField("reasons", T.StringType())]))


def test_split_write_runs_one_pass_without_a_shuffle(spark, path):
    df = spark.createDataFrame([("1", "2", None)], "id string, price string, day string")
    problems = split.row_problems(df, LINE, ["id"])
    assert "Exchange" not in plan_text(df.withColumn("p", problems), "simple")
    split.split_write(df, path, LINE)
    plan = plan_text(split.accepted_rows(spark, path, LINE), "simple")
    assert "PartitionFilters: [isnotnull(refused" in plan
