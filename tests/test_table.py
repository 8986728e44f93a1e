from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import table
from millrace.operators.dedup import add_hashes
from millrace.operators.positions import range_slice
from millrace.operators.quality import SchemaMismatch
from millrace.operators.table import (
    compact,
    current_version,
    drop_partitions,
    history,
    merge_metrics,
    read_table,
    replace_partitions,
    table_size,
    upsert,
    write_table,
)
from millrace.plans.explain import plan_lines, plan_text
from millrace.plans.jobs import append_batches
from millrace.sources.derived import sales

ROW = "id long, part string, value long"


def frame(spark, *data, schema=ROW):
    return spark.createDataFrame(list(data), schema)


def files_below(path):
    return sorted(
        os.path.join(folder, name)
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith((".parquet", ".json"))
    )


def test_versions_and_time_travel(spark, path):
    a, b, c = (frame(spark, (i, "p", i * 10)) for i in (1, 2, 3))
    assert current_version(spark, path) is None
    assert [write_table(a, path), write_table(b, path)] == [0, 1]
    assert write_table(c, path, mode="overwrite") == 2
    assert rows(read_table(spark, path), "id") == [(3,)]
    assert rows(read_table(spark, path, 1), "id") == [(1,), (2,)]
    assert rows(read_table(spark, path, 0), "id") == [(1,)]
    assert rows(history(spark, path), "version", "operation", "base_version", "rows") == [
        (0, "append", 0, 1), (1, "append", 0, 1), (2, "overwrite", 2, 1),
    ]
    for wrong in (3, -1):
        with pytest.raises(ValueError):
            read_table(spark, path, wrong)


def test_missing_table(spark, path):
    with pytest.raises(ValueError, match="no table"):
        read_table(spark, path)


def test_empty_commit(spark, path):
    write_table(frame(spark), path, partition_by=["part"])
    assert rows(read_table(spark, path)) == []
    write_table(frame(spark, (1, "a", 1)), path)
    assert rows(read_table(spark, path), "id", "part") == [(1, "a")]
    assert rows(history(spark, path), "rows") == [(0,), (1,)]


@pytest.mark.parametrize(
    "bad,message",
    [
        ("id long, part string, amount long", "amount: not in the table; value: missing"),
        ("id long, part string, value string", "value: string does not fit bigint"),
        ("id long, part string", "value: missing"),
        ("id long, part string, value double", "value: double does not fit bigint"),
        ("id long, part string, value long, commit long", "commit: not in the table"),
    ],
)
def test_bad_rows_are_refused_before_any_file(spark, path, bad, message):
    write_table(frame(spark, (1, "a", 1)), path)
    before = files_below(path)
    for mode in ("append", "overwrite"):
        with pytest.raises(SchemaMismatch, match=message):
            write_table(spark.createDataFrame([], bad), path, mode=mode)
    assert files_below(path) == before and current_version(spark, path) == 0


def test_commit_is_a_reserved_name(spark, path):
    with pytest.raises(SchemaMismatch, match="commit: reserved"):
        write_table(frame(spark, (1, 2), schema="id long, commit long"), path)
    with pytest.raises(SchemaMismatch, match="commit: reserved"):
        upsert(frame(spark, (1, 2), schema="id long, commit long"), path, ["id"], ["commit"])
    assert current_version(spark, path) is None and not os.path.exists(path)


def test_narrow_numbers_are_widened_and_order_is_free(spark, path):
    write_table(frame(spark, (1, "a", 1)), path)
    write_table(spark.createDataFrame([(7, 2, "b")], "value int, id int, part string"), path)
    table_rows = read_table(spark, path)
    assert dict(table_rows.dtypes) == {"id": "bigint", "part": "string", "value": "bigint"}
    assert rows(table_rows) == [(1, "a", 1), (2, "b", 7)]


def test_required_columns(spark, path):
    write_table(frame(spark, (1, "a", 1)), path, required=["id"])
    with pytest.raises(Exception, match="null in required column id"):
        write_table(frame(spark, (None, "b", 2)), path)
    assert rows(read_table(spark, path)) == [(1, "a", 1)]
    # The next commit takes over what the failed one may have left.
    assert write_table(frame(spark, (2, "b", 2)), path) == 1
    assert rows(read_table(spark, path), "id") == [(1,), (2,)]
    with pytest.raises(SchemaMismatch, match="id: missing"):
        write_table(spark.createDataFrame([("c",)], "part string"), path, merge_schema=True)


def test_schema_merge(spark, path):
    write_table(frame(spark, (1, "a", 1)), path)
    write_table(frame(spark, (2, 0.0), schema="id long, metric double"), path, merge_schema=True)
    assert rows(read_table(spark, path)) == [(1, "a", 1, None), (2, None, None, 0.0)]
    assert read_table(spark, path, 0).columns == ["id", "part", "value"]
    with pytest.raises(SchemaMismatch):
        write_table(frame(spark, ("x", 0.0), schema="id string, metric double"), path, merge_schema=True)


def test_schema_replacement(spark, path):
    write_table(frame(spark, (1, "a", 1)), path)
    other = frame(spark, ("x",), schema="name string")
    assert write_table(other, path, mode="overwrite", replace_schema=True) == 1
    assert rows(read_table(spark, path)) == [("x",)]
    assert rows(read_table(spark, path, 0)) == [(1, "a", 1)]


def test_evolution_counts(spark, path):
    v1 = sales(spark, 5000)
    write_table(v1, path, "overwrite")
    again = v1.orderBy("id").limit(1000).withColumn("new_metric", F.lit(0.0))
    assert write_table(again, path, merge_schema=True) == 1
    found = read_table(spark, path)
    assert found.count() == 6000
    assert found.filter("new_metric IS NULL").count() == 5000
    assert history(spark, path).count() == 2


def test_thirty_appends_and_compaction(spark, path):
    v1 = sales(spark, 3000)
    batch = range_slice(F.col("id"), F.lit(0), F.lit(2999), 30)
    last = append_batches((v1.filter(batch == i) for i in range(30)), path)
    assert last == 29
    means = read_table(spark, path).groupBy("user_segment").agg(F.avg("value"))
    before = rows(means)
    assert before == rows(v1.groupBy("user_segment").agg(F.avg("value")))
    many = table_size(spark, path).first()
    assert compact(spark, path, files=2) == 30
    few = table_size(spark, path).first()
    assert few["live_files"] == 2 < many["live_files"]
    assert few["stored_files"] == many["stored_files"] + 2
    assert rows(read_table(spark, path).groupBy("user_segment").agg(F.avg("value"))) == before
    assert read_table(spark, path, 29).count() == 3000
    assert compact(spark, path) == 31
    assert rows(read_table(spark, path), "id") == rows(v1, "id")


def test_partitions_keep_text_and_null(spark, path):
    data = [(1, "007", 1), (2, None, 2), (3, "a/b:c d+e%", 3)]
    write_table(frame(spark, *data), path, partition_by=["part"])
    assert rows(read_table(spark, path)) == sorted(data)
    one = read_table(spark, path).filter("part = '007'")
    assert "part" in plan_lines(one, "PartitionFilters")[0]
    assert rows(one) == [(1, "007", 1)]
    with pytest.raises(SchemaMismatch, match="partitioned by"):
        write_table(frame(spark, *data), path, partition_by=["id"])


def test_dropped_and_replaced_partitions(spark, path):
    data = [(1, "a", 1), (2, "b", 2), (3, None, 3), (4, "c+d/e", 4)]
    write_table(frame(spark, *data), path, partition_by=["part"])
    drop_partitions(spark, path, ["a", None])
    assert rows(read_table(spark, path), "id") == [(2,), (4,)]
    assert table_size(spark, path).first()["live_files"] == 2
    write_table(frame(spark, (5, "a", 5)), path)
    assert rows(read_table(spark, path), "id") == [(2,), (4,), (5,)]
    replace_partitions(frame(spark, (6, "b", 6), (7, None, 7), (8, "c+d/e", 8)), path)
    assert rows(read_table(spark, path), "id") == [(5,), (6,), (7,), (8,)]
    assert table_size(spark, path).first()["live_files"] == 4
    assert rows(read_table(spark, path, 0), "id") == [(1,), (2,), (3,), (4,)]
    compact(spark, path)
    assert rows(read_table(spark, path), "id") == [(5,), (6,), (7,), (8,)]


def test_hidden_dates_are_pruned_not_read(spark, feed, path):
    bronze = add_hashes(feed)
    write_table(bronze, path, partition_by=["partition_date"])
    first = bronze.agg(F.min("partition_date")).first()[0]
    drop_partitions(spark, path, [first])
    left = read_table(spark, path)
    assert "partition_date" in plan_lines(left, "PartitionFilters")[0]
    assert rows(left, "message_id", "arrival_index") == rows(
        bronze.filter(F.col("partition_date") != F.lit(first)), "message_id", "arrival_index"
    )


def test_plain_tables_have_no_partition_to_drop(spark, path):
    write_table(frame(spark, (1, "a", 1)), path)
    with pytest.raises(ValueError, match="partitioned by one column"):
        drop_partitions(spark, path, ["a"])


UP = "message_id string, created_at double, arrival_index long, value long"


@pytest.mark.parametrize("buckets", [1, 5])
def test_upsert_rules(spark, path, buckets):
    def put(*data):
        return upsert(frame(spark, *data, schema=UP), path, buckets=buckets)

    put(("a", 1.0, 1, 10), ("a", 2.0, 2, 11), ("b", 5.0, 3, 20), (None, 1.0, 4, 30), ("d", None, 5, 40))
    assert rows(read_table(spark, path), "message_id", "value") == [
        (None, 30), ("a", 11), ("b", 20), ("d", 40),
    ]
    put(
        ("a", 3.0, 9, 12),      # newer
        ("b", 4.0, 10, 21),     # older, loses
        ("c", 1.0, 11, 50),     # new
        ("d", 0.0, 0, 41),      # any time beats null
        (None, 1.0, 4, 31),     # full tie: the batch wins
        ("b", None, 99, 22),
    )
    expected = [(None, 31), ("a", 12), ("b", 20), ("c", 50), ("d", 41)]
    assert rows(read_table(spark, path), "message_id", "value") == expected
    assert rows(merge_metrics(spark, path)) == [(0, 5, 0, 4, 1), (1, 6, 4, 5, 5)]
    assert rows(read_table(spark, path, 0), "message_id", "value")[1] == ("a", 11)


def test_repeated_upsert_changes_nothing(spark, path, feed):
    columns = ["message_id", "arrival_index", "value"]
    halves = [feed.filter("arrival_index < 900"), feed.filter("arrival_index >= 900")]
    for half in halves:
        upsert(half, path)
    once = rows(read_table(spark, path), *columns)
    assert len(once) == 1000
    for half in halves:
        upsert(half, path)
    assert rows(read_table(spark, path), *columns) == once


def test_upsert_over_appended_duplicates_makes_keys_unique(spark, path):
    upsert(frame(spark, ("a", 1.0, 1, 1), schema=UP), path)
    write_table(frame(spark, ("a", 2.0, 2, 2), schema=UP), path)
    upsert(frame(spark, ("b", 1.0, 3, 3), schema=UP), path)
    assert rows(read_table(spark, path), "message_id", "value") == [("a", 2), ("b", 3)]


def test_upsert_leaves_other_buckets_alone(spark, path):
    upsert(frame(spark, *[(str(i), 1.0, i, i) for i in range(200)], schema=UP), path, buckets=20)
    before = set(files_below(f"{path}/data"))
    upsert(frame(spark, ("7", 2.0, 900, -7), schema=UP), path)
    fresh = set(files_below(f"{path}/data")) - before
    assert before < set(files_below(f"{path}/data")) and len({os.path.dirname(f) for f in fresh}) == 1
    assert rows(history(spark, path).filter("version = 1"), "rows")[0][0] < 60
    found = dict(rows(read_table(spark, path), "message_id", "value"))
    assert len(found) == 200 and found["7"] == -7 and found["8"] == 8
    assert table_size(spark, path).first()["live_files"] == len(before)


def test_empty_upsert_writes_nothing(spark, path):
    upsert(frame(spark, ("a", 1.0, 1, 1), schema=UP), path)
    before = files_below(path)
    assert upsert(frame(spark, schema=UP), path) == 0
    assert files_below(path) == before


def test_upsert_shuffles_the_batch_once(spark, path, feed, monkeypatch):
    upsert(feed, path)
    plans = []
    commit = table._commit
    monkeypatch.setattr(table, "_commit", lambda *a, **k: plans.append(plan_text(a[3], "simple")) or commit(*a, **k))
    upsert(feed.limit(5), path)
    assert plans[0].count("Exchange hashpartitioning") == 1


def test_upsert_into_plain_and_partitioned_tables(spark, tmp_path):
    for name, parts in (("plain", None), ("parted", ["value"])):
        path = str(tmp_path / name)
        write_table(frame(spark, ("a", 1.0, 1, 1), ("a", 2.0, 2, 2), schema=UP), path, partition_by=parts)
        upsert(frame(spark, ("b", 1.0, 3, 3), schema=UP), path)
        assert rows(read_table(spark, path), "message_id", "value") == [("a", 2), ("b", 3)]


def test_upsert_refuses_other_schema(spark, path):
    upsert(frame(spark, ("a", 1.0, 1, 1), schema=UP), path)
    with pytest.raises(SchemaMismatch):
        upsert(frame(spark, ("a", 1.0, 1, "x"), schema=UP.replace("value long", "value string")), path)


def test_second_writer_fails_and_the_first_ones_rows_stay(spark, path):
    write_table(frame(spark, (1, "a", 1)), path)
    stale = table.snapshot(spark, path)
    write_table(frame(spark, (2, "b", 2)), path)
    with pytest.raises(FileExistsError, match="already exists"):
        write_table(frame(spark, (3, "c", 3)), path, found=stale)
    assert rows(read_table(spark, path), "id") == [(1,), (2,)]
    write_table(frame(spark, (4, "d", 4)), path)
    assert rows(read_table(spark, path), "id") == [(1,), (2,), (4,)]


def test_leftovers_of_a_crash_stop_nobody(spark, path):
    write_table(frame(spark, (1, "a", 1)), path)
    segment = os.path.join(path, "ledger", os.listdir(f"{path}/ledger")[0])
    with open(f"{segment}/.half-written", "w") as left:
        left.write('{"version": 1')
    os.makedirs(f"{path}/data/commit=1-dead/_temporary/0")
    assert write_table(frame(spark, (2, "b", 2)), path) == 1
    assert rows(read_table(spark, path), "id") == [(1,), (2,)]


def test_many_commits_stay_bounded(spark, path):
    for i in range(40):
        write_table(frame(spark, (i, "p", i)), path, fold_commits=6)
    found = table.snapshot(spark, path)
    assert len(found.live) <= 3 * 6 and found.total_rows == 40
    assert rows(read_table(spark, path), "id") == [(i,) for i in sorted(range(40), key=str)]
    assert history(spark, path).filter("operation = 'fold'").count() >= 6


def test_hidden_values_stay_bounded(spark, path):
    write_table(frame(spark, (1, "a", 1), (2, "b", 2)), path, partition_by=["part"])
    for i in range(5):
        replace_partitions(frame(spark, (1, "a", i)), path)
    assert table.snapshot(spark, path).hidden == {"a": 5}
    assert rows(read_table(spark, path)) == [(1, "a", 4), (2, "b", 2)]
    compact(spark, path)
    assert table.snapshot(spark, path).hidden == {}
    assert rows(read_table(spark, path)) == [(1, "a", 4), (2, "b", 2)]


def test_empty_text_is_no_partition(spark, path):
    with pytest.raises(Exception, match="empty text in partition column part"):
        write_table(frame(spark, (1, "", 1)), path, partition_by=["part"])
    assert current_version(spark, path) is None
    write_table(frame(spark, (1, "a", 1)), path, partition_by=["part"])
    with pytest.raises(Exception, match="empty text"):
        replace_partitions(frame(spark, (1, "", 1)), path)
    with pytest.raises(ValueError, match="empty text"):
        drop_partitions(spark, path, [""])
    assert rows(read_table(spark, path)) == [(1, "a", 1)]
