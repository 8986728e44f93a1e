from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import session
from millrace.operators import quality, writes
from millrace.operators.sizes import dataset_files, dataset_size
from millrace.operators.table import read_table
from millrace.plans import compare, jobs
from millrace.plans.explain import operator_count, plan_lines, plan_text
from millrace.schemas import MESSAGE, SALES
from millrace.sources import derived, files

CSV = T.StructType([T.StructField(n, t) for n, t in (("a", T.LongType()), ("b", T.StringType()), ("c", T.StringType()))])


@pytest.fixture
def ragged(tmp_path):
    text = 'a,b,c\n1,2,3\n4,5,6,7\n8,9\n,"",x\n'
    target = tmp_path / "ragged.csv"
    target.write_text(text)
    return str(target)


def test_ragged_csv(spark, ragged):
    assert rows(files.read_csv(spark, ragged, CSV)) == [
        (None, None, "x"), (1, "2", "3"), (4, "5", "6"), (8, "9", None),
    ]
    inferred = files.read_csv(spark, ragged)
    assert dict(inferred.dtypes) == {"a": "int", "b": "int", "c": "string"}
    assert rows(inferred, "a") == [(None,), (1,), (4,), (8,)]
    assert tuple(files.csv_quality(spark, ragged, CSV).first()) == (4, 2, 3, 3, 3)


def test_csv_to_table(spark, ragged, path):
    assert jobs.csv_to_table(spark, ragged, path, CSV) == 0
    assert jobs.csv_to_table(spark, ragged, path, CSV) == 1
    assert read_table(spark, path).count() == 4


def test_jsonl_keeps_text_and_refuses_garbage(spark, tmp_path):
    good = tmp_path / "good.jsonl"
    good.write_text('{"message_id":"m","sequence_id":1,"zipcode":"01234","created_at":1.5}\n')
    row = files.read_jsonl(spark, str(good)).first()
    assert (row["message_id"], row["zipcode"], row["created_at"], row["value"]) == ("m", "01234", 1.5, None)
    assert files.read_jsonl(spark, str(good)).schema == MESSAGE
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"message_id":"m"}\nnot json\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        files.read_jsonl(spark, str(bad)).collect()


def test_latest_path(spark, tmp_path):
    for name in ("feed_1.jsonl", "feed_3.jsonl", "feed_2.jsonl", "other_9.jsonl"):
        (tmp_path / name).write_text("{}\n")
    spark.range(1).write.json(str(tmp_path / "feed_25.jsonl"))
    assert files.latest_path(spark, f"{tmp_path}/feed_*.jsonl").endswith("/feed_3.jsonl")
    assert files.latest_path(spark, f"{tmp_path}/feed_2*.jsonl").endswith("/feed_25.jsonl")
    with pytest.raises(FileNotFoundError):
        files.latest_path(spark, f"{tmp_path}/none_*.jsonl")


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    lines = files.scan_parquet(spark, f"{sf_dir}/lineitem.parquet")
    query = lines.filter(F.col("l_linenumber") > 2).groupBy("l_linenumber").agg(F.avg("l_extendedprice"))
    assert "GreaterThan(l_linenumber,2)" in plan_lines(query, "PushedFilters")[0]
    assert plan_lines(query, "ReadSchema") == ["struct<l_linenumber:int,l_extendedprice:double>"]
    assert operator_count(query, "Exchange") == 1
    assert "Parsed Logical Plan" in plan_text(query, "extended")


def test_partitioned_write_and_pruned_read(spark, path):
    df = spark.createDataFrame([(1, "007"), (2, None), (3, "x"), (4, "x")], "id long, part string")
    writes.write_partitioned(df, path, "part")
    one = files.scan_partitioned(spark, path, df.schema, part="007")
    assert rows(one, "id", "part") == [(1, "007")]
    assert "part" in plan_lines(one, "PartitionFilters")[0]
    assert rows(files.scan_partitioned(spark, path, df.schema).select("id", "part")) == rows(df)
    loose = files.scan_files(spark, path)
    assert loose.columns == ["id"] and loose.count() == 4


def test_gathered_partitions_have_few_files(spark, path):
    df = spark.range(1000).repartition(8).withColumn("part", F.col("id") % 4)
    writes.write_partitioned(df, path, "part")
    writes.write_partitioned(df, path + "-loose", "part", gather=False)
    assert dataset_size(dataset_files(spark, path)).first()["files"] == 4
    assert dataset_size(dataset_files(spark, path + "-loose")).first()["files"] == 32


def test_hot_partition_is_split_over_files(spark, path):
    hot = F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.lit("cold"))
    df = spark.range(200_000).repartition(8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"), hot.alias("part"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "2m")
    try:
        writes.write_partitioned(df, path, "part")
    finally:
        spark.conf.unset(size)
    sizes = [r["length"] for r in dataset_files(spark, path).filter("path LIKE '%part=hot%'").collect()]
    assert len(sizes) > 3 and max(sizes) < sum(sizes) / 2
    assert spark.read.parquet(path).count() == 200_000


def test_replaced_dates_leave_others(spark, path):
    df = spark.createDataFrame([(1, "d1"), (2, "d2")], "id long, partition_date string")
    writes.write_partitioned(df, path, "partition_date")
    writes.replace_dates(df.filter("id = 1").withColumn("id", F.lit(9).cast("long")), path)
    assert rows(spark.read.schema(df.schema).parquet(path), "id") == [(2,), (9,)]


def test_codecs(spark, sf_dir, path):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    found = {r["codec"]: r for r in compare.compare_codecs(df, path).collect()}
    assert list(sorted(found)) == ["gzip", "snappy", "uncompressed"]
    assert found["uncompressed"]["bytes_ratio"] == 1.0
    assert found["gzip"]["bytes"] < found["snappy"]["bytes"] < found["uncompressed"]["bytes"]
    names = [os.path.basename(r["path"]) for r in dataset_files(spark, f"{path}/gzip").collect()]
    assert all(".gz." in n for n in names)


def test_layouts_read_the_same_rows(spark, sf_dir, path):
    df = spark.read.parquet(f"{sf_dir}/customer.parquet")
    found = {r["layout"]: r for r in compare.compare_layouts(df, path, "c_mktsegment", "BUILDING").collect()}
    assert found["flat"]["rows_read"] == found["partitioned"]["rows_read"] > 0
    assert found["partitioned"]["files"] == 5


def test_evolution_comparison(spark, path):
    df = derived.sales(spark, 2000)
    added = df.filter("id < 400")
    found = {r["approach"]: r for r in compare.compare_evolution(df, added, "new_metric", 0.0, path).collect()}
    assert (found["rewrite"]["rows"], found["rewrite"]["rows_without_column"]) == (2000, 0)
    assert (found["append"]["rows"], found["append"]["rows_without_column"]) == (2400, 2000)
    assert found["rewrite"]["bytes_after"] > found["rewrite"]["bytes_before"]
    assert found["append"]["bytes_after"] < found["rewrite"]["bytes_after"]


def test_table_overhead(spark, path):
    found = {r["format"]: r for r in compare.compare_table_overhead(derived.sales(spark, 2000), path).collect()}
    assert found["parquet"]["overhead_percent"] == 0.0
    assert 0 < found["table"]["overhead_percent"] < 25


@pytest.mark.parametrize("n,spacing", [(500_000, 63), (1_000_000, 31), (2_000_000, 15), (5_000_000, 6)])
def test_sales_spacing(spark, n, spacing):
    row = derived.sales(spark, n).filter("id = 1").first()
    assert row["timestamp"].isoformat() == f"2024-01-01T00:{spacing // 60:02d}:{spacing % 60:02d}"
    assert row["value"] == 2


def test_sales_shape(spark):
    df = derived.sales(spark, 10_000)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SALES]
    assert df.agg(F.avg("value")).first()[0] == 4999.0
    assert df.groupBy("value").count().filter("count <> 2").isEmpty()
    for column, size in (("region", 4), ("user_segment", 3)):
        counts = [r["count"] for r in df.groupBy(column).count().collect()]
        assert len(counts) == size and min(counts) > 10_000 / size * 0.9


def test_draws(spark):
    drawn = [r["drawn"] for r in derived.draws_from_range(spark, 100, 10).collect()]
    assert len(drawn) == 10 and all(0 <= d < 100 for d in drawn)
    many = derived.draws_from_range(spark, 100, 5000)
    assert many.select("drawn").distinct().count() == 100


def test_name_check_reports_both_sets(spark):
    df = spark.createDataFrame([(1, 2)], "id long, value long")
    assert quality.check_column_names(df, {"value", "id"}) is df
    with pytest.raises(quality.SchemaMismatch, match=r"\['id', 'values'\], got \['id', 'value'\]"):
        quality.check_column_names(df, ["id", "values"])


def test_type_rules():
    integer, double = T.IntegerType(), T.DoubleType()
    assert quality.fits_type(integer, T.LongType()) and not quality.fits_type(T.LongType(), integer)
    assert quality.fits_type(T.FloatType(), double) and not quality.fits_type(integer, double)
    assert not quality.fits_type(T.StringType(), double)


def test_schema_report_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "id long, name string")
    expected = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType())])
    assert rows(quality.schema_report(df, expected)) == [
        ("id", "bigint", 2, 1, "null in a required column"), ("name", "string", 2, 1, None),
    ]
    assert rows(quality.schema_report(df), "column_name", "nulls") == [("id", 1), ("name", 1)]


def test_fallback(spark, tmp_path):
    df = spark.range(10)
    blocker = tmp_path / "file"
    blocker.write_text("x")
    good, bad, other = str(tmp_path / "good"), str(blocker / "below"), str(tmp_path / "other")
    assert writes.write_with_fallback(df, good, other) == {"location": good, "attempt": "primary"}
    assert not os.path.exists(other)
    assert writes.write_with_fallback(df, bad, other) == {"location": other, "attempt": "fallback"}
    assert spark.read.parquet(other).count() == 10


def test_unstable_rows_are_pinned(spark, tmp_path):
    df = spark.range(100).withColumn("r", F.rand())
    pinned = session.pin(df)
    assert rows(pinned) == rows(pinned)
    blocker = tmp_path / "file"
    blocker.write_text("x")
    record = writes.write_with_fallback(df, str(blocker / "x"), str(tmp_path / "out"), stable=False)
    assert record["attempt"] == "fallback"


def test_outcomes(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "id long, value long")
    good = jobs.checked_write(df, ["id", "value"], str(tmp_path / "a"), str(tmp_path / "b"))
    assert good == {"status": "success", "result": {"location": str(tmp_path / "a"), "attempt": "primary"}}
    bad = jobs.checked_write(df, ["id", "values"], str(tmp_path / "c"), str(tmp_path / "d"))
    assert bad["status"] == "failed" and "values" in bad["error"]
    assert not os.path.exists(tmp_path / "c")


def test_scratch_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert first.startswith(shared) and first != second


def test_shuffle_partitions():
    assert session.shuffle_partitions_for(0, 8) == 8
    assert session.shuffle_partitions_for(10 << 40, 5000) == 81920
