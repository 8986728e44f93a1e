from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.values import (
    labelled,
    modulo_group,
    overhead_percent,
    percent,
    pick,
    ratio,
    throughput,
)
from millrace.operators import positions, relational
from millrace.operators.bounds import broadcast_if_small, measured_bytes
from millrace.operators.quality import SchemaMismatch
from millrace.plans.explain import plan_text


@pytest.fixture(scope="module")
def million(spark):
    number = F.col("id")
    return spark.range(1_000_000).select(
        number, modulo_group(number, 100).alias("group"), number.alias("val")
    )


def test_group_mean_closed_form(million):
    found = dict(rows(relational.group_mean(million, "group", "val")))
    assert found == {str(g): 499950.0 + g for g in range(100)}


def test_filter_mean_having_closed_form(million):
    result = relational.filtered_group_mean(million, "val", 500_000, "group", "val", 750_000)
    assert dict(rows(result)) == {str(g): 749950.0 + g for g in range(51, 100)}


def test_group_mean_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", None), ("b", None), (None, 4), (None, 6)], "k string, v long"
    )
    assert rows(relational.group_mean(df, "k", "v")) == [(None, 5.0), ("a", 1.0), ("b", None)]


def test_filter_is_strict_and_drops_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "v long")
    assert rows(relational.where_above(df, "v", 2)) == [(3,)]


def test_distinct_count_includes_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    assert relational.distinct_count(df, "v").first()[0] == 2


def test_ordered_puts_nulls_first(spark):
    df = spark.createDataFrame([(2, "x"), (None, "y"), (1, "z"), (1, "a")], "v long, t string")
    assert [tuple(r) for r in relational.ordered(df, "v", "t").collect()] == [
        (None, "y"), (1, "a"), (1, "z"), (2, "x"),
    ]


def test_set_difference_treats_null_as_a_value(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    right = spark.createDataFrame([(2,), (2,), (3,)], "k long")
    assert rows(relational.set_difference(left, right, "k")) == [(None,), (1,)]
    assert rows(relational.set_difference(left, left, "k")) == []


def test_concat_rows_requires_one_schema(spark):
    a = spark.createDataFrame([(1, "x")], "a long, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a long")
    assert rows(relational.concat_rows(a, b)) == [(1, "x"), (2, "y")]
    with pytest.raises(SchemaMismatch, match="b: missing"):
        relational.concat_rows(a, b.withColumnRenamed("b", "c"))
    with pytest.raises(SchemaMismatch, match="a: int does not fit bigint"):
        relational.concat_rows(a, b.withColumn("a", F.col("a").cast("int")))


def test_concat_evolving_fills_null(spark):
    a = spark.createDataFrame([(1,)], "a long")
    b = spark.createDataFrame([(2, 0.0)], "a long, m double")
    assert rows(relational.concat_evolving(a, b)) == [(1, None), (2, 0.0)]


@pytest.mark.parametrize("limit", [0, 10_000])
@pytest.mark.parametrize("offset,length", [(0, 0), (0, 7), (493, 14), (995, 50), (2000, 3)])
def test_slice_rows(spark, monkeypatch, limit, offset, length):
    monkeypatch.setattr(positions, "TOP_N_ROWS", limit)
    shuffled = spark.range(1000).repartition(7).orderBy(F.rand(3))
    expected = [(i,) for i in range(1000)][offset : offset + length]
    found = positions.slice_rows(shuffled, ["id"], offset, length)
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_ties_are_cut_alike_at_every_size(spark, monkeypatch):
    df = spark.range(3000).select(F.lit(1).alias("k"), "id").repartition(5)
    cuts = []
    for limit in (0, 10_000):
        monkeypatch.setattr(positions, "TOP_N_ROWS", limit)
        cuts.append(rows(positions.slice_rows(df, ["k"], 500, 700), "id"))
    assert len(cuts[0]) == 700 and cuts[0] == cuts[1]


def test_row_index_is_dense_over_several_keys(spark):
    df = spark.range(5000).select(F.pmod(F.col("id") * 7919, F.lit(13)).alias("a"), "id")
    found = positions.with_row_index(df.repartition(5), ["a", F.col("id").desc()])
    got = sorted((r["row_index"], r["a"], r["id"]) for r in found.collect())
    assert [g[0] for g in got] == list(range(5000))
    assert [(a, -i) for _, a, i in got] == sorted((a, -i) for _, a, i in got)


def test_range_slices_keep_every_row(spark):
    df = spark.range(1007).select(
        positions.range_slice(F.col("id"), F.lit(0), F.lit(1006), 10).alias("s")
    )
    counts = dict(rows(df.groupBy("s").count()))
    assert sorted(counts) == list(range(10)) and sum(counts.values()) == 1007
    assert max(counts.values()) - min(counts.values()) <= 1


def test_ratios_guard_zero(spark):
    df = spark.createDataFrame([(1, 4), (1, 0)], "a long, b long")
    a, b = F.col("a"), F.col("b")
    found = df.select(
        ratio(a, b), percent(a, b, default=0.0), overhead_percent(a, b), throughput(b, F.lit(2.0))
    )
    assert rows(found) == [(None, 0.0, None, 0.0), (0.25, 25.0, -75.0, 2.0)]


def test_labels(spark):
    assert spark.range(1).select(labelled("customer", F.col("id"))).first()[0] == "customer0"


def test_pick_does_not_depend_on_partitioning_and_is_even(spark):
    ids = spark.range(40_000)
    once = rows(ids.select("id", pick(F.col("id"), 7, 4).alias("p")))
    again = rows(ids.repartition(13).select("id", pick(F.col("id"), 7, 4).alias("p")))
    assert once == again
    counts = {}
    for _, p in once:
        counts[p] = counts.get(p, 0) + 1
    assert set(counts) == {0, 1, 2, 3}
    assert all(abs(c - 10_000) < 500 for c in counts.values())


def test_top_rows_are_limited_before_the_shuffle(million):
    top = relational.top_rows_per_key(million, ["group"], [F.col("val").desc()], 2)
    assert plan_text(top, "simple").count("WindowGroupLimit") == 2
    assert top.count() == 200


def test_broadcast_only_when_measured_small(spark):
    df = spark.range(1000).select(F.lit("x" * 100).alias("s"))
    assert measured_bytes(df) == 1000 * 116
    assert "broadcast" in plan_text(broadcast_if_small(df, 200_000), "extended")
    assert "broadcast" not in plan_text(broadcast_if_small(df, 100_000), "extended")


def test_nested_columns_are_measured(spark):
    df = spark.range(100).select(F.array_repeat(F.col("id"), 500).alias("many"), F.struct("id").alias("one"))
    assert measured_bytes(df) > 100 * 500 * 8
