"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_sql(spark, sf_dir, duck, name):
    result = contract.queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    found = sorted((tuple(row[c] for c in columns) for row in result.collect()), key=repr)
    if name not in contract.oracle_sql():
        assert found
        return
    relation = duck.sql(contract.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    places = [relation.columns.index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in places) for row in relation.fetchall()), key=repr)
    assert expected, "a check over no rows shows nothing"
    assert found == expected


def test_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    flagship = contract.entry(spark)
    assert not flagship.isEmpty()
    assert {"composite_hash", "payload_hash", "partition_date"} <= set(flagship.columns)


def test_layout_queries_write_in_parallel(spark, sf_dir, duck, monkeypatch):
    from millrace.plans import compare, queries

    parts, names = [], []
    layouts, size = compare.compare_layouts, queries.dataset_size
    monkeypatch.setattr(compare, "compare_layouts", lambda df, *rest: parts.append(df.rdd.getNumPartitions()) or layouts(df, *rest))
    monkeypatch.setattr(queries, "dataset_size", lambda files: names.extend(r["path"].split("/")[-1][:10] for r in files.collect()) or size(files))
    settings = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        for name in ("layout_files", "stored_size"):
            test_query_matches_sql(spark, sf_dir, duck, name)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert parts[0] > 1 and len(set(names)) > 1


def test_packed_small_files_in_many_tasks(spark, sf_dir, tmp_path, monkeypatch):
    """With many splits of the input no file of the large commit, and no packed one, holds a whole table."""
    from pyarrow import parquet
    from millrace.operators import packing, table

    own = duckdb.connect()
    for name, step in (("lineitem", 300), ("orders", 300)):
        parquet.write_table(parquet.read_table(f"{sf_dir}/{name}.parquet"), tmp_path / f"{name}.parquet", row_group_size=step)
        own.execute(f"CREATE VIEW {name} AS FROM '{tmp_path}/{name}.parquet'")
    done, listed = [], []
    pack = packing.pack_small

    def watched(session, path, target_bytes):
        before = [r["path"] for r in table.live_files(session, path).collect()]
        done.append(pack(session, path, target_bytes))
        after = [r["path"] for r in table.live_files(session, path).collect()]
        listed.append((len([f for f in before if "commit=0-" in f]), len([f for f in after if f not in before])))
        return done[-1]

    monkeypatch.setattr(packing, "pack_small", watched)
    settings = {"spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        test_query_matches_sql(spark, str(tmp_path), own, "packed_small_files")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    (large, packed), = listed
    assert large > 4 and packed > 1 and done[0].files_after < done[0].files_before
