"""Registered queries over the given tables, each with the SQL that must return the same rows.

Queries that store something do so below the scratch folder, then read it back.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.keys import composite_key, epoch_date, epoch_seconds
from millrace.functions.values import labelled, modulo_group, pick_sql
from millrace.operators import dedup, feed, history, packing, positions, quality, relational, split, table, writes
from millrace.operators.sizes import dataset_files, dataset_size
from millrace.plans import compare, explain, jobs
from millrace.session import scratch_path
from millrace.sources import derived, files
from millrace.streaming import feed as streams
from millrace.streaming.marks import Marks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return add


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return files.scan_parquet(spark, f"{sf}/{name}.parquet")


def _feed(spark: SparkSession, sf: str, **options) -> DataFrame:
    return derived.message_feed(_table(spark, sf, "events"), **options)


def _feed_sql(copies: str = "CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END") -> str:
    return f"""WITH feed AS (
  SELECT CAST(event_id AS VARCHAR) AS message_id, event_id AS sequence_id,
         user_id % 3 AS partition_id, epoch_us(ts) / 1e6 AS created_at,
         epoch_us(ts) / 1e6 + CASE WHEN delivery > 0 THEN 1800 ELSE 0 END AS arrival_ts,
         CASE WHEN delivery > 0 THEN (event_id + 25) * 2 + 1 ELSE event_id * 2 END AS arrival_index,
         user_id, event_type, value, props, ts
  FROM (SELECT *, unnest(range({copies})) AS delivery FROM events))
"""


_FEED = _feed_sql()
_LOSSY = _feed_sql("CASE WHEN event_id % 97 = 0 THEN 0 WHEN event_id % 10 = 0 THEN 2 ELSE 1 END")
_HASH = "sha256(concat_ws('|', message_id, sequence_id, partition_id))"
_PAYLOAD = ["event_type", "props", "user_id", "value"]
_STORED = ["message_id", "sequence_id", "partition_id", "arrival_index", "composite_hash"]


# Filters, projections and aggregates


@registered(
    """SELECT l_linenumber, round(avg(l_extendedprice), 6) AS mean_price FROM lineitem
    WHERE l_linenumber > 2 GROUP BY l_linenumber HAVING avg(l_extendedprice) > 25000"""
)
def filter_mean_having(spark: SparkSession, sf: str) -> DataFrame:
    means = relational.filtered_group_mean(
        _table(spark, sf, "lineitem"), "l_linenumber", 2, "l_linenumber", "l_extendedprice", 25000
    )
    return means.select("l_linenumber", F.round("l_extendedprice", 6).alias("mean_price"))


@registered(
    """SELECT CAST(l_orderkey % 100 AS VARCHAR) AS group_key, round(avg(l_partkey), 6) AS mean_value
    FROM lineitem GROUP BY 1"""
)
def modulo_group_mean(spark: SparkSession, sf: str) -> DataFrame:
    keyed = _table(spark, sf, "lineitem").select(
        modulo_group(F.col("l_orderkey"), 100).alias("group_key"), "l_partkey"
    )
    return relational.group_mean(keyed, "group_key", "l_partkey").select(
        "group_key", F.round("l_partkey", 6).alias("mean_value")
    )


@registered("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
def segment_customers(spark: SparkSession, sf: str) -> DataFrame:
    chosen = relational.where_equal(_table(spark, sf, "customer"), c_mktsegment="BUILDING")
    return relational.columns(chosen, "c_custkey", "c_name", "c_acctbal")


@registered("SELECT count(*) AS row_count, count(DISTINCT l_partkey) AS parts FROM lineitem")
def row_and_distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    lines = _table(spark, sf, "lineitem")
    parts = relational.distinct_count(lines, "l_partkey", "parts").scalar()
    return relational.row_count(lines, "row_count").withColumn("parts", parts)


@registered(
    """SELECT o_orderkey, o_custkey, CAST(row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1
    AS BIGINT) AS row_index FROM orders"""
)
def orders_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """Ascending sort; the position in the sorted output shows the order."""
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return positions.with_row_index(
        orders, [F.col("o_custkey").asc_nulls_first(), F.col("o_orderkey").asc_nulls_first()]
    )


@registered("SELECT event_id, event_type, value FROM events")
def events_ordered(spark: SparkSession, sf: str) -> DataFrame:
    events = _table(spark, sf, "events").select("event_id", "event_type", "value")
    return relational.ordered(events, "event_type", "event_id")


@registered(
    """SELECT o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (ORDER BY o_orderkey)
    BETWEEN (SELECT count(*) // 3 FROM orders) + 1 AND 2 * (SELECT count(*) // 3 FROM orders)"""
)
def middle_slice(spark: SparkSession, sf: str) -> DataFrame:
    """The second third of the orders by key."""
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    third = orders.count() // 3
    return positions.slice_rows(orders, ["o_orderkey"], third, third)


@registered(
    """SELECT user_segment AS segment, count(*) AS row_count, min(c_custkey) AS first_key
    FROM (SELECT c_mktsegment AS user_segment, c_custkey FROM customer) GROUP BY ALL"""
)
def split_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    """A frame split by key into one folder per value, then each part counted."""
    path = scratch_path(spark, "split")
    writes.write_partitioned(_table(spark, sf, "customer"), path, "c_mktsegment")
    parts = files.scan_partitioned(spark, path)
    return parts.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min("c_custkey").alias("first_key")
    )


@registered(
    """SELECT c_custkey AS account, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_acctbal FROM supplier"""
)
def concat_accounts(spark: SparkSession, sf: str) -> DataFrame:
    customers = _table(spark, sf, "customer").select(
        F.col("c_custkey").alias("account"), F.col("c_acctbal").alias("balance")
    )
    suppliers = _table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("account"), F.col("s_acctbal").alias("balance")
    )
    return relational.concat_rows(customers, suppliers)


@registered(
    """SELECT c_custkey AS account, c_mktsegment AS segment, NULL AS nation FROM customer
    UNION ALL SELECT s_suppkey, NULL, s_nationkey FROM supplier"""
)
def concat_evolving_accounts(spark: SparkSession, sf: str) -> DataFrame:
    customers = _table(spark, sf, "customer").select(
        F.col("c_custkey").alias("account"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = _table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("account"), F.col("s_nationkey").alias("nation")
    )
    return relational.concat_evolving(customers, suppliers)


@registered(
    """SELECT o_orderkey FROM orders WHERE NOT EXISTS
    (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
)
def orders_without_lines(spark: SparkSession, sf: str) -> DataFrame:
    return relational.set_difference(
        _table(spark, sf, "orders"), _table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey"
    )


_DRAWN = pick_sql("o_orderkey", derived.SEED, "(SELECT count(*) FROM customer)")


@registered(
    f"""SELECT o_orderkey AS draw, 'customer' || drawn AS customer,
    'Processed customer' || drawn AS outcome FROM (SELECT o_orderkey, {_DRAWN} AS drawn FROM orders)"""
)
def processed_customers(spark: SparkSession, sf: str) -> DataFrame:
    """A customer drawn with replacement for every order, and its processing text."""
    population = relational.row_count(_table(spark, sf, "customer")).scalar()
    drawn = derived.draws(_table(spark, sf, "orders"), "o_orderkey", population)
    named = drawn.select("draw", labelled("customer", F.col("drawn")).alias("customer"))
    return named.withColumn("outcome", labelled("Processed ", F.col("customer")))


def _pick_from_sql(values: tuple[str, ...], seed: int) -> str:
    names = ", ".join(f"'{v}'" for v in values)
    return f"([{names}])[{pick_sql('o_orderkey', seed, len(values))} + 1]"


_REGION = _pick_from_sql(derived.REGIONS, derived.SEED)
_SEGMENT = _pick_from_sql(derived.SEGMENTS, derived.SEED + 1)


@registered(
    f"""SELECT {_REGION} AS region, {_SEGMENT} AS user_segment, count(*) AS row_count,
    round(avg(o_orderkey * 2 % 10000), 6) AS mean_value,
    CAST(max(TIMESTAMP '2024-01-01' + to_seconds(o_orderkey * greatest(1,
        31536000 // (SELECT count(*) FROM orders)))) AS VARCHAR) AS last_time
    FROM orders GROUP BY 1, 2"""
)
def sales_by_region(spark: SparkSession, sf: str) -> DataFrame:
    """The synthetic sales table over the order keys, averaged by region and segment."""
    orders = _table(spark, sf, "orders")
    sales = derived.sales_columns(orders, "o_orderkey", relational.row_count(orders).scalar())
    return sales.groupBy("region", "user_segment").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.round(F.avg("value"), 6).alias("mean_value"),
        F.max("timestamp").cast("string").alias("last_time"),
    )


# Storage layouts


@registered(
    """SELECT o_orderstatus, round(avg(o_totalprice), 6) AS mean_price, count(*) AS row_count
    FROM orders GROUP BY o_orderstatus"""
)
def multi_file_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in thirty batch folders (three statuses in ten key ranges), read in one scan."""
    orders = _table(spark, sf, "orders")
    path = scratch_path(spark, "batches")
    low = orders.agg(F.min("o_orderkey")).scalar()
    high = orders.agg(F.max("o_orderkey")).scalar()
    batch = positions.range_slice(F.col("o_orderkey"), low, high, 10)
    named = orders.withColumn("batch", F.concat_ws("_", "o_orderstatus", batch))
    writes.write_partitioned(named, path, "batch")
    stored = files.scan_files(spark, path, orders.schema)
    return stored.groupBy("o_orderstatus").agg(
        F.round(F.avg("o_totalprice"), 6).alias("mean_price"), F.count(F.lit(1)).alias("row_count")
    )


@registered(
    "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY'"
)
def partition_pruned_read(spark: SparkSession, sf: str) -> DataFrame:
    customers = _table(spark, sf, "customer")
    path = scratch_path(spark, "partitioned")
    writes.write_partitioned(customers, path, "c_mktsegment")
    one = files.scan_partitioned(spark, path, customers.schema, c_mktsegment="MACHINERY")
    return one.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@registered(
    """SELECT layout, (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING') AS rows_read
    FROM (VALUES ('flat'), ('partitioned')) AS layouts(layout)"""
)
def layout_comparison(spark: SparkSession, sf: str) -> DataFrame:
    compared = compare.compare_layouts(
        _table(spark, sf, "customer"), scratch_path(spark, "layouts"), "c_mktsegment", "BUILDING"
    )
    return compared.select("layout", "rows_read")


@registered(
    """SELECT codec, CAST(place AS INT) AS place, count(*) > 0 AS stored, true AS timed
    FROM lineitem, (VALUES ('gzip', 1), ('snappy', 2), ('uncompressed', 3)) AS c(codec, place) GROUP BY codec, place"""
)
def codec_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """The codecs by size of the stored order lines, the smallest first."""
    sizes = compare.compare_codecs(_table(spark, sf, "lineitem"), scratch_path(spark, "codecs"))
    return sizes.select(
        "codec",
        F.rank().over(Window.orderBy("bytes")).alias("place"),
        (F.col("files") > 0).alias("stored"),
        ((F.col("write_seconds") > 0) & (F.col("read_seconds") > 0)).alias("timed"),
    )


@registered(
    """SELECT codec, count(*) AS row_count, CAST(sum(l_partkey) AS BIGINT) AS part_sum FROM lineitem,
    (VALUES ('uncompressed'), ('snappy'), ('gzip')) AS codecs(codec) GROUP BY codec"""
)
def codec_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "codecs")
    for name in writes.CODECS:
        writes.write_parquet(_table(spark, sf, "lineitem"), f"{folder}/{name}", name)
    stored = files.scan_parquet(spark, f"{folder}/*")
    codec = F.regexp_extract(F.col("_metadata.file_path"), r"/([a-z]+)/part-[^/]*$", 1)
    return stored.groupBy(codec.alias("codec")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("l_partkey").alias("part_sum")
    )


@registered(
    """SELECT CAST(count(DISTINCT c_mktsegment) AS BIGINT) AS files, CAST(sum(strlen(c_name) + 1) AS BIGINT) AS bytes FROM customer"""
)
def stored_size(spark: SparkSession, sf: str) -> DataFrame:
    """Files and bytes of the customers' names as text lines, one file per segment."""
    path = scratch_path(spark, "lines")
    names = _table(spark, sf, "customer").select("c_mktsegment", F.col("c_name").alias("value"))
    names.repartition("c_mktsegment").write.partitionBy("c_mktsegment").text(path)
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True).load(path)
    return dataset_size(stored.select("path", "length"))


@registered(
    """SELECT layout, CASE layout WHEN 'flat' THEN 1 ELSE count(DISTINCT c_mktsegment) END AS folders,
    count(*) FILTER (c_mktsegment = 'BUILDING') AS rows_read, true AS has_bytes
    FROM customer, (VALUES ('flat'), ('partitioned')) AS layouts(layout) GROUP BY layout"""
)
def layout_files(spark: SparkSession, sf: str) -> DataFrame:
    """Folders of a flat and of a partitioned layout, written in parallel."""
    path = scratch_path(spark, "layouts")
    compared = compare.compare_layouts(_table(spark, sf, "customer"), path, "c_mktsegment", "BUILDING")
    stored = dataset_files(spark, f"{path}/flat", f"{path}/partitioned")
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    layout = F.regexp_extract("path", r"/(flat|partitioned)/(?:c_mktsegment=[^/]*/)?[^/]*$", 1)
    folders = stored.groupBy(layout.alias("layout")).agg(F.countDistinct(folder).alias("folders"))
    return compared.join(folders, "layout").select("layout", "folders", "rows_read", (F.col("bytes") > 0).alias("has_bytes"))


@registered(
    """SELECT fact, CAST(count(*) > 0 AS BOOLEAN) AS holds FROM orders, (VALUES ('filter in the scan'), ('one exchange'),
    ('partial aggregate'), ('two columns read')) AS f(fact) GROUP BY fact"""
)
def plan_facts(spark: SparkSession, sf: str) -> DataFrame:
    """What the plan of a filtered group mean over the orders shows, as rows."""
    means = relational.filtered_group_mean(_table(spark, sf, "orders"), "o_totalprice", 1000, "o_orderstatus", "o_totalprice", 0)
    text = explain.plan_text(means, "formatted")
    facts = {
        "filter in the scan": "GreaterThan(o_totalprice" in text,
        "one exchange": text.count("Arguments: hashpartitioning") == 1,
        "partial aggregate": "partial_avg" in text,
        "two columns read": "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in text,
    }
    return spark.createDataFrame(list(facts.items()), "fact string, holds boolean")


@registered(
    """SELECT approach, CASE approach WHEN 'append' THEN n + n // 5 ELSE n END AS row_count,
    CASE approach WHEN 'append' THEN n ELSE 0 END AS rows_without_column
    FROM (SELECT count(*) AS n FROM orders), (VALUES ('append'), ('rewrite')) AS a(approach)"""
)
def evolution_comparison(spark: SparkSession, sf: str) -> DataFrame:
    orders = _table(spark, sf, "orders")
    added = positions.first_rows(orders, ["o_orderkey"], orders.count() // 5)
    compared = compare.compare_evolution(
        orders, added, "new_metric", 0.0, scratch_path(spark, "evolution")
    )
    return compared.select("approach", F.col("rows").alias("row_count"), "rows_without_column")


# Versioned tables


@registered(
    """SELECT o_orderkey, o_totalprice, CAST(NULL AS DOUBLE) AS new_metric FROM orders
    UNION ALL SELECT o_orderkey, o_totalprice, 0.0 FROM orders
    QUALIFY row_number() OVER (ORDER BY o_orderkey) <= (SELECT count(*) // 5 FROM orders)"""
)
def schema_evolved_read(spark: SparkSession, sf: str) -> DataFrame:
    """All orders, then the first fifth once more with a new column."""
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    path = scratch_path(spark, "evolved")
    table.write_table(orders, path, "overwrite")
    again = positions.first_rows(orders, ["o_orderkey"], orders.count() // 5)
    table.write_table(relational.with_literal(again, "new_metric", 0.0), path, merge_schema=True)
    return table.read_table(spark, path)


_BATCHES = 3
_BATCH_SQL = f"""(SELECT *, coalesce(CAST(floor((o_orderkey - low) * {_BATCHES} / (high - low + 1)) AS BIGINT), 0) AS batch
    FROM orders, (SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders))"""


def _order_batches(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Orders in equal key ranges; orders are scanned once and none is left out."""
    orders = _table(spark, sf, "orders")
    ends = orders.agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")).first()
    batch = positions.range_slice(F.col("o_orderkey"), F.lit(ends["low"]), F.lit(ends["high"]), _BATCHES)
    parted = scratch_path(spark, "order-batches")
    writes.write_partitioned(orders.withColumn("batch", F.coalesce(batch, F.lit(0))), parted, "batch")
    stored = spark.read.schema(T.StructType([*orders.schema, T.StructField("batch", T.IntegerType())])).parquet(parted)
    return [stored.filter(F.col("batch") == i).drop("batch") for i in range(_BATCHES)]


def _orders_in_batches(spark: SparkSession, sf: str) -> str:
    """A table of orders in commits of equal key ranges."""
    path = scratch_path(spark, "orders")
    jobs.append_batches(_order_batches(spark, sf), path)
    return path


@registered(f"SELECT o_orderkey, o_custkey, o_totalprice FROM {_BATCH_SQL} WHERE batch < 2")
def time_travel_read(spark: SparkSession, sf: str) -> DataFrame:
    """Orders appended range by range, read as of the second commit."""
    return table.read_table(spark, _orders_in_batches(spark, sf), version=1).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@registered(
    f"""SELECT batch AS version, CASE WHEN batch = 0 THEN 'overwrite' ELSE 'append' END AS operation,
    count(*) AS row_count, CAST(sum(count(*)) OVER (ORDER BY batch) AS BIGINT) AS total_rows FROM {_BATCH_SQL} GROUP BY batch"""
)
def table_history(spark: SparkSession, sf: str) -> DataFrame:
    return table.history(spark, _orders_in_batches(spark, sf)).select(
        "version", "operation", F.col("rows").alias("row_count"), "total_rows"
    )


@registered(
    """SELECT o_orderstatus, round(avg(o_totalprice), 6) AS mean_price FROM orders
    GROUP BY o_orderstatus"""
)
def compacted_mean(spark: SparkSession, sf: str) -> DataFrame:
    path = _orders_in_batches(spark, sf)
    table.compact(spark, path)
    means = relational.group_mean(table.read_table(spark, path), "o_orderstatus", "o_totalprice")
    return means.select("o_orderstatus", F.round("o_totalprice", 6).alias("mean_price"))


@registered(
    """SELECT (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM orders) AS row_count,
    ((SELECT sum(l_orderkey) FROM lineitem) + (SELECT sum(o_orderkey) FROM orders))::BIGINT AS key_sum,
    true AS fewer_files, true AS large_untouched"""
)
def packed_small_files(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of line items in one commit and of orders in a few of smaller files: packing rewrites the small ones alone."""
    path = scratch_path(spark, "packing")
    table.write_table(_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_shipdate").alias("at")), path)
    size = table.live_files(spark, path).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("length").alias("largest")).first()
    large = size["bytes"]
    for batch in _order_batches(spark, sf):
        # As many files as the large commit has, and so smaller ones.
        orders = batch.select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("at")).repartition(size["files"])
        table.write_table(orders, path)
    # Of a file of more than half this size the large commit is left alone; a packed file grows with that file, not with the table.
    done = packing.pack_small(spark, path, target_bytes=2 * size["largest"] - 1)
    rows = table.read_table(spark, path).agg(F.count(F.lit(1)).alias("row_count"), F.sum("key").alias("key_sum"))
    return rows.withColumns(
        {"fewer_files": F.lit(done.files_after < done.files_before), "large_untouched": F.lit(done.bytes_untouched == large)}
    )


_PLANTED = """(SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS customer_key,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS amount, o_totalprice FROM orders)"""
_ORDER_LINE = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("customer_key", T.LongType()),
        T.StructField("amount", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
    ]
)


def _split_orders(spark: SparkSession, sf: str) -> split.Split:
    """Orders with planted faults: unknown customers, amounts that are no number, and prices out of range."""
    orders = _table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer_key"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("amount"),
        "o_totalprice",
    )
    checks = {"o_totalprice: out of range": F.col("o_totalprice") < 300_000}
    return split.split_write(orders, scratch_path(spark, "split"), _ORDER_LINE, ["o_orderkey", "customer_key"], checks)


@registered(
    f"""SELECT o_orderkey, customer_key, CAST(amount AS BIGINT) AS amount, o_totalprice FROM {_PLANTED}
    WHERE customer_key IS NOT NULL AND amount <> 'n/a' AND o_totalprice < 300000"""
)
def split_write_accepted(spark: SparkSession, sf: str) -> DataFrame:
    return split.accepted_rows(spark, _split_orders(spark, sf).path, _ORDER_LINE)


@registered(
    f"""SELECT reasons, count(*) AS row_count, sum(o_orderkey)::BIGINT AS key_sum FROM (SELECT *, concat_ws('; ',
    CASE WHEN customer_key IS NULL THEN 'customer_key: null in a required column' END,
    CASE WHEN amount = 'n/a' THEN 'amount: not a bigint' END,
    CASE WHEN o_totalprice >= 300000 THEN 'o_totalprice: out of range' END) AS reasons FROM {_PLANTED}) WHERE reasons <> '' GROUP BY reasons"""
)
def split_write_refused(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows were refused for which reasons, and their keys from the rows as they came."""
    rows = split.refused_rows(spark, _split_orders(spark, sf).path)
    key = F.get_json_object("original", "$.o_orderkey").cast("long")
    return rows.groupBy(F.array_join("reasons", "; ").alias("reasons")).agg(F.count(F.lit(1)).alias("row_count"), F.sum(key).alias("key_sum"))


@registered(
    """SELECT attempt, problems, CAST(0 AS BIGINT) AS version_after, (SELECT count(*) FROM orders) AS rows_after
    FROM (VALUES ('renamed column', 'schema mismatch: amount: not in the table; o_totalprice: missing'),
    ('wrong type', 'schema mismatch: o_totalprice: string does not fit double'), ('missing column', 'schema mismatch: o_totalprice: missing'))
    AS refused(attempt, problems)"""
)
def refused_writes(spark: SparkSession, sf: str) -> DataFrame:
    """Writes that a table must refuse: what was wrong, and that version and rows are as before."""
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    path = scratch_path(spark, "refusing")
    table.write_table(orders, path)
    attempts = {
        "renamed column": orders.withColumnRenamed("o_totalprice", "amount"),
        "wrong type": orders.withColumn("o_totalprice", F.col("o_totalprice").cast("string")),
        "missing column": orders.select("o_orderkey"),
    }
    seen = []
    for name, bad in attempts.items():
        record = quality.outcome(lambda bad=bad: table.write_table(bad, path))
        seen.append((name, record.get("error"), table.current_version(spark, path)))
    report = spark.createDataFrame(seen, "attempt string, problems string, version_after long")
    return report.join(table.read_table(spark, path).agg(F.count(F.lit(1)).alias("rows_after")), how="full")


@registered(
    """SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def upsert_latest_event(spark: SparkSession, sf: str) -> DataFrame:
    """Latest event per user, from a table of the first half month and a batch of the second."""
    events = _table(spark, sf, "events")
    path = scratch_path(spark, "upsert")
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    # The later half first: the second batch is older throughout, and unknown times are in it too.
    later = F.coalesce(F.col("ts") >= middle, F.lit(False))
    for half in (later, ~later):
        table.upsert(events.filter(half), path, ["user_id"], ["ts", "event_id"])
    return table.read_table(spark, path).select("user_id", "event_id", "event_type", "value")


def _mixed_upserts(spark: SparkSession, sf: str) -> str:
    """Messages by user: first the events of the middle of the month, then a batch of all events.

    The batch holds older, equal and newer rows of the keys in the table, and new keys.
    """
    events = _table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("message_id"),
        F.lit(0).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("partition_id"),
        epoch_seconds(F.col("ts")).alias("created_at"),
        F.col("event_id").alias("arrival_index"),
        "event_type",
    )
    path = scratch_path(spark, "mixed-upserts")
    begin, end = (epoch_seconds(F.lit(f"2024-01-{day} 00:00:00").cast("timestamp_ntz")) for day in ("10", "20"))
    middle = F.coalesce(F.col("created_at").between(begin, end), F.lit(False))
    table.upsert(events.filter(middle), path, with_hash=True)
    table.upsert(events, path, with_hash=True)
    return path


_UPSERT_INPUT = """WITH first AS (SELECT * FROM events WHERE ts BETWEEN '2024-01-10' AND '2024-01-20'),
    second AS (SELECT * FROM events),
    either AS (SELECT * FROM first UNION SELECT * FROM second)
"""


@registered(
    _UPSERT_INPUT
    + """SELECT CAST(user_id AS VARCHAR) AS message_id, event_id AS arrival_index, event_type,
    sha256(concat_ws('|', CAST(user_id AS VARCHAR), 0, 0)) AS composite_hash FROM either
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def upsert_older_loses(spark: SparkSession, sf: str) -> DataFrame:
    return table.read_table(spark, _mixed_upserts(spark, sf)).select(
        "message_id", "arrival_index", "event_type", "composite_hash"
    )


@registered(
    _UPSERT_INPUT
    + """, counts AS (SELECT (SELECT count(*) FROM first) AS a, (SELECT count(*) FROM second) AS b,
    (SELECT count(DISTINCT user_id) FROM first) AS k, (SELECT count(DISTINCT user_id) FROM either) AS m)
    SELECT CAST(0 AS BIGINT) AS version, a AS initial_records, CAST(0 AS BIGINT) AS existing_rows, k AS rows_in_table,
    a - k AS merged_duplicates FROM counts
    UNION ALL SELECT 1, b, k, m, b + k - m FROM counts"""
)
def upsert_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return table.merge_metrics(spark, _mixed_upserts(spark, sf))


# CSV and JSON Lines


_CSV = T.StructType(
    [
        T.StructField("order_key", T.LongType()),
        T.StructField("priority", T.StringType()),
        T.StructField("customer_key", T.LongType()),
    ]
)
_CSV_SQL = """SELECT o_orderkey AS order_key, o_orderpriority AS priority,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS customer_key FROM orders"""


def _ragged_csv(spark: SparkSession, sf: str) -> str:
    """Orders as CSV lines: too long where status is F, too short where it is P."""
    full = ["o_orderkey", "o_orderpriority", "o_custkey"]
    line = (
        F.when(F.col("o_orderstatus") == "F", F.concat_ws(",", *full, F.lit("surplus")))
        .when(F.col("o_orderstatus") == "P", F.concat_ws(",", *full[:2]))
        .otherwise(F.concat_ws(",", *full))
    )
    path = scratch_path(spark, "ragged-csv")
    _table(spark, sf, "orders").select(line.alias("value")).write.text(path)
    return path


@registered(_CSV_SQL)
def csv_ragged_read(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_csv(spark, _ragged_csv(spark, sf), _CSV, header=False)


@registered(
    """SELECT count(*) AS lines, count(*) FILTER (o_orderstatus IN ('F', 'P')) AS ragged,
    count(o_orderkey) AS order_key_present, count(o_orderpriority) AS priority_present,
    count(o_custkey) FILTER (o_orderstatus <> 'P') AS customer_key_present FROM orders"""
)
def csv_quality(spark: SparkSession, sf: str) -> DataFrame:
    return files.csv_quality(spark, _ragged_csv(spark, sf), _CSV, header=False)


@registered(_CSV_SQL)
def csv_to_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv-table")
    jobs.csv_to_table(spark, _ragged_csv(spark, sf), path, _CSV, header=False)
    return table.read_table(spark, path)


@registered(
    """SELECT o_orderkey AS order_key, o_orderpriority AS priority, o_totalprice AS price FROM orders"""
)
def csv_header_to_table(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as CSV with a header and inferred types, written to a table."""
    source, path = scratch_path(spark, "header-csv"), scratch_path(spark, "csv-table")
    orders = _table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price")
    )
    orders.write.option("header", True).csv(source)
    jobs.csv_to_table(spark, source, path)
    return table.read_table(spark, path).select(F.col("order_key").cast("long").alias("order_key"), "priority", "price")


@registered(
    """SELECT column_name, column_type FROM (VALUES ('order_key', 'int'), ('priority', 'string'), ('price', 'double'))
    AS t(column_name, column_type) WHERE (SELECT count(*) FROM orders) > 0"""
)
def csv_inferred_types(spark: SparkSession, sf: str) -> DataFrame:
    source = scratch_path(spark, "header-csv")
    _table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price")
    ).write.option("header", True).csv(source)
    return quality.schema_report(files.read_csv(spark, source)).select("column_name", "column_type")


_FEED_JSON = T.StructType(
    [
        T.StructField("event", T.StringType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("partition_id", T.LongType()),
        T.StructField("created_at", T.DoubleType()),
        T.StructField("arrival_ts", T.DoubleType()),
        T.StructField("arrival_index", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _feed_jsonl(spark: SparkSession, sf: str) -> tuple[str, int]:
    """The feed as JSON Lines files of consecutive arrivals, and their number."""
    path = scratch_path(spark, "feed-jsonl")
    files_written = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _feed(spark, sf).select(*_FEED_JSON.names)
    ranged = rows.repartitionByRange(files_written, "arrival_index")
    ranged.sortWithinPartitions("arrival_index").write.json(path)
    return path, files_written


def _feed_stream(spark: SparkSession, sf: str, batches: int = 1) -> DataFrame:
    """The feed as a stream of about ``batches`` micro-batches, each read by many tasks."""
    path, count = _feed_jsonl(spark, sf)
    return streams.read_message_stream(
        spark, path, _FEED_JSON, files_per_batch=max(1, count // batches)
    )


@registered(
    _FEED
    + """SELECT 'message_received' AS event, message_id, sequence_id, partition_id, created_at,
    arrival_ts, arrival_index, event_type, value FROM feed"""
)
def jsonl_read(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_jsonl(spark, _feed_jsonl(spark, sf)[0], _FEED_JSON)


@registered("SELECT count(*) AS row_count, max(CAST(ts AS DATE))::VARCHAR AS newest FROM events "
            "WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def latest_feed_file(spark: SparkSession, sf: str) -> DataFrame:
    """Events as one JSON Lines folder per day; the newest by name is found and read."""
    events = _table(spark, sf, "events")
    path = scratch_path(spark, "daily")
    dated = events.select("event_id", "ts", F.to_date("ts").cast("string").alias("day"))
    dated.hint("rebalance", F.col("day")).write.partitionBy("day").json(path)
    newest = files.latest_path(spark, f"{path}/day=*")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    return files.read_jsonl(spark, newest, schema).agg(
        F.count(F.lit(1)).alias("row_count"), F.max(F.to_date("ts")).cast("string").alias("newest")
    )


@registered(
    _FEED + """SELECT message_id, arrival_index, CAST(row_number() OVER (ORDER BY arrival_index) AS
    BIGINT) AS dense_index FROM feed"""
)
def arrival_stamping(spark: SparkSession, sf: str) -> DataFrame:
    """Gap-free arrival numbers over a feed stored as files."""
    received = files.read_jsonl(spark, _feed_jsonl(spark, sf)[0], _FEED_JSON)
    numbered = positions.with_row_index(
        received.select("message_id", "arrival_index"), ["arrival_index"], "_index"
    )
    return numbered.select(
        "message_id", "arrival_index", (F.col("_index") + 1).alias("dense_index")
    )


@registered(
    _FEED + """SELECT message_id, CAST(row_number() OVER (ORDER BY arrival_index) AS BIGINT) AS stamped_index,
    true AS stamped FROM feed"""
)
def arrival_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """Arrival numbers from the files' order and the rows' places in them, with the clock's time."""
    path = scratch_path(spark, "arriving")
    rows = _feed(spark, sf).select("message_id", F.col("arrival_index").alias("sent"))
    rows.repartitionByRange(4, "sent").sortWithinPartitions("sent").write.json(path)
    received = spark.read.schema("message_id string, sent long").json(path)
    # All files are of one moment here, so that the order is that of names and places.
    stamped = streams.with_arrival(received).withColumn("arrival_order", F.col("arrival_order").dropFields("file_time"))
    return streams.with_arrival_index(stamped).select(
        "message_id", F.col("arrival_index").alias("stamped_index"), F.col("arrival_ts").isNotNull().alias("stamped")
    )


# Message feed


@registered(
    _FEED + f"SELECT message_id, arrival_index, {_HASH} AS composite_hash FROM feed"
)
def composite_hash(spark: SparkSession, sf: str) -> DataFrame:
    return _feed(spark, sf).select(
        "message_id", "arrival_index", composite_key().alias("composite_hash")
    )


@registered(
    _FEED
    + """SELECT message_id, arrival_index,
    sha256(message_id || sequence_id || partition_id) AS composite_hash FROM feed"""
)
def composite_hash_run_together(spark: SparkSession, sf: str) -> DataFrame:
    return _feed(spark, sf).select(
        "message_id", "arrival_index", composite_key(separator="").alias("composite_hash")
    )


@registered("SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS partition_date FROM events")
def epoch_dates(spark: SparkSession, sf: str) -> DataFrame:
    seconds = epoch_seconds(F.col("ts"))
    return _table(spark, sf, "events").select(
        "event_id", epoch_date(seconds).cast("string").alias("partition_date")
    )


@registered(
    _FEED
    + f"""SELECT message_id, arrival_index, {_HASH} AS composite_hash,
    sha256('{{"event_type":"' || event_type || '","message_id":"' || message_id
        || '","partition_id":' || partition_id || ',"props":"' || replace(props, '"', '\\"')
        || '","sequence_id":' || sequence_id || ',"user_id":' || user_id || ',"value":' || value
        || '}}') AS payload_hash,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS partition_date FROM feed"""
)
def bronze_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.add_hashes(_feed(spark, sf), _PAYLOAD).select(
        "message_id",
        "arrival_index",
        "composite_hash",
        "payload_hash",
        F.col("partition_date").cast("string").alias("partition_date"),
    )


@registered(
    _FEED
    + """SELECT count(*) AS total_records,
    count(DISTINCT (message_id, sequence_id, partition_id)) AS unique_composite_keys,
    count(DISTINCT (message_id, sequence_id, partition_id, event_type, props, user_id, value))
        AS unique_payloads,
    count(*) - count(DISTINCT (message_id, sequence_id, partition_id)) AS potential_duplicates
    FROM feed"""
)
def bronze_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.bronze_metrics(dedup.add_hashes(_feed(spark, sf), _PAYLOAD))


@registered(
    _FEED
    + """SELECT count(*) AS total_records,
    count(DISTINCT (message_id, sequence_id, partition_id)) AS unique_composite_keys,
    count(DISTINCT (message_id, sequence_id, partition_id, event_type, props, user_id, value))
        AS unique_payloads,
    count(*) - count(DISTINCT (message_id, sequence_id, partition_id)) AS potential_duplicates
    FROM feed"""
)
def bronze_metrics_by_date(spark: SparkSession, sf: str) -> DataFrame:
    """The same metrics from partials per date, brought up to date in three increments of which each reads its own dates."""
    bronze = table.read_table(spark, _stored_bronze(spark, sf))
    path = scratch_path(spark, "metrics")
    # One row per date of the table's directories.
    dates = sorted(row[0] for row in bronze.select("partition_date").distinct().collect())
    for part in range(3):
        history.refresh_metrics(bronze, path, dates[part::3])
    return history.stored_metrics(spark, path)


# Users as message ids: one key, many events, many payloads.
def _reused(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("message_id"),
        F.lit(0).cast("long").alias("sequence_id"),
        (F.col("user_id") % 3).alias("partition_id"),
        "event_type",
        epoch_seconds(F.col("ts")).alias("created_at"),
        F.col("event_id").alias("arrival_index"),
    )


_REUSED = """WITH reused AS (SELECT CAST(user_id AS VARCHAR) AS message_id, 0 AS sequence_id,
    user_id % 3 AS partition_id, event_type, event_id FROM events)
"""


@registered(
    """WITH runs AS (SELECT user_id, event_type, ts, event_id,
        sum(CASE WHEN before = event_type THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run
        FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
    ), states AS (SELECT user_id, run, min(event_type) AS event_type, min(epoch_us(ts) / 1e6) AS valid_from, count(*) AS deliveries
        FROM runs GROUP BY user_id, run)
    SELECT CAST(user_id AS VARCHAR) AS message_id, event_type, valid_from,
        lead(valid_from) OVER (PARTITION BY user_id ORDER BY run) AS valid_to, deliveries FROM states"""
)
def payload_history(spark: SparkSession, sf: str) -> DataFrame:
    """From when to when each event type of a user was the last one said."""
    return history.payload_history(_reused(spark, sf), ["message_id"], "event_type")


@registered(
    _REUSED
    + f"""SELECT {_HASH} AS composite_hash, count(*) AS deliveries,
    count(DISTINCT event_type) AS payloads FROM reused
    GROUP BY message_id, sequence_id, partition_id HAVING count(DISTINCT event_type) > 1"""
)
def reused_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that came with different payloads."""
    return dedup.changed_payloads(dedup.add_hashes(_reused(spark, sf), ["event_type"]))


@registered(
    _FEED
    + f"""SELECT deliveries, payloads, count(*) AS keys FROM (SELECT {_HASH} AS composite_hash,
    count(*) AS deliveries, count(DISTINCT (event_type, props, user_id, value)) AS payloads
    FROM feed GROUP BY 1) GROUP BY ALL"""
)
def payload_hash_groups(spark: SparkSession, sf: str) -> DataFrame:
    """How many keys were delivered how often with how many payloads."""
    profile = dedup.key_profile(dedup.add_hashes(_feed(spark, sf), _PAYLOAD))
    return profile.groupBy("deliveries", "payloads").agg(F.count(F.lit(1)).alias("keys"))


_FIRST = f"""SELECT message_id, sequence_id, partition_id, arrival_index, {_HASH} AS composite_hash
    FROM feed QUALIFY row_number() OVER (PARTITION BY message_id, sequence_id, partition_id
    ORDER BY arrival_index) = 1"""


@registered(_FEED + _FIRST)
def eager_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.eager_dedup(_feed(spark, sf)).select(*_STORED)


@registered(
    _FEED
    + """SELECT n AS initial_records, k AS final_records, n - k AS dropped_duplicates,
    round((n - k) * 100.0 / n, 6) AS dedup_rate_percent FROM (SELECT count(*) AS n,
    count(DISTINCT (message_id, sequence_id, partition_id)) AS k FROM feed)"""
)
def eager_dedup_metrics(spark: SparkSession, sf: str) -> DataFrame:
    metrics = dedup.dedup_metrics(_feed(spark, sf))
    return metrics.withColumn("dedup_rate_percent", F.round("dedup_rate_percent", 6))


@registered(
    _FEED
    + f"""SELECT message_id, sequence_id, partition_id, arrival_index, {_HASH} AS composite_hash
    FROM feed QUALIFY row_number() OVER (PARTITION BY message_id
    ORDER BY created_at DESC, arrival_index DESC) = 1"""
)
def latest_by_message(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.latest_by_message(_feed(spark, sf)).select(*_STORED)


@registered(
    """SELECT user_id, event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
)
def latest_by_user(spark: SparkSession, sf: str) -> DataFrame:
    """Last write wins over keys with many writes."""
    events = _table(spark, sf, "events")
    return dedup.keep_last(events, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type"
    )


def _stored_bronze(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "bronze")
    bronze = dedup.add_hashes(_feed(spark, sf), _PAYLOAD)
    table.write_table(bronze, path, partition_by=["partition_date"])
    return path


@registered(_FEED + _FIRST)
def silver_from_bronze(spark: SparkSession, sf: str) -> DataFrame:
    bronze = table.read_table(spark, _stored_bronze(spark, sf))
    return dedup.silver(bronze).select(*_STORED)


_BY_DATE = "SELECT message_id, arrival_index, CAST(CAST(ts AS DATE) AS VARCHAR) AS partition_date FROM feed"


def _by_date(rows: DataFrame) -> DataFrame:
    return rows.select(
        "message_id", "arrival_index", F.col("partition_date").cast("string").alias("partition_date")
    )


@registered(_FEED + _BY_DATE + " WHERE CAST(ts AS DATE) > DATE '2024-01-20'")
def bronze_new_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Only the dates after the last processed one."""
    bronze = table.read_table(spark, _stored_bronze(spark, sf))
    return _by_date(feed.dates_after(bronze, datetime.date(2024, 1, 20)))


@registered(_FEED + _BY_DATE + " WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def bronze_on_date(spark: SparkSession, sf: str) -> DataFrame:
    bronze = table.read_table(spark, _stored_bronze(spark, sf))
    return _by_date(feed.on_date(bronze, datetime.date(2024, 1, 15)))


@registered(
    _FEED + _BY_DATE + " WHERE CAST(ts AS DATE) NOT IN (DATE '2024-01-10', DATE '2024-01-11')"
)
def bronze_dates_dropped(spark: SparkSession, sf: str) -> DataFrame:
    path = _stored_bronze(spark, sf)
    table.drop_partitions(spark, path, [datetime.date(2024, 1, 10), datetime.date(2024, 1, 11)])
    return _by_date(table.read_table(spark, path))


@registered(
    _FEED
    + _BY_DATE
    + """ WHERE CAST(ts AS DATE) <> DATE '2024-01-15'
    UNION ALL SELECT message_id, min(arrival_index), CAST(CAST(ts AS DATE) AS VARCHAR) FROM feed
    WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY message_id, ts"""
)
def bronze_date_replaced(spark: SparkSession, sf: str) -> DataFrame:
    """One date put in place of itself after deduplication; the other dates are not rewritten."""
    path = _stored_bronze(spark, sf)
    day = feed.on_date(table.read_table(spark, path), datetime.date(2024, 1, 15))
    table.replace_partitions(dedup.silver(day), path)
    return _by_date(table.read_table(spark, path))


@registered(
    _LOSSY
    + """SELECT event_id AS sequence_id FROM events
    WHERE event_id NOT IN (SELECT sequence_id FROM feed)"""
)
def missing_sequences(spark: SparkSession, sf: str) -> DataFrame:
    produced = _table(spark, sf, "events").select(F.col("event_id").alias("sequence_id"))
    return feed.missing_sequences(produced, _feed(spark, sf, lose_every=97))


@registered(
    _LOSSY
    + """SELECT partition_id, before + 1 AS first_missing, sequence_id - 1 AS last_missing, sequence_id - before - 1 AS missing
    FROM (SELECT partition_id, sequence_id, lag(sequence_id) OVER (PARTITION BY partition_id ORDER BY sequence_id) AS before
    FROM (SELECT DISTINCT partition_id, sequence_id FROM feed
        UNION SELECT DISTINCT partition_id, -1 FROM feed UNION SELECT DISTINCT partition_id, 2000000000 FROM feed))
    WHERE sequence_id - before > 1"""
)
def missing_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of ids that each partition lacks, up to an end far beyond the last one; buckets so small that runs cross them."""
    return feed.missing_ranges(_feed(spark, sf, lose_every=97), ["partition_id"], 0, 1_999_999_999, bucket_ids=50)


@registered(
    _LOSSY
    + """SELECT (SELECT count(*) FROM events) AS total_produced, count(*) AS total_received,
    (SELECT count(*) FROM events WHERE event_id NOT IN (SELECT sequence_id FROM feed)) AS missing
    FROM feed"""
)
def feed_totals(spark: SparkSession, sf: str) -> DataFrame:
    produced = _table(spark, sf, "events").select(F.col("event_id").alias("sequence_id"))
    return feed.feed_totals(produced, _feed(spark, sf, lose_every=97))


@registered(
    _FEED
    + "SELECT sequence_id, count(*) AS deliveries FROM feed GROUP BY sequence_id HAVING count(*) > 1"
)
def duplicate_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return feed.duplicate_sequences(_feed(spark, sf))


_STEPS = """, steps AS (SELECT *, lag(sequence_id) OVER (PARTITION BY partition_id
    ORDER BY arrival_index) > sequence_id AS back FROM feed)
"""


@registered(
    _FEED
    + _STEPS
    + """SELECT partition_id, count(*) AS received, count(*) FILTER (back) AS steps_back,
    count(*) FILTER (back) > 0 AS out_of_order FROM steps GROUP BY partition_id"""
)
def out_of_order_by_partition(spark: SparkSession, sf: str) -> DataFrame:
    # Buckets so small that steps cross their borders.
    return feed.out_of_order(_feed(spark, sf), bucket_rows=500)


@registered(
    _FEED
    + """SELECT partition_id, string_agg(CAST(sequence_id AS VARCHAR), ',' ORDER BY arrival_index)
    FILTER (place <= 15) AS first_sequence_ids, max(place) > 15 AS more
    FROM (SELECT *, row_number() OVER (PARTITION BY partition_id ORDER BY arrival_index) AS place
    FROM feed) GROUP BY partition_id"""
)
def first_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    listed = feed.first_arrivals(_feed(spark, sf))
    ids = F.array_join(F.col("first_sequence_ids").cast("array<string>"), ",")
    return listed.withColumn("first_sequence_ids", ids)


@registered(
    _FEED
    + _STEPS
    + """SELECT partition_id, count(*) AS received, count(DISTINCT message_id) AS unique_messages,
    round((count(*) - count(DISTINCT message_id)) * 100.0 / count(*), 6) AS duplicate_percent,
    round(avg(arrival_ts - created_at), 6) AS mean_latency_s,
    round(max(arrival_ts - created_at), 6) AS max_latency_s,
    round(count(*) FILTER (back) * 100.0 / count(*), 6) AS out_of_order_percent
    FROM steps GROUP BY partition_id"""
)
def feed_quality(spark: SparkSession, sf: str) -> DataFrame:
    rounded = ["duplicate_percent", "mean_latency_s", "max_latency_s", "out_of_order_percent"]
    report = feed.feed_quality(_feed(spark, sf), bucket_rows=500)
    return report.withColumns({c: F.round(c, 6) for c in rounded})


@registered(
    _FEED
    + """SELECT partition_id, quantile, count(*) AS messages, round(min(latency), 6) AS min_latency_s,
    round(max(latency), 6) AS max_latency_s, true AS within_bound
    FROM (SELECT partition_id, arrival_ts + value - created_at AS latency FROM feed),
    (SELECT unnest([0.5, 0.95, 0.99])::DOUBLE AS quantile) GROUP BY partition_id, quantile"""
)
def latency_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Latency percentiles per partition from stored sketches per date, held against the exact ranks.

    The value of an event delays its delivery by as many seconds.
    """
    received = _feed(spark, sf).withColumn("arrival_ts", F.col("arrival_ts") + F.col("value"))
    path = writes.write_parquet(feed.latency_sketches(received), scratch_path(spark, "latency-sketches"))
    found = feed.latency_quantiles(spark.read.parquet(path))
    checked = feed.quantile_ranks(received, found)
    return checked.select(
        "partition_id",
        "quantile",
        "messages",
        F.round("min_latency_s", 6).alias("min_latency_s"),
        F.round("max_latency_s", 6).alias("max_latency_s"),
        (F.col("rank_error") <= feed.RANK_ERROR).alias("within_bound"),
    )


@registered(
    _FEED
    + """, counts AS (SELECT count(*) AS n, count(DISTINCT (message_id, sequence_id, partition_id))
    AS k, count(DISTINCT message_id) AS m FROM feed)
    SELECT strategy, records, round(records * 100.0 / n, 6) AS percent_of_input,
    records - k AS preserved_duplicates, round(records * 1.0 / k, 6) AS times_eager,
    k = m AS dedups_agree FROM (SELECT *, unnest(['eager_dedup', 'bronze_append',
    'merge_last_write', 'merge_table']) AS strategy, unnest([k, n, m, m]) AS records FROM counts)"""
)
def strategy_comparison(spark: SparkSession, sf: str) -> DataFrame:
    counts = compare.strategy_counts(_feed(spark, sf))
    return counts.withColumns(
        {c: F.round(c, 6) for c in ("percent_of_input", "times_eager")}
    )


@registered(
    _FEED
    + """, counts AS (SELECT count(*) AS n, count(DISTINCT (message_id, sequence_id, partition_id)) AS k,
    count(DISTINCT message_id) AS m FROM feed)
    SELECT strategy, records, n AS input_records, strategy = 'bronze_append' AS most_bytes, true AS has_rate
    FROM (SELECT *, unnest(['eager_dedup', 'bronze_append', 'merge_last_write', 'merge_table']) AS strategy,
    unnest([k, n, m, m]) AS records FROM counts)"""
)
def strategy_storage(spark: SparkSession, sf: str) -> DataFrame:
    """All four strategies run and stored: rows, and which one takes the most bytes."""
    source = writes.write_parquet(_feed(spark, sf), scratch_path(spark, "strategy-feed"))
    stored = compare.compare_strategies(spark.read.parquet(source), scratch_path(spark, "strategies"), _PAYLOAD)
    most = stored.agg(F.max("bytes")).first()[0]
    return stored.select(
        "strategy",
        "records",
        "input_records",
        (F.col("bytes") == F.lit(most)).alias("most_bytes"),
        (F.col("input_rows_per_second") > 0).alias("has_rate"),
    )


# Streams


_DISTINCT_KEYS = f"SELECT DISTINCT message_id, {_HASH} AS composite_hash FROM feed"


def _drain(spark: SparkSession, stream: DataFrame) -> DataFrame:
    sink = scratch_path(spark, "stream-out")
    streams.append_available(stream, sink, scratch_path(spark, "stream-state"))
    return spark.read.schema(stream.schema).parquet(sink)


@registered(_FEED + _DISTINCT_KEYS)
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The unbounded filter over a stream of feed files in four micro-batches: redeliveries cross them."""
    stream = _feed_stream(spark, sf, batches=4)
    return _drain(spark, streams.drop_seen(stream)).select("message_id", "composite_hash")


_DELAY_SECONDS = 260_011


@registered(
    _FEED
    + f""", held AS (SELECT *, sequence_id % 50 = 7 AS withheld FROM feed)
    SELECT DISTINCT message_id, {_HASH} AS composite_hash FROM held
    WHERE NOT withheld OR created_at > (SELECT max(created_at) FROM held WHERE NOT withheld) - {_DELAY_SECONDS}"""
)
def stream_dedup_bounded(spark: SparkSession, sf: str) -> DataFrame:
    """The filter with expiring state. Redeliveries come in time; withheld messages come last, most of them too late.

    The delay is a tenth of the feed's time, so state expires. The stream is restarted for the late ones.
    """
    rows = _feed(spark, sf).select(*_FEED_JSON.names)
    withheld = F.coalesce(F.col("sequence_id") % 50 == 7, F.lit(False))
    folder, sink, state = (scratch_path(spark, label) for label in ("late-feed", "stream-out", "stream-state"))
    for part, count in ((~withheld, 4), (withheld, 1)):
        rows.filter(part).repartitionByRange(count, "arrival_index").sortWithinPartitions("arrival_index").write.mode("append").json(folder)
        stream = streams.read_message_stream(spark, folder, _FEED_JSON, files_per_batch=2)
        kept = streams.drop_seen_within(stream, f"{_DELAY_SECONDS} seconds")
        streams.append_available(kept, sink, state)
    return spark.read.schema(kept.schema).parquet(sink).select("message_id", "composite_hash")


def _two_deliveries(spark: SparkSession, sf: str, path: str, filters: Marks | None = None) -> None:
    """First arrivals to a table, from files that come in as two deliveries; the stream is restarted for the second."""
    rows = _feed(spark, sf).select(*_FEED_JSON.names)
    middle = F.lit(rows.agg(F.avg("arrival_index")).first()[0])
    folder, state = scratch_path(spark, "deliveries"), scratch_path(spark, "stream-state")
    early = F.coalesce(F.col("arrival_index") < middle, F.lit(False))
    for delivery in (early, ~early):
        rows.filter(delivery).write.mode("append").json(folder)
        stream = streams.read_message_stream(spark, folder, _FEED_JSON)
        streams.first_arrival_stream(stream, path, state, marks=filters)


@registered(_FEED + _FIRST)
def stream_first_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """First arrival of every key in a table, from files that come in as two deliveries.

    The stream is restarted from its checkpoint for the second.
    """
    path = scratch_path(spark, "stream-table")
    _two_deliveries(spark, sf, path)
    return table.read_table(spark, path).select(*_STORED)


@registered(_FEED + _FIRST)
def stream_first_arrivals_marked(spark: SparkSession, sf: str) -> DataFrame:
    """The same, where Bloom filters beside the table tell which of its buckets to open."""
    path = scratch_path(spark, "stream-table")
    _two_deliveries(spark, sf, path, Marks(scratch_path(spark, "marks")))
    return table.read_table(spark, path).select(*_STORED)


@registered(
    _FEED
    + """, half AS (SELECT message_id, sequence_id, partition_id,
    min(arrival_index) < (SELECT avg(arrival_index) FROM feed) AS early,
    max(arrival_index) >= (SELECT avg(arrival_index) FROM feed) AS late FROM feed GROUP BY ALL)
    SELECT count(*) AS keys, count(*) FILTER (NOT early) AS new_keys FROM half WHERE late"""
)
def stream_marks_report(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of the second delivery and those that the table didn't hold, as the batch reports them."""
    path, filters = scratch_path(spark, "stream-table"), Marks(scratch_path(spark, "marks"))
    _two_deliveries(spark, sf, path, filters)
    return filters.report(spark).select("keys", "new_keys")


@registered(
    _FEED
    + """SELECT message_id, sequence_id, partition_id, arrival_index FROM feed
    QUALIFY row_number() OVER (PARTITION BY message_id
    ORDER BY created_at DESC, arrival_index DESC) = 1"""
)
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Last write per message, merged into a table batch by batch."""
    stream = _feed_stream(spark, sf, batches=3)
    path = scratch_path(spark, "stream-table")
    streams.upsert_stream(stream, path, scratch_path(spark, "stream-state"))
    return table.read_table(spark, path).select(
        "message_id", "sequence_id", "partition_id", "arrival_index"
    )


def _arriving(spark: SparkSession, sf: str, label: str, run) -> None:
    """The feed as three deliveries of consecutive arrivals; ``run(folder)`` takes up what has come after each."""
    rows = _feed(spark, sf).select(*_FEED_JSON.names, F.col("arrival_index").alias("sent"))
    ends = rows.agg(F.min("sent").alias("low"), F.max("sent").alias("high")).first()
    delivery = F.coalesce(positions.range_slice(F.col("sent"), F.lit(ends["low"]), F.lit(ends["high"]), 3), F.lit(0))
    folder = scratch_path(spark, label)
    for number in range(3):
        part = rows.filter(delivery == number).repartitionByRange(4, "sent").sortWithinPartitions("sent")
        part.write.mode("append").json(folder)
        run(folder)


@registered(
    _FEED + """SELECT message_id, CAST(row_number() OVER (ORDER BY arrival_index) AS BIGINT) AS stamped_index, true AS stamped FROM feed"""
)
def stream_arrival_index(spark: SparkSession, sf: str) -> DataFrame:
    """Arrival numbers that go on over three micro-batches, the stream being restarted for each."""
    path, state = scratch_path(spark, "stamped"), scratch_path(spark, "stream-state")

    def run(folder: str) -> None:
        schema = T.StructType([*_FEED_JSON.fields, T.StructField("sent", T.LongType())])
        # The files of one delivery are written at about the same time; their names tell the order.
        streams.arrival_index_stream(streams.read_message_stream(spark, folder, schema), path, state, by_time=False)

    _arriving(spark, sf, "arriving", run)
    return table.read_table(spark, path).select(
        "message_id", F.col("arrival_index").alias("stamped_index"), F.col("arrival_ts").isNotNull().alias("stamped")
    )


@registered(
    _FEED
    + _STEPS
    + """SELECT partition_id, count(*) AS received, count(*) FILTER (back) AS steps_back,
    count(*) FILTER (back) > 0 AS out_of_order FROM steps GROUP BY partition_id"""
)
def stream_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    """Order by partition from one state row each, over three micro-batches with a restart before each."""
    path, state = scratch_path(spark, "order-state"), scratch_path(spark, "stream-state")
    _arriving(
        spark,
        sf,
        "arriving",
        lambda folder: streams.order_stream(streams.read_message_stream(spark, folder, _FEED_JSON), path, state, bucket_rows=500),
    )
    return streams.order_state(spark, path)


# Checks


_EXPECTED_ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType(), False),
        T.StructField("o_custkey", T.StringType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_comment", T.StringType()),
    ]
)


@registered(
    """SELECT column_name, column_type, (SELECT count(*) FROM orders) AS row_count,
    CASE column_name WHEN 'o_comment' THEN (SELECT count(*) FROM orders)
    ELSE (SELECT count(*) FILTER (o_orderkey IS NULL OR o_custkey IS NULL OR o_orderstatus IS NULL
    OR o_totalprice IS NULL OR o_orderdate IS NULL OR o_orderpriority IS NULL) FROM orders) END
    AS nulls, problem FROM (VALUES ('o_orderkey', 'bigint', NULL),
    ('o_custkey', 'bigint', 'expected string'), ('o_orderstatus', 'string', NULL),
    ('o_totalprice', 'double', NULL), ('o_orderdate', 'timestamp_ntz', NULL),
    ('o_orderpriority', 'string', 'not expected'), ('o_comment', 'string', 'missing'))
    AS report(column_name, column_type, problem)"""
)
def column_check_report(spark: SparkSession, sf: str) -> DataFrame:
    report = quality.schema_report(_table(spark, sf, "orders"), _EXPECTED_ORDERS)
    return report.withColumnRenamed("rows", "row_count")


@registered(
    """SELECT * FROM (VALUES ('complete', 'success', 'primary', NULL),
    ('incomplete', 'failed', NULL, 'schema mismatch: expected columns [''s_name'', ''s_rating'', ''s_suppkey''], got [''s_name'', ''s_suppkey'']')) AS t(attempt, status, location, error)
    WHERE (SELECT count(*) FROM supplier) > 0"""
)
def checked_writes(spark: SparkSession, sf: str) -> DataFrame:
    """A checked write that succeeds and one that lacks a column: status, place and error as rows."""
    suppliers = _table(spark, sf, "supplier").select("s_suppkey", "s_name")
    seen = []
    for name, expected in (("complete", ["s_suppkey", "s_name"]), ("incomplete", ["s_suppkey", "s_name", "s_rating"])):
        record = jobs.checked_write(suppliers, expected, scratch_path(spark, "checked"), scratch_path(spark, "fallback"))
        seen.append((name, record["status"], record.get("result", {}).get("attempt"), record.get("error")))
    return spark.createDataFrame(seen, "attempt string, status string, location string, error string")


@registered("SELECT s_suppkey, s_name, s_acctbal, 'fallback' AS attempt FROM supplier")
def fallback_write(spark: SparkSession, sf: str) -> DataFrame:
    """The first location lies below a regular file and so cannot be written."""
    suppliers = _table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    path = writes.write_parquet(suppliers, scratch_path(spark, "suppliers"))
    regular_file = dataset_files(spark, path).first()["path"]
    record = jobs.checked_write(
        files.scan_parquet(spark, path, suppliers.schema),
        ["s_suppkey", "s_name", "s_acctbal"],
        f"{regular_file}/unwritable",
        scratch_path(spark, "fallback"),
    )
    written = record["result"]
    return files.scan_parquet(spark, written["location"], suppliers.schema).withColumn(
        "attempt", F.lit(written["attempt"])
    )
