"""Connected components of a graph given as an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import scratch_path

#: Rows for which a task of its own writes a file.
FILE_ROWS = 100_000


def stored(df: DataFrame, label: str, most: int | None = None) -> DataFrame:
    """``df`` as a table in the scratch folder.

    ``most`` is a bound of its rows, if known: so many shuffle partitions are then written by one task that small tables
    don't get a file from each, but no fewer than keep all cores busy. Give it where rows are spread evenly.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    tasks = None if most is None else max(spark.sparkContext.defaultParallelism, -(-most // FILE_ROWS))
    (df if tasks is None else df.coalesce(tasks)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node that each node of the links reaches.

    ``links`` has long columns ``a`` and ``b``. Each round is two groupings and joins over the links that are
    left; their number falls to one per node. A node with very many links is combined before each shuffle;
    both sides of each join are stored tables, so that Spark can split such a node. Rounds are stored in the shared folder, so a lost executor
    costs no earlier round. Each stored table is grouped by node or pair, and so spread evenly. Only counts and sums of the
    links reach the driver.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct(), "edges"
    )
    before = _sums(edges)
    while True:
        most = before[0]
        # Large star: each node hands its larger neighbours to the smallest of itself and its neighbours.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("low"))
        least = stored(least, "edges", 2 * most)
        large = both.join(least, F.col("a") == F.col("node")).where(F.col("b") > F.col("a"))
        large = large.select(F.col("b").alias("a"), F.col("low").alias("b")).where(F.col("a") > F.col("b")).distinct()
        large = stored(large, "edges", most)
        # Small star: each node and its smaller neighbours go to the smallest of them.
        small = large.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "node")
        moved = large.join(small, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        moved = moved.unionByName(small.select(F.col("node").alias("a"), F.col("low").alias("b"))).where(F.col("a") > F.col("b"))
        edges = stored(moved.distinct(), "edges", most)
        after = _sums(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = after


def _sums(edges: DataFrame) -> tuple:
    """The number of the links and sums that change with them."""
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum((mixed % 1_000_003).cast("long")), F.bit_xor(mixed)).first())
