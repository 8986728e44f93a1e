"""Bloom filters beside a table: which keys it can't hold, known without opening it.

    path/base-N/key_bucket=B/     marks of all keys of version N of the table
    path/batch-N/key_bucket=B/    marks of the keys that version N adds
    path/report/batch-N/          what the batch found

A key sets a few bits among those of its key bucket; the bits lie in bitmaps of 4 KB. Marks are written before the rows
they stand for, so that they may name too many keys, never too few: the exact join decides about those.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.keys import KEY_FIELDS
from millrace.operators.table import BUCKETS, Snapshot, _bucket, _line_path, read_table
from millrace.session import list_names, read_file

#: Bits of one bitmap, as Spark's bitmap functions have them.
PART_BITS = 32768
#: Batches whose marks are read one by one before they are joined into a new base.
FOLD_BATCHES = 32
#: Commits that leave a table's keys as they are.
_SAME_KEYS = ("fold", "compact", "pack")


@dataclass(frozen=True)
class Marks:
    """Size and place of the filters of a table in ``buckets`` hash buckets of ``keys``."""

    path: str
    keys: Sequence[str] = tuple(KEY_FIELDS)
    buckets: int = BUCKETS
    parts: int = 16
    hashes: int = 4

    @classmethod
    def sized(cls, path: str, expected_keys: int, rate: float = 0.01, keys: Sequence[str] = tuple(KEY_FIELDS), buckets: int = BUCKETS) -> Marks:
        """Filters that name about ``rate`` of the new keys in vain while the table has ``expected_keys``."""
        bits = -math.log(rate) / math.log(2) ** 2
        parts = max(1, math.ceil(expected_keys * bits / buckets / PART_BITS))
        return cls(path, tuple(keys), buckets, parts, max(1, round(bits * math.log(2))))

    def _positions(self, rows: DataFrame, *kept: str) -> DataFrame:
        """A row per key and hash: ``key_bucket, part, bit`` and the columns ``kept``."""
        columns = [F.col(f"`{k}`") for k in self.keys]
        places = [F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(self.parts * PART_BITS)) for seed in range(self.hashes)]
        at = rows.select(*kept, _bucket(self.keys, self.buckets).alias("key_bucket"), F.explode(F.array(*places)).alias("at"))
        return at.select(*kept, "key_bucket", F.floor(F.col("at") / PART_BITS).cast("int").alias("part"), (F.col("at") % PART_BITS).alias("bit"))

    def _stored(self, spark: SparkSession) -> dict[int, str]:
        """The folders of the newest base and of later batches, by version."""
        names = [n.split("-") for n in list_names(spark, self.path) if "-" in n]
        base = max((int(v) for kind, v in names if kind == "base"), default=-1)
        found = {int(v): f"{self.path}/batch-{v}" for kind, v in names if kind == "batch" and int(v) > base}
        if base >= 0:
            found[base] = f"{self.path}/base-{base}"
        return found

    def _complete(self, spark: SparkSession, table: str, folders: dict[int, str], version: int, writer: str) -> bool:
        """Whether the marks cover the keys of all commits up to ``version``: those after the base are this writer's."""
        base = max((v for v, folder in folders.items() if "/base-" in folder), default=-1)
        if version - base > 4 * FOLD_BATCHES:
            return False
        for v in range(base + 1, version + 1):
            line = json.loads(read_file(spark, _line_path(table, v)))
            if line["operation"] not in _SAME_KEYS and (v not in folders or line.get("writer") != writer):
                return False
        return True

    def _read(self, spark: SparkSession, folders: Sequence[str], touched: Sequence[int] | None = None) -> DataFrame:
        """``key_bucket, part, bits`` of the folders, one row per bitmap; only the buckets ``touched``."""
        schema = "part int, bits binary, key_bucket int"
        rows = spark.createDataFrame([], schema)
        for folder in folders:
            rows = rows.unionByName(spark.read.schema(schema).parquet(folder))
        if touched is not None:
            rows = rows.where(F.col("key_bucket").isin(list(touched)))
        return rows.groupBy("key_bucket", "part").agg(F.bitmap_or_agg("bits").alias("bits"))

    def add(self, rows: DataFrame, version: int) -> None:
        """Marks the keys of ``rows``, which version ``version`` of the table is about to add."""
        self._write(rows, f"batch-{version}")
        # Only versions that are committed go into a base.
        folders = {v: folder for v, folder in self._stored(rows.sparkSession).items() if v < version}
        if len(folders) > FOLD_BATCHES:
            whole = self._read(rows.sparkSession, list(folders.values()))
            whole.repartition("key_bucket").write.mode("overwrite").partitionBy("key_bucket").parquet(f"{self.path}/base-{version - 1}")

    def _write(self, rows: DataFrame, name: str) -> None:
        bits = self._positions(rows).groupBy("key_bucket", "part").agg(F.bitmap_construct_agg("bit").alias("bits"))
        bits.repartition("key_bucket").write.mode("overwrite").partitionBy("key_bucket").parquet(f"{self.path}/{name}")

    def maybe_seen(self, fresh: DataFrame, table: str, found: Snapshot, writer: str) -> DataFrame:
        """``fresh`` (a stored frame with a number ``_row`` per row) with ``_maybe``: whether the table may hold the row's key.

        If others than ``writer`` changed the table since the last base, the marks are made anew from its keys first.
        """
        spark = fresh.sparkSession
        # What lies above the table's version belongs to a batch that was not committed, and is written again.
        folders = {v: folder for v, folder in self._stored(spark).items() if v <= found.version}
        if not self._complete(spark, table, folders, found.version, writer):
            self._write(read_table(spark, table, found.version).select(*self.keys), f"base-{found.version}")
            folders = {found.version: f"{self.path}/base-{found.version}"}
        # At most as many values as there are buckets.
        touched = [row[0] for row in fresh.select(_bucket(self.keys, self.buckets)).distinct().collect()]
        bits = self._read(spark, list(folders.values()), touched)
        byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.expr("shiftright(_byte, cast(bit % 8 as int)) & 1 = 1")
        asked = self._positions(fresh, "_row").join(bits, ["key_bucket", "part"]).withColumn("_byte", byte).where(is_set)
        hits = asked.groupBy(F.col("_row").alias("_hit")).agg(F.count(F.lit(1)).alias("_hits")).where(F.col("_hits") == self.hashes)
        marked = fresh.join(hits, F.col("_row") == F.col("_hit"), "left")
        return marked.withColumn("_maybe", F.col("_hit").isNotNull()).drop("_hit", "_hits")

    def write_report(self, marked: DataFrame, new: DataFrame, batch_id: int) -> None:
        """One row: keys of the batch, those that may have been seen, buckets touched and opened, and new keys."""
        bucket = _bucket(self.keys, self.buckets)
        counts = marked.agg(
            F.count(F.lit(1)).alias("keys"),
            F.count_if("_maybe").alias("maybe_seen"),
            F.count_distinct(bucket).alias("buckets_touched"),
            F.count_distinct(F.when(F.col("_maybe"), bucket)).alias("buckets_opened"),
        )
        row = counts.select(F.lit(batch_id).alias("batch_id"), "*", F.lit(new.count()).alias("new_keys"))
        row.write.mode("overwrite").parquet(f"{self.path}/report/batch={batch_id}")

    def report(self, spark: SparkSession) -> DataFrame:
        """The rows of :meth:`write_report`, one per batch that met a table."""
        return spark.read.parquet(f"{self.path}/report").drop("batch")
