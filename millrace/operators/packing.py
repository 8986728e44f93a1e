"""Compaction by size: small files are packed together, large ones stay as they are."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import table

TARGET_BYTES = 128 << 20


@dataclass
class Packing:
    """What :func:`pack_small` did."""

    version: int
    files_before: int
    files_after: int
    bytes_packed: int
    bytes_untouched: int


def folder_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Per live folder of the current version: files, bytes and the largest file, from the listing alone."""
    folder = F.regexp_extract("path", f"/({table.COMMIT}=[0-9]+-[^/]+)/", 1)
    return (
        table.live_files(spark, path)
        .groupBy(folder.alias("folder"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("length").alias("largest"))
    )


def pack_small(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> Packing:
    """Rewrite the small files of a versioned table into files of about ``target_bytes``; the rows stay the same.

    A folder is small if its largest file is below half the target. Small folders go together into bins, largest
    first, until a bin is full; a bin of a single file is left alone, too. What is large is neither read nor written:
    its folders belong to the new version as they are, and earlier versions read what they read before. Rows that are
    hidden meanwhile end here. The listing has a row per live folder, which :data:`table.FOLD_COMMITS` bounds.
    """
    found = table.snapshot(spark, path)
    if found is None:
        raise ValueError(f"no table at {path}")
    sizes = {row["folder"]: row for row in folder_sizes(spark, path).collect()}
    before = sum(row["files"] for row in sizes.values())
    total = sum(row["bytes"] for row in sizes.values())
    small = sorted((row for row in sizes.values() if row["largest"] < target_bytes / 2), key=lambda r: (-r["bytes"], r["folder"]))
    files = sum(row["files"] for row in small)
    packed = sum(row["bytes"] for row in small)
    bins = max(1, round(packed / target_bytes))
    if files <= bins:
        return Packing(found.version, before, before, 0, total)
    names = {row["folder"] for row in small}
    own = [entry for entry in found.live if entry["folder"] in names]
    rows = table._read(spark, path, found, live=own)
    if not found.partition_by and not found.buckets:
        # The scan packs small files into tasks; fewer tasks than that need no shuffle.
        rows = rows.coalesce(bins)
    version = table._commit(
        spark,
        path,
        "pack",
        rows,
        found,
        found.schema,
        found.partition_by,
        found.bucket_by,
        found.buckets,
        instead_of=[entry["folder"] for entry in own],
        unique_key=found.unique_key,
        tier=max(entry["tier"] for entry in own) + 1,
    )
    after = folder_sizes(spark, path).agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
    return Packing(version, before, after, packed, total - packed)
