"""Versioned tables: Parquet folders, one per commit, and a ledger of commits.

    path/data/commit=N-<attempt>[/part=value]/*.parquet     the rows that commit N added
    path/ledger/<thousands>/<N>.json                        one line that makes commit N visible

Each attempt of a commit writes its rows to a fresh folder and publishes them last, by moving its
ledger line into place without overwriting. A job that dies in between leaves nothing readable and
stops nobody; of two writers of one version the second fails and the first one's rows stay.

A ledger line is a whole snapshot: the folders it reads, the newest version that hides each partition
or bucket, and the last batch of each stream. Readers open the newest line only. Appends fold
:data:`FOLD_COMMITS` folders of a tier into one of the next, so a line stays short however many
commits there were, and each row is rewritten a logarithmic number of times. Old folders stay for
reading earlier versions.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.keys import KEY_FIELDS, composite_key
from millrace.operators.dedup import WRITE_ORDER, keep_last
from millrace.operators.quality import (
    SchemaMismatch,
    fit_to,
    merged_schema,
    schema_problems,
    with_required,
)
from millrace.operators.sizes import dataset_files
from millrace.session import list_names, pin, publish, read_file

COMMIT = "commit"
BUCKET = "key_bucket"
RESERVED = (COMMIT, BUCKET)
#: Folders of one tier that a table reads before they are folded into one.
FOLD_COMMITS = 64
#: Buckets of a table made by an upsert. A bucket is the least that an upsert rewrites.
BUCKETS = 16
NULL_PART = "__HIVE_DEFAULT_PARTITION__"
_SEGMENT = 1000

LEDGER = (
    "version bigint, operation string, base_version bigint, rows bigint, total_rows bigint, batch_rows bigint, "
    "existing_rows bigint, schema_json string, partition_by array<string>, bucket_by array<string>, buckets int, "
    "unique_key array<string>, live array<struct<folder: string, version: bigint, tier: int>>, "
    "hidden map<string, bigint>, writers map<string, bigint>, writer string, batch_id bigint, written_at string"
)


@dataclass
class Snapshot:
    """What the ledger says about one version."""

    version: int
    base: int
    schema: T.StructType
    partition_by: list[str]
    bucket_by: list[str]
    buckets: int
    unique_key: list[str]
    live: list[dict]
    hidden: dict[str, int]
    writers: dict[str, int]
    total_rows: int | None


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per commit, in no particular order."""
    return spark.read.schema(LEDGER).option("recursiveFileLookup", True).json(f"{path}/ledger")


def _line_path(path: str, version: int) -> str:
    return f"{path}/ledger/{version // _SEGMENT:012d}/{version:015d}.json"


def _lines(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """The oldest and newest version, from names alone: those of one segment of the ledger."""
    segments = list_names(spark, f"{path}/ledger")
    for segment in sorted(segments, reverse=True):
        names = [n for n in list_names(spark, f"{path}/ledger/{segment}") if n.endswith(".json") and n[0] != "."]
        if names:
            return 0, max(int(n.removesuffix(".json")) for n in names)
    return None


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The given or latest version; ``None`` if the table does not exist."""
    known = _lines(spark, path)
    if known is None:
        return None
    if version is not None and not known[0] <= version <= known[1]:
        raise ValueError(f"{path} has no version {version}")
    line = json.loads(read_file(spark, _line_path(path, known[1] if version is None else version)))
    return Snapshot(
        version=line["version"],
        base=line["base_version"],
        schema=T.StructType.fromJson(json.loads(line["schema_json"])),
        partition_by=line["partition_by"],
        bucket_by=line["bucket_by"],
        buckets=line["buckets"],
        unique_key=line["unique_key"],
        live=line["live"],
        hidden=line["hidden"],
        writers=line["writers"],
        total_rows=line["total_rows"],
    )


def current_version(spark: SparkSession, path: str) -> int | None:
    found = snapshot(spark, path)
    return found.version if found else None


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the latest or the given version."""
    found = snapshot(spark, path, version)
    if found is None:
        raise ValueError(f"no table at {path}")
    return _read(spark, path, found)


def _stored_columns(schema: T.StructType, bucketed: bool) -> T.StructType:
    extra = [T.StructField(COMMIT, T.StringType())]
    if bucketed:
        extra.append(T.StructField(BUCKET, T.IntegerType()))
    return T.StructType([*schema.fields, *extra])


def _read(
    spark: SparkSession,
    path: str,
    found: Snapshot,
    buckets: Sequence[int] | None = None,
    live: Sequence[dict] | None = None,
) -> DataFrame:
    live = found.live if live is None else live
    if not live:
        return spark.createDataFrame([], found.schema)
    folders = [f"{path}/data/{entry['folder']}" for entry in live]
    stored = _stored_columns(found.schema, bool(found.buckets))
    rows = spark.read.schema(stored).option("basePath", f"{path}/data").parquet(*folders)
    if buckets is not None:
        rows = rows.filter(F.col(BUCKET).isin(list(buckets)))
    part = BUCKET if found.buckets else found.partition_by[0] if found.partition_by else None
    if found.hidden and part:
        # Both columns are directories, so hidden files are not opened.
        name = F.coalesce(F.col(f"`{part}`").cast("string"), F.lit(NULL_PART))
        own = F.substring_index(F.col(COMMIT), "-", 1).cast("long")
        newest = F.try_element_at(_literal_map(found.hidden), name)
        rows = rows.filter(F.coalesce(own >= newest, F.lit(True)))
    return rows.select(*[F.col(f"`{f.name}`") for f in found.schema])


def _literal_map(values: dict[str, int]) -> Column:
    pairs = [F.lit(x) for name, version in values.items() for x in (name, version)]
    return F.create_map(*pairs)


def already_committed(spark: SparkSession, path: str, writer: str, batch_id: int) -> bool:
    """Whether the writer has committed this batch or, batches being numbered upwards, a later one."""
    found = snapshot(spark, path)
    return found is not None and found.writers.get(writer, -1) >= batch_id


def _bucket(columns: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(buckets)).cast("int")


def _commit(
    spark: SparkSession,
    path: str,
    operation: str,
    rows: DataFrame | None,
    found: Snapshot | None,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    rewrites_all: bool = False,
    instead_of: Sequence[str] = (),
    hidden: Sequence[str] = (),
    hides_written: bool = False,
    unique_key: Sequence[str] = (),
    writer: str | None = None,
    batch_id: int | None = None,
    gather: bool = True,
    tier: int = 0,
    counts: Observation | None = None,
) -> int:
    for name in RESERVED:
        if name in schema.names:
            raise SchemaMismatch([f"{name}: reserved column name"])
    version = 0 if found is None else found.version + 1
    live = [] if rewrites_all or found is None else [e for e in found.live if e["folder"] not in instead_of]
    written = 0
    hidden = list(hidden)
    if rows is not None:
        folder = f"{COMMIT}={version}-{uuid.uuid4().hex[:12]}"
        parts = list(partition_by)
        for name in parts:
            if isinstance(schema[name].dataType, T.StringType):
                # The directory layout would turn it into null.
                refusal = F.raise_error(F.lit(f"empty text in partition column {name}")).cast("string")
                rows = rows.withColumn(name, F.when(F.col(f"`{name}`") == "", refusal).otherwise(F.col(f"`{name}`")))
        if buckets:
            rows = rows.withColumn(BUCKET, _bucket(bucket_by, buckets))
            parts = [BUCKET]
        if parts and gather:
            # One shuffle so that a partition value ends in few files; AQE splits a hot value.
            rows = rows.hint("rebalance", *[F.col(f"`{c}`") for c in parts])
        # Counted in the writing stage itself, where each finished task counts once.
        counted = Observation()
        rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
        rows.write.partitionBy(*parts).parquet(f"{path}/data/{folder}")
        written = counted.get.get("rows", 0)
        if written:
            live.append({"folder": folder, "version": version, "tier": tier})
            if hides_written:
                # From what was written, so that it is the same rows.
                prefix = f"{parts[0]}="
                names = [n for n in list_names(spark, f"{path}/data/{folder}") if n.startswith(prefix)]
                hidden += [_unescaped(n.removeprefix(prefix)) for n in names]
    newest = {} if rewrites_all or found is None else dict(found.hidden)
    newest |= {name: version for name in hidden}
    oldest = min((e["version"] for e in live), default=version)
    seen = counts.get if counts is not None else {}
    existing = seen.get("existing", 0)
    if operation in ("drop", "replace"):
        total = None
    elif rewrites_all or found is None:
        total = written
    elif found.total_rows is None:
        total = None
    else:
        total = found.total_rows + (0 if instead_of else written - existing)
    line = {
        "version": version,
        "operation": operation,
        "base_version": version if rewrites_all or found is None else found.base,
        "rows": written,
        "total_rows": total,
        "batch_rows": seen.get("batch") if counts is not None else None,
        "existing_rows": (found.total_rows if found else 0) if counts is not None else None,
        "schema_json": schema.json(),
        "partition_by": list(partition_by),
        "bucket_by": list(bucket_by),
        "buckets": buckets,
        "unique_key": list(unique_key),
        "live": live,
        # A value hidden before every live folder was written hides nothing any more.
        "hidden": {name: at for name, at in newest.items() if at > oldest},
        "writers": (found.writers if found else {}) | ({} if writer is None else {writer: batch_id}),
        "writer": writer,
        "batch_id": batch_id,
        "written_at": datetime.datetime.now(datetime.timezone.utc).isoformat(),
    }
    if not publish(spark, json.dumps(line), _line_path(path, version)):
        raise FileExistsError(f"version {version} of {path} already exists: another writer was first")
    return version


def _unescaped(name: str) -> str:
    """The value of a directory name; Spark writes special characters as percent signs and two digits."""
    out, at = [], 0
    while at < len(name):
        if name[at] == "%" and at + 2 < len(name) + 0 and all(c in "0123456789abcdefABCDEF" for c in name[at + 1 : at + 3]):
            out.append(chr(int(name[at + 1 : at + 3], 16)))
            at += 3
        else:
            out.append(name[at])
            at += 1
    return "".join(out)


def _fold(spark: SparkSession, path: str, found: Snapshot, most: int) -> None:
    """Folds full tiers, lowest first; rows that are hidden meanwhile end here."""
    tier = 0
    while sum(e["tier"] == tier for e in found.live) >= most:
        own = [e for e in found.live if e["tier"] == tier]
        _commit(
            spark,
            path,
            "fold",
            _read(spark, path, found, live=own),
            found,
            found.schema,
            found.partition_by,
            found.bucket_by,
            found.buckets,
            instead_of=[e["folder"] for e in own],
            unique_key=found.unique_key,
            tier=tier + 1,
        )
        found = snapshot(spark, path)
        tier += 1


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] | None = None,
    merge_schema: bool = False,
    replace_schema: bool = False,
    required: Sequence[str] = (),
    gather: bool = True,
    writer: str | None = None,
    batch_id: int | None = None,
    bucket_by: Sequence[str] = (),
    buckets: int = BUCKETS,
    fold_commits: int = FOLD_COMMITS,
    found: Snapshot | None = None,
) -> int:
    """Append to or overwrite a table; returns the new version.

    The schema is checked before any file is written: names and types must be the table's (a
    narrower number is widened). ``merge_schema`` lets an append bring new columns, null in older
    rows, and omit nullable ones; ``replace_schema`` lets an overwrite change everything. A new table
    refuses nulls in its ``required`` columns: such a row fails the write, which then stays
    invisible.

    Rows of a partitioned table are first shuffled by partition value, so that a value ends in few
    files; ``gather=False`` skips that where they arrive so arranged. An empty string in a partition
    column is refused: directories can't tell it from null. ``bucket_by`` makes a new table of
    ``buckets`` hash buckets of these columns instead. ``found`` is the snapshot to build on, the
    latest by default; if it isn't the latest any more, the commit fails.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    found = found or snapshot(spark, path)
    if found is None or (mode == "overwrite" and replace_schema):
        schema = with_required(df.schema, required)
        parts, keys = list(partition_by or ()), list(bucket_by)
        buckets = buckets if keys else 0
        if parts and keys:
            raise ValueError("a table has partitions or buckets, not both")
    else:
        parts, keys, buckets = found.partition_by, found.bucket_by, found.buckets
        if partition_by is not None and list(partition_by) != parts:
            raise SchemaMismatch([f"table is partitioned by {parts}, not {list(partition_by)}"])
        problems = schema_problems(
            df.schema, found.schema, allow_new=merge_schema, allow_missing=merge_schema
        )
        if problems:
            raise SchemaMismatch(problems)
        schema = merged_schema(found.schema, df.schema)
    version = _commit(
        spark,
        path,
        mode,
        fit_to(df, schema),
        found,
        schema,
        parts,
        keys,
        buckets,
        rewrites_all=mode == "overwrite",
        writer=writer,
        batch_id=batch_id,
        gather=gather,
    )
    if mode == "append":
        _fold(spark, path, snapshot(spark, path, version), fold_commits)
    return version


def upsert(
    df: DataFrame,
    path: str,
    key: Sequence[str] = ("message_id",),
    order: Sequence[str] = WRITE_ORDER,
    buckets: int = BUCKETS,
    with_hash: bool = False,
    writer: str | None = None,
    batch_id: int | None = None,
    fold_commits: int = FOLD_COMMITS,
) -> int:
    """Merge a batch into a table so that each key keeps its latest row; returns the version.

    Greatest ``order`` wins, nulls lose, and on a full tie the batch wins, so repeating a batch
    changes nothing. The table is made of ``buckets`` hash buckets of the key. Only the buckets that
    the batch touches are read, merged with it in one shuffle and written anew, beside their earlier
    form; the others stay. Choose so many buckets that one is a fair thing to rewrite. An empty batch
    writes nothing. A table that has no buckets of this key, or whose keys an append may have
    repeated, is rewritten once as a whole.

    ``with_hash`` stores the ``composite_hash`` of the message columns too. :func:`merge_metrics`
    tells how many rows came, were there and stayed.
    """
    spark = df.sparkSession
    key, order = list(key), list(order)
    if with_hash:
        df = df.withColumn("composite_hash", composite_key(KEY_FIELDS))
    found = snapshot(spark, path)
    counts = Observation()
    from_batch = "_from_batch"
    seen = [F.count_if(F.col(from_batch) == n).alias(name) for n, name in ((0, "existing"), (1, "batch"))]
    if found is None:
        batch = df.withColumn(from_batch, F.lit(1)).observe(counts, *seen)
        merged, schema, parts = keep_last(batch, key, order).drop(from_batch), with_required(df.schema, ()), []
        touched, rewrites_all = None, True
    else:
        problems = schema_problems(df.schema, found.schema)
        if problems:
            raise SchemaMismatch(problems)
        schema, parts = found.schema, found.partition_by
        # The touched buckets and the merged rows come from one and the same batch.
        batch = pin(fit_to(df, schema))
        rewrites_all = not found.buckets or found.bucket_by != key or found.unique_key != key
        if rewrites_all:
            touched = None
            if batch.isEmpty():
                return found.version
        else:
            # At most one row per bucket.
            touched = [row[0] for row in batch.select(_bucket(key, found.buckets)).distinct().collect()]
            if not touched:
                return found.version
        both = _read(spark, path, found, touched).withColumn(from_batch, F.lit(0))
        both = both.unionByName(batch.withColumn(from_batch, F.lit(1))).observe(counts, *seen)
        merged = keep_last(both, key, [*order, from_batch]).drop(from_batch)
    if not rewrites_all:
        buckets = found.buckets
    if parts:
        buckets = 0
    version = _commit(
        spark,
        path,
        "upsert",
        merged,
        found,
        schema,
        parts,
        key if buckets else (),
        buckets,
        rewrites_all=rewrites_all,
        hidden=[str(b) for b in touched or ()],
        unique_key=key,
        writer=writer,
        batch_id=batch_id,
        counts=counts,
    )
    _fold(spark, path, snapshot(spark, path, version), fold_commits)
    return version


def merge_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Per upsert: rows of the batch, rows there before, rows after, and how many rows merging saved."""
    done = history(spark, path).filter("operation = 'upsert'")
    return done.select(
        "version",
        F.col("batch_rows").alias("initial_records"),
        "existing_rows",
        F.col("total_rows").alias("rows_in_table"),
        (F.col("batch_rows") + F.col("existing_rows") - F.col("total_rows")).alias("merged_duplicates"),
    )


def rows_of_keys(batch: DataFrame, path: str, key: Sequence[str], found: Snapshot) -> DataFrame:
    """The table's rows in the buckets that the keys of ``batch`` (a stored frame) touch."""
    spark = batch.sparkSession
    if not found.buckets or found.bucket_by != list(key):
        return _read(spark, path, found)
    touched = [row[0] for row in batch.select(_bucket(key, found.buckets)).distinct().collect()]
    return _read(spark, path, found, touched)


def compact(spark: SparkSession, path: str, files: int | None = None) -> int:
    """Rewrite the current version into fewer files as a new commit.

    Without ``files`` nothing is shuffled in an unpartitioned table: the scan already packs small
    files into tasks of ``spark.sql.files.maxPartitionBytes``, and each task writes one file.
    """
    found = snapshot(spark, path)
    if found is None:
        raise ValueError(f"no table at {path}")
    rows = _read(spark, path, found)
    if files is not None:
        rows = rows.repartition(files, *found.partition_by)
    return _commit(
        spark,
        path,
        "compact",
        rows,
        found,
        found.schema,
        found.partition_by,
        found.bucket_by,
        found.buckets,
        rewrites_all=True,
        unique_key=found.unique_key,
        gather=files is None,
    )


def drop_partitions(spark: SparkSession, path: str, values: Sequence) -> int:
    """Hide partitions from the next version on. Writes only a ledger line.

    The folders remain for earlier versions; where rows must be erased, compact and then remove the
    old commits with the file system's own tools. No partition is named by an empty text.
    """
    found = snapshot(spark, path)
    _require_one_partition_column(path, found)
    if "" in values:
        raise ValueError("a partition can't be named by an empty text")
    return _commit(
        spark,
        path,
        "drop",
        None,
        found,
        found.schema,
        found.partition_by,
        hidden=[NULL_PART if v is None else str(v) for v in values],
        unique_key=found.unique_key,
    )


def replace_partitions(df: DataFrame, path: str) -> int:
    """Put the rows of ``df`` in place of every partition they touch; others are not rewritten.

    ``df`` is computed once: what it replaces is told by the folders that it wrote.
    """
    spark = df.sparkSession
    found = snapshot(spark, path)
    _require_one_partition_column(path, found)
    problems = schema_problems(df.schema, found.schema)
    if problems:
        raise SchemaMismatch(problems)
    return _commit(
        spark,
        path,
        "replace",
        fit_to(df, found.schema),
        found,
        found.schema,
        found.partition_by,
        hides_written=True,
    )


def _require_one_partition_column(path: str, found: Snapshot | None) -> None:
    if found is None:
        raise ValueError(f"no table at {path}")
    if len(found.partition_by) != 1:
        raise ValueError(f"{path} must be partitioned by one column")


def live_files(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Path and length of the files that a version reads, without opening them."""
    found = snapshot(spark, path, version)
    if found is None:
        raise ValueError(f"no table at {path}")
    if not found.live:
        return spark.createDataFrame([], "path string, length long")
    files = dataset_files(spark, *[f"{path}/data/{entry['folder']}" for entry in found.live])
    if not found.hidden:
        return files
    part = BUCKET if found.buckets else found.partition_by[0]
    # Directory names are percent-encoded, with a plain plus sign.
    name = F.regexp_extract("path", f"/{part}=([^/]*)/", 1)
    value = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    own = F.regexp_extract("path", f"/{COMMIT}=([0-9]+)-", 1).cast("long")
    newest = F.try_element_at(_literal_map(found.hidden), value)
    return files.filter(F.coalesce(own >= newest, F.lit(True)))


def table_size(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes of a table in one row: those of the current version, and all that are stored."""
    none = F.lit(None).cast("long")
    live = live_files(spark, path).select(F.col("length").alias("_live"), none.alias("_all"))
    stored = dataset_files(spark, f"{path}/data").select(none.alias("_live"), F.col("length").alias("_all"))
    return live.unionByName(stored).agg(
        F.count("_live").alias("live_files"),
        F.coalesce(F.sum("_live"), F.lit(0)).alias("live_bytes"),
        F.count("_all").alias("stored_files"),
        F.coalesce(F.sum("_all"), F.lit(0)).alias("stored_bytes"),
    )
