"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import logging
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming keys live in RocksDB on the executors' disks, not on their heaps.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A batch stores what changed instead of a whole state snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_scratch: str | None = None
_scratch_used: list[str] = []


def build_session(
    app_name: str = "millrace",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the library's defaults; ``conf`` wins over them.

    ``shuffle_partitions`` is only the starting number: AQE merges small partitions, it never
    splits large ones outside joins and rebalances, so start high on a cluster
    (see :func:`shuffle_partitions_for`).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shuffle_partitions_for(shuffled_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Enough shuffle partitions that each holds about ``target_bytes`` and no core idles."""
    return max(cores, -(-shuffled_bytes // target_bytes))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting: it gets one temporary folder per process.
    """
    global _local_scratch
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        local = shared.startswith("file:") or "://" not in shared and shared.startswith("/")
        if local and spark.sparkContext.master.split("[")[0] not in ("local", "local-cluster"):
            logging.getLogger(__name__).warning("spark.checkpoint.dir is %s: it must be a mount that all executors share", shared)
        return shared.rstrip("/")
    # Executors of local-cluster are other processes.
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="millrace-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below :func:`scratch_root`."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch_used.append(path)
    return path


def pin(df):
    """Reliable checkpoint of ``df``: later uses read the same rows, lineage is cut."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()


# Small metadata files, in whatever file system a path names. They use the session's JVM, so they need
# a classic session: Spark Connect has none.


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists."""
    system, target = _file_system(spark, path)
    return system.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if there is no such folder."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    return [status.getPath().getName() for status in system.listStatus(target)]


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    system, target = _file_system(spark, path)
    stream = system.open(target)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, text: str, path: str) -> bool:
    """Puts a small file in place as a whole; False if one is there already, which then stays.

    The text goes to a hidden file first, which is renamed without overwriting. What a crash leaves is
    a hidden file that nobody reads.
    """
    system, target = _file_system(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(hidden, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(system.makeQualified(hidden), system.makeQualified(target), none)
    except Exception:
        if not system.exists(target):
            raise
        system.delete(hidden, False)
        return False
    return True


def clear_scratch(spark: SparkSession) -> None:
    """Removes what this library's calls have stored in the scratch folder in this process.

    Call it at the end of a session, when no result that reads scratch data is needed any more.
    """
    while _scratch_used:
        system, target = _file_system(spark, _scratch_used.pop())
        system.delete(target, True)
