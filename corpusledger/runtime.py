"""Session settings, staged tables and files for the executors."""

from __future__ import annotations

import contextlib
import gc
import hashlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS_PER_SLOT = 4
#: Without it a session keeps up to 250 MB of what earlier reads have listed.
LISTING_CACHE = "spark.sql.hive.manageFilesourcePartitions"
#: Splits of reads of many small files: by their bytes and not by 4 MB for each, and some per slot.
SMALL_FILE_BYTES = "64k"
READING_TASKS_PER_SLOT = 4
#: Writer options with which tasks put their files in place, instead of the driver one by one at the end.
#: For writers whose output counts only when something else says that it is whole.
COMMIT_BY_TASKS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
#: Writer options for many small files. Hadoop's checked local file system gives every file a second one
#: with its checksums and starts a process for each to set its mode; Parquet pages carry checksums of their
#: own. Other stores are written as ever.
MANY_FILES = COMMIT_BY_TASKS | {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true",
}

_local_roots: dict[str, str] = {}
_shipped_files: set[tuple[str, str]] = set()
_staging: list[str] = []


def local_session(cpus: int | str = "*", app: str = "corpusledger") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # 10,000 web documents per Arrow batch are about 50 MB; 2,048 keep workers small.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2048")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="corpusledger-")
    return _local_roots[app]


@contextlib.contextmanager
def staging_under(spark: SparkSession, root: str):
    """Within this, tables are staged under ``root``, next to what they lead to, and go at its end."""
    path = f"{root}/_staging/{uuid.uuid4().hex}"
    _staging.append(path)
    try:
        yield
    finally:
        _staging.remove(path)
        delete(spark, path)


@contextlib.contextmanager
def session_settings(spark: SparkSession, changed: dict[str, str]):
    """Settings of the session that hold within this only."""
    before = {key: spark.conf.get(key, None) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def bounded_listing(spark: SparkSession):
    """Within this, Spark lists folders with a few tasks per slot.

    By itself it takes a task per folder, up to 10,000 for each folder above them; folders of one small
    file each then cost more tasks, and more task results, than all else. What it has listed goes
    with the table that was read, instead of staying in the session's cache.
    """
    tasks = LISTING_TASKS_PER_SLOT * spark.sparkContext.defaultParallelism
    return session_settings(spark, {LISTING_TASKS: str(tasks), LISTING_CACHE: "false"})


def merged_splits(spark: SparkSession):
    """Within this, what runs reads many small files with a few tasks per slot, not with one for each few files."""
    splits = READING_TASKS_PER_SLOT * spark.sparkContext.defaultParallelism
    return session_settings(
        spark, {"spark.sql.files.openCostInBytes": SMALL_FILE_BYTES, "spark.sql.files.minPartitionNum": str(splits)}
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of the run that stages, or else in the shared folder."""
    if _staging:
        return f"{_staging[-1]}/{name}-{uuid.uuid4().hex[:12]}"
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/corpusledger/{app}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so that later passes do not recompute it."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_parts(parts: Iterable, make: Callable[..., DataFrame], name: str) -> DataFrame:
    """The tables that ``make`` makes of the parts, staged one after another; for tables of many small files.

    Spark's reader holds an entry per file on the driver as long as its table is referenced. Python's
    handles of Java objects are in cycles, so the collector is called to let a part go before the next.
    """
    staged = []
    for part in parts:
        table = make(part)
        with merged_splits(table.sparkSession):
            staged.append(stage(table, name))
        del table
        gc.collect()
    return reduce(DataFrame.unionByName, staged)


def stage_by(df: DataFrame, name: str, column: str) -> DataFrame:
    """``stage`` with one directory per value of ``column``, so that later passes prune by it."""
    return write_by(df, scratch_path(df.sparkSession, name), column)


def write_by(df: DataFrame, path: str, column: str) -> DataFrame:
    """``df`` as it was written to ``path``, in place of what an interrupted run left there."""
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(column).parquet(path)
    return read_by(df.sparkSession, path, df.schema)


def read_by(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def drop_scratch(spark: SparkSession) -> None:
    """Delete everything this application staged."""
    delete(spark, f"{shared_root(spark)}/corpusledger/{spark.sparkContext.applicationId}")


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def pin_small(df: DataFrame) -> DataFrame:
    """Compute a table once that is small as a rule: plans, cut points, bounds.

    Its files tell the planner and adaptive execution its size, so it is broadcast if it is small
    in bytes and joined by shuffle otherwise.
    """
    return stage(df, "small")


def spread(df: DataFrame, *keys: str, source: DataFrame | None = None) -> DataFrame:
    """Spread rows over all slots when the input has fewer splits than the session has slots.

    Token counting is CPU-bound, so one large row group must not keep the other slots idle.
    Inputs with enough splits, the usual case on a cluster, are returned unshuffled. The splits are
    estimated from the scanned bytes of ``source``; nothing is run to find out.
    """
    spark = df.sparkSession
    scan = (source if source is not None else df)._jdf.queryExecution().optimizedPlan().stats()
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    slots = spark.sparkContext.defaultParallelism
    if int(str(scan.sizeInBytes())) // int(str(split)) >= slots:
        return df
    return df.repartition(slots, *keys)


def file_digest(path: str) -> str:
    """SHA-256 of a file on the driver."""
    with open(path, "rb") as lines:
        return hashlib.file_digest(lines, "sha256").hexdigest()


def ship_file(spark: SparkSession, path: str) -> str:
    """Send a driver-side file to every executor once; returns the name to ask for there.

    Executors know files by their base name, so the name is the digest of the content.
    """
    context = spark.sparkContext
    name = file_digest(path)
    if (context.applicationId, name) not in _shipped_files:
        copy = os.path.join(tempfile.mkdtemp(prefix="corpusledger-ship-"), name)
        shutil.copyfile(path, copy)
        context.addFile(copy)
        _shipped_files.add((context.applicationId, name))
    return name
