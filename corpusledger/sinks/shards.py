"""Fixed-size shards, written wave by wave so that an interrupted run can resume."""

from __future__ import annotations

import contextlib
import re
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusledger.functions.keys import shard_name
from corpusledger.functions.text import checked_int32, date_literal, int_div
from corpusledger.runtime import MANY_FILES, bounded_listing, path_exists, stage_parts
from corpusledger.sources.files import list_files

#: Fixed value: the output columns, in order.
OUTPUT_SCHEMA = "date int, text string, token_count int"
OUTPUT_PHYSICAL = {"date": "INT32", "text": "BYTE_ARRAY", "token_count": "INT32"}
#: ``run`` is the identity of the settings that wrote a shard; of several commits of a shard the last
#: one holds, and one without rows takes the shard back.
MANIFEST_SCHEMA = "source_config string, shard int, rows bigint, tokens bigint, run string, commit bigint"
#: With the commit's time in seconds the manifest, to which rows are only added, is also the history of
#: the run's progress. Manifests of earlier versions have none.
COMMIT_SCHEMA = f"{MANIFEST_SCHEMA}, taken_at double"
SHARDS_PER_TASK = 2
#: Rows of a writing task where shards are small; below that, at most so many tasks for each slot.
ROWS_PER_TASK = 100_000
TASKS_PER_SLOT = 4
#: Spark's reader keeps about 2 KB on the driver for each file of a table: passes over whole years read so
#: many shards at a time, in whole dumps.
SHARDS_PER_READ = 20_000


_clocks: list[Callable[[], float]] = []


@contextlib.contextmanager
def timed_by(clock: Callable[[], float]):
    """Within this, commits are noted with the seconds that ``clock`` gives."""
    _clocks.append(clock)
    try:
        yield
    finally:
        _clocks.remove(clock)


def _now() -> float:
    return float((_clocks[-1] if _clocks else time.time)())


def output_rows(
    rows: DataFrame, year: int, tokens: Column, keep: list[str] | None = None
) -> DataFrame:
    """Exactly the contract's columns, plus the two that become the shard's path.

    ``keep`` names columns that order rows inside a shard; the writer drops them.
    """
    return rows.select(
        date_literal(year).alias("date"),
        "text",
        checked_int32(tokens).alias("token_count"),
        "source_config",
        "shard",
        *(keep or []),
    )


def planned_shards(positions: DataFrame, rows_per_shard: int) -> DataFrame:
    """``(source_config, shard, rows)`` from dense positions; the last shard may be short."""
    shard = int_div("position", rows_per_shard).cast("int")
    return positions.groupBy("source_config", shard.alias("shard")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def shards_of_totals(totals: DataFrame, rows_per_shard: int) -> DataFrame:
    """The same table from per-dump row totals, where positions are dense."""
    size = F.lit(rows_per_shard)
    last = int_div(F.col("rows") - 1, rows_per_shard).cast("int")
    return (
        totals.where("rows > 0")
        .select("source_config", F.col("rows").alias("total"), F.explode(F.sequence(F.lit(0), last)).alias("shard"))
        .select(
            "source_config", "shard",
            F.least(size, F.col("total") - F.col("shard") * size).cast("bigint").alias("rows"),
        )
    )


def committed_shards(spark: SparkSession, root: str) -> DataFrame | None:
    """The manifest of shards already written under ``root`` and when each was committed."""
    path = f"{root}/manifest"
    if not path_exists(spark, path):
        return None
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    rows = rows.withColumn("committed_at", F.col("_metadata.file_modification_time"))
    last = Window.partitionBy("source_config", "shard").orderBy(F.desc("commit"))
    twice = Window.partitionBy("source_config", "shard", "commit")
    message = F.concat(F.lit("committed twice at once: "), "source_config", F.lit("/"), F.col("shard"))
    return (
        rows.withColumns({"place": F.row_number().over(last), "times": F.count(F.lit(1)).over(twice)})
        .where("place = 1")
        .withColumn("rows", F.when(F.col("times") == 1, F.col("rows")).otherwise(F.raise_error(message).cast("bigint")))
        .where("rows > 0")
        .drop("place", "times")
    )


def commit_history(spark: SparkSession, root: str) -> DataFrame:
    """(source_config, commit, taken_at, rows, tokens, shards): what each commit added to each dump.

    A shard that is written anew, or taken back, adds the difference to what it had.
    """
    rows = spark.read.schema(COMMIT_SCHEMA).parquet(f"{root}/manifest")
    before = Window.partitionBy("source_config", "shard").orderBy("commit")
    held = {name: F.coalesce(F.lag(name).over(before), F.lit(0)) for name in ("rows", "tokens")}
    added = rows.select(
        "source_config", "commit", "taken_at",
        *((F.col(name) - held[name]).alias(name) for name in held),
        (F.sign("rows") - F.sign(held["rows"])).cast("bigint").alias("shards"),
    )
    return added.groupBy("source_config", "commit", "taken_at").agg(
        *(F.sum(name).cast("bigint").alias(name) for name in ("rows", "tokens", "shards"))
    )


def pending_shards(planned: DataFrame, committed: DataFrame) -> DataFrame:
    """Planned shards not in the manifest.

    More committed rows than the plan has for a dump means the plan changed under a running job,
    which is an error.
    """
    done = committed.groupBy("source_config").agg(F.sum("rows").alias("done"))
    plan = planned.groupBy("source_config").agg(F.sum("rows").alias("target"))
    beyond = done.join(plan, "source_config").where(F.col("done") > F.col("target"))
    if beyond.limit(1).count():
        raise ValueError("the manifest holds more rows than the plan allows")
    return planned.join(
        committed.select("source_config", "shard"), ["source_config", "shard"], "left_anti"
    )


#: Per dump of a wave its first shard and the one after its last.
Wave = dict[str, tuple[int, int]]


def waves(pending: Wave, shards_per_wave: int) -> list[Wave]:
    """Ranges of shards by dump, cut so that each wave has at most ``shards_per_wave`` shards.

    A large dump spreads over several waves, so what a crash loses is a wave's worth of shards.
    """
    groups: list[Wave] = [{}]
    room = shards_per_wave
    for name in sorted(pending):
        first, end = pending[name]
        while first < end:
            if not room:
                groups.append({})
                room = shards_per_wave
            taken = min(room, end - first)
            groups[-1][name] = (first, first + taken)
            first, room = first + taken, room - taken
    return [group for group in groups if group]


def in_wave(wave: Wave) -> Column:
    """Whether a row with ``source_config`` and ``shard`` belongs to the wave."""
    inside = F.lit(False)
    for name, (first, end) in wave.items():
        own = (F.col("source_config") == name) & (F.col("shard") >= first) & (F.col("shard") < end)
        inside = inside | own
    return inside


def write_shards(
    rows: DataFrame, root: str, *, order: list[str], year: int, tokens: Column, shards: int,
    compression: str = "zstd", rows_per_shard: int | None = None,
) -> None:
    """Write rows that carry ``source_config`` and ``shard``: one file per shard, in order.

    The only wide shuffle of text. Tokens are counted behind it if ``tokens`` is a counter, so
    the work spreads over shards however few splits the source has. A task writes
    ``SHARDS_PER_TASK`` shards, or more of them if they are small (``rows_per_shard``). It appends, so
    any output committer will do, and tasks put their files in place themselves, without checksum files
    beside them; ``clear_shards`` removes what a crashed wave left behind.
    """
    keys = ["source_config", "shard"]
    placed = rows.repartition(writing_tasks(rows.sparkSession, shards, rows_per_shard), *keys)
    (
        output_rows(placed, year, tokens, keep=order)
        .sortWithinPartitions(*keys, *order)
        .drop(*order)
        .write.mode("append")
        .option("compression", compression)
        .options(**MANY_FILES)
        .partitionBy(*keys)
        .parquet(f"{root}/data")
    )


def writing_tasks(spark: SparkSession, shards: int, rows_per_shard: int | None = None) -> int:
    """How many tasks write so many shards: a number that grows with rows, not with small shards."""
    tasks = -(-shards // SHARDS_PER_TASK)
    if rows_per_shard is not None:
        by_rows = -(-shards * rows_per_shard // ROWS_PER_TASK)
        tasks = min(tasks, max(by_rows, TASKS_PER_SLOT * spark.sparkContext.defaultParallelism))
    return max(1, tasks)


def clear_shards(spark: SparkSession, root: str, firsts: dict[str, int], run: str, commit: int) -> None:
    """Delete every shard of a dump from its first pending one on.

    That is what a crashed wave wrote without committing it, and a short last shard that is to
    grow. The latter is taken back from the manifest before its file goes.
    """
    manifest = committed_shards(spark, root)
    if manifest is not None:
        pending = F.lit(False)
        for name, first in firsts.items():
            pending = pending | (F.col("source_config") == name) & (F.col("shard") >= first)
        taken_back = manifest.where(pending).select("source_config", "shard").collect()
        if taken_back:  # at most one per dump: all earlier ones are full
            rows = [(row[0], row[1], 0, 0, run, commit, _now()) for row in taken_back]
            spark.createDataFrame(rows, COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    for name, first in firsts.items():
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/data/source_config={name}")
        filesystem = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not filesystem.exists(folder):
            continue
        for status in filesystem.listStatus(folder):
            shard = re.fullmatch(r"shard=(\d+)", status.getPath().getName())
            if shard and int(shard[1]) >= first:
                filesystem.delete(status.getPath(), True)


def commit_shards(spark: SparkSession, root: str, wave: Wave, run: str, commit: int) -> None:
    """Append a wave's shards to the manifest, measured from what was written, all of them at once."""
    taken_at = _now()

    def measured(group: list[str]) -> DataFrame:
        own = in_wave({name: wave[name] for name in group})
        return read_output(spark, root, group).where(own).groupBy("source_config", "shard").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("token_count").cast("bigint").alias("tokens"),
            F.lit(run).alias("run"), F.lit(commit).cast("bigint").alias("commit"),
            F.lit(taken_at).alias("taken_at"),
        )

    # A dump's folder has its earlier shards too.
    groups = dump_groups({name: end for name, (_, end) in wave.items()})
    stage_parts(groups, measured, "measured").write.mode("append").parquet(f"{root}/manifest")


def dump_groups(shards: dict[str, int]) -> list[list[str]]:
    """Dumps in name order, cut so that each group has at most ``SHARDS_PER_READ`` shards, or one dump."""
    groups: list[list[str]] = []
    room = 0
    for name in sorted(shards):
        if not groups or shards[name] > room:
            groups.append([])
            room = SHARDS_PER_READ
        groups[-1].append(name)
        room -= shards[name]
    return groups


def output_groups(spark: SparkSession, root: str, listed: DataFrame) -> list[list[str]] | None:
    """The written dumps in ``dump_groups`` by the paths of their files; None if one read can take the whole year.

    So it is too if there is anything beside the folders of dumps, for Spark's reader to judge.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/data")
    filesystem = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [status for status in filesystem.listStatus(folder) if status.getPath().getName()[0] not in "._"]
    dumps = [re.fullmatch(r"source_config=([\w.-]+)", status.getPath().getName()) for status in found]
    if not all(status.isDirectory() and dump for status, dump in zip(found, dumps)):
        return None
    held = {dump[1]: 0 for dump in dumps}
    dump = F.regexp_extract("path", r"/source_config=([^/]+)/", 1)
    held.update({row[0]: row[1] for row in listed.groupBy(dump).count().collect()})
    groups = dump_groups(held)
    return groups if len(groups) > 1 else None


def last_commit(spark: SparkSession, root: str) -> int:
    """The number of the last commit under ``root``, 0 without any."""
    if not path_exists(spark, f"{root}/manifest"):
        return 0
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/manifest")
    return rows.agg(F.max("commit")).first()[0] or 0


def read_output(spark: SparkSession, root: str, dumps: list[str] | None = None) -> DataFrame:
    """The written rows with their shard identity, which lives in the path.

    Naming dumps lists only their directories.
    """
    schema = f"{OUTPUT_SCHEMA}, source_config string, shard int"
    base = f"{root}/data"
    paths = [f"{base}/source_config={name}" for name in dumps] if dumps else [base]
    with bounded_listing(spark):
        return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def output_files(spark: SparkSession, root: str) -> DataFrame:
    """``(source_config, shard, shard_name, path, size)`` of the written shards."""
    return (
        list_files(spark, f"{root}/data")
        .withColumn("source_config", F.regexp_extract("path", r"/source_config=([^/]+)/", 1))
        .withColumn("shard", F.regexp_extract("path", r"/shard=(\d+)/", 1).cast("int"))
        .select(
            "source_config", "shard",
            shard_name("source_config", "shard").alias("shard_name"), "path", "size",
        )
    )
