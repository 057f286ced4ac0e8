"""Files as tables: listings, Parquet footers and content hashes."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusledger.runtime import bounded_listing, pin_small, stage, stage_parts

FOOTER_SCHEMA = (
    "path string, row_group int, rows bigint, col_index int, col string, type string, "
    "comp bigint, uncomp bigint, codec string"
)


#: Splits of a file listing per task slot of the session, if there are so many files for each.
LISTING_SPLITS_PER_SLOT = 4
FILES_PER_SPLIT = 16
#: What a task has found below its folders is handed on in batches of so many entries.
LISTED_PER_BATCH = 10_000
LISTED_SCHEMA = "path string, folder boolean, size bigint, modified bigint"


def open_filesystem(path: str):
    """The file system and inner path of a listed file, inside a task; listings do not quote paths."""
    from pyarrow import fs

    path = path.replace("%", "%25").replace(" ", "%20")

    # Hadoop prints local paths with one slash, Arrow wants an empty host.
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def list_files(spark: SparkSession, base: str, pattern: str = "*.parquet") -> DataFrame:
    """``(path, name, size, modified)`` of the files below ``base``; no content is read.

    Empty files are listed with size 0 and no time; names that Spark's readers pass over are left out.
    Tasks list the folders level by level, so the driver holds no entry per file. Only of a store
    that Arrow does not reach, of a single file or a pattern of folders does Spark's reader make the list.
    """
    if not _tasks_can_list(spark, base, pattern):
        return _listed_by_reader(spark, base, pattern)
    matches = re.compile(fnmatch.translate(pattern)).match

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        rows: list[tuple] = []
        for batch in batches:
            for path in batch.column(0).to_pylist():
                filesystem, inner = open_filesystem(path)
                for entry in filesystem.get_file_info(fs.FileSelector(inner)):
                    name, folder = entry.base_name, entry.type == fs.FileType.Directory
                    if not _passed_over(name) and (folder or matches(name)):
                        # Summary files have no rows, so they are listed as empty ones are.
                        size = 0 if folder or name.startswith("_") and "=" not in name else entry.size
                        time = entry.mtime_ns // 1_000_000 if size else None
                        rows.append((f"{path.rstrip('/')}/{name}", folder, size, time))
                    if len(rows) == LISTED_PER_BATCH:
                        yield _listed_batch(rows)
                        rows = []
        yield _listed_batch(rows)

    found, count = _level_by_level(spark, base, visit, LISTED_SCHEMA)
    splits = min(LISTING_SPLITS_PER_SLOT * spark.sparkContext.defaultParallelism, -(-count // FILES_PER_SPLIT))
    return found.repartition(max(1, splits)).select(
        "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "size",
        F.timestamp_millis("modified").alias("modified"),
    )


def _listed_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"path": pa.string(), "folder": pa.bool_(), "size": pa.int64(), "modified": pa.int64()}
    columns = zip(*rows) if rows else ([] for _ in kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(values), kind) for values, kind in zip(columns, kinds.values())], names=list(kinds)
    )


def _passed_over(name: str) -> bool:
    """Whether Spark's readers pass over files and folders of that name."""
    hidden = name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")
    return hidden and not name.startswith(("_common_metadata", "_metadata"))


def _tasks_can_list(spark: SparkSession, base: str, pattern: str) -> bool:
    """Whether ``base`` is one folder in a store that Arrow reaches, and Python knows the pattern as Hadoop does."""
    from pyarrow import fs

    if re.search(r"[*?\[{\\]", base) or not re.fullmatch(r"[\w.*?-]+", pattern):
        return False
    try:
        filesystem, inner = open_filesystem(_qualified(spark, base))
        return filesystem.get_file_info(inner).type == fs.FileType.Directory
    except (pa.ArrowException, OSError):
        return False


def _level_by_level(spark: SparkSession, base: str, visit: Callable, schema: str) -> tuple[DataFrame, int]:
    """What ``visit`` finds in the folder ``base`` and in the folders it finds, staged, and how many files."""
    slots = LISTING_SPLITS_PER_SLOT * spark.sparkContext.defaultParallelism
    level = spark.createDataFrame([(_qualified(spark, base),)], "path string").coalesce(1)
    levels, files = [], 0
    while True:
        listed = stage(level.mapInArrow(visit, schema), "folders")
        levels.append(listed.where("NOT folder"))
        folders, others = listed.agg(F.count_if("folder"), F.count_if(~F.col("folder"))).first()
        files += others
        if not folders:
            return reduce(DataFrame.unionByName, levels), files
        level = listed.where("folder").select("path").repartition(min(slots, folders))


def _listed_by_reader(spark: SparkSession, base: str, pattern: str) -> DataFrame:
    """The same list by Spark's reader, which passes over empty files: they come from its own list of paths.

    The reader plans about one split per large file; as only names are read, splits are merged to a
    few per slot.
    """
    splits = LISTING_SPLITS_PER_SLOT * spark.sparkContext.defaultParallelism
    with bounded_listing(spark):
        found = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true")
            .load(base)
        )
    files = found.coalesce(splits).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )
    empty = (
        _listed_paths(found)
        .join(files.select(plain_path("path").alias("plain")), "plain", "left_anti")
        .select(F.col("plain").alias("path"), F.lit(0).cast("bigint").alias("size"),
                F.lit(None).cast("timestamp").alias("modified"))
    )
    return files.unionByName(empty).select(
        "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "size", "modified"
    )


def _listed_paths(files: DataFrame) -> DataFrame:
    """``plain``: every path a file reader has listed, handed over without leaving the JVM."""
    jvm = files.sparkSession._jvm
    wrapped = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(files._jdf.inputFiles())
    paths = jvm.scala.jdk.javaapi.CollectionConverters.asJava(wrapped)
    listed = files.sparkSession._jsparkSession.createDataset(paths, jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(listed.toDF(), files.sparkSession).select(
        plain_path(F.replace(F.replace("value", F.lit("%20"), F.lit(" ")), F.lit("%25"), F.lit("%"))).alias("plain")
    )


def leftovers(spark: SparkSession, base: str) -> DataFrame:
    """``(path, size)`` of what unfinished writers leave below ``base``, however deep.

    Temporary files, empty ones included, and the working folders of output committers, also in
    folders without files. Tasks list the folders found so far, level by level until none is left;
    a working folder is reported and not entered. Like footers and hashes, this needs a store that
    Arrow reaches.
    """
    found, _ = _level_by_level(spark, base, _list_folders, "path string, folder boolean, size bigint")
    return found.select("path", "size")


def _list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The folders in each folder, and what unfinished writers left in it."""
    from pyarrow import fs

    for batch in batches:
        for path in batch.column(0).to_pylist():
            filesystem, inner = open_filesystem(path)
            paths, folders, sizes = [], [], []
            for entry in filesystem.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
                folder = entry.type == fs.FileType.Directory
                working = folder and entry.base_name == "_temporary"
                if folder or entry.base_name.endswith(".tmp") and entry.base_name[0] not in "._":
                    paths.append(f"{path.rstrip('/')}/{entry.base_name}")
                    folders.append(folder and not working)
                    sizes.append(0 if folder else entry.size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(folders, pa.bool_()), pa.array(sizes, pa.int64())],
                names=["path", "folder", "size"],
            )


def _qualified(spark: SparkSession, path: str) -> str:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return filesystem.makeQualified(folder).toString()


def dump_discovery(spark: SparkSession, base: str, prefix: str, parent: str = "") -> DataFrame:
    """Dumps below ``base`` whose directory name starts with ``prefix``: shards and bytes.

    ``parent`` is the part of the directory name before the dump name, for example
    ``source_config=``.
    """
    dump = F.regexp_extract("path", rf"/{parent}([^/]*)/(?:[^/]+/)*[^/]+$", 1)
    return (
        list_files(spark, base)
        .withColumn("source_config", dump)
        .where(F.col("source_config").startswith(prefix) & (F.col("source_config") != ""))
        .groupBy("source_config")
        .agg(
            F.count(F.lit(1)).alias("shards"),
            F.sum("size").alias("bytes"),
            F.min("name").alias("first_shard"),
            F.max("name").alias("last_shard"),
        )
    )


def footer_scan(files: DataFrame) -> DataFrame:
    """One row per file, row group and column, from Parquet footers; data pages stay unread.

    ``files`` is a listing with ``path``; its partitions say how many footers a task opens.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for batch in batches:
            for path in batch.column(0).to_pylist():
                filesystem, inner = open_filesystem(path)
                with filesystem.open_input_file(inner) as handle:
                    footer = pq.ParquetFile(handle).metadata
                    columns: dict[str, list] = {name: [] for name in FOOTER_FIELDS}
                    for index in range(footer.num_row_groups):
                        group = footer.row_group(index)
                        for number in range(group.num_columns):
                            column = group.column(number)
                            values = (
                                path, index, group.num_rows, number, column.path_in_schema,
                                column.physical_type, column.total_compressed_size,
                                column.total_uncompressed_size, column.compression,
                            )
                            for name, value in zip(FOOTER_FIELDS, values):
                                columns[name].append(value)
                yield pa.RecordBatch.from_pydict(columns, schema=FOOTER_ARROW)

    if "size" in files.columns:
        files = files.where("size > 0")  # an empty file has no footer
    return files.select("path").mapInArrow(read, FOOTER_SCHEMA)


FOOTER_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("row_group", pa.int32()),
        ("rows", pa.int64()),
        ("col_index", pa.int32()),
        ("col", pa.string()),
        ("type", pa.string()),
        ("comp", pa.int64()),
        ("uncomp", pa.int64()),
        ("codec", pa.string()),
    ]
)
FOOTER_FIELDS = FOOTER_ARROW.names


def shard_footers(footers: DataFrame) -> DataFrame:
    """Footers rolled up per file: rows, row groups, codecs, column and text bytes."""
    text = F.col("col") == "text"
    once = F.when(F.col("col_index") == 0, F.col("rows")).otherwise(0)
    return (
        footers.groupBy("path")
        .agg(
            F.sum(once).alias("rows"),
            (F.max("row_group") + 1).alias("row_groups"),
            F.array_sort(F.collect_set("codec")).alias("codecs"),
            F.sum("comp").alias("compressed_bytes"),
            F.sum("uncomp").alias("uncompressed_bytes"),
            F.sum(F.when(text, F.col("comp")).otherwise(0)).alias("text_compressed_bytes"),
            F.sum(F.when(text, F.col("uncomp")).otherwise(0)).alias("text_uncompressed_bytes"),
        )
    )


def plain_path(path: Column | str) -> Column:
    """Listings and row metadata print local paths with one and three slashes; make them equal."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def row_group_slice(
    rows: DataFrame, footers: DataFrame, groups: list[int] | DataFrame, columns: list[str]
) -> DataFrame:
    """``columns`` of the rows in the chosen row groups, with file, group and place in the group.

    ``rows`` is a Parquet read of the files the footers describe; ``groups`` are numbers that
    hold for every file, or a table of (path, row_group). Row groups become ranges of the
    reader's row index; a file's ranges are one small array, so nothing is shuffled.
    """
    upto = Window.partitionBy("path").orderBy("row_group")
    spans = footers.where("col_index = 0").withColumn("last", F.sum("rows").over(upto))
    if isinstance(groups, DataFrame):
        spans = spans.join(groups.select("path", "row_group"), ["path", "row_group"])
    else:
        spans = spans.where(F.col("row_group").isin(*groups))
    ranges = (
        spans.groupBy(plain_path("path").alias("path"))
        .agg(
            F.collect_list(
                F.struct("row_group", (F.col("last") - F.col("rows")).alias("first"), "last")
            ).alias("ranges")
        )
    )
    indexed = rows.select(
        *columns,
        plain_path("_metadata.file_path").alias("path"),
        F.col("_metadata.row_index").alias("row_index"),
    )
    index = F.col("row_index")
    inside = F.filter("ranges", lambda r: (index >= r["first"]) & (index < r["last"]))
    return (
        indexed.join(pin_small(ranges), "path")
        .withColumn("range", F.get(inside, F.lit(0)))
        .where(F.col("range").isNotNull())
        .select(
            *columns, "path", F.col("range.row_group").alias("row_group"),
            (index - F.col("range.first")).alias("row"),
        )
    )


def file_digests(files: DataFrame, chunk: int = 8 * 1024 * 1024) -> DataFrame:
    """Add the SHA-256 of each file, read in chunks inside the tasks.

    Chunked reading keeps a task's memory at one chunk and has no file size limit.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        for batch in batches:
            hashes = []
            for path in batch.column(0).to_pylist():
                filesystem, inner = open_filesystem(path)
                running = sha256()
                with filesystem.open_input_stream(inner) as handle:
                    while block := handle.read(chunk):
                        running.update(block)
                hashes.append(running.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(hashes, pa.string())],
                names=["path", "name", "size", "sha256"],
            )

    return files.select("path", "name", "size").mapInArrow(
        digest, "path string, name string, size bigint, sha256 string"
    )


def content_digests(spark: SparkSession, folders: list[list[str]], pattern: str = "*.parquet") -> DataFrame:
    """``(path, size, sha256)`` of the files below the folders, hashed as whole contents by Spark's reader; staged.

    The driver holds an entry per file of one list of folders at a time.
    """

    def hashed(paths: list[str]) -> DataFrame:
        with bounded_listing(spark):
            content = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern).load(paths)
        return content.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))

    return stage_parts(folders, hashed, "contents")
