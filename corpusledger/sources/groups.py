"""Chosen row groups of Parquet files as a data source: of the rest, not a byte is read.

Spark's own Parquet reader takes whole files or byte ranges and drops row groups only by column
statistics. Samples name row groups by number, so this source plans one input partition per chosen
group, and partitions of several groups where there are more of them than ``TASKS_PER_SLOT`` for each
slot; a task opens the file's footer, then reads each group's chosen columns batch by batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, LessThan, LessThanOrEqual,
)
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from corpusledger.sources.files import open_filesystem

FORMAT = "parquet_row_groups"
#: What the source adds to a file's columns: file, group, place in the group and place in the file.
PLACES = [
    StructField("path", StringType()),
    StructField("row_group", IntegerType()),
    StructField("row", LongType()),
    StructField("file_row", LongType()),
]
_PLACE_NAMES = [field.name for field in PLACES]
BATCH_ROWS = 1024
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: Row groups of small files are read by at most so many tasks for each slot of the session.
TASKS_PER_SLOT = 16

_registered: set[str] = set()


@dataclass
class RowGroup(InputPartition):
    path: str | None
    number: int
    #: Further groups of the same task.
    more: list[RowGroup] = field(default_factory=list)


class RowGroupReader(DataSourceReader):
    """Reads the groups of the option ``groups``: ``[[path, [number, ...]], ...]``.

    The option ``tasks`` is the largest number of partitions; without it each group has its own.
    """

    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.schema = schema
        self.groups = json.loads(options["groups"])
        self.tasks = int(options.get("tasks", 0))
        self.pushed: list[Filter] = []

    def __getstate__(self) -> dict:
        # Every task gets a copy of the reader, and its groups by its partition.
        return self.__dict__ | {"groups": [], "pushed": []}

    def partitions(self) -> list[RowGroup]:
        chosen = [RowGroup(path, number) for path, numbers in self.groups for number in numbers]
        kept = [group for group in chosen if all(_passes(filter_, group) for filter_ in self.pushed)]
        if self.tasks and len(kept) > self.tasks:
            kept = [RowGroup(part[0].path, part[0].number, part[1:]) for part in _parts(kept, self.tasks)]
        return kept or [RowGroup(None, 0)]  # Spark asks for one at least

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        for group in (partition, *partition.more):
            yield from self._read_group(group)

    def _read_group(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition.path is None:
            return
        wanted = to_arrow_schema(self.schema)
        columns = [field.name for field in wanted if field.name not in _PLACE_NAMES]
        filesystem, inner = open_filesystem(partition.path)
        with filesystem.open_input_file(inner) as handle:
            file = pq.ParquetFile(handle)
            sizes = [file.metadata.row_group(i).num_rows for i in range(partition.number + 1)]
            # Without any column of the file, its footer tells how many rows there are.
            batches = (
                file.iter_batches(BATCH_ROWS, row_groups=[partition.number], columns=columns)
                if columns else iter([_no_columns(sizes[-1])])
            )
            first, row = sum(sizes[:-1]), 0
            for batch in batches:
                places = pa.array(range(row, row + batch.num_rows), pa.int64())
                extra = {
                    "path": pa.array([partition.path] * batch.num_rows, pa.string()),
                    "row_group": pa.array([partition.number] * batch.num_rows, pa.int32()),
                    "row": places,
                    "file_row": pa.compute.add(places, first),
                }
                row += batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        extra[field.name] if field.name in extra else batch.column(field.name).cast(field.type)
                        for field in wanted
                    ],
                    schema=wanted,
                )


class PushingReader(RowGroupReader):
    """For sessions with filter push-down; Spark refuses a reader that offers it in others."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Filters on file and group choose partitions and need no second look."""
        for filter_ in filters:
            if getattr(filter_, "attribute", None) in (("path",), ("row_group",)) and isinstance(
                filter_, tuple(_HOLDS)
            ):
                self.pushed.append(filter_)
            else:
                yield filter_


def _parts(groups: list[RowGroup], count: int) -> list[list[RowGroup]]:
    """The groups in ``count`` runs of nearly one length, none of them empty."""
    return [groups[len(groups) * i // count:len(groups) * (i + 1) // count] for i in range(count)]


def _no_columns(rows: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(rows)], names=["none"])


_HOLDS = {
    EqualTo: lambda filter_, value: value == filter_.value,
    In: lambda filter_, value: value in filter_.value,
    LessThan: lambda filter_, value: value < filter_.value,
    LessThanOrEqual: lambda filter_, value: value <= filter_.value,
    GreaterThan: lambda filter_, value: value > filter_.value,
    GreaterThanOrEqual: lambda filter_, value: value >= filter_.value,
    IsNotNull: lambda filter_, value: True,
}


def _passes(filter_: Filter, group: RowGroup) -> bool:
    value = group.path if filter_.attribute == ("path",) else group.number
    return _HOLDS[type(filter_)](filter_, value)


class RowGroupSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: StructType) -> RowGroupReader:
        pushes = self.options.get("pushdown") == "true"
        return (PushingReader if pushes else RowGroupReader)(schema, self.options)


def read_row_groups(groups: DataFrame, columns: list[StructField]) -> DataFrame:
    """``columns`` of the chosen row groups, with ``path``, ``row_group``, ``row`` and ``file_row``.

    ``groups`` is a table of (path, row_group). It comes to the driver, which deals its rows to tasks:
    one for each, or runs of several in at most ``TASKS_PER_SLOT`` tasks a slot. Filters on path and group drop tasks where the session has
    ``spark.sql.python.filterPushdown.enabled``, and rows where it has not. Files need a store that
    Arrow reaches. A group that a file does not have fails its task; no groups give no rows.
    """
    spark = groups.sparkSession
    chosen = groups.groupBy("path").agg(F.sort_array(F.collect_set("row_group")).alias("numbers")).collect()
    schema = StructType([*columns, *PLACES])
    if not chosen:
        return spark.createDataFrame([], schema)
    listed = json.dumps(sorted([row["path"], row["numbers"]] for row in chosen))
    pushdown = spark.conf.get(PUSHDOWN, "false")
    tasks = TASKS_PER_SLOT * spark.sparkContext.defaultParallelism
    source = _source(spark).schema(schema).option("groups", listed).option("tasks", str(tasks))
    return source.option("pushdown", pushdown).load()


def _source(spark: SparkSession):
    if spark.sparkContext.applicationId not in _registered:
        spark.dataSource.register(RowGroupSource)
        _registered.add(spark.sparkContext.applicationId)
    return spark.read.format(FORMAT)
