"""Row groups read alone, and the samples that choose them."""

import os
import pickle

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, IsNotNull, LessThan, StringContains
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corpusledger.operators import project, sample
from corpusledger.runtime import scratch_path, session_settings
from corpusledger.sources import files, groups

N, TEXT = StructField("n", LongType()), StructField("text", StringType())


@pytest.fixture(scope="module")
def base(spark):
    """Two files: forty row groups of 25 rows with wide texts, and one of three uneven groups."""
    folder = scratch_path(spark, "grouped files")
    os.makedirs(folder)
    table = pa.table({"n": range(1000), "text": [f"{i} " + os.urandom(2_000).hex() for i in range(1000)], "m": range(1000)})
    pq.write_table(table, f"{folder}/a.parquet", row_group_size=25)
    with pq.ParquetWriter(f"{folder}/b.parquet", table.schema) as out:
        for at, rows in ((0, 3), (3, 0), (3, 10), (13, 2)):
            out.write_table(table.slice(at, rows), row_group_size=100)
    return folder


@pytest.fixture(scope="module")
def footers(spark, base):
    return files.footer_scan(files.list_files(spark, base)).cache()


def path_of(footers, name):
    return next(r["path"] for r in footers.select("path").distinct().collect() if r["path"].endswith(name))


def test_chosen_groups_only(spark, footers):
    a, b = path_of(footers, "a.parquet"), path_of(footers, "b.parquet")
    chosen = spark.createDataFrame([(a, 3), (a, 39), (a, 3), (b, 2), (b, 1)], "path string, row_group int")
    rows = groups.read_row_groups(chosen, [N, TEXT])
    assert rows.rdd.getNumPartitions() == 4
    found = sorted((r["path"], r["row_group"], r["row"], r["file_row"], r["n"]) for r in rows.collect())
    wanted = [(a, g, i, 25 * g + i, 25 * g + i) for g in (3, 39) for i in range(25)]
    assert found == wanted + [(b, 2, i, 3 + i, 3 + i) for i in range(10)]
    assert all(r["text"].startswith(f"{r['n']} ") for r in rows.collect())


class Counting:
    """A file that counts what is read of it."""

    def __init__(self, path):
        self.file, self.read_bytes, self.closed = open(path, "rb"), 0, False

    def read(self, size=-1):
        data = self.file.read(size)
        self.read_bytes += len(data)
        return data

    def seek(self, *where):
        return self.file.seek(*where)

    def tell(self):
        return self.file.tell()

    def size(self):
        return os.fstat(self.file.fileno()).st_size

    def close(self):
        self.closed = True

    def seekable(self):
        return True

    def readable(self):
        return True

    def writable(self):
        return False


def read_bytes(monkeypatch, base, columns, numbers):
    """What a reader's partitions read of the file with forty groups."""
    opened = []

    class Store:
        def open_input_file(self, inner):
            opened.append(Counting(inner))
            return pa.PythonFile(opened[-1], mode="r")

    monkeypatch.setattr(groups, "open_filesystem", lambda path: (Store(), f"{base}/a.parquet"))
    reader = groups.RowGroupReader(StructType([*columns, *groups.PLACES]), {"groups": f'[["a", {numbers}]]'})
    rows = sum(batch.num_rows for part in reader.partitions() for batch in reader.read(part))
    return rows, sum(file.read_bytes for file in opened)


def test_bytes_of_the_chosen_groups_only(monkeypatch, base):
    meta = pq.ParquetFile(f"{base}/a.parquet").metadata
    footer = meta.serialized_size + 65536  # the reader takes the file's last 64 KB at once
    size = os.path.getsize(f"{base}/a.parquet")
    rows, read = read_bytes(monkeypatch, base, [N, TEXT], [0, 7, 21])
    own = sum(meta.row_group(g).column(c).total_compressed_size for g in (0, 7, 21) for c in (0, 1))
    assert rows == 75 and own <= read <= own + 3 * footer < size / 2
    rows, narrow = read_bytes(monkeypatch, base, [N], [0, 7, 21])
    assert rows == 75 and narrow <= sum(meta.row_group(g).column(0).total_compressed_size for g in (0, 7, 21)) + 3 * footer
    assert read_bytes(monkeypatch, base, [], [5])[0] == 25


def test_pushed_filters_drop_partitions(spark, footers):
    a, b = path_of(footers, "a.parquet"), path_of(footers, "b.parquet")
    reader = groups.PushingReader(StructType([N]), {"groups": f'[["{a}", [0, 1, 2, 30]], ["{b}", [0, 2]]]'})
    left = [StringContains(("path",), "x"), EqualTo(("n",), 3)]
    pushed = [In(("row_group",), (1, 2, 30)), LessThan(("row_group",), 20), EqualTo(("path",), a), IsNotNull(("path",))]
    assert list(reader.pushFilters([*left, *pushed])) == left
    assert [(p.path, p.number) for p in reader.partitions()] == [(a, 1), (a, 2)]
    chosen = footers.where("col_index = 0").select("path", "row_group")
    for enabled in ("true", "false"):
        with session_settings(spark, {groups.PUSHDOWN: enabled}):
            rows = groups.read_row_groups(chosen, [N]).where(F.col("row_group").isin(1, 39) & (F.col("path") == a))
            assert sorted(r["n"] for r in rows.collect()) == [*range(25, 50), *range(975, 1000)]
            none = groups.read_row_groups(chosen, [N]).where("row_group = 77")
            assert none.count() == 0
    with session_settings(spark, {groups.PUSHDOWN: "true"}):
        rows = groups.read_row_groups(chosen, [N]).where("row_group = 39")
        assert rows.rdd.getNumPartitions() == 1


def test_no_groups_and_missing_groups(spark, footers):
    assert groups.read_row_groups(footers.where("false"), [N]).count() == 0
    gone = footers.where("col_index = 0").select("path", F.lit(99).alias("row_group"))
    with pytest.raises(Exception, match="(?i)index|group"):
        groups.read_row_groups(gone, [N]).count()


def test_groups_until_rows_are_reached(spark, footers):
    a, b = path_of(footers, "a.parquet"), path_of(footers, "b.parquet")

    def chosen(rows):
        found = sample.groups_reaching(footers, rows).collect()
        return [sorted(r["row_group"] for r in found if r["path"] == p) for p in (a, b)]

    assert chosen(0) == [[], []]
    assert chosen(3) == [[0], [0]] and chosen(4) == [[0], [0, 1, 2]]
    assert chosen(25) == [[0], [0, 1, 2, 3]] and chosen(26) == [[0, 1], [0, 1, 2, 3]]
    assert chosen(10**6) == [list(range(40)), [0, 1, 2, 3]]
    rows = sample.leading_texts(sample.groups_reaching(footers, 30), 30).collect()
    assert sorted((r["path"], r["file_row"]) for r in rows) == [(a, i) for i in range(30)] + [(b, i) for i in range(15)]
    first = sample.first_groups(footers, 3).collect()
    assert sorted((r["path"], r["row_group"]) for r in first) == [(p, g) for p in (a, b) for g in range(3)]


def test_written_bytes_are_those_of_the_files(spark, base, tmp_path):
    rows = spark.range(300).selectExpr(
        "concat('y ', id % 3, '%') AS year", "2013 AS date", "repeat(cast(id AS string), 20) AS text", "1 AS token_count"
    )
    found = {r["year"]: r for r in project.written_bytes(rows, "year").collect()}
    assert set(found) == {"y 0%", "y 1%", "y 2%"}
    for year, row in found.items():
        alone = rows.where(F.col("year") == year).drop("year").coalesce(1)
        alone.write.option("compression", "zstd").parquet(str(tmp_path / year[2]))
        size = sum(p.stat().st_size for p in (tmp_path / year[2]).glob("*.parquet"))
        assert row["rows"] == 100 and abs(row["file_bytes"] - size) < 0.05 * size
        assert row["output_bytes_per_row"] == row["file_bytes"] / 100


def test_many_groups_share_tasks(spark, footers, monkeypatch):
    """No more tasks than the bound, every group once, and no task gets the others' groups."""
    a = path_of(footers, "a.parquet")
    options = {"groups": f'[["{a}", {list(range(40))}]]', "tasks": "3"}
    reader = groups.RowGroupReader(StructType([N, *groups.PLACES]), options)
    parts = reader.partitions()
    assert [1 + len(part.more) for part in parts] == [13, 13, 14]
    assert [g.number for part in parts for g in (part, *part.more)] == list(range(40))
    assert a.encode() not in pickle.dumps(reader)
    assert sum(batch.num_rows for part in parts for batch in reader.read(part)) == 1000
    monkeypatch.setattr(groups, "TASKS_PER_SLOT", 1)
    rows = groups.read_row_groups(footers.where("col_index = 0").select("path", "row_group"), [N])
    assert rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    found = sorted((r["path"] == a, r["row_group"], r["row"], r["file_row"], r["n"]) for r in rows.collect())
    assert [row for row in found if row[0]] == [(True, i // 25, i % 25, i, i) for i in range(1000)]
    assert len(found) == 1015
