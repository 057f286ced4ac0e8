"""What the driver and the scheduler hold of many small files: no entry or task for each."""

import gc
import weakref

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corpusledger.functions.counters import CounterSpec
from corpusledger.plans import check
from corpusledger.plans.config import RunConfig
from corpusledger.plans.year import run_year
from corpusledger.runtime import LISTING_CACHE, bounded_listing, stage_parts
from corpusledger.sinks import shards as sink
from corpusledger.sources import files


def _rows(listing):
    return sorted(tuple(row) for row in listing.select("path", "name", "size", "modified").collect())


def test_tasks_list_files(spark, tmp_path):
    """The list is that of Spark's reader, but no list of all files is on the driver."""
    base = tmp_path / "out dir"
    for i in range(60):
        folder = base / f"source_config=d{i % 3}" / f"shard={i}"
        folder.mkdir(parents=True)
        (folder / f"part {i}.parquet").write_bytes(b"x" * (i % 5))
    (base / "source_config=d0" / "at 100%.parquet").write_bytes(b"x")
    for hidden in ("_SUCCESS", "_x.parquet", ".y.parquet", "z.parquet._COPYING_", "_temporary/0/a.parquet", "n.tmp"):
        (base / hidden).parent.mkdir(parents=True, exist_ok=True)
        (base / hidden).write_bytes(b"x")
    (base / "_by=1").mkdir()
    (base / "_by=1" / "_metadata.parquet").write_bytes(b"xy")
    found = files.list_files(spark, str(base))
    assert len(found._jdf.inputFiles()) < 62
    assert found.count() == 62 and found.dtypes == files._listed_by_reader(spark, str(base), "*.parquet").dtypes
    assert _rows(found) == _rows(files._listed_by_reader(spark, str(base), "*.parquet"))
    one = files.list_files(spark, str(base), "part 1.parquet")
    assert [row["name"] for row in one.collect()] == ["part 1.parquet"]
    (tmp_path / "empty").mkdir()
    assert files.list_files(spark, str(tmp_path / "empty")).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.list_files(spark, str(tmp_path / "none"))


def test_listings_leave_no_cache(spark):
    before = spark.conf.get(LISTING_CACHE)
    with bounded_listing(spark):
        assert spark.conf.get(LISTING_CACHE) == "false"
    assert spark.conf.get(LISTING_CACHE) == before


def test_parts_go_before_the_next(spark, tmp_path):
    """The driver holds one part's table at a time, whenever Python would collect its garbage."""
    path = str(tmp_path / "table")
    spark.range(10).write.parquet(path)
    seen = []

    def make(part):
        assert all(table() is None for table in seen)
        rows = spark.read.parquet(path).where(F.col("id") == part)
        seen.append(weakref.ref(rows._jdf))
        return rows

    gc.disable()
    try:
        found = stage_parts([1, 5, 7], make, "part")
    finally:
        gc.enable()
    assert sorted(row["id"] for row in found.collect()) == [1, 5, 7] and len(seen) == 3


@pytest.mark.parametrize("shards, groups", [
    ({"a": 3, "b": 2, "c": 1}, [["a", "b"], ["c"]]), ({"a": 9, "b": 9}, [["a"], ["b"]]),
    ({"b": 0, "a": 5}, [["a", "b"]]), ({}, []),
])
def test_dump_groups(monkeypatch, shards, groups):
    monkeypatch.setattr(sink, "SHARDS_PER_READ", 5)
    assert sink.dump_groups(shards) == groups


def test_years_are_read_in_parts(spark, tmp_path, monkeypatch):
    """A year's commit and its check read some dumps at a time, with the same outcome."""
    docs = spark.range(420).select(
        F.concat(F.lit("d"), F.col("id") % 3).alias("source_config"), (F.col("id") / 3).cast("bigint").alias("doc_id"),
        F.concat(F.lit("some words "), F.col("id")).alias("text"),
    )
    config = RunConfig({
        "year": 2013, "selection": {"rule": "retain_all", "shuffle": False}, "output": {"compression": "zstd"},
        "source": {"configs": {f"d{i}": 140 for i in range(3)}}, "target_tokens": 1,
    })
    reads, plain = [], sink.read_output

    def recording(*given):
        rows = plain(*given)
        reads.append(len(rows._jdf.inputFiles()))
        return rows

    monkeypatch.setattr(sink, "read_output", recording)
    monkeypatch.setattr(check, "read_output", recording)
    outcomes = []
    for most in (1_000, 20):
        monkeypatch.setattr(sink, "SHARDS_PER_READ", most)
        reads.clear()
        root = str(tmp_path / f"year{most}")
        report = run_year(docs, config, root, counter=CounterSpec("regex"), rows_per_shard=10)
        committed = sink.committed_shards(spark, root).select("source_config", "shard", "rows", "tokens", "commit")
        told = report.withColumn("rows", F.col("rows") + 1).withColumn(
            "source_configs", F.filter("source_configs", lambda e: e["source_config"] != "d1")
        )
        problems = check.year_problems(spark, root, told, config)
        outcomes.append((
            sorted(map(tuple, committed.collect())), sorted(map(str, problems.collect())),
            check.verify_year(spark, root, report, config).first().asDict(),
        ))
        assert max(reads) == (42 if most > 20 else 14) and sum(reads) == 42 * 3
    assert outcomes[0] == outcomes[1]
    assert len(outcomes[0][0]) == 42 and outcomes[0][2] == {"problems": 0, "verdict": "PASS"}
    assert {"not in the report", "total rows differ", "total dumps differ"} <= {
        row.split("rule='")[1].split("'")[0] for row in outcomes[0][1]
    }
    # What is beside the dumps is still judged: a file there takes the year as one read again.
    (tmp_path / "year20" / "data" / "more").mkdir()
    listed = sink.output_files(spark, f"{tmp_path}/year20")
    assert sink.output_groups(spark, f"{tmp_path}/year20", listed) is None


def test_hashes_of_many_shards(spark, tmp_path, monkeypatch):
    """Folders of one shard each are listed and hashed by a few tasks, some dumps at a time."""
    rows = spark.range(2_600).select(
        F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"),
        F.concat(F.lit("src"), (F.col("id") < 100).cast("int")).alias("source"),
        F.concat(F.lit("some words "), F.col("id")).alias("text"),
    )
    path = str(tmp_path / "documents.parquet")
    rows.coalesce(1).write.parquet(path)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    answer = db.execute(entry.oracle_sql()["manifest_files"]).fetchall()
    context = spark.sparkContext
    for most in (20_000, 50):
        monkeypatch.setattr(sink, "SHARDS_PER_READ", most)
        context.setJobGroup(f"hashes {most}", "hashes")
        try:
            found = [tuple(row) for row in entry.queries()["manifest_files"](spark, str(tmp_path)).collect()]
        finally:
            context._jsc.clearJobGroup()
        tracker = context.statusTracker()
        stages = [s for job in tracker.getJobIdsForGroup(f"hashes {most}") for s in tracker.getJobInfo(job).stageIds]
        tasks = [info.numTasks for s in stages if (info := tracker.getStageInfo(s))]
        assert max(tasks) <= 4 * context.defaultParallelism < 157 + 7
        assert found == answer == [("verified by sha256", 157 + 7)]
