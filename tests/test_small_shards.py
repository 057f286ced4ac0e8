"""Many small shards: tasks and comparisons grow with rows, and plans keep their output bytes."""

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corpusledger.functions import keys
from corpusledger.functions.counters import CounterSpec
from corpusledger.operators import select
from corpusledger.plans import year
from corpusledger.plans.config import RunConfig
from corpusledger.sinks import shards as sink
from corpusledger.sources import files


def test_writing_tasks(spark):
    slots = sink.TASKS_PER_SLOT * spark.sparkContext.defaultParallelism
    assert sink.writing_tasks(spark, 100_000) == 50_000
    assert sink.writing_tasks(spark, 100_000, 50_000) == 50_000  # large shards: two a task, as ever
    assert sink.writing_tasks(spark, 10_000, 16) == slots
    assert sink.writing_tasks(spark, 10_000_000, 16) == 1_600
    assert sink.writing_tasks(spark, 3, 16) == 2 and sink.writing_tasks(spark, 0, 16) == 1


def test_listing_tasks(spark, tmp_path):
    """Folders of one file each are listed by a few tasks."""
    count = 150
    for i in range(count):
        (tmp_path / f"shard={i}").mkdir()
        (tmp_path / f"shard={i}" / "a.parquet").write_bytes(b"x")
    context = spark.sparkContext
    context.setJobGroup("listing of small folders", "listing")
    try:
        found = files.list_files(spark, str(tmp_path))
    finally:
        context._jsc.clearJobGroup()
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing of small folders") for s in tracker.getJobInfo(job).stageIds]
    tasks = [tracker.getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) <= 4 * context.defaultParallelism < count
    assert found.count() == count


@pytest.mark.parametrize("rows, last, size, bits", [
    (100, 99, 16, 4), (100, 1999, 16, 8), (100, 99, 1, 0), (0, -1, 16, 20), (10, 10**9, 16, 20), (5, 4, 10**9, 20),
])
def test_id_bits(rows, last, size, bits):
    assert keys.id_bits(rows, last, size) == bits
    assert bits in (0, 20) or rows * 2**bits / (last + 1) <= size < rows * 2 ** (bits + 1) / (last + 1)


@pytest.mark.parametrize("rule", ["retain_all", "token_budget"])
def test_buckets_have_few_shards(spark, tmp_path, monkeypatch, rule):
    """A row is compared with the starts of its bucket: few, however many shards a dump has."""
    docs = spark.range(8_000).select(
        F.concat(F.lit("d"), F.col("id") % 3).alias("source_config"), F.col("id").alias("doc_id"),
        F.concat(F.lit("some words "), F.col("id")).alias("text"),
    )
    held = {row[0]: row[1] for row in docs.groupBy("source_config").count().collect()}
    chosen = {"rule": rule, "shuffle": rule == "token_budget"} | ({"random_seed": 7} if rule == "token_budget" else {})
    config = RunConfig({
        "year": 2013, "selection": chosen, "output": {"compression": "zstd"}, "source": {"configs": held},
        "target_tokens": 3 * 6_000,
    })
    starts, plain = [], year.shard_bounds

    def recording(*args, **names):
        bounds = plain(*args, **names)
        starts.append(bounds.agg(F.max(F.size("starts"))).first()[0])
        return bounds

    monkeypatch.setattr(year, "shard_bounds", recording)
    monkeypatch.setattr(year, "SHARDS_PER_BUCKET", 8)
    root = str(tmp_path / "year")
    year.run_year(docs, config, root, counter=CounterSpec("regex"), rows_per_shard=10)
    assert starts and max(starts) <= 16
    order = F.struct("doc_id") if rule == "retain_all" else F.struct("key", "doc_id")
    ordered = docs if rule == "retain_all" else select.seeded(docs, 7)
    wanted = {
        row[0]: [d["doc_id"] for d in row[1]]
        for row in ordered.groupBy("source_config").agg(F.sort_array(F.collect_list(order))).collect()
    }
    written = sink.read_output(spark, root).groupBy("source_config", "shard").agg(
        F.collect_set(F.regexp_extract("text", r"(\d+)$", 1).cast("bigint")).alias("ids")
    ).collect()
    assert {len(row["ids"]) for row in written if row["shard"] < 50} == {10}
    for row in written:
        at = 10 * row["shard"]
        assert set(row["ids"]) == set(wanted[row["source_config"]][at:at + len(row["ids"])])


def test_multi_year_plan_has_output_bytes(spark, tmp_path):
    """Output bytes by the sampled texts, in the query and its SQL."""
    rows = spark.range(400).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("src"), F.col("id") % 9).alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"),
        F.concat(F.repeat(F.lit("w\u00e4re "), (F.col("id") % 13).cast("int") + 1), F.col("id")).alias("text"),
    )
    path = str(tmp_path / "documents.parquet")
    rows.coalesce(1).write.parquet(path)
    found = entry.queries()["multi_year_plan"](spark, str(tmp_path)).toPandas()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    answer = db.execute(entry.oracle_sql()["multi_year_plan"]).df()
    assert sorted(found.columns) == sorted(answer.columns) and "output_bytes_at_target" in found.columns
    assert len(found) == len(answer) > 1
    joined = found.merge(answer, on="year", suffixes=("", "_sql"))
    for name in ("output_bytes_all", "output_bytes_at_target"):
        assert (joined[name] > 0).all() and (abs(joined[name] - joined[f"{name}_sql"]) < 0.011).all()


def test_one_file_per_shard(spark, tmp_path):
    """A shard's folder holds its one file: no second one with checksums, and its pages are checked."""
    rows = spark.range(60).select(
        F.lit("d").alias("source_config"), (F.col("id") % 6).cast("int").alias("shard"), "id",
        F.concat(F.lit("some words "), F.col("id")).alias("text"),
    )
    root = tmp_path / "year"
    sink.write_shards(
        rows, str(root), order=["id"], year=2013, tokens=F.lit(3), shards=6, compression="none", rows_per_shard=10,
    )
    folders = sorted((root / "data" / "source_config=d").glob("shard=*"))
    assert [len(list(folder.iterdir())) for folder in folders] == [1] * 6
    assert sink.read_output(spark, root=str(root)).agg(F.count_distinct("text")).first()[0] == 60
    (written,) = folders[0].iterdir()
    pq.ParquetFile(written, page_checksum_verification=True).read()
    spoilt = written.read_bytes().replace(b"some words 6", b"some worlds6", 1)
    copy = tmp_path / "spoilt.parquet"
    copy.write_bytes(spoilt)
    with pytest.raises(OSError, match="CRC"):
        pq.ParquetFile(copy, page_checksum_verification=True).read()


@pytest.mark.parametrize("name", ["verify_faults", "verify_year"])
def test_settings_are_counted_once(spark, sf, monkeypatch, name):
    """A year and its check share settings that take a count of all texts."""
    calls, plain = [], entry._year_config
    monkeypatch.setattr(entry, "_year_config", lambda *given: calls.append(given) or plain(*given))
    entry.queries()[name](spark, sf)
    assert len(calls) == 1
