"""Streams give the batch result, across micro-batches, restarts and retried batches."""

import os

from pyspark.sql import functions as F

from corpusledger.functions.counters import CounterSpec, token_count
from corpusledger.operators import select
from corpusledger.runtime import scratch_path, stage
from corpusledger.streaming import budget, count, progress


def ids(df):
    return sorted(row["doc_id"] for row in df.select("doc_id").collect())


def test_stream_count(spark, docs):
    base, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "query"))
    regex = token_count(spark, CounterSpec("regex"))
    expected = {r["doc_id"]: r["n"] for r in docs.select("doc_id", regex("text").alias("n")).collect()}
    parts = docs.randomSplit([0.5, 0.5], 1)
    for part in parts:
        part.repartition(3).write.mode("append").parquet(base)
        stream = count.read_stream(spark, base, docs.schema, 2)
        count.stream_count(stream, regex, out, checkpoint)
    batches = len([n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()])
    assert batches == 4
    count.stream_count(count.read_stream(spark, base, docs.schema, 2), regex, out, checkpoint)
    found = spark.read.parquet(out).collect()
    assert len(found) == len(expected)
    assert {r["doc_id"]: r["token_count"] for r in found} == expected


def test_stream_budget_survives_a_retried_batch(spark, docs):
    regex = token_count(spark, CounterSpec("regex"))
    counted = stage(select.seeded(docs.withColumn("token_count", regex("text")).drop("text"), 4, 2), "counted")
    plans = counted.groupBy("source_config").agg((F.sum("token_count") / 2).cast("bigint").alias("token_quota"))
    plans = stage(plans, "plans")
    expected = ids(select.token_budget(counted, plans))
    base, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "query"))
    ranges = [("0", "5"), ("5", "b"), ("b", "g")]
    for number, (low, high) in enumerate(ranges):
        counted.where((F.col("key") >= low) & (F.col("key") < high)).write.mode("append").parquet(base)
        stream = count.read_stream(spark, base, counted.schema, 1000)
        budget.stream_budget(stream, plans, out, checkpoint)
        if number == 1:
            # As if the driver died before the batch was marked as committed.
            os.remove(f"{checkpoint}/commits/1")
            crc = f"{checkpoint}/commits/.1.crc"
            if os.path.exists(crc):
                os.remove(crc)
    assert ids(budget.admitted(spark, out, counted.schema)) == expected
    totals = {r["source_config"]: (r["rows"], r["tokens"]) for r in budget.running_totals(spark, out).collect()}
    direct = select.selection_totals(select.token_budget(counted, plans)).collect()
    assert totals == {r["source_config"]: (r["rows"], r["tokens"]) for r in direct}
    # Late documents of met quotas are not admitted.
    late = counted.limit(5).withColumn("doc_id", F.col("doc_id") + 100_000)
    late.write.mode("append").parquet(base)
    budget.stream_budget(count.read_stream(spark, base, counted.schema, 1000), plans, out, checkpoint)
    assert ids(budget.admitted(spark, out, counted.schema)) == expected


def test_progress(spark):
    plans = spark.createDataFrame(
        [("a", 100, None, 50), ("b", 100, None, 40), ("c", 7, None, 90), ("d", 30, 30, None)],
        "source_config string, available_rows bigint, row_target bigint, token_quota bigint",
    )
    committed = spark.createDataFrame(
        [("a", 0, 10, 20), ("a", 1, 10, 5), ("c", 0, 7, 60), ("d", 0, 12, 99)],
        "source_config string, shard int, rows bigint, tokens bigint",
    )
    rows = {r["source_config"]: r for r in progress.progress_snapshot(committed, plans).collect()}
    assert (rows["a"]["done"], rows["a"]["percent"], rows["a"]["unit"]) == (25, 50.0, "tokens")
    assert (rows["b"]["done"], rows["b"]["shards"]) == (0, 0)
    assert rows["c"]["source_exhausted"] and not rows["a"]["source_exhausted"]
    assert (rows["d"]["done"], rows["d"]["unit"], rows["d"]["percent"]) == (12, "rows", 40.0)
    timed = committed.withColumn("committed_at", F.current_timestamp())
    ages = {r["source_config"]: r["commit_age_seconds"] for r in progress.progress_snapshot(timed, plans).collect()}
    assert ages["a"] == 0 and ages["b"] is None
    files = spark.createDataFrame([("x", 3), ("y", 4)], "path string, size bigint")
    disk = progress.disk_snapshot(files, files.limit(1)).first()
    assert (disk["shards_on_disk"], disk["shard_bytes"], disk["in_flight"]) == (2, 7, ["x"])
    total = progress.progress_totals(progress.progress_snapshot(committed, plans)).first()
    assert (total["rows"], total["tokens"], total["shards"]) == (39, 184, 4)
    history = spark.createDataFrame(
        [(0, 40, 100), (10, 60, 100), (20, 60, 100), (25, 100, 100)], "taken_at bigint, done bigint, target bigint"
    )
    got = {r["taken_at"]: (r["rate"], r["eta_seconds"]) for r in progress.progress_rates(history).collect()}
    assert got == {0: (None, None), 10: (2.0, 20.0), 20: (None, None), 25: (8.0, 0.0)}


def test_history_of_commits(spark, tmp_path):
    from corpusledger.sinks import shards as sink

    turns = [
        [("a", 0, 10, 50, "r", 1, 100.0), ("b", 0, 10, 70, "r", 1, 100.0)],
        [("a", 1, 4, 20, "r", 2, 160.0)],
        [("a", 1, 0, 0, "r", 3, 170.0)],  # a short last shard is taken back
        [("a", 1, 10, 55, "r", 4, 220.0), ("c", 0, 3, 1, "r", 4, 220.0)],
    ]
    for rows in turns:
        spark.createDataFrame(rows, sink.COMMIT_SCHEMA).write.mode("append").parquet(f"{tmp_path}/manifest")
    commits = sink.commit_history(spark, str(tmp_path))
    added = {(r["source_config"], r["commit"]): (r["rows"], r["tokens"], r["shards"]) for r in commits.collect()}
    assert added == {
        ("a", 1): (10, 50, 1), ("b", 1): (10, 70, 1), ("a", 2): (4, 20, 1), ("a", 3): (-4, -20, -1),
        ("a", 4): (10, 55, 1), ("c", 4): (3, 1, 1),
    }
    plans = spark.createDataFrame(
        [("a", None, 200), ("b", None, 100), ("c", 9, None)], "source_config string, row_target bigint, token_quota bigint"
    )
    rates = progress.progress_rates(progress.run_history(commits, plans)).orderBy("commit").collect()
    assert [(r["taken_at"], r["done"], r["target"]) for r in rates] == [
        (100.0, 120, 309), (160.0, 140, 309), (170.0, 120, 309), (220.0, 178, 309),
    ]
    assert [r["rate"] for r in rates] == [None, 20 / 60, None, 58 / 50]


def test_runs_leave_their_history(spark, docs):
    from corpusledger.plans.config import RunConfig
    from corpusledger.plans.year import run_year
    from corpusledger.sinks import shards as sink

    root = scratch_path(spark, "year")
    held = {r["source_config"]: r["count"] for r in docs.groupBy("source_config").count().collect()}
    config = RunConfig({
        "year": 2013, "source": {"configs": held}, "selection": {"rule": "retain_all", "shuffle": False},
        "sample_mode": {"rows_per_config": 1, "shuffle": False}, "output": {"compression": "zstd"},
    })
    now = iter(range(0, 10_000, 10))
    run_year(docs, config, root, counter=CounterSpec("regex"), rows_per_shard=20, rows_per_wave=60, clock=lambda: next(now))
    commits = sink.commit_history(spark, root).collect()
    shards = sum(-(-n // 20) for n in held.values())
    assert sum(r["rows"] for r in commits) == sum(held.values()) and sum(r["shards"] for r in commits) == shards
    assert len({r["commit"] for r in commits}) == -(-shards // 3)
    times = sorted({(r["commit"], r["taken_at"]) for r in commits})
    assert [b[1] - a[1] for a, b in zip(times, times[1:])] == [10.0] * (len(times) - 1)
