"""A whole year: exact shards, resume, candidate rounds, reports and samples."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusledger.functions.counters import CounterSpec, token_count
from corpusledger.operators import select
from corpusledger.plans import year
from corpusledger.plans.build import build_plans, config_dumps
from corpusledger.plans.config import RunConfig
from corpusledger.runtime import path_exists, scratch_path, stage
from corpusledger.sinks import shards as sink
from corpusledger.sources.dumps import numbered_documents

SIZE = 10
REGEX = CounterSpec("regex")


@pytest.fixture(scope="module")
def held(docs):
    return {r["source_config"]: r["count"] for r in docs.groupBy("source_config").count().collect()}


@pytest.fixture(scope="module")
def counted(spark, docs):
    return stage(docs.withColumn("token_count", token_count(spark, REGEX)("text")), "counted")


def config(held, rule, target=0, **selection):
    budget = rule == "token_budget"
    return RunConfig(
        {
            "year": 2013,
            "source": {"configs": held},
            "target_tokens": target,
            "selection": {"rule": rule, "shuffle": budget, "random_seed": 9 if budget else None, **selection},
            "sample_mode": {"total_rows": 31, "shuffle": True, "random_seed": 9},
            "output": {"compression": "zstd"},
        }
    )


@pytest.fixture(scope="module")
def target(counted):
    return counted.agg(F.sum("token_count")).first()[0] * 2 // 5


def written(spark, root):
    """Per shard: its texts and counts in file order."""
    rows = sink.read_output(spark, root).select(
        "source_config", "shard", F.col("_metadata.row_index").alias("row"), "text", "token_count", "date"
    )
    found = {}
    for r in rows.orderBy("source_config", "shard", "row").collect():
        found.setdefault((r["source_config"], r["shard"]), []).append((r["text"], r["token_count"], r["date"]))
    return found


def expected(ordered):
    """The same from documents in emitted order."""
    found, seen = {}, {}
    for r in ordered:
        dump = r["source_config"]
        place = seen.get(dump, 0)
        seen[dump] = place + 1
        found.setdefault((dump, place // SIZE), []).append((r["text"], r["token_count"], 2013))
    return found


def run(docs, settings, root, **options):
    return year.run_year(docs, settings, root, counter=REGEX, rows_per_shard=SIZE, **options)


def test_retain_all(spark, docs, held, counted):
    root = scratch_path(spark, "year")
    report = run(docs.repartition(5), config(held, "retain_all"), root).first()
    assert written(spark, root) == expected(counted.orderBy("source_config", "doc_id").collect())
    assert report["rows"] == sum(held.values()) and not report["partial"]
    assert {e["source_config"]: e["shards"] for e in report["source_configs"]} == {
        name: -(-rows // SIZE) for name, rows in held.items()
    }
    assert all(e["token_quota"] is None and not e["quota_reached"] for e in report["source_configs"])
    files = sink.output_files(spark, root).collect()
    assert len(files) == len({r["shard_name"] for r in files}) == sum(-(-r // SIZE) for r in held.values())


def test_budget_is_resumable(spark, docs, held, counted, target, monkeypatch):
    settings = config(held, "token_budget", target)
    plans = build_plans(config_dumps(spark, settings), settings, "full")
    keyed = stage(select.seeded(counted, 9), "keyed")
    chosen = select.token_budget(keyed, plans).orderBy("source_config", "key", "doc_id").collect()

    whole = scratch_path(spark, "year")
    report = run(docs, settings, whole).first()
    assert written(spark, whole) == expected(chosen)
    assert report["rows"] == len(chosen)
    assert all(e["quota_reached"] and not e["source_exhausted"] for e in report["source_configs"])
    assert json.loads(report["processing_config"]) == settings.settings

    # Interrupted: the second wave is written but never reaches the manifest.
    root = scratch_path(spark, "year")
    commit, waves = year.commit_shards, []

    def crash(session, path, wave, run, number):
        waves.append(wave)
        if len(waves) == 6:
            raise OSError("lost")
        commit(session, path, wave, run, number)

    monkeypatch.setattr(year, "commit_shards", crash)
    with pytest.raises(OSError):
    # A wave is one shard: the crash is in the middle of a dump.
        run(docs, settings, root, rows_per_wave=SIZE)
    monkeypatch.setattr(year, "commit_shards", commit)
    assert all(last - first == 1 for wave in waves for first, last in wave.values())
    assert len(waves[-1]) == 1 and next(iter(waves[-1].values()))[0] > 0
    before = sink.output_files(spark, root).collect()
    sure = {(r["source_config"], r["shard"]) for r in sink.committed_shards(spark, root).collect()}
    assert len(sure) == 5

    # The rerun counts nothing twice and leaves committed shards alone.
    rounds = []
    write_by = year.write_by
    monkeypatch.setattr(year, "write_by", lambda df, *rest: rounds.append(df) or write_by(df, *rest))
    again = run(docs, settings, root).first()
    assert written(spark, root) == expected(chosen)
    assert again["source_configs"] == report["source_configs"]
    after = {(r["source_config"], r["shard"]): r["path"] for r in sink.output_files(spark, root).collect()}
    paths = {(r["source_config"], r["shard"]): r["path"] for r in before}
    assert all(after[key] == paths[key] for key in sure)
    assert not rounds

    # Nothing left to do.
    assert run(docs, settings, root).first()["source_configs"] == report["source_configs"]
    assert not rounds
    assert not path_exists(spark, f"{root}/_counted") and not staged_in(spark, root)


def staged_in(spark, root):
    """What is left of staging below ``root``; the folder itself may stay, empty."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_staging")
    filesystem = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().toString() for s in filesystem.listStatus(folder)] if filesystem.exists(folder) else []


def test_larger_sample_extends_a_smaller_one(spark, docs, held, counted):
    settings = config(held, "retain_all")
    settings.settings["sample_mode"] = {"rows_per_config": 5}
    root, whole = scratch_path(spark, "year"), scratch_path(spark, "year")
    run(docs, settings, root, mode="sample")
    first = {r["path"] for r in sink.output_files(spark, f"{root}/sample").collect()}
    report = run(docs, settings, root, mode="sample", sample_rows=12).first()
    run(docs, settings, whole, mode="sample", sample_rows=12)
    assert report["rows"] == 12 * len(held)
    assert written(spark, f"{root}/sample") == written(spark, f"{whole}/sample")
    assert {e["shards"] for e in report["source_configs"]} == {2}
    assert not first & {r["path"] for r in sink.output_files(spark, f"{root}/sample").collect()}
    with pytest.raises(ValueError, match="manifest has 12 rows"):
        run(docs, settings, root, mode="sample", sample_rows=11)


def test_raised_budget_is_finished(spark, docs, held, counted, target):
    root, whole = scratch_path(spark, "year"), scratch_path(spark, "year")
    small = run(docs, config(held, "token_budget", target // 2), root).first()
    full = {tuple(r)[:2]: r["path"] for r in sink.output_files(spark, root).collect()}
    report = run(docs, config(held, "token_budget", target), root).first()
    wanted = run(docs, config(held, "token_budget", target), whole).first()
    assert report["source_configs"] == wanted["source_configs"] and report["rows"] > small["rows"]
    assert written(spark, root) == written(spark, whole)
    kept = {tuple(r)[:2]: r["path"] for r in sink.output_files(spark, root).collect()}
    assert sum(kept[key] == path for key, path in full.items()) >= len(full) - len(held)


def test_other_settings_are_refused(spark, docs, held, target):
    settings = config(held, "token_budget", target)
    root = scratch_path(spark, "year")
    run(docs, settings, root, dumps=["fr"])
    for other in (
        lambda: run(docs, config(held, "token_budget", target, random_seed=77), root),
        lambda: year.run_year(docs, settings, root, counter=REGEX, rows_per_shard=SIZE * 2),
        lambda: year.run_year(
            docs, settings, root, counter=CounterSpec("regex", pattern="x"), rows_per_shard=SIZE
        ),
    ):
        with pytest.raises(ValueError, match="other settings"):
            other()
    manifest = sink.committed_shards(spark, root)
    again = manifest.where("shard = 0").select("source_config", "shard", "rows", "tokens", "run", "commit")
    again.write.mode("append").parquet(f"{root}/manifest")
    with pytest.raises(PySparkException, match="committed twice"):
        run(docs, settings, root)


def test_ids_must_number_the_documents(spark):
    def build(ids):
        docs = spark.createDataFrame([("a", i, "text") for i in ids], "source_config string, doc_id bigint, text string")
        return run(docs, config({"a": len(ids)}, "retain_all"), scratch_path(spark, "year")).first()

    assert build([0, 1, 2, 40_000])["rows"] == 4
    with pytest.raises(ValueError, match="without repeats"):
        build([0, 0, 2, 3])
    with pytest.raises(ValueError, match="without repeats"):
        build([-1, 0])
    with pytest.raises(ValueError, match="too sparse"):
        build([5, 2**61])


def test_candidate_rounds_find_the_same_documents(spark, docs, held, counted, target):
    settings = config(held, "token_budget", target)
    plans = build_plans(config_dumps(spark, settings), settings, "full")
    count = token_count(spark, REGEX)
    keyed = select.seeded(docs, 9, 5)
    folders = [scratch_path(spark, "counts") for _ in range(2)]
    everything = select.token_budget(year.count_candidates(keyed, plans, count, 1.0, folders[0]), plans)
    few = year.count_candidates(keyed, plans, count, 0.05, folders[1])
    assert few.count() < sum(held.values())
    pruned = select.token_budget(few, plans)
    ids = [sorted(r["doc_id"] for r in df.select("doc_id").collect()) for df in (everything, pruned)]
    assert ids[0] == ids[1]
    assert few.select("doc_id").distinct().count() == few.count()


def test_quota_beyond_the_source_keeps_all(spark, docs, held, counted):
    total = counted.agg(F.sum("token_count")).first()[0]
    settings = config(held, "token_budget", total * 3, estimated_tokens_available=total * 30)
    root = scratch_path(spark, "year")
    report = run(docs, settings, root).first()
    assert report["rows"] == sum(held.values())
    assert all(e["source_exhausted"] and not e["quota_reached"] for e in report["source_configs"])


def test_subset_and_sample(spark, docs, held, counted, target):
    settings = config(held, "token_budget", target)
    root = scratch_path(spark, "year")
    report = run(docs, settings, root, dumps=["fr"]).first()
    assert report["partial"] and report["dumps_processed"] == ["fr"]
    quota = build_plans(config_dumps(spark, settings), settings, "full").where("source_config = 'fr'")
    assert report["source_configs"][0]["token_quota"] == quota.first()["token_quota"]
    # Another dump later leaves the first one alone.
    run(docs, settings, root, dumps=["de"])
    assert {dump for dump, _ in written(spark, root)} == {"fr", "de"}

    sampled = run(docs, settings, root, mode="sample").first()
    assert sampled["rows"] == 31 and sampled["mode"] == "sample"
    found = written(spark, f"{root}/sample")
    for (dump, shard), rows in found.items():
        if dump == "fr" and shard == 0:
            assert rows == written(spark, root)[("fr", 0)][: len(rows)]


def test_source_order_sample_override(spark, docs, held, counted):
    settings = config(held, "retain_all")
    settings.settings["sample_mode"] = {"rows_per_config": 5}
    root = scratch_path(spark, "year")
    run(docs, settings, root, mode="sample", sample_rows=12)
    ordered = counted.orderBy("source_config", "doc_id").collect()
    seen, head = {}, []
    for r in ordered:
        seen[r["source_config"]] = seen.get(r["source_config"], 0) + 1
        if seen[r["source_config"]] <= 12:
            head.append(r)
    assert written(spark, f"{root}/sample") == expected(head)


def test_numbered_corpus_on_disk(spark, docs, held, counted):
    path = scratch_path(spark, "corpus")
    files = docs.repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id")
    files.select("text", "source_config").write.partitionBy("source_config").parquet(path)
    numbered = numbered_documents(spark, path)
    ordered = counted.orderBy("source_config", "doc_id").collect()

    root = scratch_path(spark, "year")
    report = run(numbered, config(held, "retain_all"), root).first()
    assert written(spark, root) == expected(ordered)
    assert report["rows"] == sum(held.values())

    plain = config(held, "retain_all")
    plain.settings["sample_mode"] = {"rows_per_config": 5}
    run(numbered, plain, root, mode="sample", sample_rows=13)
    seen, head = {}, []
    for r in ordered:
        seen[r["source_config"]] = seen.get(r["source_config"], 0) + 1
        if seen[r["source_config"]] <= 13:
            head.append(r)
    assert written(spark, f"{root}/sample") == expected(head)


def test_refusals(spark, docs, held):
    more = {name: rows + 1 for name, rows in held.items()}
    with pytest.raises(RuntimeError, match="holds"):
        run(docs, config(more, "retain_all"), scratch_path(spark, "year"))
    with pytest.raises(ValueError, match="rows_per_shard"):
        year.run_year(docs, config(held, "retain_all"), "x", counter=REGEX, rows_per_shard=0)
    odd = docs.withColumn("source_config", F.lit("a/b"))
    with pytest.raises(ValueError, match="directory names"):
        run(odd, config({"a/b": 200}, "retain_all"), scratch_path(spark, "year"))
    root = scratch_path(spark, "year")
    manifest = spark.createDataFrame([("fr", 3, 10, 1, "x", 1)], sink.MANIFEST_SCHEMA)
    manifest.write.parquet(f"{root}/manifest")
    with pytest.raises(ValueError, match="manifest"):
        run(docs, config(held, "retain_all"), root)
    nulls = docs.withColumn("text", F.when(F.col("doc_id") != 3, F.col("text")))
    with pytest.raises(PySparkException, match="must hold strings"):
        run(nulls, config(held, "retain_all"), scratch_path(spark, "year"))


@pytest.mark.parametrize("rows, size, expect", [(20, 10, [10, 10]), (21, 10, [10, 10, 1]), (3, 10, [3])])
def test_planned_shards(spark, rows, size, expect):
    totals = spark.createDataFrame([("a", rows), ("none", 0)], "source_config string, rows bigint")
    planned = sink.shards_of_totals(totals, size).orderBy("shard").collect()
    assert [(r["shard"], r["rows"]) for r in planned] == list(enumerate(expect))
    positions = spark.range(rows).select(F.lit("a").alias("source_config"), F.col("id").alias("position"))
    same = sink.planned_shards(positions, size).orderBy("shard").collect()
    assert [r["rows"] for r in same] == expect


def test_waves_cover_every_pending_shard():
    assert sink.waves({"c": (0, 1), "a": (2, 7), "b": (0, 9)}, 10) == [
        {"a": (2, 7), "b": (0, 5)}, {"b": (5, 9), "c": (0, 1)},
    ]
    assert sink.waves({"a": (0, 25), "b": (3, 4)}, 10) == [
        {"a": (0, 10)}, {"a": (10, 20)}, {"a": (20, 25), "b": (3, 4)},
    ]
    assert sink.waves({}, 10) == []


def test_pending_shards(spark):
    planned = spark.createDataFrame([("a", 0, 5), ("a", 1, 5), ("b", 0, 2)], "source_config string, shard int, rows bigint")
    done = spark.createDataFrame([("a", 0, 5), ("z", 0, 9)], planned.schema)
    left = sink.pending_shards(planned, done).collect()
    assert sorted((r["source_config"], r["shard"]) for r in left) == [("a", 1), ("b", 0)]
    above = spark.createDataFrame([("b", 0, 3)], planned.schema)
    with pytest.raises(ValueError, match="more rows"):
        sink.pending_shards(planned, above)


def test_zero_quotas_write_nothing(spark, docs, held):
    report = run(docs, config(held, "token_budget", 0), scratch_path(spark, "year")).first()
    assert report["rows"] == 0 and all(e["quota_reached"] for e in report["source_configs"])
