"""One writer at a time: claims, refusals, takeovers, and years that two runs want to write."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from corpusledger.functions.counters import CounterSpec
from corpusledger.plans import year
from corpusledger.plans.config import RunConfig
from corpusledger.runtime import scratch_path
from corpusledger.sinks import shards as sink
from corpusledger.sinks.commits import CommitLog, ConcurrentRun


def kinds(log):
    return [log.entry(number)["kind"] for number in log.numbers()]


def test_numbers_are_created_once(spark, tmp_path):
    logs = [CommitLog(spark, f"file:{tmp_path}/out dir") for _ in range(2)]
    for log in logs:
        log.last = 7
    won = []

    def add(log):
        try:
            log.commit()
            won.append(log.writer)
        except ConcurrentRun:
            pass

    threads = [threading.Thread(target=add, args=(log,)) for log in logs]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and logs[0].numbers() == [8] and logs[0].entry(8)["writer"] == won[0]


def test_open_claims_refuse_others(spark, tmp_path):
    one, two = CommitLog(spark, str(tmp_path)), CommitLog(spark, str(tmp_path))
    one.begin()
    with pytest.raises(ConcurrentRun, match="has not ended"):
        two.begin()
    one.commit()
    one.end()
    two.begin()
    two.end()
    # What a finished run began behind is dropped.
    assert kinds(two) == ["begin", "end"] and two.numbers() == [4, 5]


def test_takeover_stops_the_first(spark, tmp_path):
    one, two = CommitLog(spark, str(tmp_path)), CommitLog(spark, str(tmp_path))
    one.begin()
    two.begin(takeover=True)
    with pytest.raises(ConcurrentRun, match="taken over"):
        one.commit()
    two.commit()
    two.end()
    assert kinds(two) == ["begin", "commit", "end"]


def test_a_claim_without_content_is_open(spark, tmp_path):
    os.makedirs(tmp_path / "_log")
    (tmp_path / "_log" / f"{3:020d}.json").touch()
    (tmp_path / "_log" / "other.txt").touch()
    with pytest.raises(ConcurrentRun):
        CommitLog(spark, str(tmp_path)).begin()
    CommitLog(spark, str(tmp_path)).begin(takeover=True)


@pytest.fixture
def settings(docs):
    held = {r["source_config"]: r["count"] for r in docs.groupBy("source_config").count().collect()}
    return RunConfig({
        "year": 2013, "source": {"configs": held}, "selection": {"rule": "retain_all", "shuffle": False},
        "sample_mode": {"rows_per_config": 1, "shuffle": False}, "output": {"compression": "zstd"},
    })


def written(spark, root):
    files = sorted((r["path"], r["size"]) for r in sink.output_files(spark, root).collect())
    return files, sorted(map(tuple, sink.committed_shards(spark, root).drop("committed_at", "commit").collect()))


def run(docs, settings, root, **options):
    return year.run_year(docs, settings, root, counter=CounterSpec("regex"), rows_per_shard=40, rows_per_wave=80, **options)


def test_of_two_runs_one_is_refused(spark, docs, settings, monkeypatch):
    """The second run starts while the first is between two waves, and finds nothing changed."""
    root, alone = scratch_path(spark, "year"), scratch_path(spark, "alone")
    run(docs, settings, alone)
    commit, seen = sink.commit_shards, []

    def during(*args):
        commit(*args)
        if not seen:
            before = written(spark, root)
            with pytest.raises(ConcurrentRun):
                run(docs, settings, root)
            seen.append(before == written(spark, root))

    monkeypatch.setattr(year, "commit_shards", during)
    run(docs, settings, root)
    assert seen == [True]
    assert written(spark, root)[1] == written(spark, alone)[1]


def test_a_driver_that_comes_back_commits_nothing(spark, docs, settings, monkeypatch):
    root = scratch_path(spark, "year")
    write, turns = sink.write_shards, []

    def paused(*args, **options):
        write(*args, **options)
        turns.append(1)
        if len(turns) == 2:
            monkeypatch.setattr(year, "write_shards", write)
            run(docs, settings, root, takeover=True)
            turns.append(written(spark, root)[1])

    monkeypatch.setattr(year, "write_shards", paused)
    with pytest.raises(ConcurrentRun, match="taken over"):
        run(docs, settings, root)
    assert written(spark, root)[1] == turns[-1]
    rows = sink.read_output(spark, root).groupBy("source_config").count()
    held = {r["source_config"]: r["count"] for r in docs.groupBy("source_config").count().collect()}
    assert {r["source_config"]: r["count"] for r in rows.collect()} == held


def test_failed_runs_give_the_root_free(spark, docs, settings, monkeypatch):
    root = scratch_path(spark, "year")

    def lost(*args):
        raise OSError("lost")

    monkeypatch.setattr(year, "commit_shards", lost)
    with pytest.raises(OSError):
        run(docs, settings, root)
    monkeypatch.undo()
    report = run(docs, settings, root).first()
    assert report["rows"] == docs.count()
    assert docs.where(F.col("doc_id").isNull()).count() == 0
