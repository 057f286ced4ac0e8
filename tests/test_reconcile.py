"""One injected fault per rule."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusledger.operators import digest, reconcile, verify
from corpusledger.runtime import scratch_path
from corpusledger.sinks.report import run_report, write_report
from corpusledger.sources.reports import scan_reports

RECORD = (
    "shard string, row bigint, text_sha256 string, text_chars bigint, text_utf8_bytes bigint, "
    "stored_token_count bigint, recounted_token_count bigint"
)


def records(spark, changes=()):
    rows = [("a", 0, "x", 3, 3, 7, 7), ("a", 1, "y", 4, 4, 8, 8), ("b", 0, "z", 5, 5, 9, 9)]
    for index, row in changes:
        rows[index] = row
    return spark.createDataFrame([row for row in rows if row], RECORD)


def test_equal_recounts_match(spark):
    pairs = reconcile.pair_recounts(records(spark), records(spark))
    verdict = reconcile.compare_verdict(pairs).first()
    assert verdict["all_counts_match"] and verdict["rows_compared"] == 3
    assert (verdict["stored"], verdict["baseline"], verdict["candidate"]) == (24, 24, 24)


def test_recount_differences(spark):
    changed = records(spark, [(1, ("a", 1, "q", 4, 4, 8, 6))])
    pairs = reconcile.pair_recounts(records(spark), changed)
    mismatch = reconcile.count_mismatches(pairs).collect()
    assert [(r["shard"], r["row"], r["delta"]) for r in mismatch] == [("a", 1, -2)]
    assert reconcile.text_mismatches(pairs).first()["candidate_text_sha256"] == "q"
    stored = reconcile.stored_vs_recount(pairs).collect()
    assert [(r["side"], r["recounted_token_count"]) for r in stored] == [("candidate", 6)]
    rolled = {r["shard"]: r for r in reconcile.compare_rollup(pairs).collect()}
    assert rolled["a"]["mismatches"] == 1 and rolled["b"]["mismatches"] == 0
    verdict = reconcile.compare_verdict(pairs).first()
    assert not verdict["all_counts_match"]


def test_recounts_of_other_documents_are_refused(spark):
    fewer = records(spark, [(2, None)])
    for left, right in [(records(spark), fewer), (fewer, records(spark))]:
        pairs = reconcile.pair_recounts(left, right)
        for result in (
            reconcile.compare_verdict, reconcile.compare_rollup, reconcile.count_mismatches,
            reconcile.text_mismatches, reconcile.stored_vs_recount,
        ):
            with pytest.raises(PySparkException, match="do not cover"):
                result(pairs).collect()
    with pytest.raises(ValueError):
        reconcile.check_contracts({"padding": False}, {"padding": True})


def entry(name, rows=10, tokens=100, shards=1, quota=100, reached=True, dry=False):
    return (name, rows, tokens, shards, quota, reached, dry)


ENTRY = (
    "source_config string, rows bigint, token_count bigint, shards bigint, token_quota bigint, "
    "quota_reached boolean, source_exhausted boolean"
)
SETTINGS = {"year": 2017, "target_tokens": 400, "selection": {"rule": "token_budget"}}


def reports(spark, workers, dumps=("a", "b", "c"), settings=None, counters=None):
    path = scratch_path(spark, "reports")
    for number, entries in enumerate(workers):
        report = run_report(
            spark.createDataFrame(entries, ENTRY), (settings or {}).get(number, SETTINGS), list(dumps),
            mode="full", counter=(counters or {}).get(number, "regex"), batch_size=8,
        )
        write_report(report, f"{path}/worker{number}")
    return scan_reports(spark, f"{path}/*")


def test_merge(spark):
    found = reports(spark, [[entry("c"), entry("a")], [entry("b", 4, 90, 2, 100, False, True)]])
    merged = reconcile.merge_reports(found).first()
    assert (merged["rows"], merged["token_count"], merged["shards"]) == (24, 290, 4)
    assert [e["source_config"] for e in merged["source_configs"]] == ["a", "b", "c"]
    assert merged["quotas_met"] == 2 and merged["dumps_exhausted"] == ["b"]
    assert not merged["partial"] and len(merged["merged_from"]) == 2
    assert merged["percent_of_target"] == pytest.approx(72.5)
    assert json.loads(merged["processing_config"]) == SETTINGS


def test_merge_refusals(spark):
    cases = [
        ("more than one report", dict(workers=[[entry("a"), entry("b")], [entry("b"), entry("c")]])),
        ("not in the config", dict(workers=[[entry("a"), entry("b")], [entry("c"), entry("x")]])),
        ("dumps missing: c", dict(workers=[[entry("a")], [entry("b")]])),
        (
            "same settings",
            dict(workers=[[entry("a"), entry("b")], [entry("c")]], settings={1: {**SETTINGS, "year": 2018}}),
        ),
        ("same settings", dict(workers=[[entry("a"), entry("b")], [entry("c")]], counters={1: "bpe"})),
    ]
    for match, arguments in cases:
        with pytest.raises(PySparkException, match=match):
            reconcile.merge_reports(reports(spark, **arguments)).collect()
    partial = reconcile.merge_reports(
        reports(spark, [[entry("a")], [entry("b")]]), allow_incomplete=True
    ).first()
    assert partial["partial"] and partial["dumps_missing"] == ["c"]


def test_no_report_is_an_error(spark):
    with pytest.raises(PySparkException):
        scan_reports(spark, scratch_path(spark, "nothing") + "/*.json").collect()


def test_manifest_statuses(spark):
    schema = "path string, size bigint, sha256 string"
    local = spark.createDataFrame(
        [("same", 1, "s"), ("gone", 1, "s"), ("size", 1, "s"), ("hash", 1, "s"), ("nohash", 1, "s")], schema
    )
    remote = spark.createDataFrame(
        [("same", 1, "s"), ("size", 2, "s"), ("hash", 1, "t"), ("nohash", 1, None), ("more", 1, "s")], schema
    )
    diff = reconcile.manifest_diff(local, remote)
    assert {r["path"]: r["status"] for r in diff.collect()} == {
        "same": "verified by sha256", "gone": "missing", "size": "size differs",
        "hash": "sha256 differs", "nohash": "verified by size only", "more": "unexpected extra",
    }
    verdict = reconcile.manifest_verdict(diff).first()
    assert (verdict["local_shards"], verdict["checked"], verdict["problems"]) == (5, 4, 4)
    assert verdict["verdict"] == "FAIL"
    good = reconcile.manifest_verdict(reconcile.manifest_diff(local, local)).first()
    assert (good["verdict"], good["verified_by_sha256"]) == ("PASS", 5)


def test_publish_gate(spark):
    done = run_report(
        spark.createDataFrame([entry("a", shards=2)], ENTRY), SETTINGS, ["a"],
        mode="full", counter="regex", batch_size=8,
    )
    files = "path string, size bigint"
    two = spark.createDataFrame([("p", 1), ("q", 2)], files)
    none = spark.createDataFrame([], files)
    tmp = spark.createDataFrame([("p.tmp", 1)], files)
    partial = done.withColumn("partial", F.lit(True))

    def reason(report, shards, leftovers, **options):
        row = reconcile.publish_gate(report, shards, leftovers, **options).first()
        assert row["publishable"] == (row["reason"] is None)
        return row["reason"]

    assert reason(done, two, none) is None
    assert reason(partial, two, none) == "report is partial"
    assert reason(partial, two, none, allow_partial=True) is None
    assert reason(done, none, none) == "no shards"
    assert reason(done, two, tmp) == "unfinished files beside the shards"
    assert reason(done, two.limit(1), none) == "shard count differs from report"


def output(spark, rows):
    return spark.createDataFrame(
        rows, "source_config string, shard int, date int, text string, token_count int"
    )


def test_integrity_rules(spark):
    good = output(spark, [("a", 0, 2013, "x", 3), ("a", 1, 2013, "y", 4)])
    assert verify.integrity_problems(verify.shard_totals(good, 2013, True), 2013).count() == 0
    bad = output(
        spark,
        [("a", 0, 2012, "x", 3), ("a", 1, None, "y", 4), ("a", 2, 2013, "z", None),
         ("a", 3, 2013, "z", 0), ("a", 4, 2013, None, 1)],
    )
    found = verify.integrity_problems(verify.shard_totals(bad, 2013, True), 2013)
    assert {(r["shard"], r["rule"]) for r in found.collect()} == {
        (0, "wrong date"), (1, "null scalar"), (1, "wrong date"), (2, "null scalar"),
        (3, "non-positive count"), (4, "null text"),
    }
    cheap = verify.integrity_problems(verify.shard_totals(bad, 2013), 2013)
    assert "null text" not in {r["rule"] for r in cheap.collect()}


def test_no_shards_give_no_division_error(spark):
    totals = verify.shard_totals(output(spark, []), 2013)
    row = verify.count_extremes(totals).first()
    assert row["rows"] is None and row["mean_tokens_per_doc"] is None


def test_report_rules(spark):
    measured = spark.createDataFrame(
        [("a", 10, 100, 1), ("b", 9, 90, 1), ("c", 12, 100, 2)],
        "source_config string, rows bigint, tokens bigint, shards bigint",
    )
    plans = spark.createDataFrame(
        [(name, 10) for name in "abcd"], "source_config string, available_rows bigint"
    )
    said = spark.createDataFrame(
        [entry("a"), entry("b", 9, 95, 1), entry("c", 11, 100, 1, None), entry("d")], ENTRY
    )

    def rules(rule):
        found = verify.report_problems(said, measured, plans, rule).collect()
        return {(r["source_config"], r["rule"]) for r in found}

    shared = {("b", "tokens differ"), ("c", "rows differ"), ("c", "shards differ"), ("d", "no shards")}
    assert rules("token_budget") == shared | {
        ("b", "short of quota"), ("c", "no quota"), ("c", "more rows than available"),
    }
    assert rules("retain_all") == shared | {
        ("b", "rows differ from pinned"), ("c", "rows differ from pinned"),
    }


def test_budget_rules_on_published_totals(spark):
    # The published 2017 totals; the overshoot was 20,347 tokens over 12 dumps.
    dumps = spark.createDataFrame(
        [("year", 101_840_059, 171_755_787, 100_000_020_347)],
        "source_config string, rows bigint, available_rows bigint, tokens bigint",
    )
    extremes = spark.createDataFrame([(203_345,)], "max_token_count bigint")
    summary = verify.budget_summary(dumps, extremes, 100_000_000_000)
    row = summary.first()
    assert row["overshoot"] == 20_347
    assert row["percent_of_target"] == pytest.approx(100.000020347, rel=1e-12)
    assert row["retention_percent"] == pytest.approx(59.29352412445934, rel=1e-12)
    assert verify.budget_problems(summary, "token_budget").count() == 0
    assert verify.budget_problems(summary, "retain_all").count() == 1

    def broken(**changes):
        changed = summary.withColumns({k: F.lit(v) for k, v in changes.items()})
        return {r["rule"] for r in verify.budget_problems(changed, "token_budget").collect()}

    assert broken(rows=171_755_787) == {"budget kept every row"}
    assert broken(tokens=99, overshoot=0) == {"tokens below target"}
    assert broken(overshoot=203_346) == {"overshoot above one document per dump"}


def test_digest_tree_and_sample(spark):
    import hashlib

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    rows = [("a", s, r, sha(f"{s}:{r}")) for s in range(3) for r in range(4)]
    table = spark.createDataFrame(rows, "source_config string, shard int, row bigint, digest string")
    shards = [sha("".join(d for _, n, _, d in rows if n == s)) for s in range(3)]
    tree = digest.digest_tree(table.repartition(5)).first()
    assert tree["digest"] == sha(sha("".join(shards)))
    assert (tree["rows"], tree["shards"]) == (12, 3)
    blocks = {}
    for s in range(3):
        blocks.setdefault(sha(str(s))[:3], []).append(shards[s])
    whole = digest.sample_digest(table.repartition(5)).first()
    assert whole["digest"] == sha("".join(sha("".join(own)) for _, own in sorted(blocks.items())))
    assert whole["rows"] == 12
    assert digest.sample_digest(table.where("shard > 9")).first()["rows"] == 0


def test_agreement(spark):
    counted = spark.createDataFrame(
        [(i, 5, 5, 5 + (i % 2)) for i in range(60)], "doc_id int, stored int, one int, two int"
    )
    long = reconcile.impl_agreement(counted, "stored", ["one", "two"], ["doc_id"])
    rows = {r["impl"]: r for r in reconcile.agreement_summary(long).collect()}
    assert rows["one"]["matches_stored"] and not rows["two"]["matches_stored"]
    assert rows["two"]["mismatch_count"] == 30 and rows["one"]["verdict"] == "FAIL"
    examples = reconcile.agreement_examples(long, ["doc_id"]).collect()
    assert [r["doc_id"] for r in sorted(examples, key=lambda r: r["rank"])] == list(range(1, 41, 2))


def test_coverage(spark):
    left = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    right = spark.createDataFrame([(2,), (3,)], "k int")
    found = reconcile.coverage_sets(left, right, ["k"]).collect()
    assert {tuple(r) for r in found} == {(1, "left only"), (3, "right only")}
