"""Recounts read from files with their contract; settings compared by content."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusledger.operators import reconcile
from corpusledger.runtime import scratch_path
from corpusledger.sources import recounts

CONTRACT = {"checkpoint": "t", "padding": False, "options": {"b": [1, 2], "a": None}}


def records(spark, counts=(7, 8, 9)):
    rows = [("a", 0, 2013, "x", 3, 3, 7, counts[0]), ("a", 1, 2013, "y", 4, 4, 8, counts[1]), ("b", 0, 2013, "z", 5, 5, 9, counts[2])]
    return spark.createDataFrame(rows, recounts.RECORD)


def test_round_trip_and_comparison(spark):
    one, two = scratch_path(spark, "one"), scratch_path(spark, "two")
    recounts.write_recount(records(spark), CONTRACT, one)
    recounts.write_recount(records(spark, (7, 6, 9)), dict(reversed(CONTRACT.items())), two)
    found, contract = recounts.read_recount(spark, one)
    assert contract == CONTRACT and sorted(found.collect()) == sorted(records(spark).collect())
    pairs = recounts.compare_recount_files(spark, one, two)
    assert [(r["shard"], r["row"], r["delta"]) for r in reconcile.count_mismatches(pairs).collect()] == [("a", 1, -2)]
    # Written anew in the same place.
    recounts.write_recount(records(spark), CONTRACT, two)
    assert reconcile.compare_verdict(recounts.compare_recount_files(spark, one, two)).first()["all_counts_match"]


def test_other_contracts_and_documents_are_refused(spark):
    one, two, three = (scratch_path(spark, name) for name in ("one", "two", "three"))
    recounts.write_recount(records(spark), CONTRACT, one)
    recounts.write_recount(records(spark), CONTRACT | {"padding": True}, two)
    recounts.write_recount(records(spark).where("shard = 'a'"), CONTRACT, three)
    with pytest.raises(ValueError, match="different contracts"):
        recounts.compare_recount_files(spark, one, two)
    with pytest.raises(PySparkException, match="do not cover"):
        recounts.compare_recount_files(spark, one, three).collect()


def test_totals_that_do_not_add_up_are_refused(spark, tmp_path):
    path = scratch_path(spark, "one")
    recounts.write_recount(records(spark), CONTRACT, path)
    records(spark).limit(1).write.mode("append").parquet(f"{path}/records")
    with pytest.raises(ValueError, match="add up"):
        recounts.read_recount(spark, path)
    recounts.write_recount(records(spark).limit(0), CONTRACT, path)
    assert recounts.read_recount(spark, path)[0].count() == 0


def test_published_documents(spark, tmp_path):
    def publish(name, **changes):
        documents = [json.loads(line) for line in records(spark).toJSON().collect()]
        report = {
            "documents": documents, "rows": 3, "recounted_token_total": 24, "stored_token_total": 24,
            "tokenizer": {"use_fast": True, "padding": False}, "tokenizer_class": "T", "tokenizer_is_fast": True,
            "tokenizer_vocab_size": 50257, "runtime": {"python": name},
        } | changes
        (tmp_path / name).write_text(json.dumps(report, indent=2))
        return str(tmp_path / name)

    one, two = publish("one.json"), publish("two.json", tokenizer={"padding": False, "use_fast": True})
    found, contract = recounts.read_recount(spark, one)
    assert contract["tokenizer"] == {"use_fast": True, "padding": False} and contract["tokenizer_vocab_size"] == 50257
    assert sorted(found.collect()) == sorted(records(spark).collect())
    assert reconcile.compare_verdict(recounts.compare_recount_files(spark, one, two)).first()["all_counts_match"]
    folder = scratch_path(spark, "folder")
    recounts.write_recount(records(spark), contract, folder)
    assert reconcile.compare_verdict(recounts.compare_recount_files(spark, folder, one)).first()["rows_compared"] == 3
    with pytest.raises(ValueError, match="different contracts"):
        recounts.compare_recount_files(spark, one, publish("three.json", tokenizer_vocab_size=1))
    with pytest.raises(ValueError, match="add up"):
        recounts.read_recount(spark, publish("four.json", rows=4))


def test_settings_are_compared_by_content(spark):
    same = ['{"b": 1, "a": {"y": [1, 2.50], "x": null}}', '{ "a":{"x":null,"y":[1,2.5]},"b":1 }']
    other = ['{"a":{"x":null,"y":[2.5,1]},"b":1}', '{"a":{"y":[1,2.5]},"b":1}', '{"a":{"x":null,"y":[1,2.5]},"b":"1"}', "{no json", '{"a":1,"a":2}', "", None]
    rows = spark.createDataFrame([(text,) for text in same + other], "settings string")
    found = [r[0] for r in rows.select(reconcile.same_content("settings")).collect()]
    assert found[0] == found[1] and len(set(found)) == 1 + len(other) and found[-4:] == other[-4:]


def test_reports_merge_by_content(spark):
    from corpusledger.sources.reports import REPORT_SCHEMA

    def report(dump, settings):
        entry = [(dump, 1, 2, 1, None, False, False)]
        return ("full", 2013, 1, 2, entry, True, [dump], ["a", "b"], settings, ("regex", 4))

    def merged(one, two):
        rows = spark.createDataFrame([report("a", one), report("b", two)], REPORT_SCHEMA)
        return reconcile.merge_reports(rows.withColumn("source_file", F.concat(F.lit("f"), F.col("dumps_processed")[0])))

    text = '{"target_tokens": 9, "selection": {"rule": "retain_all"}}'
    assert merged(text, '{"selection":{"rule":"retain_all"},"target_tokens":9}').first()["rows"] == 2
    with pytest.raises(PySparkException, match="same settings"):
        merged(text, text.replace("9", "8")).collect()
