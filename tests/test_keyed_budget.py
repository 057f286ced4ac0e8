"""Budgets in keyed state give what the batch form and the form with state tables give."""

import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusledger.operators import select
from corpusledger.runtime import scratch_path, stage
from corpusledger.streaming import budget, count, keyed_budget

SCHEMA = "source_config string, doc_id bigint, key string, bucket int, token_count bigint"


@pytest.fixture(scope="module")
def arrivals(spark):
    """Three batches in key order; documents without tokens, and copies of a key, around the cuts."""
    rng = random.Random(4)
    rows = [(dump, i, f"{rng.randrange(400):03x}", 0, rng.choice([0, 0, 1, 5, 40])) for dump in "abc" for i in range(120)]
    return stage(spark.createDataFrame(rows, SCHEMA), "arrivals")


@pytest.fixture(scope="module")
def plans(spark, arrivals):
    totals = {r[0]: r[1] for r in arrivals.groupBy("source_config").agg(F.sum("token_count")).collect()}
    rows = [("a", totals["a"] // 2), ("b", 10**9), ("c", 0), ("unseen", 7)]
    return stage(spark.createDataFrame(rows, "source_config string, token_quota bigint"), "plans")


def ids(df):
    return sorted((r["source_config"], r["doc_id"]) for r in df.collect())


def forget(checkpoint, batch):
    """As if the driver died before the batch was marked as committed."""
    for name in (f"{checkpoint}/commits/{batch}", f"{checkpoint}/commits/.{batch}.crc"):
        if os.path.exists(name):
            os.remove(name)


def test_equals_the_other_forms_over_retries_and_restarts(spark, arrivals, plans):
    expected = ids(select.token_budget(arrivals, plans))
    assert expected and not any(dump == "c" for dump, _ in expected)
    base, out, other, state, query = (scratch_path(spark, n) for n in ("in", "out", "other", "state", "query"))
    for number, (low, high) in enumerate([("000", "060"), ("060", "0c0"), ("0c0", "fff")]):
        arrivals.where((F.col("key") >= low) & (F.col("key") < high)).repartition(2).write.mode("append").parquet(base)
        keyed_budget.stream_budget_keyed(count.read_stream(spark, base, SCHEMA, 1000), plans, out, state)
        budget.stream_budget(count.read_stream(spark, base, SCHEMA, 1000), plans, other, query)
        if number == 1:
            forget(state, 1)
    assert ids(keyed_budget.admitted_keyed(spark, out)) == expected
    assert ids(budget.admitted(spark, other, arrivals.schema)) == expected
    totals = {r["source_config"]: (r["rows"], r["tokens"]) for r in keyed_budget.keyed_totals(spark, state).collect()}
    batch = budget.running_totals(spark, other).collect()
    assert totals == {r["source_config"]: (r["rows"], r["tokens"]) for r in batch if r["rows"]}
    late = arrivals.where("source_config = 'a'").limit(5).withColumn("doc_id", F.col("doc_id") + 1_000)
    late.write.mode("append").parquet(base)
    keyed_budget.stream_budget_keyed(count.read_stream(spark, base, SCHEMA, 1000), plans, out, state)
    assert ids(keyed_budget.admitted_keyed(spark, out)) == expected


def test_goes_on_behind_a_batch_run(spark, arrivals, plans):
    done = stage(select.token_budget(arrivals.where("key < '050'"), plans), "done")
    initial = done.groupBy("source_config").agg(F.sum("token_count").alias("tokens"), F.count("*").alias("rows"))
    base, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    arrivals.where("key >= '050'").coalesce(1).write.parquet(base)
    for _ in range(2):
        keyed_budget.stream_budget_keyed(count.read_stream(spark, base, SCHEMA, 1), plans, out, state, initial)
    assert sorted(ids(done) + ids(keyed_budget.admitted_keyed(spark, out))) == ids(select.token_budget(arrivals, plans))
    totals = {r["source_config"]: r["tokens"] for r in keyed_budget.keyed_totals(spark, state).collect()}
    direct = select.selection_totals(select.token_budget(arrivals, plans)).collect()
    assert {d: t for d, t in totals.items() if t} == {r["source_config"]: r["tokens"] for r in direct if r["tokens"]}


class Value:
    """A state variable as the processor sees it."""

    def __init__(self, held=None):
        self.held = held

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


@pytest.mark.parametrize("room", [0, 1, 37, 400, 10**6])
@pytest.mark.parametrize("start", [None, (30, 2)])
def test_chunks_in_any_order_give_the_cut_of_the_whole(monkeypatch, room, start):
    monkeypatch.setattr(keyed_budget, "SLACK", 25)
    rng = random.Random(room)
    for turn in range(20):
        rows = pd.DataFrame({
            "source_config": "a", "key": [f"{rng.randrange(60):02x}" for _ in range(150)], "doc_id": rng.sample(range(999), 150),
            "token_count": [rng.choice([0, 0, 3, 9]) for _ in range(150)], "token_quota": room,
        })
        processor = keyed_budget.BudgetProcessor()
        processor.totals = Value(start)
        chunks = [rows.iloc[i:i + 11] for i in range(0, 150, 11)]
        rng.shuffle(chunks)
        found = list(processor.handleInputRows(("a",), iter(chunks), None))
        used, count_ = start or (0, 0)
        wanted = []
        for row in rows.sort_values(["key", "doc_id"]).itertuples():
            if used >= room:
                break
            wanted.append(row.doc_id)
            used += row.token_count
        assert [i for part in found for i in part["doc_id"]] == wanted
        if wanted:
            assert processor.totals.get() == (used, count_ + len(wanted))
