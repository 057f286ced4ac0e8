"""Joins by shuffle, for tables too large to broadcast, give the same results."""

import pytest
from pyspark.sql import functions as F

from corpusledger.functions.counters import CounterSpec
from corpusledger.plans.config import RunConfig
from corpusledger.plans.year import run_year
from corpusledger.runtime import scratch_path
from corpusledger.sinks.shards import read_output


@pytest.fixture
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def build(spark, docs):
    held = {row[0]: row[1] for row in docs.groupBy("source_config").count().collect()}
    config = RunConfig(
        {
            "year": 2013, "source": {"configs": held}, "target_tokens": 200 * sum(held.values()),
            "selection": {
                "rule": "token_budget", "shuffle": True, "random_seed": 5,
                "estimated_tokens_available": 1000 * sum(held.values()),
            },
        }
    )
    root = scratch_path(spark, "year")
    report = run_year(docs, config, root, counter=CounterSpec("regex"), rows_per_shard=8).first()
    rows = read_output(spark, root).select(
        "source_config", "shard", F.col("_metadata.row_index").alias("row"), "text", "token_count"
    )
    return report["source_configs"], sorted(tuple(row) for row in rows.collect())


def test_year(spark, docs, no_broadcast):
    shuffled = build(spark, docs)
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(name)
    assert build(spark, docs) == shuffled
