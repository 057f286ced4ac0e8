"""Selection against a direct loop, on corner cases and on one dump that dominates."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusledger.functions.keys import bucket_bits, key_bucket
from corpusledger.operators import prefix, select
from corpusledger.runtime import pin_small, stage

ORDER = select.SEEDED_ORDER


def loop(docs, quotas):
    """Keep documents in key order until the quota is crossed."""
    kept = []
    for dump, quota in quotas.items():
        running = 0
        for key, doc_id, tokens in sorted(d[1:] for d in docs if d[0] == dump):
            if running >= quota:
                break
            kept.append((dump, doc_id))
            running += tokens
    return sorted(kept)


def corpus(spark, rows):
    keyed = select.seeded(
        spark.createDataFrame(rows, "source_config string, doc_id bigint, token_count bigint"), 7, 4
    )
    return stage(keyed, "docs")


def kept(df):
    return sorted((row["source_config"], row["doc_id"]) for row in df.collect())


def test_budget_equals_loop_on_random_dumps(spark):
    rng = random.Random(5)
    rows, doc_id = [], 0
    for number in range(24):
        for _ in range(rng.choice([1, 3, 40])):
            rows.append((f"d{number:02d}", doc_id, rng.choice([0, 0, 1, 5, 9])))
            doc_id += 1
    rows += [("hot", doc_id + i, 3) for i in range(600)]
    docs = corpus(spark, rows)
    listed = [tuple(r) for r in docs.select("source_config", "key", "doc_id", "token_count").collect()]
    totals = {}
    for dump, _, _, tokens in listed:
        totals[dump] = totals.get(dump, 0) + tokens
    pick = [lambda t: 0, lambda t: t, lambda t: t + 1, lambda t: t // 2, lambda t: 1]
    quotas = {dump: pick[i % 5](total) for i, (dump, total) in enumerate(sorted(totals.items()))}
    quotas["hot"] = 901
    plans = spark.createDataFrame(list(quotas.items()), "source_config string, token_quota bigint")
    assert kept(select.token_budget(docs, plans)) == loop(listed, quotas)


def test_empty_document_after_an_exact_quota_is_dropped(spark):
    docs = corpus(spark, [("a", i, t) for i, t in enumerate([4, 0, 0, 6, 0, 2, 0])])
    listed = [tuple(r) for r in docs.select("source_config", "key", "doc_id", "token_count").collect()]
    running = 0
    for _, _, _, tokens in sorted(listed, key=lambda row: row[1]):
        running += tokens
        quota = {"a": running}
        plans = spark.createDataFrame(list(quota.items()), "source_config string, token_quota bigint")
        assert kept(select.token_budget(docs, plans)) == loop(listed, quota)


def test_outcome_flags(spark):
    plans = spark.createDataFrame(
        [("met", 10, 5), ("dry", 4, 99), ("zero", 3, 0), ("gone", 0, 8)],
        "source_config string, available_rows bigint, token_quota bigint",
    )
    totals = spark.createDataFrame(
        [("met", 2, 7), ("dry", 4, 12)], "source_config string, rows bigint, tokens bigint"
    )
    rows = {r["source_config"]: r for r in select.quota_outcome(totals, plans, 3).collect()}
    flags = {n: (r["quota_reached"], r["source_exhausted"]) for n, r in rows.items()}
    assert flags == {
        "met": (True, False), "dry": (False, True), "zero": (True, False), "gone": (False, True),
    }
    assert rows["met"]["overshoot"] == 2 and rows["dry"]["shards"] == 2
    short = spark.createDataFrame([("dry", 3, 12)], totals.schema)
    with pytest.raises(PySparkException, match="neither met nor"):
        select.quota_outcome(short, plans.where("source_config = 'dry'"), 3).collect()


def test_first_rows_cut_surplus_and_shortfalls_show(spark):
    docs = spark.createDataFrame(
        [("a", i) for i in range(0, 50, 2)] + [("b", i) for i in range(1, 9, 2)],
        "source_config string, doc_id bigint",
    )
    targets = spark.createDataFrame([("a", 3), ("b", 9)], "source_config string, row_target bigint")
    assert kept(select.first_rows(docs, targets)) == [
        ("a", 0), ("a", 2), ("a", 4), ("b", 1), ("b", 3), ("b", 5), ("b", 7),
    ]
    held = docs.groupBy("source_config").agg(F.count("*").alias("available_rows"))
    short = select.shortfalls(held, targets).collect()
    assert [(r["source_config"], r["available_rows"]) for r in short] == [("b", 4)]


def test_sample_is_the_head_of_the_shuffle(spark, docs):
    plans = docs.groupBy("source_config").agg((F.count("*") / 3).cast("bigint").alias("row_target"))
    chosen = select.proportional_sample(docs.drop("text"), pin_small(plans), 11)
    order = select.seeded_shuffle(docs.drop("text"), 11).join(plans, "source_config")
    head = order.where("position < row_target")
    assert kept(chosen) == kept(head)


def test_shuffle_is_a_permutation_that_depends_on_the_seed(spark, docs):
    def positions(seed, partitions):
        shuffled = select.seeded_shuffle(docs.drop("text").repartition(partitions), seed)
        return {r["doc_id"]: (r["source_config"], r["position"]) for r in shuffled.collect()}

    first = positions(1, 3)
    assert first == positions(1, 7)
    assert first != positions(2, 3)
    counts = {}
    for dump, position in first.values():
        counts.setdefault(dump, []).append(position)
    assert all(sorted(found) == list(range(len(found))) for found in counts.values())


def test_bucket_sizes():
    assert bucket_bits(0) == bucket_bits(1000) == 6
    for rows in (10**8, 7 * 10**9, 2 * 10**10):
        assert 1 << 17 <= rows / 2 ** bucket_bits(rows) <= 1 << 18
    assert bucket_bits(10**30) == 32


def test_buckets_follow_the_key(spark):
    keys = ["00000000f", "0fffffff0", "10000000a", "80000000b", "ffffffffc"]
    rows = spark.createDataFrame([(k,) for k in keys], "key string")
    for bits, expected in [(4, [0, 0, 1, 8, 15]), (1, [0, 0, 0, 1, 1])]:
        assert [r[0] for r in rows.select(key_bucket("key", bits)).collect()] == expected
    by_row = rows.withColumn("bits", F.when(F.col("key") < "8", 4).otherwise(1))
    assert [r[0] for r in by_row.select(key_bucket("key", F.col("bits"))).collect()] == [0, 0, 1, 1, 1]


def test_dense_index_crosses_id_buckets(spark):
    ids = [5, (1 << 20) - 1, 1 << 20, (1 << 20) + 7, 3 << 20, (9 << 20) + 1]
    docs = spark.createDataFrame([("a", i) for i in ids], "source_config string, doc_id bigint")
    placed = prefix.dense_index(
        select.in_source_order(docs), group="source_config", bucket="bucket", order=["doc_id"]
    )
    assert {r["doc_id"]: r["position"] for r in placed.collect()} == {i: n for n, i in enumerate(ids)}


@pytest.mark.parametrize("size", [1, 3, 7, 100, 1000])
def test_shard_assignment_equals_position(spark, docs, size):
    keyed = stage(select.seeded(docs.drop("text"), 3, 4), "keyed")
    names = dict(group="source_config", bucket="bucket", order=ORDER)
    bounds = prefix.shard_bounds(keyed, rows_per_shard=size, **names)
    assigned = prefix.assign_shards(keyed, bounds, **names).select("doc_id", "shard")
    placed = prefix.dense_index(keyed, **names).select(
        "doc_id", F.floor(F.col("position") / size).alias("expected")
    )
    joined = assigned.join(placed, "doc_id")
    assert joined.count() == keyed.count()
    assert joined.where("shard != expected").count() == 0


def test_pinned_tables_are_broadcast_by_their_bytes(spark):
    table = spark.range(50).withColumnRenamed("id", "doc_id")
    pinned = pin_small(table)
    assert "ResolvedHint" not in pinned._jdf.queryExecution().logical().toString()
    assert "Broadcast" in _plan(table.join(pinned, "doc_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert "Broadcast" not in _plan(table.join(pinned, "doc_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert pinned.count() == 50


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
