"""Shards near equal in bytes, places without gaps, versions that move whole slots only."""

import zlib

import pytest

from corpusledger.llm import virtual_slots as op
from corpusledger.runtime import scratch_path

from .shared import SCHEMA, empty, messy


def check(docs, rows, shards=8):
    assert len(rows) == docs.count()
    size = sorted(len((r["text"] or "").encode()) + 1 for r in docs.collect())
    assert sorted(r["size"] for r in rows) == size
    places = {}
    for r in rows:
        places.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(own) == list(range(len(own))) for own in places.values())
    assert set(places) <= set(range(shards))
    owner = {}
    for r in rows:
        assert owner.setdefault(r["virtual_slot"], r["shard"]) == r["shard"]


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = op.shard_records(docs, scratch_path(spark, "map")).collect()
    check(docs, rows)
    totals = [sum(r["size"] for r in rows if r["shard"] == i) for i in range(8)]
    assert max(totals) - min(totals) < 0.01 * sum(totals) / 8 + max(r["size"] for r in rows) / 8
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)


def test_messy(spark):
    docs = messy(spark)
    rows = op.shard_records(docs, scratch_path(spark, "map")).collect()
    check(docs, rows)
    path = scratch_path(spark, "map")
    assert op.shard_records(empty(spark), path).count() == 0
    assert op.load_map(spark, path).count() == op.SLOTS


def test_versions(spark):
    path = scratch_path(spark, "map")
    schema = "virtual_slot int, bytes bigint"
    even = spark.createDataFrame([(i, 10) for i in range(16)], schema)
    assert op.rebalance(spark, path, even, 16, 4) == 0
    heavy = spark.createDataFrame([(i, 40 if i % 4 == 0 else 10) for i in range(16)], schema)
    assert op.rebalance(spark, path, heavy, 16, 4) == 1
    assert op.rebalance(spark, path, heavy, 16, 4) == 1  # nothing to move: no new version
    first = {r["virtual_slot"]: r["shard"] for r in op.load_map(spark, path, 0).collect()}
    second = {r["virtual_slot"]: r["shard"] for r in op.load_map(spark, path).collect()}
    moved = [i for i in range(16) if first[i] != second[i]]
    assert 0 < len(moved) < 8
    totals = [sum(40 if i % 4 == 0 else 10 for i in range(16) if second[i] == s) for s in range(4)]
    assert max(totals) - min(totals) <= 40  # the heaviest slot
    assert op.rebalance(spark, path, heavy, 16, 5) == 2  # one more shard
    third = {r["virtual_slot"]: r["shard"] for r in op.load_map(spark, path).collect()}
    assert 4 in third.values()


@pytest.mark.parametrize("weights", [{}, {0: 5}, {i: 1 for i in range(8)}, {0: 100, 1: 1, 2: 1, 3: 1}])
def test_edited_never_worse(weights):
    before = op.first_map(8, 3)
    after = op.edited(before, weights, 3)
    spread = lambda m: max(t := [sum(w for s, w in weights.items() if m[s] == i) for i in range(3)]) - min(t)
    assert spread(after) <= spread(before)
    assert op.edited(after, weights, 3) == after


def test_write(spark):
    docs = messy(spark).drop("shard")
    path, out = scratch_path(spark, "map"), scratch_path(spark, "shards")
    rows = op.shard_records(docs, path).collect()
    op.write_shards(docs, path, out)
    written = spark.read.parquet(out)
    assert written.count() == len(rows)
    counts = {r[0]: r[1] for r in written.groupBy("shard").count().collect()}
    assert counts == {s: sum(r["shard"] == s for r in rows) for s in {r["shard"] for r in rows}}


def test_keys_that_are_null_or_repeat(spark):
    """The law holds whatever the ids: rows that no id tells apart are spread."""
    for ids in (lambda i: None, lambda i: 7, lambda i: None if i % 2 else 7 if i % 3 else i):
        rows = [(ids(i), "same text", None, None, i) for i in range(2_000)]
        docs = spark.createDataFrame(rows, SCHEMA)
        path, out = scratch_path(spark, "map"), scratch_path(spark, "shards")
        found = op.shard_records(docs, path).collect()
        check(docs, found)
        totals = [sum(r["size"] for r in found if r["shard"] == i) for i in range(8)]
        assert max(totals) - min(totals) <= 2 * max(r["size"] for r in found)
    op.write_shards(docs, path, out)
    counts = {r[0]: r[1] for r in spark.read.parquet(out).groupBy("shard").count().collect()}
    assert counts == {s: sum(r["shard"] == s for r in found) for s in range(8)}


def test_single_keys_decide_slots(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "'x' AS text")
    slots = [
        {r["doc_id"]: r["virtual_slot"] for r in op.shard_records(part, scratch_path(spark, "map")).collect()}
        for part in (docs, docs.where("doc_id % 3 = 0"))
    ]
    assert all(slots[0][doc] == slot for doc, slot in slots[1].items())
