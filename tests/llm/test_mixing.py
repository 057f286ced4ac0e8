"""Mixes against a direct computation."""

import hashlib
import re

import pytest

from corpusledger.llm import mixing as op

from .shared import SCHEMA, empty, messy

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows):
    """{(row number): (size, source size, target, taken)}."""
    sizes = [len(WORD.findall(text or "")) for _, text, _ in rows]
    names = sorted({source for *_, source in rows}, key=lambda s: (s is None, (s or "").encode()))
    held = {name: sum(n for n, row in zip(sizes, rows) if row[2] == name) for name in names}
    weight = {name: (1, 2, 3)[i % 3] for i, name in enumerate(names)}
    target, open_names, left = {}, set(names), sum(sizes)
    while open_names:
        rate = left / sum(weight[n] for n in open_names)
        above = [n for n in open_names if rate * weight[n] >= 3 * held[n]]
        if not above:
            target |= {n: rate * weight[n] for n in open_names}
            break
        for n in above:
            target[n] = float(3 * held[n])
            left -= 3 * held[n]
            open_names.remove(n)
    out = []
    for (doc, _, source), size in zip(rows, sizes):
        out.append((doc, size, held[source], target[source]))
    return out


def check(docs):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    found = op.mix(docs).collect()
    again = op.mix(docs.repartition(3)).collect()
    order = lambda row: tuple((x is None, x) for x in row)
    assert sorted(map(tuple, found), key=order) == sorted(map(tuple, again), key=order)
    wanted = sorted(brute(rows), key=order)
    got = sorted(((r["doc_id"], r["size"], r["source_size"], r["target"]) for r in found), key=order)
    assert len(got) == len(wanted)
    for g, w in zip(got, wanted):
        assert g[:3] == w[:3] and g[3] == pytest.approx(w[3])
    for source in {r["source"] for r in found}:
        own = [r for r in found if r["source"] == source]
        largest = max(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= largest
        # Whole takes for all, one more below some hash.
        least = min(r["repeats"] for r in own)
        assert {r["repeats"] for r in own if r["size"]} <= {least, least + 1}
        # Nested by the hash of the id; rows without one are hashed by their text (test_null_ids).
        hashed = sorted(
            (int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16), -r["repeats"])
            for r in own if r["size"] and r["doc_id"] is not None
        )
        assert [x for _, x in hashed] == sorted(x for _, x in hashed)
    assert all(r["taken"] <= 3 * r["size"] for r in found)
    return found


def test_documents(spark, docs):
    raw = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert len(check(raw)) == raw.count()


def test_limits_are_shared_out(spark):
    rows = [(i, "w " * 5, None, "a", 0) for i in range(200)] + [(300, "w " * 40, None, "b", 0)]
    rows += [(400 + i, "w", None, "c", 0) for i in range(3)] + [(500, "", None, "d", 0)]
    found = check(spark.createDataFrame(rows, SCHEMA))
    assert {r["target"] for r in found if r["source"] == "c"} == {9.0}
    assert {r["target"] for r in found if r["source"] == "d"} == {0.0}
    assert {r["target"] for r in found if r["source"] == "b"} == {120.0}
    assert next(r["target"] for r in found if r["source"] == "a") == pytest.approx(1043 - 129)


def test_targets_are_monotone_in_taken_documents(spark):
    rows = [(i, "w " * (i % 9), None, "a", 0) for i in range(300)]
    records = op.sized(spark.createDataFrame(rows, SCHEMA)).cache()
    taken = []
    for rest in (1.0, 100.0, 400.0, 900.0):
        wanted = spark.createDataFrame([("a", rest)], "source string, rest double")
        limit = op.thresholds(records, wanted).first()["threshold"]
        taken.append({r["doc_id"] for r in records.collect() if r["hash"] < limit})
    assert taken[0] <= taken[1] <= taken[2] <= taken[3] and len(taken[1]) < len(taken[3])


def test_decided_keeps_columns_and_agrees(spark):
    docs = messy(spark)
    check(docs)
    rows = op.decided(docs).collect()
    assert set(docs.columns) | {"__repeats"} == set(rows[0].asDict()) and len(rows) == docs.count()
    both = {(r["doc_id"], r["source"]): r["repeats"] for r in op.mix(docs).collect()}
    assert all(both[r["doc_id"], r["source"]] == r["__repeats"] for r in rows)
    assert op.mix(empty(spark)).count() == 0


def test_null_ids(spark):
    """Rows without an id meet the targets as others do, and are nested by their texts' hashes."""
    rows = [(None, f"{'w ' * 9}{i}", None, "ab"[i % 2], 0) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = check(docs)
    for source, target in (("a", 4000 / 3), ("b", 8000 / 3)):
        assert abs(sum(r["taken"] for r in found if r["source"] == source) - target) <= 10
    for source in "ab":
        taken = [(int(hashlib.md5(f"t{r['text']}".encode()).hexdigest()[:15], 16), -r["__repeats"])
                 for r in op.decided(docs).collect() if r["source"] == source]
        assert [x for _, x in sorted(taken)] == sorted(x for _, x in taken)
