"""Hits against a direct search over all aligned windows, and planted passages."""

import random
import re
from collections import Counter

import pytest

from corpusledger.llm import decontaminate as op

from .shared import SCHEMA, empty, messy, prose

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bag(words):
    k = min(5, len(words))
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def likeness(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def brute(docs, items, every_window=False):
    """{(doc_id, item_id): best similarity} of at least 0.75."""
    out = {}
    for item, text in items:
        own = WORD.findall((text or "").translate(LOWER))
        if not own or item is None:
            continue
        wanted, k = bag(own), min(5, len(own))
        places = {}
        for j in range(len(own) - k + 1):
            places.setdefault(tuple(own[j:j + k]), []).append(j)
        for doc, text in docs:
            words = WORD.findall((text or "").translate(LOWER))
            begins = set()
            for i in range(len(words) - k + 1):
                begins.update(i - j for j in places.get(tuple(words[i:i + k]), ()))
            if every_window and len(words) >= len(own):
                begins = range(len(words) - len(own) + 1) if begins else ()
            for begin in begins:
                window = words[max(0, begin):begin + len(own)]
                k_w = Counter(tuple(window[i:i + k]) for i in range(len(window) - k + 1))
                found = likeness(k_w, wanted) if k_w else 0
                if found >= 0.75:
                    out[doc, item] = max(found, out.get((doc, item), 0))
    return out


def found(docs, benchmark):
    return {(r["doc_id"], r["item_id"]): r["similarity"] for r in op.contaminated(docs, benchmark).collect()}


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    wanted = brute([tuple(r) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    got = found(docs, items)
    assert got.keys() == wanted.keys() and wanted
    assert all(got[pair] == pytest.approx(wanted[pair]) for pair in got)


def test_planted_and_edited_passages(spark):
    rng = random.Random(3)
    items = [(i, prose(100 + i, rng.randint(6, 60), 2000)) for i in range(25)] + [(90, "Only four Words here")]
    docs = []
    for i in range(120):
        words, item = prose(1000 + i, 120, 3000).split(), items[i % 25][1].split()
        for _ in range(i // 25):  # edits: replaced, dropped and added words
            at, how = rng.randrange(len(item)), rng.randrange(3)
            item[at:at + 1] = [["odd"], [], [item[at], "odd"]][how]
        at = rng.randrange(len(words)) if i % 7 else 0
        docs.append((i, " ".join([*words[:at], *item, *words[at:]]).upper() if i % 2 else " ".join([*words[:at], *item, *words[at:]])))
    docs += [(500, "so only FOUR words here, no: only four words here"), (501, items[20][1]), (502, items[20][1])]
    docs += [(600 + i, prose(7000 + i, 200, 3000)) for i in range(30)]
    data = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = found(data, spark.createDataFrame(items, "item_id bigint, text string"))
    wanted = brute(docs, items)
    assert got.keys() == wanted.keys()
    assert all(got[pair] == pytest.approx(wanted[pair]) for pair in got)
    # Windows at all other places find no further document.
    assert {d for d, _ in brute(docs, items, every_window=True)} <= {d for d, _ in got}
    assert {500, 501, 502} <= {d for d, _ in got} and not any(d >= 600 for d, _ in got)


def test_both_joins_agree(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    sent = found(docs, items)
    monkeypatch.setattr(op, "MAX_SENT", 0)
    assert found(docs, items) == sent


def test_index_finds_all_within_radius():
    reach = op.RADIUS // (op.BITS // op.BLOCK_BITS)
    masks = set(op._near_values(reach))
    rng = random.Random(5)
    for _ in range(2000):
        print_, errors = rng.getrandbits(64), rng.sample(range(64), op.RADIUS)
        other = print_
        for bit in errors:
            other ^= 1 << bit
        blocks = [((print_ ^ other) >> (8 * i)) & 255 for i in range(8)]
        assert any(block in masks for block in blocks)


def test_messy(spark):
    items = spark.createDataFrame(
        [(1, prose(1, 120)), (2, None), (3, ""), (None, "one"), (4, "one"), (4, "one")], "item_id bigint, text string"
    )
    docs = messy(spark)
    got = {(r["doc_id"], r["item_id"]) for r in op.contaminated(docs, items).collect()}
    assert got == {(1, 1), (2, 1), (6, 4), (7, 4)}
    assert op.contaminated(empty(spark), items).count() == 0
    assert op.contaminated(docs, empty(spark).selectExpr("doc_id AS item_id", "text")).count() == 0
    assert SCHEMA
