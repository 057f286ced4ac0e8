"""Ranked search against a direct computation over all pairs."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from corpusledger.llm import dual_tree as op

from .shared import SCHEMA, empty, messy, prose

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=10):
    split = lambda text: TERM.findall((text or "").translate(LOWER))
    held = [(doc, len(found), Counter(found)) for doc, text in docs if (found := split(text))]
    N, L = len(held), sum(n for _, n, _ in held)
    df = Counter(term for _, _, found in held for term in found)
    out = []
    for item, text in items:
        scores = []
        for doc, n, found in held:
            m, score = 25 + 75 * n * N // L, 0
            for term in split(text):
                if tf := found[term]:
                    w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[term] + 1)))
                    score += w * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc, score))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, rank, doc, score) for rank, (_, _, doc, score) in enumerate(scores[:k], 1)]
    return out


def check(docs, items, k=10):
    key = lambda row: tuple((x is None, x) for x in row)
    got = sorted(map(tuple, op.search(docs, items, k).collect()), key=key)
    pairs = lambda df, name: [(r[name], r["text"]) for r in df.select(name, "text").collect()]
    assert got == sorted(brute(pairs(docs, "doc_id"), pairs(items, "item_id"), k), key=key)
    return got


def test_documents(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    assert check(docs, items)


def test_messy_rows(spark):
    docs = messy(spark)
    items = spark.createDataFrame([
        (1, prose(1, 30)), (1, prose(1, 30)), (2, None), (None, prose(3, 20)), (3, ""), (4, "ONE one 漢字"),
        (5, "nowhere"), (6, prose(4, 9) + " " + prose(2, 9)), (7, " .,\n"),
    ], "item_id bigint, text string").selectExpr("*", "'mine' AS rank", "'mine' AS doc_id", "'mine' AS m")
    check(docs, items)
    check(docs, items, k=1)
    assert op.search(empty(spark), items).count() == 0
    assert op.search(docs, items.limit(0)).count() == 0
    assert op.search(docs.where("text IS NULL"), items).count() == 0


def test_copies_tie_by_doc_id(spark):
    rows = [(5_000 - i, prose(i % 3, 40), None, None, 0) for i in range(900)] + [(None, prose(0, 40), None, None, 0)] * 20
    items = spark.createDataFrame([(1, prose(0, 25)), (2, prose(1, 5))], "item_id bigint, text string")
    check(spark.createDataFrame(rows, SCHEMA).repartition(5), items)


def test_few_documents_and_repeated_terms(spark):
    docs = spark.createDataFrame([(1, "a a a b", None, None, 0), (2, "b c", None, None, 0)], SCHEMA)
    items = spark.createDataFrame([(1, "a a b"), (2, "c C c"), (3, "b")], "item_id bigint, text string")
    check(docs, items)


def test_blocks_of_items_and_small_batches(spark, sf, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_TERMS", 300)
    monkeypatch.setattr(op, "SEED_SHARE", 2)
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    check(docs, items, k=3)


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "x y z"), ("a", "x y z"), (None, "x y"), ("é", "z z q")], "doc_id string, text string")
    items = spark.createDataFrame([("i", "x z")], "item_id string, text string")
    got = {r["doc_id"]: (r["rank"], r["score"]) for r in op.search(docs, items).collect()}
    assert set(got) == {"a", "b", None, "é"} and got["a"][1] == got["b"][1] and got["a"][0] + 1 == got["b"][0]


def test_pieces_of_long_texts(monkeypatch):
    text = prose(3, 3_000) + " Éa_b-9 " + "w" * 5_000
    whole = [t for part in op.terms(text) for t in part]
    monkeypatch.setattr(op, "PIECE", 11)
    assert [t for part in op.terms(text) for t in part] == whole
    assert [t.decode() for t in whole] == TERM.findall(text.translate(LOWER))


def vectors(seed, rows, terms, share):
    rng = np.random.default_rng(seed)
    # Groups of rows that share most of their terms, the same groups for any seed.
    group = np.random.default_rng(0).random((24, terms)) < share
    own = group[rng.integers(0, 24, rows)] & (rng.random((rows, terms)) < 0.7)
    return own * rng.integers(1, 1_000, (rows, terms))


@pytest.mark.parametrize("dtype", [np.float64, np.int64])
def test_bounds_prune_batches_without_loss(dtype):
    weights = vectors(1, 60, 300, 0.05).astype(dtype)
    task = op.Search(weights, 5, np.ones(60, np.int64))
    kept, every = [], []
    for seed in range(12):
        docs = vectors(100 + seed, 200, 300, 0.05)
        row, term = np.nonzero(docs)
        place = np.random.default_rng(seed).permutation(200)
        items, rows, scores = task.batch(place, row, term, docs[row, term])
        kept += [(i, -s, seed, place[r]) for i, r, s in zip(items, rows, scores)]
        exact = weights.astype(np.int64) @ docs.T
        assert all(exact[i, r] == s for i, r, s in zip(items, rows, scores))
        every += [(i, -exact[i, r], seed, place[r]) for i in range(60) for r in range(200) if exact[i, r] > 0]
    for item in range(60):
        best = lambda found: sorted(x for x in found if x[0] == item)[:5]
        assert best(kept) == best(every)
    # Of 60 x 200 x 12 pairs, most were left with their batch.
    assert task.scored < 0.6 * 60 * 200 * 12


def test_node_bounds_cover_what_is_below():
    weights = vectors(3, 37, 80, 0.2).astype(np.float64)
    docs = vectors(4, 75, 80, 0.2).astype(np.float64)
    order, levels = op.doc_tree(docs)
    assert sorted(order.tolist()) == list(range(75)) and len(levels[0]) == 1
    exact = weights @ docs.T

    def visit(node):
        for level, most in enumerate(levels):
            span = op.DOC_LEAF << (len(levels) - 1 - level)
            bound = most[:, node.used] @ node.most
            for i in range(len(most)):
                assert bound[i] >= exact[np.ix_(node.items, order[i * span:(i + 1) * span])].max()
        for below in node.below:
            visit(below)

    root = op.item_tree(weights)
    visit(root)
    assert sorted(root.items.tolist()) == list(range(37))


def test_large_weights_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(op, "EXACT", 0)
    docs = spark.createDataFrame([(i, "x " * (i % 5) + prose(i, 20), None, None, 0) for i in range(80)], SCHEMA)
    items = spark.createDataFrame([(1, "x " * 3_000), (2, "x " + prose(7, 4)), (3, "y")], "item_id bigint, text string")
    check(docs, items)
