"""Components against all pairs, with buckets that hold more than one group."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from corpusledger.llm import circulant_minhash as op

from .shared import empty, messy, prose

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def components_of(rows):
    """Per row, the first row of its component: smallest doc_id, nulls last, then the earlier one."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    sets = dict(enumerate(shingles(text) for _, text in rows))
    root = {row: row for row in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return rows, sets, {row: find(row) for row in sets}


def brute(rows):
    """Every row's (doc_id, size of the set, component, kept), with repeats."""
    rows, sets, first = components_of(rows)
    of = lambda row: rows[first[row]][0]
    return Counter((rows[row][0], len(s), of(row), rows[row][0] == of(row)) for row, s in sets.items())


def found(docs):
    out = op.near_duplicates(docs).collect()
    assert len({r["row"] for r in out}) == len(out)
    assert all(r["kept"] for r in out if r["first"])
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out)


def edited(text, changes, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_documents(spark, docs):
    rows = [tuple(row) for row in docs.select("doc_id", "text").collect()]
    assert found(docs) == brute(rows)


def test_groups_chains_and_shared_passages(spark):
    passage, rows = prose(99, 60), []
    for i in range(60):  # a passage that many share, below the threshold
        rows.append((i, f"{passage} {prose(1000 + i, 50)}"))
    base = prose(5, 150)
    for i in range(60, 110):  # near copies of one text, not all alike enough with each other
        rows.append((i, edited(base, i % 4 + 1, i)))
    chain = base
    for i in range(110, 125):  # each like the one before only
        chain = edited(chain, 3, i)
        rows.append((i, chain))
    rows += [(200 + i, prose(7, 90)) for i in range(30)]
    rows += [(300 + i, f"{passage} {prose(3000, 12)} x{i}") for i in range(25)]
    data = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(data) == brute(rows)


def test_rare_pairs_settle_what_stars_leave(spark):
    """Two groups that meet in buckets: the exact step finds every pair between components."""
    rows = [(i, prose(40, 100)) if i < 2 else (i, edited(prose(40, 100), 4, i)) for i in range(12)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = texts.withColumnRenamed("doc_id", "row")
    rest = texts.selectExpr("row", "row AS root")
    pairs = op.confirmed(op._rare_pairs(rest, texts, 75, 5), texts, 75, 5).collect()
    wanted = set()
    for (a, x), (b, y) in combinations(rows, 2):
        both = len(shingles(x) & shingles(y))
        if 100 * both >= 75 * len(shingles(x) | shingles(y)):
            wanted.add((a, b))
    assert {tuple(pair) for pair in pairs} == wanted and wanted


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 530)]
    links = [(a, b) for a, b in links if a != b]
    root = {i: i for i in range(600)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    nodes = spark.range(600).withColumnRenamed("id", "row")
    out = op.components(nodes, spark.createDataFrame(links, "a bigint, b bigint"))
    assert {tuple(row) for row in out.collect()} == {(i, find(i)) for i in range(600)}


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 1500).astype(np.uint64)
    a, b = op.signature(pool[:1000], 512), op.signature(pool[500:], 512)
    assert abs((a == b).mean() - 500 / 1500) < 0.08


def test_messy(spark):
    docs = messy(spark)
    rows = [(row["doc_id"], row["text"]) for row in docs.collect()]
    assert found(docs) == brute(rows)
    assert op.near_duplicates(empty(spark)).count() == 0


def test_ids_that_are_null_or_repeat(spark):
    """Every row counts: links over any text of an id, and one first row per component."""
    a, b, c = prose(1, 80), prose(2, 80), prose(3, 80)
    rows = [(1, a), (1, b), (2, b), (5, c), (None, c), (None, a), (7, ""), (7, ""), (None, ""), (None, None)]
    rows += [(None, prose(50 + i % 40, 60)) for i in range(200)] + [(9, c)] * 30 + [(9, edited(b, 2, 1))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(docs) == brute(rows)
    out = op.near_duplicates(docs).collect()
    listed, sets, first = components_of(rows)
    assert sum(r["first"] for r in out) == len(set(first.values()))
    assert {(r["doc_id"], r["component_id"]) for r in out if r["n_shingles"]} >= {(2, 1), (1, 1), (9, 5), (None, 5)}
    assert Counter(r["doc_id"] for r in out if r["first"]) == Counter(listed[row][0] for row in set(first.values()))


def test_ids_of_other_types(spark):
    docs = spark.createDataFrame([("b", prose(1, 50)), ("a", prose(1, 50)), (None, "x")], "doc_id string, text string")
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in op.near_duplicates(docs).collect()} == {
        ("a", "a", True), ("b", "a", False), (None, None, True),
    }


def test_near_copies_take_one_comparison_each(spark, monkeypatch):
    """A group of near copies is compared about once per row, whatever the number of bands; none is lost."""
    rng, rows = random.Random(5), []
    for i in range(120):
        words = [f"w{k}" for k in range(400)]
        for at in rng.sample(range(400), 5):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    compared, plain = [], op.confirmed

    def counting(pairs, *more):
        compared.append(pairs.count())
        return plain(pairs, *more)

    monkeypatch.setattr(op, "confirmed", counting)
    monkeypatch.setattr(op, "PAIRS_PER_GROUP", 7, raising=False)
    assert found(docs) == brute(rows)
    assert sum(compared) < 2 * len(rows)


def test_rows_on_the_rim_of_a_group_are_not_compared_with_all_of_it(spark):
    """Rows near enough to a few of a large component only: few meet all of it, and no link is lost."""
    base, rng = [f"w{k}" for k in range(150)], random.Random(11)

    def changed(*places):
        words = list(base)
        for slot, value in places:
            words[8 + 18 * slot] = f"x{slot}_{value}"
        return " ".join(words)

    inside = [changed((a, i), (b, j)) for a, b in combinations(range(8), 2) for i in range(4) for j in range(4)]
    rim = sorted({changed(*((slot, rng.randrange(4)) for slot in rng.sample(range(8), 4))) for _ in range(60)})
    rows = list(enumerate([*inside, *rim]))
    texts = spark.createDataFrame(rows, "row bigint, text string").coalesce(1).cache()
    rest = texts.selectExpr("row", f"IF(row < {len(inside)}, 0, row) AS root")
    rare = op._rare_shingles(rest, texts, 75, 5)
    joined, links = op._rare_stars(rare, rest, texts, 75, 5)
    left = op._pairs_of(rare, joined, 75)
    every = op._rare_pairs(rest, texts, 75, 5).count()
    assert left.count() < every / 4 and every > 10 * len(rows)
    sets, root = [shingles(text) for _, text in rows], dict(rest.collect())
    similar = lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    for table in links:
        assert all(similar(*pair) for pair in table.collect())
    more = [tuple(pair) for pair in op.confirmed(left, texts, 75, 5).collect()]
    groups = op.components(
        joined.select(joined.root.alias("row")).distinct(),
        spark.createDataFrame([(now[a], now[b]) for now in [dict(joined.collect())] for a, b in more], "a bigint, b bigint"),
    )
    end, at = dict(groups.collect()), dict(joined.collect())
    for a, b in combinations(range(len(rows)), 2):
        if similar(a, b):
            assert end[at[a]] == end[at[b]], (a, b, root[a], root[b])
