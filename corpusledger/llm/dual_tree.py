"""Ranked lexical search by a dual tree: the best documents of every item, exactly.

Items and documents are vectors over the items' terms: an item's coordinate is a term's weight times its
occurrences, a document's what the contract's formula makes of occurrences and length. Both are put into
trees whose nodes hold the largest value of each coordinate below them. The product of two nodes' maxima
is at least the score of every pair below, so a pair of nodes is left as soon as that bound is under the
weakest k-th score that the node's items have so far: whole batches of documents at once, without loss.

Spark's part: one pass over the texts gives each document's length and its occurrences of the items'
terms, a narrow staged table; the corpus' totals and each term's documents are sums over that. A second
pass searches the staged documents batch by batch where they lie, a tree to a batch. It starts from the
k-th scores that one in ``SEED_SHARE`` documents already gives (a score of k real documents can only be
too low as a bound), so tasks hand on few rows; every document is searched all the same. The k best of
each item are then ranked from the k best of each batch.

Items are taken in blocks of a bounded number of terms, each block with a pass of its own; only a block's
items and terms are on the driver and in a task. Nothing of the documents is.

Scores are whole numbers. Products run in doubles, where the items' weights keep every sum below 2**53
and so exact, and in 64-bit integers otherwise.

Defined cases: a null or empty text has no terms, is never found as a document and finds nothing as an
item; N and L are 0 for a table without terms, and the result is empty; rows with one doc_id are
documents of their own, rows with one item_id items of their own with ranks of their own; among equal
scores null ids come last; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusledger.llm.common import staged

K = 10
#: Item blocks: terms with repeats, and items, that a block holds on average.
BLOCK_TERMS, BLOCK_ITEMS = 1 << 14, 512
#: Numbers that a batch's matrix of documents and terms may have, and documents in a batch.
MOST_CELLS, MOST_ROWS = 1 << 22, 1024
DOC_LEAF, ITEM_LEAF = 8, 4
#: Leaves of documents scored between two looks at the bounds.
AT_ONCE = 8
SEED_SHARE = 64
SCALE = 1_000_000_000
#: Doubles hold every whole number up to this.
EXACT = 1 << 53
PIECE = 1 << 20
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_OTHER = re.compile(rb"[^0-9a-z\x80-\xff]")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a megabyte of it at a time: ASCII letters and digits and all beyond ASCII."""
    data = (text or "").encode().translate(_LOWER)
    at = 0
    while len(data) - at > PIECE and (gap := _OTHER.search(data, at + PIECE)):
        yield _TERM.findall(data[at:gap.start()])
        at = gap.start()
    yield _TERM.findall(data[at:] if at else data)


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, idx, tf): a document's number of terms and its occurrences of the vocabulary's.

    Documents without any term are left out: they count for nothing.
    """
    known = vocabulary.__contains__

    def counted(batches):
        for batch in batches:
            numbers, idx, tf, rows = [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                number, held = 0, Counter()
                for found in terms(text):
                    number += len(found)
                    held.update(filter(known, found))
                if number:
                    rows.append(row)
                    numbers.append(number)
                    idx.append([vocabulary[term] for term in held])
                    tf.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int64()),
                 pa.array(idx, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int64()))],
                names=["doc_id", "n", "idx", "tf"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n bigint, idx array<int>, tf array<bigint>"
    return staged(docs.select("doc_id", "text").mapInArrow(counted, schema), "vectors")


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, Counter]]]:
    """The items as (row number, terms) block by block; a row's block follows from its number's hash."""
    size = items.agg(
        F.count(F.lit(1)).alias("items"),
        F.sum(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("bigint")).alias("terms"),
    ).first()
    blocks = max(1, -(-(size["terms"] or 0) // BLOCK_TERMS), -(-size["items"] // BLOCK_ITEMS))
    block = F.pmod(F.xxhash64("__item"), F.lit(blocks))
    for number in range(blocks):
        rows = items.where(block == number).select("__item", "text").collect()
        found = [(row["__item"], Counter(term for part in terms(row["text"]) for term in part)) for row in rows]
        found = sorted((item for item in found if item[1]), key=lambda item: item[0])
        if found:
            yield found


# --- trees -----------------------------------------------------------------------------------


def _halved(matrix: np.ndarray, rows: np.ndarray, leaf: int) -> np.ndarray:
    """The rows in an order in which like ones are near.

    They are halved by which of two rows, far from each other, they are more like, and so on to leaves.
    """
    if len(rows) <= leaf:
        return rows
    own = matrix[rows].astype(np.float64)
    length = np.sqrt(np.einsum("ij,ij->i", own, own))
    length[length == 0] = 1
    one = np.argmin(own @ own[length.argmax()] / length)
    two = np.argmin(own @ own[one] / length)
    side = own @ (own[one] / length[one] - own[two] / length[two]) / length
    order = rows[np.argsort(side, kind="stable")]
    half = leaf * -(-len(rows) // (2 * leaf))
    return np.concatenate((_halved(matrix, order[:half], leaf), _halved(matrix, order[half:], leaf)))


@dataclass
class ItemNode:
    """Items from the places of ``items``; ``used`` are the terms they hold, ``most`` the maxima there."""

    items: np.ndarray
    used: np.ndarray
    most: np.ndarray
    weights: np.ndarray | None = None  # of a leaf: terms by items
    below: list[ItemNode] = field(default_factory=list)


def item_tree(weights: np.ndarray) -> ItemNode:
    """The tree over items (rows) by terms (columns)."""

    def node(items: np.ndarray) -> ItemNode:
        most = weights[items].max(axis=0)
        used = np.flatnonzero(most)
        if len(items) <= ITEM_LEAF:
            return ItemNode(items, used, most[used], np.ascontiguousarray(weights[items][:, used].T))
        half = ITEM_LEAF * -(-len(items) // (2 * ITEM_LEAF))
        return ItemNode(items, used, most[used], None, [node(items[:half]), node(items[half:])])

    return node(_halved(weights, np.arange(len(weights)), ITEM_LEAF))


def doc_tree(matrix: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of the documents, and the maxima of the nodes level by level, the root's first.

    Leaf i has the documents at places ``DOC_LEAF * i`` and on; node i of a level has nodes 2 i and
    2 i + 1 of the next.
    """
    order = _halved(matrix, np.arange(len(matrix)), DOC_LEAF)
    most = np.maximum.reduceat(matrix[order], np.arange(0, len(order), DOC_LEAF), axis=0)
    levels = [most]
    while len(most) > 1:
        most = np.maximum.reduceat(most, np.arange(0, len(most), 2), axis=0)
        levels.insert(0, most)
    return order, levels


class Search:
    """The items of a block against batches of documents; one per task.

    ``weakest`` has each item's k-th score so far, 1 where there are fewer than k.
    """

    def __init__(self, weights: np.ndarray, k: int, weakest: np.ndarray) -> None:
        self.root, self.k = item_tree(weights), k
        self.dtype, self.terms = weights.dtype, weights.shape[1]
        self.best = np.zeros((len(weights), k), np.int64)
        self.weakest = weakest.copy()
        self.pairs = self.scored = 0

    def rows(self) -> int:
        return min(MOST_ROWS, max(DOC_LEAF, MOST_CELLS // max(1, self.terms)))

    def batch(self, place: np.ndarray, row: np.ndarray, term: np.ndarray, value: np.ndarray):
        """(items, rows, scores) that may be among the best: at most k of each item.

        ``place`` orders the documents among equal scores; (row, term, value) are their coordinates.
        """
        matrix = np.zeros((len(place), self.terms), self.dtype)
        matrix[row, term] = value
        order, levels = doc_tree(matrix)
        self.matrix, self.order, self.levels, self.place = matrix, order, levels, place
        self.found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self._visit(self.root, 0, np.zeros(1, np.int64))
        items, rows, scores = [], [], []
        for item, parts in self.found.items():
            own = np.concatenate([part[0] for part in parts])
            score = np.concatenate([part[1] for part in parts])
            first = np.lexsort((place[own], -score))[:self.k]
            items.append(np.full(len(first), item))
            rows.append(own[first])
            scores.append(score[first])
        if not items:
            return (np.zeros(0, np.int64),) * 3
        return np.concatenate(items), np.concatenate(rows), np.concatenate(scores)

    def _bound(self, node: ItemNode, level: int, nodes: np.ndarray) -> np.ndarray:
        self.pairs += len(nodes)
        return self.levels[level][np.ix_(nodes, node.used)] @ node.most

    def _visit(self, node: ItemNode, level: int, nodes: np.ndarray) -> None:
        bound = self._bound(node, level, nodes)
        open_ = bound >= self.weakest[node.items].min()
        if not open_.any():
            return
        nodes, bound = nodes[open_], bound[open_]
        lowest = level == len(self.levels) - 1
        if lowest and not node.below:
            self._score(node, nodes, bound)
            return
        if not lowest:
            level += 1
            nodes = (2 * nodes[:, None] + np.arange(2)).ravel()
            nodes = nodes[nodes < len(self.levels[level])]
        for below in node.below or [node]:
            self._visit(below, level, nodes)

    def _score(self, node: ItemNode, leaves: np.ndarray, bound: np.ndarray) -> None:
        """Scores of a leaf's items with the documents of leaves, the most promising leaves first."""
        first = np.argsort(-bound, kind="stable")
        leaves, bound = leaves[first], bound[first]
        for at in range(0, len(leaves), AT_ONCE):
            if bound[at] < self.weakest[node.items].min():
                return  # nor any behind it
            places = (DOC_LEAF * leaves[at:at + AT_ONCE, None] + np.arange(DOC_LEAF)).ravel()
            rows = self.order[places[places < len(self.order)]]
            scores = (self.matrix[np.ix_(rows, node.used)] @ node.weights).astype(np.int64)
            self.scored += scores.size
            for column in np.flatnonzero((scores >= self.weakest[node.items]).any(axis=0)).tolist():
                self._note(node.items[column], rows, scores[:, column])

    def _note(self, item: int, rows: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.weakest[item]
        rows, scores = rows[good], scores[good]
        if len(rows) > self.k:
            first = np.lexsort((self.place[rows], -scores))[:self.k]
            rows, scores = rows[first], scores[first]
        self.found.setdefault(item, []).append((rows, scores))
        self.best[item] = np.sort(np.concatenate((self.best[item], scores)))[-self.k:]
        self.weakest[item] = max(self.weakest[item], self.best[item, 0])


# --- the search over all documents -------------------------------------------------------------


def _searched(vectors: DataFrame, weights: np.ndarray, k: int, weakest: np.ndarray) -> DataFrame:
    """(item, doc_id, score): the k best documents of each batch, if they reach ``weakest``."""

    def search(batches):
        task = Search(weights, k, weakest)
        for whole in batches:
            for at in range(0, len(whole), task.rows()):
                batch = whole.slice(at, task.rows())
                ids, idx, tf = batch.column(0), batch.column(2), batch.column(3)
                lengths = pc.list_value_length(idx).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(batch)), lengths)
                tf = tf.flatten().to_numpy(zero_copy_only=False)
                m = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), lengths)
                value = SCALE * tf // (1000 * tf + 8 * m)
                place = np.empty(len(batch), np.int64)
                place[pc.sort_indices(ids, sort_keys=[("", "ascending")]).to_numpy()] = np.arange(len(batch))
                items, rows, scores = task.batch(place, row, idx.flatten().to_numpy(zero_copy_only=False), value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, pa.int32()), ids.take(pa.array(rows, pa.int64())), pa.array(scores, pa.int64())],
                    names=["item", "doc_id", "score"],
                )

    kind = dict(vectors.dtypes)["doc_id"]
    return vectors.select("doc_id", "m", "idx", "tf").mapInArrow(search, f"item int, doc_id {kind}, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(docs: DataFrame, items: list[tuple[int, Counter]], k: int) -> DataFrame:
    """(__item, rank, doc_id, score) of the items of a block."""
    vocabulary = {term: i for i, term in enumerate(sorted(set().union(*(held for _, held in items))))}
    vectors = _vectors(docs, vocabulary)
    totals = vectors.agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    number, length = totals["N"], totals["L"] or 0
    df = np.zeros(len(vocabulary), np.int64)  # one row per term of the block
    for row in vectors.select(F.explode("idx").alias("term")).groupBy("term").count().collect():
        df[row["term"]] = row["count"]
    weight = [math.floor(1000 * math.log((2 * number + 2) / (2 * int(d) + 1))) for d in df]
    # A coordinate of a document is below a million.
    largest = max(sum(weight[vocabulary[t]] * c for t, c in held.items()) for _, held in items) * 1_000_000
    weights = np.zeros((len(items), len(vocabulary)), np.float64 if largest < EXACT else np.int64)
    for i, (_, held) in enumerate(items):
        for term, count in held.items():
            weights[i, vocabulary[term]] = weight[vocabulary[term]] * count
    # n times N can pass 64 bits on very large tables.
    product = F.lit(75).cast("decimal(2,0)") * F.col("n").cast("decimal(17,0)") * F.lit(number).cast("decimal(17,0)")
    sized = vectors.withColumn("__product", product).withColumn("__length", F.lit(max(1, length)).cast("decimal(19,0)"))
    sized = sized.withColumn("m", F.lit(25) + F.expr("__product div __length"))
    weakest = np.ones(len(items), np.int64)
    some = sized.where(F.pmod(F.xxhash64("n", "idx", "tf"), F.lit(SEED_SHARE)) == 0)
    seeds = _ranked(_searched(some, weights, k, weakest), k).where(F.col("rank") == k)
    for row in seeds.select("item", "score").collect():  # one row per item of the block
        weakest[row["item"]] = row["score"]
    found = staged(_searched(sized, weights, k, weakest), "found")
    numbers = docs.sparkSession.createDataFrame([(i, row) for i, (row, _) in enumerate(items)], "item int, __item bigint")
    return _ranked(found, k).join(F.broadcast(numbers), "item").select("__item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` its ``k`` best rows of ``docs``."""
    named = staged(items.select("item_id", "text").withColumn("__item", F.monotonically_increasing_id()), "items")
    ids = named.select("__item", "item_id")
    blocks = [staged(_block(docs, block, k), "block") for block in _blocks(named)]
    kind = dict(docs.dtypes)["doc_id"]
    found = docs.sparkSession.createDataFrame([], f"__item bigint, rank int, doc_id {kind}, score bigint")
    for block in blocks:
        found = found.unionByName(block)
    return found.join(ids, "__item").select("item_id", "rank", "doc_id", "score")
