"""Benchmark decontamination by SimHash over item-sized windows of the documents.

Built from DataFrame functions only. Words are those of ``common.words_of`` with A-Z in lower case.

1. Shingles of five words of all documents are hashed once. Where one is also an item's, a window as
   long as the item is laid so that the two shingles coincide (cut off at the document's ends). A
   window without any shared shingle has the similarity 0, so none that matters is left out.
2. Windows and items get a 64-bit SimHash in which every shingle votes as often as it occurs.
3. Multi-index: fingerprints are cut into eight blocks of eight bits. Two that differ in at most
   ``RADIUS`` = 23 bits differ in at most two bits of some block, so each item is listed under all
   values within two bits of each of its blocks, and a window looks up its eight blocks: every
   fingerprint of an item of its length within the radius is found.
4. Found pairs are confirmed by the exact similarity of their weighted shingles, the weights being
   how often each occurs: sum of smaller weights by sum of larger ones, at least 0.75.

Only the items' shingles are sent to all tasks, if they are at most ``MAX_SENT`` rows; beyond that
the same join shuffles.

Defined cases: null or empty texts and items have no shingles and match nothing; an item of fewer
than five words is one shingle of all its words; repeated rows are reported once; a null doc_id is
reported as null; rows with a null item_id are no items; empty tables give an empty result. Only the
named columns are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusledger.llm.common import staged, words_of

WORDS = 5
SIMILARITY = 0.75
BITS = 64
BLOCK_BITS = 8
RADIUS = 23
MAX_SENT = 500_000


def shingles(words: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order.

    The words are bound to a variable, so that they are split once whatever the optimizer does.
    """
    def hashed(own: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(own) - size)
        runs = F.transform(at, lambda i: F.xxhash64(*(F.get(own, i + j) for j in range(size))))
        return F.when(F.size(own) >= size, runs).otherwise(F.array().cast("array<bigint>"))

    return F.get(F.transform(F.array(words), hashed), F.lit(0))


def simhash(hashes: Column) -> Column:
    """Bit b is set where more than half of the hashes have it."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def voted(b: Column) -> Column:
        has = lambda total, h: total + F.call_function("shiftright", h, b).bitwiseAND(one)
        return F.when(
            2 * F.aggregate(hashes, none, has) > F.size(hashes), F.call_function("shiftleft", one, b)
        ).otherwise(none)

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(BITS - 1)), none, lambda bits, b: bits.bitwiseOR(voted(b))
    )


def occurrences(hashes: Column) -> Column:
    """Each hash together with the number of its earlier occurrences, so that sets hold weights."""
    return F.transform(
        hashes,
        lambda h, i: F.xxhash64(h, F.size(F.filter(F.slice(hashes, F.lit(1), i), lambda g: g == h))),
    )


def _block(fingerprint: Column, i: int) -> Column:
    return F.shiftrightunsigned(fingerprint, i * BLOCK_BITS).bitwiseAND(F.lit(255).cast("bigint"))


def _near_values(reach: int) -> list[int]:
    """Masks of at most ``reach`` bits of a block."""
    return [mask for mask in range(1 << BLOCK_BITS) if mask.bit_count() <= reach]


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, length, step, hashes, fingerprint): ``step`` words to a shingle."""
    words = benchmark.where(F.col("item_id").isNotNull()).select(
        "item_id", F.transform(words_of(F.col("text")), _lower).alias("words")
    ).where(F.size("words") > 0).distinct()
    step = F.least(F.size("words"), F.lit(WORDS))
    by_step = F.coalesce(
        *(F.when(step == k, shingles(F.col("words"), k)) for k in range(1, WORDS + 1))
    )
    listed = words.select("item_id", F.size("words").alias("length"), step.alias("step"), by_step.alias("hashes"))
    return staged(listed, "hashed").withColumn("fingerprint", simhash(F.col("hashes")))


def _lower(word: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(word, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, start, length, hashes): windows that share a shingle with an item of their length."""
    anchors = staged(
        items.select("length", "step", F.posexplode("hashes").alias("offset", "hash"))
        .select("length", "step", "offset", "hash").distinct(),
        "anchors",
    )
    steps = [row[0] for row in anchors.select("step").distinct().collect()]
    few = anchors.count() <= MAX_SENT
    lowered = _lower(F.coalesce(F.col("text"), F.lit("")))
    words = docs.select("doc_id", words_of(lowered).alias("words"))
    found = []
    for step in sorted(steps):
        own = anchors.where(F.col("step") == step).drop("step")
        hashed = words.select("doc_id", shingles(F.col("words"), step).alias("all"))
        # The outer form keeps the optimizer from hashing once more for a filter on empty arrays.
        listed = hashed.select("doc_id", "all", F.posexplode_outer("all").alias("place", "hash"))
        laid = listed.join(F.broadcast(own) if few else own, "hash")
        begin = F.col("place") - F.col("offset")
        first = F.greatest(begin, F.lit(0))
        last = F.least(begin + F.col("length") - step, F.size("all") - 1)
        found.append(
            laid.select(
                "doc_id", first.alias("start"), "length", F.lit(step).alias("step"),
                F.slice("all", first + 1, last - first + 1).alias("hashes"),
            )
        )
    if not found:
        return docs.sparkSession.createDataFrame(
            [], "doc_id bigint, start int, length int, step int, hashes array<bigint>"
        )
    return reduce(DataFrame.unionByName, found).dropDuplicates(
        ["doc_id", "start", "length", "step", "hashes"]
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                 radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, start, words, distance, similarity): the best window of each pair."""
    items = staged(items_of(benchmark), "items")
    laid = windows(docs, items).withColumn("fingerprint", simhash(F.col("hashes")))
    laid = staged(laid, "windows")
    blocks, reach = BITS // BLOCK_BITS, radius // (BITS // BLOCK_BITS)
    masks = F.array(*(F.lit(mask).cast("bigint") for mask in _near_values(reach)))
    index = items.select(
        "item_id", "length", "fingerprint", "hashes",
        F.posexplode(F.array(*(_block(F.col("fingerprint"), i) for i in range(blocks)))).alias("block", "value"),
    ).select(
        "item_id", "length", "block", F.col("fingerprint").alias("item_print"),
        F.explode(F.transform(masks, lambda mask: mask.bitwiseXOR(F.col("value")))).alias("value"),
    )
    asked = laid.select(
        "doc_id", "start", "length", "fingerprint", "hashes",
        F.posexplode(F.array(*(_block(F.col("fingerprint"), i) for i in range(blocks)))).alias("block", "value"),
    )
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print")))
    near = (
        asked.join(index, ["length", "block", "value"])
        .withColumn("distance", distance)
        .where(F.col("distance") <= radius)
        .select("doc_id", "start", "length", "hashes", "item_id", "distance")
        .distinct()
    )
    full = near.join(items.select("item_id", F.col("hashes").alias("item_hashes"), F.col("length").alias("item_length")), "item_id")
    shared = F.size(F.array_intersect(occurrences(F.col("hashes")), occurrences(F.col("item_hashes"))))
    either = F.size("hashes") + F.size("item_hashes") - shared
    exact = full.where(F.col("length") == F.col("item_length")).withColumn("similarity", shared / either)
    best = exact.where(F.col("similarity") >= similarity).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("similarity", -F.col("start"), "length", -F.col("distance"))).alias("w")
    )
    return best.select(
        "doc_id", "item_id", (-F.col("w")["col2"]).cast("bigint").alias("start"),
        F.col("w.length").cast("bigint").alias("words"), (-F.col("w")["col4"]).cast("bigint").alias("distance"),
        F.col("w.similarity").alias("similarity"),
    )
