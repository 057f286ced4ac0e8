"""Mixing sources to target weights by hash thresholds, without sorting.

Every source gets a target in words. It is taken whole as often as the target holds it, and the
rest of the target is met by the documents whose hash lies below the source's threshold. The
threshold is found on histograms: words summed by source and leading hash bits, the bucket in which
the running sum passes the target, then the same inside that bucket only, with the next bits, until
every source's bucket is one hash. Thresholds are nested: a larger target takes the same documents
and more.

A document is taken if the sum before it and the sum with it together stay below twice the rest,
that is if taking it brings the sum nearer; documents with one hash (one doc_id, or one text without a
doc_id) go together.

Defined cases: a null text has size 0; a null source is a source, last in order; a null doc_id is
hashed by its text; sources whose documents are all empty have the target 0; repeated rows
are taken alike; an empty table gives an empty table. Only the named columns are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusledger.llm.common import staged, words_of

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
#: Bits of the hash, and bits per histogram.
BITS = 60
LEVEL_BITS = 12


def hash_of(identity: str, text: str) -> Column:
    """The first 60 bits of the MD5 of the identity, or of the text after a ``t`` where that is null."""
    named = F.coalesce(F.col(identity).cast("string"), F.concat(F.lit("t"), F.coalesce(F.col(text), F.lit(""))))
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, BITS // 4), 16, 10).cast("bigint")


def sized(docs: DataFrame, identity: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(identity, source, size, hash): size in words."""
    return docs.select(
        F.col(identity), F.col(source).alias("source"),
        F.size(words_of(F.col(text))).cast("bigint").alias("size"),
        hash_of(identity, text).alias("hash"),
    )


def targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source.

    Weights repeat over the sources in order. All sizes together are shared out by weight; a source
    stops at ``most`` times its size and what it cannot take is shared by the others. That ends
    where every source has min(its limit, weight x rate) for one rate: with sources ordered by
    limit / weight, the first ones are at their limits. The window holds one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    listed = sources.select("source", "source_size", weight.cast("bigint").alias("weight"))
    ratio = F.col("source_size").cast("double") / F.col("weight")
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    below = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    full = listed.withColumn("ratio", ratio).select(
        "*",
        F.row_number().over(by_ratio).alias("place"),
        F.sum("source_size").over(Window.partitionBy()).alias("all"),
        F.coalesce(F.sum("source_size").over(below), F.lit(0)).alias("below"),
        F.sum("weight").over(onward).alias("onward"),
    )
    # What is left if all sources before this one are at their limits, per unit of weight.
    left = F.col("all") - most * F.col("below")
    limit = (most * F.col("source_size")).cast("double")
    limited = limit * F.col("onward") <= left.cast("double") * F.col("weight")
    first = full.withColumn("limited", limited).select(
        "*",
        F.min(F.when(~F.col("limited"), F.struct("place", left.alias("left"), "onward")))
        .over(Window.partitionBy()).alias("first"),
    )
    shared = F.col("first.left").cast("double") * F.col("weight") / F.col("first.onward")
    return first.select(
        "source", "source_size",
        F.when(F.col("limited"), limit).otherwise(shared).alias("target"),
    )


def plan(sources: DataFrame) -> DataFrame:
    """(source, source_size, target, repeats, rest): whole takes, and words still wanted."""
    times = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0).cast("bigint")
    return targets(sources).withColumn("repeats", times).withColumn(
        "rest", F.col("target") - F.col("repeats") * F.col("source_size")
    )


def thresholds(records: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, threshold): documents of the source with a smaller hash are taken once more.

    One histogram per level; below the first, only over rows in their source's open bucket.
    """
    null = "\x00"  # no Parquet path or join sees it outside this function
    name = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(null)).alias("name")
    rows = records.where("size > 0").select(name, "hash", "size")
    # ``base`` is the sum of all smaller hashes than the open bucket's, ``bucket`` its leading bits.
    state = wanted.select(name, "rest", F.lit(0).cast("bigint").alias("base"), F.lit(0).cast("bigint").alias("bucket"))
    for shift in range(BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        inside = F.shiftright("hash", shift + LEVEL_BITS) == F.col("bucket")
        held = rows.join(state.where("rest > 0"), "name").where(inside)
        counted = held.groupBy("name", F.shiftright("hash", shift).alias("part")).agg(
            F.sum("size").alias("words"), F.max("rest").alias("rest"), F.max("base").alias("base")
        )
        upto = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        ranked = counted.withColumn("excl", F.col("base") + F.coalesce(F.sum("words").over(upto), F.lit(0)))
        # The last part that begins below the target: all before it are taken, all after it not.
        chosen = ranked.where(F.col("excl") < F.col("rest")).groupBy("name").agg(
            F.max(F.struct("part", "excl", "words")).alias("at")
        )
        state = staged(
            state.drop("base", "bucket", "words").join(chosen, "name").select(
                "name", "rest", F.col("at.excl").alias("base"), F.col("at.part").alias("bucket"),
                F.col("at.words").alias("words"),
            ),
            "buckets",
        )
    # The last level's part is one hash: in or out, whichever leaves the sum nearer.
    nearer = F.col("base") + (F.col("base") + F.col("words")) < 2 * F.col("rest")
    found = state.select("name", (F.col("bucket") + nearer.cast("bigint")).alias("threshold"))
    plain = F.when(F.col("name") != null, F.expr("substring(name, 2)")).alias("source")
    return found.select(plain, "threshold")


def rates(records: DataFrame) -> DataFrame:
    """(__source, source_size, target, repeats, threshold): one row per source of ``sized`` rows."""
    wanted = staged(plan(records.groupBy("source").agg(F.sum("size").alias("source_size"))), "plan")
    found = thresholds(records, wanted).withColumnRenamed("source", "__source")
    full = wanted.join(found, F.col("source").eqNullSafe(F.col("__source")), "left").select(
        F.col("source").alias("__source"), "source_size", "target", "repeats",
        F.coalesce("threshold", F.lit(0)).alias("threshold"),
    )
    return staged(full, "rates")


def mix(docs: DataFrame, identity: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(identity, source, size, source_size, target, repeats, taken), one row per row of ``docs``."""
    records = staged(sized(docs, identity, text, source), "sizes")
    out = records.join(rates(records), F.col("source").eqNullSafe(F.col("__source")))
    repeats = F.col("repeats") + (F.col("hash") < F.col("threshold")).cast("bigint")
    return out.select(
        identity, "source", "size", "source_size", "target", repeats.alias("repeats")
    ).withColumn("taken", F.col("size") * F.col("repeats"))


def decided(docs: DataFrame, identity: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with ``__repeats``, how often the mix takes the row; the texts are not shuffled."""
    found = rates(staged(sized(docs, identity, text, source), "sizes")).select(
        "__source", F.col("repeats").alias("__whole"), F.col("threshold").alias("__threshold")
    )
    out = docs.join(found, F.col(source).eqNullSafe(F.col("__source")))
    once_more = (hash_of(identity, text) < F.col("__threshold")).cast("bigint")
    return out.withColumn("__repeats", F.col("__whole") + once_more).drop(
        "__source", "__whole", "__threshold"
    )
