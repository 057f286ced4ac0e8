"""Which documents a plan keeps: source-order prefixes, seeded prefixes and token budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusledger.functions.keys import DEFAULT_BITS, ID_BUCKET_BITS, id_bucket, key_bucket, shuffle_key
from corpusledger.functions.text import ceil_div
from corpusledger.operators.prefix import dense_index, find_cuts, keep_prefix

DUMP = "source_config"


def seeded(docs: DataFrame, seed: int, bits: int | Column = DEFAULT_BITS) -> DataFrame:
    """Add the order of a seeded shuffle: ``key``, and ``bucket`` for the prefix operators.

    A full uniform permutation per dump. Resuming replays it because it depends on the seed and
    the document alone.
    """
    keyed = docs.withColumn("key", shuffle_key(seed, DUMP, "doc_id"))
    return keyed.withColumn("bucket", key_bucket("key", bits))


def in_source_order(docs: DataFrame, bits: int | Column = ID_BUCKET_BITS) -> DataFrame:
    """Add ``bucket`` for prefixes in source order, which ``doc_id`` gives."""
    return docs.withColumn("bucket", id_bucket("doc_id", bits))


SEEDED_ORDER = ["key", "doc_id"]
SOURCE_ORDER = ["doc_id"]


def seeded_shuffle(docs: DataFrame, seed: int, bits: int | Column = DEFAULT_BITS) -> DataFrame:
    """Every document's position in its dump's shuffled order."""
    return dense_index(
        seeded(docs, seed, bits), group=DUMP, bucket="bucket", order=SEEDED_ORDER
    )


def leading_rows(
    narrow: DataFrame, targets: DataFrame, order: list[str], quota: str = "row_target"
) -> DataFrame:
    """The first ``row_target`` rows of each dump in the given order (surplus is cut)."""
    cuts = find_cuts(
        narrow, targets, group=DUMP, bucket="bucket", order=order, weight=F.lit(1), quota=quota
    )
    return keep_prefix(narrow, cuts, group=DUMP, order=order, quota=quota)


def first_rows(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """First N rows per dump in source order: what ``retain_all`` and plain samples keep."""
    return leading_rows(in_source_order(docs), targets, SOURCE_ORDER)


def proportional_sample(docs: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """Leading rows of the seeded shuffle: a prefix of what a budget run would keep."""
    return leading_rows(seeded(docs, seed), targets, SEEDED_ORDER)


def shortfalls(dumps: DataFrame, targets: DataFrame) -> DataFrame:
    """Dumps that hold fewer rows than their plan promises; a run must stop on any."""
    held = F.coalesce(F.col("available_rows"), F.lit(0))
    return (
        targets.select(DUMP, "row_target")
        .join(dumps.select(DUMP, "available_rows"), DUMP, "left")
        .where(held < F.col("row_target"))
        .select(DUMP, F.col("row_target"), held.alias("available_rows"))
    )


def token_budget(counted: DataFrame, plans: DataFrame, tokens: str = "token_count") -> DataFrame:
    """Documents of each dump, in seeded order, until its token quota is met.

    The document that crosses the quota is kept, the next one is not, even if it is empty; a
    quota of zero keeps nothing; a dump that never reaches its quota is kept whole. ``counted``
    carries ``key`` and ``bucket`` and should be staged, so that tokens are counted once.
    """
    cuts = budget_cuts(counted, plans, tokens)
    return keep_prefix(counted, cuts, group=DUMP, order=SEEDED_ORDER, quota="token_quota")


def budget_cuts(counted: DataFrame, plans: DataFrame, tokens: str = "token_count") -> DataFrame:
    return find_cuts(
        counted, plans, group=DUMP, bucket="bucket", order=SEEDED_ORDER,
        weight=F.col(tokens).cast("bigint"), quota="token_quota",
    )


def selection_totals(selected: DataFrame, tokens: str = "token_count") -> DataFrame:
    """Rows and tokens kept per dump."""
    return selected.groupBy(DUMP).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(tokens).cast("bigint").alias("tokens")
    )


def quota_outcome(totals: DataFrame, plans: DataFrame, rows_per_shard: int) -> DataFrame:
    """Per dump: what was kept, whether the quota was met or the source ran out first.

    Exhaustion follows from the data: every available row was kept and the quota is still open.
    A dump with neither outcome is an error of the run and fails the query. Row-target plans have
    no quota and report neither outcome. Totals that carry ``shards``, as those of a manifest do, are
    reported with them; otherwise shards follow from the rows.
    """
    rows = F.coalesce(F.col("rows"), F.lit(0))
    kept = F.coalesce(F.col("tokens"), F.lit(0))
    quota = F.col("token_quota")
    reached = quota.isNotNull() & (kept >= quota)
    exhausted = quota.isNotNull() & (kept < quota) & (rows >= F.col("available_rows"))
    shards = ceil_div(rows, rows_per_shard)
    if "shards" in totals.columns:
        shards = F.coalesce("shards", F.lit(0).cast("bigint"))
    message = F.concat(F.lit("quota neither met nor source exhausted: "), F.col(DUMP))
    return plans.join(totals, DUMP, "left").select(
        DUMP,
        "available_rows",
        "token_quota",
        rows.alias("rows"),
        kept.alias("token_count"),
        shards.alias("shards"),
        (kept - quota).alias("overshoot"),
        reached.alias("quota_reached"),
        F.when(quota.isNull() | reached | exhausted, exhausted)
        .otherwise(F.raise_error(message).cast("boolean"))
        .alias("source_exhausted"),
    )
