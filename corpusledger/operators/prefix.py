"""Ordered prefixes and dense positions without putting a whole dump into one task.

Every operator here works in two levels. Rows carry a *bucket* that is monotone in their order
(leading digits of a random key, or high bits of an id). Totals per bucket are pre-aggregated
where the rows are; running sums go over those totals; and only rows of a single bucket ever
meet in one window. A dump that holds a third of the corpus just has more rows per bucket, or
more buckets, never a bigger window group than its bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusledger.functions.text import int_div
from corpusledger.runtime import pin_small


def bucket_bases(rows: DataFrame, *, group: str, bucket: str, weight: Column) -> DataFrame:
    """Per (group, bucket): its total weight and the total of all earlier buckets."""
    upto = Window.partitionBy(group).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        rows.groupBy(group, bucket)
        .agg(F.sum(weight).cast("bigint").alias("inside"))
        .withColumn("upto", F.sum("inside").over(upto))
        .withColumn("base", F.col("upto") - F.col("inside"))
    )


def find_cuts(
    rows: DataFrame,
    quotas: DataFrame,
    *,
    group: str,
    bucket: str,
    order: list[str],
    weight: Column,
    quota: str = "quota",
) -> DataFrame:
    """Where each group's prefix ends: ``(group, quota, cut)``.

    A row belongs to the prefix while the weights *before* it add up to less than the quota, so
    the row that crosses the quota is the last one kept. ``cut`` holds that row's order columns;
    it is null when the group never reaches its quota. ``rows`` is scanned twice and should be
    cheap to scan: stage it when the weight is computed by a token counter.
    """
    totals = bucket_bases(rows, group=group, bucket=bucket, weight=weight)
    crossing = pin_small(
        totals.join(quotas.select(group, quota), group)
        .where((F.col("base") < F.col(quota)) & (F.col(quota) <= F.col("upto")))
        .select(group, bucket, (F.col(quota) - F.col("base")).alias("need"))
    )
    upto = Window.partitionBy(group).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    cuts = (
        rows.select(group, bucket, *order, weight.alias("weight"))
        .join(crossing, [group, bucket])
        .withColumn("upto", F.sum("weight").over(upto))
        .where(F.col("upto") >= F.col("need"))
        .groupBy(group)
        .agg(F.min(F.struct(*order)).alias("cut"))
    )
    return pin_small(quotas.select(group, quota).join(cuts, group, "left"))


def keep_prefix(
    rows: DataFrame, cuts: DataFrame, *, group: str, order: list[str], quota: str = "quota"
) -> DataFrame:
    """Rows up to and including each group's cut; a map-side filter, no shuffle."""
    position = F.struct(*order)
    kept = (F.col(quota) > 0) & (F.col("cut").isNull() | (position <= F.col("cut")))
    return rows.join(cuts, group).where(kept).drop(quota, "cut")


def dense_index(
    rows: DataFrame, *, group: str, bucket: str, order: list[str], output: str = "position"
) -> DataFrame:
    """Add the zero-based position of each row within its group.

    The bucket join and the in-bucket window share one exchange on (group, bucket).
    """
    bases = bucket_bases(rows, group=group, bucket=bucket, weight=F.lit(1)).select(
        group, bucket, "base"
    )
    inside = Window.partitionBy(group, bucket).orderBy(*order)
    return (
        rows.join(bases, [group, bucket])
        .withColumn(output, F.col("base") + F.row_number().over(inside) - 1)
        .drop("base")
    )


def shard_bounds(
    rows: DataFrame, *, group: str, bucket: str, order: list[str], rows_per_shard: int
) -> DataFrame:
    """Per (group, bucket): the shard its first row falls in and where later shards start.

    With this table a row finds its shard from its own order columns, so text is shuffled only
    once, to its shard. A bucket's list is at most its rows divided by the shard size.
    """
    indexed = dense_index(rows, group=group, bucket=bucket, order=order)
    shard = int_div("position", rows_per_shard).cast("int")
    starts = F.when(F.col("position") % rows_per_shard == 0, F.struct(*order))
    bounds = indexed.groupBy(group, bucket).agg(
        F.min(shard).alias("first_shard"),
        # The first row of the bucket is no later start even if it opens a shard.
        F.min(F.struct(*order)).alias("_first"),
        F.array_sort(F.collect_list(starts)).alias("_starts"),
    )
    later = F.filter("_starts", lambda start: start > F.col("_first"))
    return pin_small(bounds.select(group, bucket, "first_shard", later.alias("starts")))


def assign_shards(
    rows: DataFrame, bounds: DataFrame, *, group: str, bucket: str, order: list[str]
) -> DataFrame:
    """Add ``shard``; rows whose bucket has no bound were not selected and must be filtered first."""
    position = F.struct(*order)
    passed = F.size(F.filter("starts", lambda start: start <= position))
    return (
        rows.join(bounds, [group, bucket])
        .withColumn("shard", F.col("first_shard") + passed)
        .drop("first_shard", "starts")
    )
