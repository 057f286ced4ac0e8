"""Exact proportional split of an integer total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def allocate(
    weights: DataFrame, total: int | Column, *, key: str, weight: str, output: str
) -> DataFrame:
    """Add ``output``: this key's share of ``total``, proportional to ``weight``.

    Part i is ``floor(T * cum_i / W) - floor(T * cum_(i-1) / W)`` over keys in sorted order, so
    the parts add up to the total and do not depend on row order. ``weights`` has one row per
    dump, hence the unpartitioned window. The product needs more than 64 bits (1e11 tokens times
    1.7e8 rows), so it is taken in DECIMAL(38).
    """
    if isinstance(total, int):
        if total < 0:
            raise ValueError("The total to split must not be negative")
        total = F.lit(total).cast("bigint")

    everything = Window.partitionBy()
    upto = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lowest, whole = F.min(weight).over(everything), F.sum(weight).over(everything)
    checked = (
        F.when(total < 0, F.raise_error(F.lit("The total to split must not be negative")))
        .when(lowest < 0, F.raise_error(F.lit("A weight must not be negative")))
        .when(whole <= 0, F.raise_error(F.lit("The weights must add up to more than zero")))
        .otherwise(F.sum(weight).over(upto))
    )
    split = weights.withColumns(
        {
            "_total": total.cast("decimal(18,0)"),
            "_whole": whole.cast("decimal(19,0)"),
            "_upto": checked.cast("decimal(19,0)"),
            "_before": F.sum(weight).over(upto).cast("decimal(19,0)")
            - F.col(weight).cast("decimal(18,0)"),
        }
    )
    share = F.expr("(_total * _upto) div _whole - (_total * cast(_before as decimal(19,0))) div _whole")
    return split.withColumn(output, share.cast("bigint")).drop("_total", "_whole", "_upto", "_before")


def keep_fraction(
    years: DataFrame, target_tokens: int | Column, *, projected: str, rows: str
) -> DataFrame:
    """Add the fraction of a year's rows that meets the target, and how many rows that is."""
    target = F.lit(target_tokens) if isinstance(target_tokens, int) else target_tokens
    fraction = F.least(
        F.lit(1.0),
        F.coalesce(
            target.cast("double") / F.nullif(F.col(projected).cast("double"), F.lit(0.0)),
            F.lit(1.0),
        ),
    )
    return years.withColumn("keep_fraction", fraction).withColumn(
        "rows_to_keep", F.col(rows) * F.col("keep_fraction")
    )
