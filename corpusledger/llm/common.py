"""What the operators share: words, staged tables, quantiles from histograms."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusledger.runtime import session_settings
from corpusledger.runtime import stage as _stage

#: Words are runs of anything but these white-space characters (the ones ``bytes.split`` splits at).
SPACE = r"[\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows per Arrow batch: texts may be long, and a pair carries two.
BATCH_ROWS = 256
#: Bytes of a row group, in memory, of staged texts.
GROUP_BYTES = 8 << 20


def words_of(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    plain = F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, SPACE, -1))


@contextlib.contextmanager
def settings(spark: SparkSession, changed: dict[str, str]):
    """Session settings that hold within this only."""
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Its shuffle files are dropped when it is written, and Python sees few rows at a time.
    """
    with settings(df.sparkSession, {CLEANUP: "true", BATCH: str(BATCH_ROWS)}):
        return _stage(df, name)


def staged_texts(df: DataFrame, name: str) -> DataFrame:
    """``staged`` with row groups of a few megabytes: a large file is read by as many tasks as it has."""
    with session_settings(df.sparkSession, {"parquet.block.size": str(GROUP_BYTES)}):
        return staged(df, name)


def quantiles(df: DataFrame, key: str, value: str, step: float, shares: dict[str, float]):
    """Per key, the named quantiles of ``value`` in units of ``step``: exact on the rounded values.

    Values are counted per key and bin first, so no group of rows meets in one task; the window
    then sees one row per bin. A quantile is the smallest bin at which at least that share of the
    key's rows has been seen. Null values are left out; a key without values has no row.
    """
    bins = (
        df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(F.col(key).alias(key), F.round(F.col(value) / F.lit(step)).cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    each = Window.partitionBy(key)
    upto = each.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = bins.select(
        key, "bin", F.sum("rows").over(upto).alias("seen"), F.sum("rows").over(each).alias("all")
    )
    return ranked.groupBy(key).agg(
        F.max("all").alias("values"),
        *(
            (F.min(F.when(F.col("seen") >= F.lit(share) * F.col("all"), F.col("bin"))) * F.lit(step))
            .alias(name)
            for name, share in shares.items()
        ),
    )
