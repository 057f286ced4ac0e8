"""Corpus tables as Spark reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusledger.functions.text import checked_text
from corpusledger.runtime import pin_small

SOURCE_SCHEMA = "text string, source_config string"


def scan_dumps(spark: SparkSession, base: str, dumps: list[str] | None = None) -> DataFrame:
    """The text of a corpus laid out as ``base/source_config=<dump>/*.parquet``.

    Only ``text`` is read; naming dumps prunes partitions. File name (with the folders below the
    dump, if there are any) and row index, which give the source order, come from the reader and
    cost no column.
    """
    rows = spark.read.schema(SOURCE_SCHEMA).parquet(base)
    if dumps:
        rows = rows.where(F.col("source_config").isin(*dumps))
    return rows.select(
        "source_config",
        F.regexp_extract("_metadata.file_path", r"/source_config=[^/]*/(.*)$", 1).alias("file_name"),
        F.col("_metadata.row_index").alias("row_index"),
        checked_text(rows).alias("text"),
    )


def source_positions(rows: DataFrame) -> DataFrame:
    """Add ``position``: the row's place in its dump, files in name order, rows as stored.

    Per-file row counts are pre-aggregated and only their running sum is windowed, so rows are
    not shuffled. Valid before any filter only.
    """
    earlier = Window.partitionBy("source_config").orderBy("file_name").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = pin_small(
        rows.groupBy("source_config", "file_name")
        .agg((F.max("row_index") + 1).alias("file_rows"))
        .withColumn("file_base", F.coalesce(F.sum("file_rows").over(earlier), F.lit(0)))
        .select("source_config", "file_name", "file_base")
    )
    return (
        rows.join(bases, ["source_config", "file_name"])
        .withColumn("position", F.col("file_base") + F.col("row_index"))
        .drop("file_base")
    )


def numbered_documents(spark: SparkSession, base: str, dumps: list[str] | None = None) -> DataFrame:
    """(source_config, doc_id, text) of a corpus on disk; ``doc_id`` is the place in the dump.

    The ids a year is built from: dense, ascending in source order, the same on every rerun.
    """
    rows = source_positions(scan_dumps(spark, base, dumps))
    return rows.select("source_config", F.col("position").alias("doc_id"), "text")


def documents(
    spark: SparkSession, path: str, dump_column: str, columns: list[str] | None = None
) -> DataFrame:
    """A flat document table with ``dump_column`` playing the dump."""
    rows = spark.read.parquet(path)
    keep = ["doc_id", *(columns if columns is not None else ["text"])]
    return rows.select(F.col(dump_column).alias("source_config"), *keep)

