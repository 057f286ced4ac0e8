"""Run reports as a nested table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: One entry per dump inside a report.
ENTRY = (
    "struct<source_config: string, rows: bigint, token_count: bigint, shards: bigint, "
    "token_quota: bigint, quota_reached: boolean, source_exhausted: boolean>"
)
#: The settings a run was given stay one JSON string: comparing runs needs equality, not fields.
REPORT_SCHEMA = (
    "mode string, year int, rows bigint, token_count bigint, "
    f"source_configs array<{ENTRY}>, partial boolean, dumps_processed array<string>, "
    "dumps_in_config array<string>, processing_config string, "
    "counting struct<implementation: string, batch_size: int>"
)


def scan_reports(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Reports matched by a glob, one row each, with the file they came from.

    Spark refuses a path that matches nothing, and so does this.
    """
    rows = spark.read.schema(REPORT_SCHEMA).option("multiLine", True).json(paths)
    return rows.select("*", F.col("_metadata.file_path").alias("source_file"))


def report_entries(reports: DataFrame) -> DataFrame:
    """One row per dump entry of every report."""
    return reports.select("source_file", F.explode("source_configs").alias("entry")).select(
        "source_file", "entry.*"
    )
