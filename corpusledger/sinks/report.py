"""The run report: per-dump entries, totals and the settings they came from."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENTRY_FIELDS = (
    "source_config", "rows", "token_count", "shards", "token_quota", "quota_reached",
    "source_exhausted",
)


def run_report(
    entries: DataFrame, settings: dict, dumps_in_config: list[str], *, mode: str, counter: str,
    batch_size: int, by: str | None = None,
) -> DataFrame:
    """One report row (or one per value of ``by``) from one entry per dump.

    The settings travel verbatim as canonical JSON, so reports of one config compare equal.
    """
    expected = F.array(*(F.lit(name) for name in sorted(dumps_in_config)))
    entry = F.struct(*ENTRY_FIELDS)
    report = entries.groupBy(*([by] if by else [])).agg(
        F.sum("rows").cast("bigint").alias("rows"),
        F.sum("token_count").cast("bigint").alias("token_count"),
        F.array_sort(F.collect_list(entry)).alias("source_configs"),
        F.array_sort(F.collect_list("source_config")).alias("dumps_processed"),
    )
    return report.select(
        *([by] if by else []),
        F.lit(mode).alias("mode"),
        F.lit(int(settings["year"])).alias("year"),
        "rows",
        "token_count",
        "source_configs",
        (F.size("dumps_processed") < F.size(expected)).alias("partial"),
        "dumps_processed",
        expected.alias("dumps_in_config"),
        F.lit(json.dumps(settings, sort_keys=True)).alias("processing_config"),
        F.struct(
            F.lit(counter).alias("implementation"), F.lit(batch_size).alias("batch_size")
        ).alias("counting"),
    )


def write_report(report: DataFrame, path: str, by: str | None = None) -> None:
    """Reports as JSON, one file per report; a report is a config's worth of data."""
    writer = report.repartition(1).write.mode("overwrite").option("ignoreNullFields", False)
    (writer.partitionBy(by) if by else writer).json(path)
