"""Hold a written year against its report, its contract and its settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusledger.operators import verify
from corpusledger.plans.build import config_dumps
from corpusledger.plans.config import RunConfig
from corpusledger.runtime import stage, stage_parts
from corpusledger.sinks.shards import output_files, output_groups, read_output

PROBLEMS = "source_config string, shard int, rule string, measured bigint, limit bigint"


def year_problems(
    spark: SparkSession, root: str, report: DataFrame, config: RunConfig,
    available: DataFrame | None = None, check_text: bool = True,
) -> DataFrame:
    """``(source_config, shard, rule, measured, limit)``: all that is wrong with the year under ``root``.

    Totals are derived from the shards again and compared with the report per dump and as a whole;
    dumps and shards that only one side has, empty shards, broken rows and a missed budget are
    problems. ``available`` has the rows each dump holds; the settings' numbers are taken without it.
    An unknown selection rule is an error, not a kind of budget. ``report`` is one row.
    """
    verify.known_rule(config.rule)
    listed = stage(output_files(spark, root), "listed")
    totals = written_totals(spark, root, listed, config.year, check_text)
    shards = stage(verify.with_empty_shards(totals, listed), "shards")  # each check reads it again
    measured = verify.per_dump_rollup(shards)
    entries = report.select(F.explode("source_configs").alias("entry")).select("entry.*")
    known = config_dumps(spark, config) if available is None else available
    found = [
        verify.integrity_problems(shards, config.year).select(
            "source_config", "shard", "rule", F.col("rows").alias("measured"), F.lit(None).alias("limit")
        ),
        verify.report_problems(entries, measured, known, config.rule),
        verify.total_problems(report, measured),
    ]
    whole = report.select(~F.col("partial") & (F.col("mode") == "full")).first()
    if whole and whole[0]:
        dumps = known.join(measured, "source_config", "left").select(
            "source_config", "available_rows", F.coalesce("rows", F.lit(0)).alias("rows"),
            F.coalesce("tokens", F.lit(0)).alias("tokens"),
        )
        target = config.target_tokens if config.rule == "token_budget" else 0
        # What sources that ran out could not give is no fault of the run.
        lacking = entries.where("source_exhausted").agg(F.sum(F.col("token_quota") - F.col("token_count"))).first()[0]
        summary = verify.budget_summary(dumps, verify.count_extremes(shards), target - (lacking or 0))
        found.append(verify.budget_problems(summary, config.rule))
    schema = spark.createDataFrame([], PROBLEMS).schema
    problems = spark.createDataFrame([], schema)
    for part in found:
        missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in part.columns}
        full = part.withColumns(missing).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))
        problems = problems.unionByName(full)
    return problems


def written_totals(
    spark: SparkSession, root: str, listed: DataFrame, year: int, check_text: bool = True
) -> DataFrame:
    """``shard_totals`` of the year under ``root``, staged, read some dumps at a time.

    The driver holds an entry per file of what it reads, so it reads no more files at once than
    ``SHARDS_PER_READ``, or a dump. ``listed`` are the year's files.
    """
    groups = output_groups(spark, root, listed) or [None]
    return stage_parts(
        groups, lambda group: verify.shard_totals(read_output(spark, root, group), year, check_text=check_text), "totals",
    )


def verify_year(spark: SparkSession, root: str, report: DataFrame, config: RunConfig, **options) -> DataFrame:
    """One row: how many problems the year has, and PASS or FAIL."""
    return verify.verdict(year_problems(spark, root, report, config, **options))
