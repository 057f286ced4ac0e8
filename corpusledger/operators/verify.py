"""Re-derive a year's totals from its shards and check them against contract and report."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusledger.functions.text import gib, percent, ratio
from corpusledger.plans.config import SELECTION_RULES
from corpusledger.runtime import bounded_listing, scratch_path, session_settings

DUMP = "source_config"
WRITTEN = f"date int, text string, token_count int, {DUMP} string, shard int"
#: Parquet by the reader that answers counts and extremes from footers, per partition too.
FROM_FOOTERS = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}
FOOTER_TOTALS = (
    f"{DUMP} string, shard int, rows bigint, counted bigint, dated bigint, "
    "min_count int, max_count int, min_date int, max_date int"
)


def shard_totals(output: DataFrame, year: int, check_text: bool = False) -> DataFrame:
    """One row per shard: rows, tokens, extremes, nulls, wrong dates.

    Reads the two scalar columns only; ``check_text`` also looks for null texts, which makes the
    scan read the text column.
    """
    count = F.col("token_count")
    wrong = F.col("date").isNull() | (F.col("date") != F.lit(year))
    measures = [
        F.count(F.lit(1)).alias("rows"),
        F.sum(count).cast("bigint").alias("tokens"),
        F.min(count).cast("bigint").alias("min_count"),
        F.max(count).cast("bigint").alias("max_count"),
        F.count_if(count.isNull() | F.col("date").isNull()).alias("null_scalars"),
        F.count_if(wrong).alias("wrong_dates"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count_if(count <= 0).alias("non_positive"),
    ]
    if check_text:
        measures.append(F.count_if(F.col("text").isNull()).alias("null_texts"))
    return output.groupBy(DUMP, "shard").agg(*measures)


def scalar_totals(spark: SparkSession, data: str) -> DataFrame:
    """Per shard the rows, the counts and dates that are not null, and their extremes.

    All of it is what Parquet footers hold, and groups are partitions: planned within
    ``FROM_FOOTERS``, no data page is read.
    """
    return spark.read.schema(WRITTEN).parquet(data).groupBy(DUMP, "shard").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("token_count").alias("counted"),
        F.count("date").alias("dated"),
        F.min("token_count").alias("min_count"),
        F.max("token_count").alias("max_count"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
    )


def footer_totals(spark: SparkSession, data: str) -> DataFrame:
    """``scalar_totals`` of the shards below ``data`` from their footers, staged.

    The reader refuses files that lack statistics, as those with a column of nulls do; then the two
    scalar columns are scanned. Of an empty shard either way may say nothing.
    """
    path = scratch_path(spark, "footers")
    try:
        with session_settings(spark, FROM_FOOTERS), bounded_listing(spark):
            scalar_totals(spark, data).write.parquet(path)
    except (PySparkException, Py4JJavaError) as error:
        if "aggregatePushdown" not in str(error):  # the setting that the refusal names
            raise
        path = scratch_path(spark, "scanned")
        with bounded_listing(spark):
            scalar_totals(spark, data).write.parquet(path)
    return spark.read.schema(FOOTER_TOTALS).parquet(path)


def suspect_shards(totals: DataFrame, year: int) -> DataFrame:
    """(source_config, shard) of which the footers say that some rule is broken."""
    rows, wrong = F.col("rows"), F.lit(year)
    return totals.where(
        (F.col("counted") < rows) | (F.col("dated") < rows) | (F.col("min_count") <= 0)
        | (F.col("min_date") != wrong) | (F.col("max_date") != wrong)
    ).select(DUMP, "shard")


def integrity_from_footers(spark: SparkSession, data: str, year: int) -> DataFrame:
    """``integrity_problems`` of the shards below ``data``; only shards with a problem are scanned.

    Footers tell which shards break a rule, but not in how many rows. The join's keys are the
    folders, so the others are pruned when the suspects are known.
    """
    suspects = suspect_shards(footer_totals(spark, data), year)
    with bounded_listing(spark):
        written = spark.read.schema(WRITTEN).parquet(data)
    rows = written.join(suspects, [DUMP, "shard"], "left_semi")
    return integrity_problems(shard_totals(rows, year), year)


def footer_extremes(totals: DataFrame) -> DataFrame:
    """The year's rows, smallest and largest token count, and shards with non-positive counts."""
    return totals.agg(
        F.sum("rows").cast("bigint").alias("rows"),
        F.min("min_count").cast("bigint").alias("min_token_count"),
        F.max("max_count").cast("bigint").alias("max_token_count"),
        F.count_if(F.col("min_count") <= 0).alias("bad_shards"),
    )


def per_dump_rollup(shards: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Shards, rows, tokens, mean tokens per document and, given file sizes, bytes per dump."""
    rolled = shards.groupBy(DUMP).agg(
        F.count(F.lit(1)).alias("shards"),
        F.sum("rows").cast("bigint").alias("rows"),
        F.sum("tokens").cast("bigint").alias("tokens"),
    )
    if sizes is not None:
        measured = sizes.groupBy(DUMP).agg(F.sum("size").cast("bigint").alias("bytes"))
        rolled = rolled.join(measured, DUMP, "left").withColumn("gib", gib(F.col("bytes")))
    return rolled.withColumn("mean_tokens_per_doc", ratio(F.col("tokens"), F.col("rows")))


def count_extremes(shards: DataFrame) -> DataFrame:
    """Smallest, largest and mean token count of the year; shards with non-positive counts."""
    return shards.agg(
        F.sum("rows").cast("bigint").alias("rows"),
        F.min("min_count").alias("min_token_count"),
        F.max("max_count").alias("max_token_count"),
        ratio(F.sum("tokens"), F.sum("rows")).alias("mean_tokens_per_doc"),
        F.count_if(F.col("non_positive") > 0).alias("bad_shards"),
    )


def integrity_problems(shards: DataFrame, year: int) -> DataFrame:
    """``(source_config, shard, rule, rows)``: one row per shard and broken rule."""
    rules = {
        "empty shard": F.when(F.col("rows") == 0, F.lit(1)).otherwise(0).cast("bigint"),
        "null scalar": F.col("null_scalars"),
        "wrong date": F.col("wrong_dates"),
        "non-positive count": F.col("non_positive"),
    }
    if "null_texts" in shards.columns:
        rules["null text"] = F.col("null_texts")
    checks = F.array(
        *(F.struct(F.lit(name).alias("rule"), bad.alias("bad")) for name, bad in rules.items())
    )
    return (
        shards.select(DUMP, "shard", F.explode(checks).alias("check"))
        .where(F.col("check.bad") > 0)
        .select(DUMP, "shard", "check.rule", F.col("check.bad").alias("rows"))
    )


def schema_problems(footers: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Files whose footer columns (name and physical type, in order) differ from ``expected``."""
    wanted = F.array(*(F.lit(f"{name} {kind}") for name, kind in expected.items()))
    column = F.struct("col_index", F.concat_ws(" ", "col", "type").alias("text"))
    found = F.transform(F.array_sort(F.collect_set(column)), lambda item: item["text"])
    return (
        footers.groupBy("path")
        .agg(found.alias("columns"))
        .where(F.col("columns") != wanted)
        .select("path", F.concat_ws(", ", "columns").alias("columns"))
    )


def run_totals(dumps: DataFrame) -> DataFrame:
    """Totals after each finished dump, in sorted order (one row per dump)."""
    upto = Window.orderBy(DUMP).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dumps.select(
        DUMP,
        "rows",
        "tokens",
        F.sum("rows").over(upto).cast("bigint").alias("rows_so_far"),
        F.sum("tokens").over(upto).cast("bigint").alias("tokens_so_far"),
    )


def budget_summary(dumps: DataFrame, extremes: DataFrame, target_tokens: int | Column) -> DataFrame:
    """One row: year totals against what was available and against the target.

    ``dumps`` has rows, tokens and available_rows per dump; ``extremes`` is one row, so it rides
    along as a join on a constant.
    """
    target = F.lit(target_tokens) if isinstance(target_tokens, int) else target_tokens
    totals = dumps.agg(
        F.count(F.lit(1)).alias("dumps"),
        F.sum("rows").cast("bigint").alias("rows"),
        F.sum("available_rows").cast("bigint").alias("available_rows"),
        F.sum("tokens").cast("bigint").alias("tokens"),
        F.max(target).cast("bigint").alias("target_tokens"),
    )
    largest = extremes.select(F.lit(1).alias("_one"), "max_token_count")
    joined = totals.withColumn("_one", F.lit(1)).join(F.broadcast(largest), "_one").drop("_one")
    overshoot = F.col("tokens") - F.col("target_tokens")
    return joined.withColumns(
        {
            "overshoot": overshoot,
            "overshoot_ceiling": F.coalesce("max_token_count", F.lit(0)) * F.col("dumps"),
            "retention_percent": percent(F.col("rows"), F.col("available_rows")),
            "percent_of_target": percent(F.col("tokens"), F.col("target_tokens")),
        }
    )


def budget_problems(summary: DataFrame, rule: str) -> DataFrame:
    """``(rule, measured, limit)`` rows the year-level totals break."""
    known_rule(rule)
    rows, available = F.col("rows"), F.col("available_rows")
    if rule == "retain_all":
        checks = [("rows differ from available", rows != available, rows, available)]
    else:
        checks = [
            ("budget kept every row", rows >= available, rows, available),
            (
                "tokens below target", F.col("tokens") < F.col("target_tokens"),
                F.col("tokens"), F.col("target_tokens"),
            ),
            (
                "overshoot above one document per dump",
                F.col("overshoot") > F.col("overshoot_ceiling"),
                F.col("overshoot"), F.col("overshoot_ceiling"),
            ),
        ]
    return _problem_rows(summary, checks, [])


def report_problems(
    entries: DataFrame, measured: DataFrame, plans: DataFrame, rule: str
) -> DataFrame:
    """``(source_config, rule, measured, limit)``: where a report and the data disagree.

    ``entries`` are the report's dumps, ``measured`` the totals derived from shards. All three
    inputs have one row per dump. A dump that only the report or only the data has is a problem.
    """
    known_rule(rule)
    joined = (
        entries.select(
            DUMP, *(F.col(name).alias(f"said_{name}") for name in ("rows", "token_count", "shards")),
            "token_quota", "source_exhausted", F.lit(True).alias("said"),
        )
        .join(measured.select(DUMP, "rows", "tokens", "shards"), DUMP, "full")
        .join(plans.select(DUMP, "available_rows"), DUMP, "left")
    )
    said = F.col("said").isNotNull()
    there = said & F.col("rows").isNotNull()
    none = F.lit(None).cast("bigint")
    rows, tokens, available = F.col("rows"), F.col("tokens"), F.col("available_rows")
    checks = [
        ("not in the report", ~said, F.col("rows"), none),
        # A dump with a quota of zero, or none of whose documents were wanted, has no shards.
        ("no shards", said & F.col("rows").isNull() & (F.col("said_rows") > 0), none, F.col("said_shards")),
        ("rows differ", there & (rows != F.col("said_rows")), rows, F.col("said_rows")),
        (
            "tokens differ", there & (tokens != F.col("said_token_count")),
            tokens, F.col("said_token_count"),
        ),
        (
            "shards differ", there & (F.col("shards") != F.col("said_shards")),
            F.col("shards"), F.col("said_shards"),
        ),
    ]
    if rule == "retain_all":
        checks.append(("rows differ from pinned", there & (rows != available), rows, available))
    else:
        quota = F.col("token_quota")
        open_end = ~F.coalesce("source_exhausted", F.lit(False))
        checks += [
            ("no quota", there & quota.isNull(), none, none),
            ("short of quota", there & (tokens < quota) & open_end, tokens, quota),
            ("more rows than available", there & (rows > available), rows, available),
        ]
    return _problem_rows(joined, checks, [DUMP])


def total_problems(report: DataFrame, measured: DataFrame) -> DataFrame:
    """``(rule, measured, limit)``: where the report's own totals differ from the data's.

    ``report`` is one row, ``measured`` one row per dump.
    """
    found = measured.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("found_rows"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("found_tokens"),
        F.count(F.lit(1)).alias("found_dumps"),
    ).withColumn("_one", F.lit(1))
    said = report.select(
        F.lit(1).alias("_one"), "rows", "token_count",
        F.size(F.filter("source_configs", lambda entry: entry["rows"] > 0)).alias("dumps"),
    )
    checks = [
        (f"total {what} differ", F.col(f"found_{what}") != F.col(name), F.col(f"found_{what}"), F.col(name))
        for what, name in (("rows", "rows"), ("tokens", "token_count"), ("dumps", "dumps"))
    ]
    return _problem_rows(said.join(found, "_one"), checks, [])


def with_empty_shards(shards: DataFrame, listed: DataFrame) -> DataFrame:
    """Shard totals with a row for every listed shard that holds no rows."""
    empty = listed.select(DUMP, "shard").distinct().join(shards, [DUMP, "shard"], "left_anti")
    zero = F.lit(0).cast("bigint")
    counted = {"rows", "tokens", "null_scalars", "wrong_dates", "non_positive", "null_texts"}
    filled = [
        F.col(name) if name in (DUMP, "shard")
        else (zero if name in counted else F.lit(None).cast(kind)).alias(name)
        for name, kind in shards.dtypes
    ]
    return shards.unionByName(empty.select(*filled))


def known_rule(rule: str) -> None:
    if rule not in SELECTION_RULES:
        raise ValueError(f"the selection rule is {rule!r}, must be one of {SELECTION_RULES}")


def first_k_problems(problems: DataFrame, k: int, by: str, order: list[str]) -> DataFrame:
    """The first ``k`` problems of each kind; Spark trims groups before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return problems.withColumn("rank", rank).where(F.col("rank") <= k)


def verdict(problems: DataFrame) -> DataFrame:
    """One row: how many problems there are and PASS or FAIL."""
    count = F.count(F.lit(1))
    return problems.agg(
        count.alias("problems"), F.when(count == 0, "PASS").otherwise("FAIL").alias("verdict")
    )


def refuse(problems: DataFrame, what: str) -> None:
    """Stop if there is any problem row, naming the first one."""
    first = problems.limit(1).collect()
    if first:
        raise ValueError(f"{what}: {first[0].asDict()}")


def _problem_rows(df: DataFrame, checks: list, keys: list[str]) -> DataFrame:
    cases = F.array(
        *(
            F.struct(
                F.lit(name).alias("rule"),
                F.coalesce(broken, F.lit(False)).alias("broken"),
                measured.cast("bigint").alias("measured"),
                limit.cast("bigint").alias("limit"),
            )
            for name, broken, measured, limit in checks
        )
    )
    return (
        df.select(*keys, F.explode(cases).alias("case"))
        .where("case.broken")
        .select(*keys, "case.rule", "case.measured", "case.limit")
    )
