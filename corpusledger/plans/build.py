"""One plan row per dump: what it must yield, whatever subset of dumps a job processes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusledger.plans.allocate import allocate
from corpusledger.plans.config import MODES, RunConfig

PLAN_SCHEMA = (
    "source_config string, available_rows bigint, row_target bigint, token_quota bigint, "
    "shuffle boolean, seed bigint"
)


def config_dumps(spark: SparkSession, config: RunConfig) -> DataFrame:
    """The dumps a config pins, with the rows it says they hold."""
    return spark.createDataFrame(
        sorted(config.dumps.items()), "source_config string, available_rows bigint"
    )


def build_plans(
    dumps: DataFrame, config: RunConfig, mode: str, sample_rows: int | None = None, target=None
) -> DataFrame:
    """Plans for every dump of the config.

    ``dumps`` is ``(source_config, available_rows)``: the config's own table, or counts derived
    from data. ``target`` overrides the config's token target (an int or a column of ``dumps``).
    """
    if mode not in MODES:
        raise ValueError(f"mode is {mode!r}, must be one of {MODES}")
    if mode == "sample":
        rules = config.sample_mode
        if sample_rows is not None:
            sized = dumps.withColumn("row_target", F.lit(sample_rows).cast("bigint"))
        elif "total_rows" in rules:
            sized = allocate(
                dumps, int(rules["total_rows"]),
                key="source_config", weight="available_rows", output="row_target",
            )
        else:
            sized = dumps.withColumn("row_target", F.lit(int(rules["rows_per_config"])).cast("bigint"))
        return _plan(sized, rules.get("shuffle"), rules.get("random_seed"))

    rules = config.selection
    if config.rule == "retain_all":
        sized = dumps.withColumn("row_target", F.col("available_rows"))
        return _plan(sized, rules.get("shuffle"), rules.get("random_seed"))

    seed = config.budget_seed()
    sized = allocate(
        dumps, config.target_tokens if target is None else target,
        key="source_config", weight="available_rows", output="token_quota",
    )
    return _plan(sized, True, seed)


def _plan(sized: DataFrame, shuffle, seed) -> DataFrame:
    def whole(value):
        return F.lit(None if value is None else int(value)).cast("bigint")

    def target(name):
        return F.col(name) if name in sized.columns else F.lit(None).cast("bigint")

    return sized.select(
        "source_config",
        F.col("available_rows").cast("bigint").alias("available_rows"),
        target("row_target").alias("row_target"),
        target("token_quota").alias("token_quota"),
        F.lit(bool(shuffle)).alias("shuffle"),
        whole(seed).alias("seed"),
    )


def dump_subset(plans: DataFrame, names: list[str] | None) -> DataFrame:
    """Plans of the named dumps only, in the order given; unknown names are an error.

    Call it on finished plans: quotas are shares of the whole config and must not depend on the
    subset. The names and the plans are a config's worth of rows.
    """
    if not names:
        return plans.withColumn("position", F.row_number().over(Window.orderBy("source_config")))
    wanted = plans.sparkSession.createDataFrame(
        list(enumerate(names, 1)), "position int, source_config string"
    )
    unknown = wanted.join(plans, "source_config", "left_anti").select("source_config").toArrow()
    if unknown.num_rows:
        raise ValueError(f"Dumps not in the config: {sorted(unknown.column(0).to_pylist())}")
    return plans.join(wanted, "source_config")

