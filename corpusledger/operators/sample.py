"""Seeded and systematic samples of shards and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField

from corpusledger.functions.text import ceil_div, int_div
from corpusledger.runtime import pin_small, stage
from corpusledger.sources.files import footer_scan
from corpusledger.sources.groups import read_row_groups

#: The columns of a written shard.
WRITTEN = [
    StructField("date", IntegerType()),
    StructField("text", StringType()),
    StructField("token_count", IntegerType()),
]


def seeded_rank(seed: int, *parts: Column | str) -> Column:
    """A reproducible random rank for the thing the parts name."""
    columns = [F.col(part) if isinstance(part, str) else part for part in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(c.cast("string") for c in columns)))


def cluster_sample(
    rows: DataFrame, shards: DataFrame, *, seed: int, shard_count: int, rows_per_shard: int,
    group_rows: int,
) -> DataFrame:
    """``rows_per_shard`` random rows of one random row group of ``shard_count`` random shards.

    ``rows`` has shard and row (position in the shard), ``shards`` one row per shard with its row
    count. The chosen (shard, group) pairs are at most ``shard_count`` rows, so picking their rows
    is a broadcast join, and the final rank sees one row group per shard.
    """
    groups = F.sequence(F.lit(0), (ceil_div("rows", group_rows) - 1).cast("int"))
    first = Window.partitionBy("shard").orderBy(seeded_rank(seed, "shard", "row_group"), "row_group")
    chosen = pin_small(
        shards.where("rows > 0")
        .orderBy(seeded_rank(seed, "shard"), "shard")
        .limit(shard_count)
        .select("shard", F.explode(groups).alias("row_group"))
        .withColumn("_rank", F.row_number().over(first))
        .where("_rank = 1")
        .drop("_rank")
    )
    rank = F.row_number().over(
        Window.partitionBy("shard").orderBy(seeded_rank(seed, "shard", "row"), "row")
    )
    group = int_div("row", group_rows).cast("int")
    return (
        rows.withColumn("row_group", group)
        .join(chosen, ["shard", "row_group"])
        .withColumn("rank", rank)
        .where(F.col("rank") <= rows_per_shard)
    )


def sample_output(
    files: DataFrame, *, seed: int, shard_count: int, rows_per_shard: int
) -> DataFrame:
    """Cluster sample of a written year: (shard, row_group, row, date, text, token_count).

    ``files`` lists the written shards (shard_name, path). Only the chosen shards are opened:
    first their footers, for the row groups, then the drawn group alone. The sample has at most
    ``shard_count * rows_per_shard`` rows and is staged, so that recounting touches nothing else.
    """
    shard = F.col("shard_name").alias("shard")
    chosen = pin_small(
        files.orderBy(seeded_rank(seed, "shard_name"), "shard_name")
        .limit(shard_count)
        .select(shard, "path")
    )
    footers = stage(footer_scan(chosen), "footers")
    drawn = Window.partitionBy("path").orderBy(seeded_rank(seed, "shard", "row_group"), "row_group")
    groups = (
        footers.where("col_index = 0")
        .join(chosen, "path")
        .withColumn("_rank", F.row_number().over(drawn))
        .where("_rank = 1")
    )
    placed = read_row_groups(groups, WRITTEN).drop("file_row")
    rank = F.row_number().over(
        Window.partitionBy("path").orderBy(seeded_rank(seed, "shard", "row"), "row")
    )
    picked = placed.join(chosen, "path").withColumn("_rank", rank).where(F.col("_rank") <= rows_per_shard)
    return stage(picked.drop("_rank", "path"), "sample")


def audit_counts(sample: DataFrame, year: int) -> DataFrame:
    """Per audited shard: rows, tokens and mismatches of the stored counts or dates."""
    return (
        _audited(sample, year)
        .groupBy("shard", "row_group")
        .agg(
            F.count(F.lit(1)).alias("rows_audited"),
            F.sum("recounted_token_count").cast("bigint").alias("tokens_audited"),
            F.count_if("mismatch").alias("mismatches"),
        )
        .withColumn("verdict", F.when(F.col("mismatches") == 0, "PASS").otherwise("FAIL"))
    )


def audit_mismatches(sample: DataFrame, year: int) -> DataFrame:
    """The audited documents whose stored count or date is wrong."""
    return _audited(sample, year).where("mismatch").select(
        "shard", "row_group", "row", "date", "stored_token_count", "recounted_token_count"
    )


def systematic_dumps(dumps: DataFrame, count: int, by: list[str] | None = None) -> DataFrame:
    """``count`` dumps spread evenly over the sorted list, per value of ``by`` if given."""
    by = by or []
    order = Window.partitionBy(*by).orderBy("source_config")
    place = F.row_number().over(order) - 1
    total = F.count(F.lit(1)).over(Window.partitionBy(*by))
    step = F.greatest(F.lit(1), int_div(total, count).cast("int"))
    return (
        dumps.withColumns({"_place": place, "_step": step})
        .where((F.col("_place") % F.col("_step") == 0) & (F.col("_place") < F.col("_step") * count))
        .drop("_place", "_step")
    )


def middle_shards(shards: DataFrame) -> DataFrame:
    """The middle shard of each dump's sorted list."""
    place = F.row_number().over(Window.partitionBy("source_config").orderBy("shard")) - 1
    total = F.count(F.lit(1)).over(Window.partitionBy("source_config"))
    return (
        shards.withColumns({"_place": place, "_total": total})
        .where(F.col("_place") == int_div("_total", 2))
        .drop("_place", "_total")
    )


def indexed_shards(shards: DataFrame, indices: list[int]) -> DataFrame:
    """The shards at the given positions of each dump's sorted list; positions past it are skipped."""
    place = F.row_number().over(Window.partitionBy("source_config").orderBy("shard")) - 1
    return shards.withColumn("shard_index", place).where(F.col("shard_index").isin(*indices))


def leading_rows_of(rows: DataFrame, shards: DataFrame, count: int) -> DataFrame:
    """The first ``count`` rows of the chosen shards."""
    chosen = pin_small(shards.select("source_config", "shard"))
    return rows.where(F.col("row") < count).join(chosen, ["source_config", "shard"])


def leading_groups(footers: DataFrame, groups: int) -> DataFrame:
    """Per file: how many rows its first ``groups`` row groups hold, for a ``row_index`` filter."""
    return (
        footers.where((F.col("col_index") == 0) & (F.col("row_group") < groups))
        .groupBy("path")
        .agg(F.sum("rows").cast("bigint").alias("leading_rows"))
    )


def first_groups(footers: DataFrame, count: int) -> DataFrame:
    """(path, row_group): the first ``count`` row groups of each file, or all it has."""
    return footers.where((F.col("col_index") == 0) & (F.col("row_group") < count)).select("path", "row_group")


def groups_reaching(footers: DataFrame, rows: int) -> DataFrame:
    """(path, row_group): each file's leading row groups until they hold ``rows`` rows.

    The group that reaches the number is the last; a file with fewer rows gives all its groups, and
    groups without rows count as any other. The running sum sees one row per group of a file.
    """
    before = Window.partitionBy("path").orderBy("row_group").rowsBetween(Window.unboundedPreceding, -1)
    held = F.coalesce(F.sum("rows").over(before), F.lit(0))
    once = footers.where("col_index = 0").withColumn("_held", held)
    return once.where(F.col("_held") < rows).select("path", "row_group")


def leading_texts(groups: DataFrame, rows: int | None = None) -> DataFrame:
    """(path, file_row, text) of the chosen row groups; at most the first ``rows`` of each file."""
    texts = read_row_groups(groups, [StructField("text", StringType())])
    if rows is not None:
        texts = texts.where(F.col("file_row") < rows)
    return texts.select("path", "file_row", "text")


def _audited(sample: DataFrame, year: int) -> DataFrame:
    wrong = F.col("stored_token_count") != F.col("recounted_token_count")
    return sample.withColumn("mismatch", wrong | (F.col("date") != F.lit(year)))
