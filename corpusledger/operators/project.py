"""Token and storage projections from samples and footers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusledger.functions.text import ceil_div, gib, ratio, tib
from corpusledger.plans.allocate import keep_fraction
from corpusledger.runtime import scratch_path
from corpusledger.sources.files import list_files

DUMP = "source_config"
#: Fixed value: date and token_count are budgeted uncompressed, four bytes each.
SCALAR_BYTES_PER_ROW = 8


def sample_totals(sample: DataFrame, by: list[str]) -> DataFrame:
    """Rows, tokens and UTF-8 bytes of a sample that carries ``tokens`` and ``utf8_bytes``."""
    return sample.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sampled_rows"),
        F.sum("tokens").cast("bigint").alias("sampled_tokens"),
        F.sum("utf8_bytes").cast("bigint").alias("sampled_utf8_bytes"),
    )


def token_projection(sampled: DataFrame, dumps: DataFrame) -> DataFrame:
    """Per dump: tokens per row of the sample times the rows the dump holds."""
    rows, tokens = F.col("sampled_rows"), F.col("sampled_tokens")
    per_row = ratio(tokens, rows)
    return dumps.select(DUMP, F.col("available_rows").alias("expected_rows")).join(sampled, DUMP).select(
        DUMP, "expected_rows", "sampled_rows", "sampled_tokens", "sampled_utf8_bytes",
        per_row.alias("tokens_per_row"),
        ratio(F.col("sampled_utf8_bytes"), tokens).alias("utf8_bytes_per_token"),
        (per_row * F.col("expected_rows")).alias("projected_tokens"),
    )


def year_projection(projected: DataFrame, target_tokens: int) -> DataFrame:
    """One row: the projected year and whether it stays below the target."""
    return projected.agg(
        F.sum("expected_rows").cast("bigint").alias("total_rows"),
        F.sum("projected_tokens").alias("projected_year_tokens"),
    ).withColumn("below_target", F.col("projected_year_tokens") < F.lit(target_tokens))


def storage_estimate(
    listing: DataFrame, footers: DataFrame, dumps: DataFrame, shards_per_dump: int
) -> DataFrame:
    """Per dump: shard count and bytes from the listing, text bytes per row from sampled footers.

    ``listing`` is (source_config, path, size); ``footers`` are rolled up per file. The first
    ``shards_per_dump`` shards by name are the sample.
    """
    sampled = (
        leading_files(listing, shards_per_dump)
        .join(footers, "path")
        .groupBy(DUMP)
        .agg(
            F.sum("rows").cast("bigint").alias("sampled_rows"),
            F.sum("text_uncompressed_bytes").cast("bigint").alias("_plain"),
            F.sum("text_compressed_bytes").cast("bigint").alias("_packed"),
            F.sum("compressed_bytes").cast("bigint").alias("_all"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("codecs")))).alias("sampled_codecs"),
        )
    )
    whole = listing.groupBy(DUMP).agg(
        F.count(F.lit(1)).alias("source_shards"), F.sum("size").cast("bigint").alias("source_bytes")
    )
    rows = F.col("sampled_rows")
    expected = F.col("expected_rows")
    return (
        dumps.select(DUMP, F.col("available_rows").alias("expected_rows"))
        .join(whole, DUMP)
        .join(sampled, DUMP)
        .select(
            DUMP, "expected_rows", "source_shards", "source_bytes", "sampled_rows", "sampled_codecs",
            ratio(F.col("_plain"), rows).alias("text_bytes_per_row"),
            ratio(F.col("_packed"), rows).alias("text_compressed_bytes_per_row"),
            ratio(F.col("_packed"), F.col("_all")).alias("text_share_of_compressed"),
            (ratio(F.col("_plain"), rows) * expected).alias("projected_text_bytes"),
            (ratio(F.col("_packed"), rows) * expected).alias("projected_text_compressed_bytes"),
            (expected * SCALAR_BYTES_PER_ROW).alias("scalar_bytes"),
        )
    )


def leading_files(listing: DataFrame, per_dump: int) -> DataFrame:
    """The first files by name of each dump; only these need their footers read."""
    rank = F.row_number().over(Window.partitionBy(DUMP).orderBy("path"))
    return listing.withColumn("_rank", rank).where(F.col("_rank") <= per_dump).drop("_rank")


def storage_totals(estimate: DataFrame) -> DataFrame:
    """One row: the estimate summed over dumps, text bytes per row weighted by the dumps' rows."""
    whole = ["expected_rows", "source_shards", "source_bytes", "sampled_rows", "scalar_bytes"]
    projected = ["projected_text_bytes", "projected_text_compressed_bytes"]
    totals = estimate.agg(
        F.count(F.lit(1)).alias("dumps"),
        *(F.sum(name).cast("bigint").alias(name) for name in whole),
        *(F.sum(name).alias(name) for name in projected),
    )
    rows = F.col("expected_rows")
    return totals.withColumns(
        {
            "text_bytes_per_row": ratio(F.col("projected_text_bytes"), rows),
            "text_compressed_bytes_per_row": ratio(F.col("projected_text_compressed_bytes"), rows),
        }
    )


def output_ratio(sample: DataFrame, codecs: list[str]) -> DataFrame:
    """Per codec: bytes per row and share of the UTF-8 text, from really writing the sample.

    ``sample`` has the output columns; one write per codec, sizes from the listing.
    """
    spark = sample.sparkSession
    measured = sample.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.octet_length("text")).cast("bigint").alias("text_utf8_bytes"),
    )
    result = None
    for codec in sorted(set(codecs)):
        path = scratch_path(spark, f"probe-{codec}")
        sample.write.option("compression", codec).parquet(path)
        written = list_files(spark, path).agg(F.sum("size").cast("bigint").alias("file_bytes"))
        row = written.select(F.lit(codec).alias("codec"), "file_bytes")
        result = row if result is None else result.unionByName(row)
    joined = result.withColumn("_one", F.lit(1)).join(
        F.broadcast(measured.withColumn("_one", F.lit(1))), "_one"
    )
    return joined.drop("_one").withColumns(
        {
            "bytes_per_row": ratio(F.col("file_bytes"), F.col("rows")),
            "ratio_vs_text_utf8": ratio(F.col("file_bytes"), F.col("text_utf8_bytes")),
        }
    )


def written_bytes(sample: DataFrame, by: str, codec: str = "zstd") -> DataFrame:
    """(``by``, rows, file_bytes, output_bytes_per_row) from really writing the sample.

    One write: the rows of a value of ``by`` go to a folder of their own, in one file as a shard has
    them, and its size is that of the listed files. ``sample`` has ``by`` and the output columns.
    """
    spark = sample.sparkSession
    path = scratch_path(spark, "probe")
    placed = sample.withColumn("_by", F.col(by).cast("string"))
    placed.drop(by).repartition("_by").write.partitionBy("_by").option("compression", codec).parquet(path)
    kind = dict(sample.dtypes)[by]
    sizes = (
        list_files(spark, path)
        .groupBy(F.url_decode(F.regexp_extract("path", r"/_by=([^/]*)/", 1)).cast(kind).alias(by))
        .agg(F.sum("size").cast("bigint").alias("file_bytes"))
    )
    rows = sample.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(sizes, by).withColumn(
        "output_bytes_per_row", ratio(F.col("file_bytes"), F.col("rows"))
    )


def dump_storage(dumps: DataFrame, rows_per_shard: int) -> DataFrame:
    """Per dump: projected output bytes and shards; needs available_rows and bytes_per_row."""
    projected = F.col("bytes_per_row") * F.col("available_rows")
    return dumps.select(
        DUMP, "available_rows", "bytes_per_row",
        projected.alias("projected_output_bytes"),
        gib(projected).alias("projected_output_gib"),
        ceil_div(F.col("available_rows"), rows_per_shard).alias("shards"),
    )


def storage_rollup(
    storage: DataFrame, *, rows_per_shard: int, free_bytes: int, fixed_bytes: int
) -> DataFrame:
    """Peak disk of both ways to run a year: keep every shard, or delete each once published.

    Two shards of slack cover staging; ``fixed_bytes`` is whatever else lives on the disk.
    """
    totals = storage.agg(
        F.sum("available_rows").cast("bigint").alias("rows"),
        F.sum("projected_output_bytes").alias("output_bytes"),
        F.sum("shards").cast("bigint").alias("shards"),
        (F.max("bytes_per_row") * rows_per_shard).alias("shard_bytes"),
    )
    shard, fixed = F.col("shard_bytes"), F.lit(float(fixed_bytes))
    scenarios = F.array(
        F.struct(
            F.lit("keep_all").alias("scenario"),
            (F.col("output_bytes") + fixed + 2 * shard).alias("peak_bytes"),
        ),
        F.struct(
            F.lit("delete_after_publish").alias("scenario"),
            (fixed + 3 * shard).alias("peak_bytes"),
        ),
    )
    free = F.lit(float(free_bytes))
    return totals.select("*", F.inline(scenarios)).withColumns(
        {
            "fits": F.col("peak_bytes") < free,
            "free_gib_after": gib(free - F.col("peak_bytes")),
            "headroom_multiple": ratio(free, F.col("peak_bytes")),
        }
    )


def multi_year_plan(
    dumps: DataFrame, sampled: DataFrame, target_tokens: int | Column
) -> DataFrame:
    """Per year: rows, projected tokens, the fraction that meets the target, output bytes.

    ``dumps`` is (year, source_config, available_rows, source_bytes); ``sampled`` has one row per
    year: sampled_rows, sampled_tokens, output_bytes_per_row.
    """
    years = dumps.groupBy("year").agg(
        F.count(F.lit(1)).alias("dumps"),
        F.sum("available_rows").cast("bigint").alias("total_rows"),
        F.sum("source_bytes").cast("bigint").alias("source_bytes"),
    )
    target = F.lit(target_tokens) if isinstance(target_tokens, int) else target_tokens
    per_row = ratio(F.col("sampled_tokens"), F.col("sampled_rows"))
    projected = years.join(sampled, "year").withColumns(
        {"tokens_per_row": per_row, "projected_tokens": per_row * F.col("total_rows")}
    )
    kept = keep_fraction(projected, target, projected="projected_tokens", rows="total_rows")
    per_output = F.col("output_bytes_per_row")
    return kept.select(
        "year", "dumps", "total_rows", "source_bytes", "sampled_rows", "tokens_per_row",
        "projected_tokens", (F.col("projected_tokens") > target).alias("exceeds_target"),
        "keep_fraction", "rows_to_keep",
        (per_output * F.col("total_rows")).alias("output_bytes_all"),
        (per_output * F.col("rows_to_keep")).alias("output_bytes_at_target"),
    )


def multi_year_totals(plan: DataFrame) -> DataFrame:
    """The plan's years and, with a null year, their grand total."""
    sums = ["total_rows", "source_bytes", "projected_tokens", "rows_to_keep",
            "output_bytes_all", "output_bytes_at_target"]
    rolled = plan.rollup("year").agg(*(F.sum(name).alias(name) for name in sums))
    return rolled.withColumns(
        {
            "source_tib": tib(F.col("source_bytes")),
            "output_tib_all": tib(F.col("output_bytes_all")),
            "output_tib_at_target": tib(F.col("output_bytes_at_target")),
        }
    )
