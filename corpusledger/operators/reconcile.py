"""Joins that compare two versions of the same truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusledger.functions.text import percent
from corpusledger.sources.reports import report_entries

KEY = ["shard", "row"]


def recount_records(
    docs: DataFrame, stored: Column, recounted: Column, key: list[str] = KEY, **extra: Column
) -> DataFrame:
    """Recount records of documents that carry ``key`` and text; the text itself goes no further.

    Stage the result before comparing: Catalyst copies a counter into the null checks it derives
    from a comparison, and would count every text twice.
    """
    return docs.select(
        *key,
        F.sha2("text", 256).alias("text_sha256"),
        F.length("text").cast("bigint").alias("text_chars"),
        F.octet_length("text").cast("bigint").alias("text_utf8_bytes"),
        stored.cast("bigint").alias("stored_token_count"),
        recounted.cast("bigint").alias("recounted_token_count"),
        *(column.alias(name) for name, column in extra.items()),
    )


def pair_recounts(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """Both recounts side by side; a document in only one of them fails the query.

    (shard, row) is unique on both sides, so the join has no hot key. Every column carries the
    coverage check. It reads both sides, so neither pruning columns nor a later filter that
    rejects nulls, which would turn the outer join into an inner one, can lose it.
    """
    joined = baseline.alias("base").join(candidate.alias("cand"), KEY, "full_outer")
    one_sided = F.col("base.text_sha256").isNull() | F.col("cand.text_sha256").isNull()
    message = F.lit("the two recounts do not cover the same documents")

    def checked(name: str, source: str, kind: str = "bigint") -> Column:
        error = F.raise_error(message).cast(kind)
        return F.when(one_sided, error).otherwise(F.col(source)).alias(name)

    return joined.select(
        *KEY,
        checked("text_sha256", "base.text_sha256", "string"),
        checked("candidate_text_sha256", "cand.text_sha256", "string"),
        checked("text_chars", "base.text_chars"),
        checked("text_utf8_bytes", "base.text_utf8_bytes"),
        checked("stored_token_count", "base.stored_token_count"),
        checked("candidate_stored", "cand.stored_token_count"),
        checked("baseline_token_count", "base.recounted_token_count"),
        checked("candidate_token_count", "cand.recounted_token_count"),
    )


def check_contracts(baseline: dict, candidate: dict) -> None:
    """Two recounts compare only if they counted under the same contract."""
    if baseline != candidate:
        raise ValueError("the two recounts counted under different contracts")


def count_mismatches(pairs: DataFrame) -> DataFrame:
    """Documents the two recounts disagree on, with the difference."""
    return pairs.where(F.col("baseline_token_count") != F.col("candidate_token_count")).select(
        *KEY, "text_sha256", "text_chars", "text_utf8_bytes", "stored_token_count",
        "baseline_token_count", "candidate_token_count",
        (F.col("candidate_token_count") - F.col("baseline_token_count")).alias("delta"),
    )


def text_mismatches(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("text_sha256") != F.col("candidate_text_sha256")).select(
        *KEY, F.col("text_sha256").alias("baseline_text_sha256"), "candidate_text_sha256"
    )


def stored_vs_recount(pairs: DataFrame) -> DataFrame:
    """Documents whose stored count differs from a recount, for both sides."""
    sides = F.array(
        F.struct(
            F.lit("baseline").alias("side"),
            F.col("stored_token_count").alias("stored"),
            F.col("baseline_token_count").alias("recounted"),
        ),
        F.struct(
            F.lit("candidate").alias("side"),
            F.col("candidate_stored").alias("stored"),
            F.col("candidate_token_count").alias("recounted"),
        ),
    )
    return (
        pairs.select(*KEY, F.explode(sides).alias("pair"))
        .where("pair.stored != pair.recounted")
        .select(
            "pair.side", *KEY,
            F.col("pair.stored").alias("stored_token_count"),
            F.col("pair.recounted").alias("recounted_token_count"),
        )
    )


def compare_rollup(pairs: DataFrame) -> DataFrame:
    """Per shard: rows, the three totals and how many documents disagree."""
    differs = F.col("baseline_token_count") != F.col("candidate_token_count")
    return pairs.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("baseline_token_count").cast("bigint").alias("baseline_tokens"),
        F.sum("candidate_token_count").cast("bigint").alias("candidate_tokens"),
        F.sum("stored_token_count").cast("bigint").alias("stored_tokens"),
        F.count_if(differs).alias("mismatches"),
    )


def compare_verdict(pairs: DataFrame) -> DataFrame:
    """One row: totals, every kind of mismatch, and whether all counts match."""
    counted = pairs.agg(
        F.count(F.lit(1)).alias("rows_compared"),
        F.sum("stored_token_count").cast("bigint").alias("stored"),
        F.sum("baseline_token_count").cast("bigint").alias("baseline"),
        F.sum("candidate_token_count").cast("bigint").alias("candidate"),
        F.count_if(F.col("baseline_token_count") != F.col("candidate_token_count")).alias("count_mismatches"),
        F.count_if(F.col("stored_token_count") != F.col("baseline_token_count")).alias("stored_vs_baseline"),
        F.count_if(F.col("candidate_stored") != F.col("candidate_token_count")).alias("stored_vs_candidate"),
        F.count_if(F.col("text_sha256") != F.col("candidate_text_sha256")).alias("text_mismatches"),
    )
    bad = F.col("count_mismatches") + F.col("stored_vs_baseline")
    bad = bad + F.col("stored_vs_candidate") + F.col("text_mismatches")
    return counted.withColumn("all_counts_match", bad == 0)


def coverage_sets(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys present on one side only: ``(key..., side)``."""
    left_keys, right_keys = left.select(*key).distinct(), right.select(*key).distinct()
    return (
        left_keys.join(right_keys, key, "left_anti").withColumn("side", F.lit("left only"))
        .unionByName(
            right_keys.join(left_keys, key, "left_anti").withColumn("side", F.lit("right only"))
        )
    )


def same_content(settings: Column | str) -> Column:
    """Free-form JSON in one form for one content: keys in order, no white space, numbers by value.

    Text that is not JSON, or repeats a key, stands for itself.
    """
    text = F.col(settings) if isinstance(settings, str) else settings
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def merge_reports(reports: DataFrame, allow_incomplete: bool = False) -> DataFrame:
    """One merged report row from the reports of workers with disjoint dumps.

    The query fails when workers disagree on mode, year, settings (by content, however they are
    written) or counter, when a dump occurs
    twice or is not in the config, and, unless ``allow_incomplete``, when one is missing. Reports
    hold one entry per dump, so everything here is a config's worth of rows.
    """
    entries = report_entries(reports)
    content = same_content("processing_config").alias("settings")
    agreed = F.struct("mode", "year", content, "counting.implementation")
    head = reports.agg(
        F.count_distinct(agreed).alias("versions"),
        F.min("mode").alias("mode"),
        F.min("year").alias("year"),
        F.min("processing_config").alias("processing_config"),
        F.min("counting").alias("counting"),
        F.array_sort(F.collect_set("source_file")).alias("merged_from"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("dumps_in_config")))).alias(
            "dumps_in_config"
        ),
    )
    totals = entries.agg(
        F.sum("rows").cast("bigint").alias("rows"),
        F.sum("token_count").cast("bigint").alias("token_count"),
        F.sum("shards").cast("bigint").alias("shards"),
        F.array_sort(F.collect_list(F.struct(*_entry_columns(entries)))).alias("source_configs"),
        F.array_sort(F.collect_list("source_config")).alias("dumps_processed"),
        F.count_if(F.col("quota_reached")).alias("quotas_met"),
        F.array_sort(
            F.collect_list(F.when(F.col("source_exhausted"), F.col("source_config")))
        ).alias("dumps_exhausted"),
    )
    merged = (
        head.withColumn("_one", F.lit(1))
        .join(totals.withColumn("_one", F.lit(1)), "_one")
        .drop("_one")
        .withColumn("dumps_missing", F.array_except("dumps_in_config", "dumps_processed"))
        .withColumn("_extra", F.array_except("dumps_processed", "dumps_in_config"))
        .withColumn("partial", F.size("dumps_missing") > 0)
    )
    twice = F.size("dumps_processed") != F.size(F.array_distinct("dumps_processed"))
    target = F.get_json_object("processing_config", "$.target_tokens").cast("bigint")
    faults = [
        (F.col("versions") != 1, F.lit("the workers did not run the same settings or counter")),
        (twice, F.lit("a dump occurs in more than one report")),
        (
            F.size("_extra") > 0,
            F.concat(F.lit("dumps not in the config: "), F.concat_ws(", ", "_extra")),
        ),
    ]
    if not allow_incomplete:
        missing = F.concat(F.lit("dumps missing: "), F.concat_ws(", ", "dumps_missing"))
        faults.append((F.col("partial"), missing))
    checked = F.lit(True)
    for broken, message in faults:
        checked = F.when(broken, F.raise_error(message).cast("boolean")).otherwise(checked)
    return (
        merged.where(checked)
        .withColumn("target_tokens", target)
        .withColumn("percent_of_target", F.col("token_count") / F.col("target_tokens") * 100.0)
        .drop("versions", "_extra")
    )


def selection_outcome(merged: DataFrame) -> DataFrame:
    """What a merged report's rule kept: ``(rule, dumps, available_rows, retained_rows, retained_percent)``.

    Available are the rows that the settings pin for the processed dumps.
    """
    pinned = F.from_json(
        F.get_json_object("processing_config", "$.source.configs"), "map<string,bigint>"
    )
    available = F.aggregate(
        "dumps_processed", F.lit(0).cast("bigint"),
        lambda total, dump: total + F.coalesce(F.element_at(pinned, dump), F.lit(0)),
    )
    return merged.select(
        F.get_json_object("processing_config", "$.selection.rule").alias("rule"),
        F.size("dumps_processed").alias("dumps"),
        available.alias("available_rows"),
        F.col("rows").alias("retained_rows"),
    ).withColumn("retained_percent", percent(F.col("retained_rows"), F.col("available_rows")))


def manifest_diff(local: DataFrame, remote: DataFrame) -> DataFrame:
    """``(path, status)`` of every file on either side.

    ``local`` is (path, size, sha256); ``remote`` the same with a null hash where unknown.
    """
    there = remote.withColumn("path_there", F.col("path"))
    joined = local.alias("here").join(there.alias("there"), "path", "full_outer")
    here_size, there_size = F.col("here.size"), F.col("there.size")
    here_hash, there_hash = F.col("here.sha256"), F.col("there.sha256")
    status = (
        F.when(here_size.isNull(), "unexpected extra")
        .when(F.col("there.path_there").isNull(), "missing")
        .when(here_size != there_size, "size differs")
        .when(there_hash.isNotNull() & (here_hash != there_hash), "sha256 differs")
        .when(there_hash.isNotNull(), "verified by sha256")
        .otherwise("verified by size only")
    )
    return joined.select("path", status.alias("status"))


def manifest_verdict(diff: DataFrame) -> DataFrame:
    good = F.col("status").startswith("verified")
    problems = F.count_if(~good)
    return diff.agg(
        F.count_if(F.col("status") != "unexpected extra").alias("local_shards"),
        F.count_if(~F.col("status").isin("unexpected extra", "missing")).alias("checked"),
        F.count_if(F.col("status") == "verified by sha256").alias("verified_by_sha256"),
        F.count_if(F.col("status") == "verified by size only").alias("verified_by_size_only"),
        problems.alias("problems"),
        F.when(problems == 0, "PASS").otherwise("FAIL").alias("verdict"),
    )


def publish_gate(
    report: DataFrame, shards: DataFrame, leftovers: DataFrame, allow_partial: bool = False
) -> DataFrame:
    """One row: may this year be published, and if not, the first reason why.

    ``report`` is one report row, ``shards`` and ``leftovers`` file listings.
    """
    expected = F.aggregate(
        "source_configs", F.lit(0).cast("bigint"), lambda total, entry: total + entry["shards"]
    )
    said = report.select(
        F.lit(1).alias("_one"), "partial", "rows", "token_count", expected.alias("expected_shards")
    )
    found = shards.agg(
        F.count(F.lit(1)).alias("shards"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    ).withColumn("_one", F.lit(1))
    partial_files = leftovers.agg(F.count(F.lit(1)).alias("leftovers")).withColumn("_one", F.lit(1))
    reason = (
        F.when(F.col("partial") & F.lit(not allow_partial), "report is partial")
        .when(F.col("shards") == 0, "no shards")
        .when(F.col("leftovers") > 0, "unfinished files beside the shards")
        .when(F.col("shards") != F.col("expected_shards"), "shard count differs from report")
    )
    return (
        said.join(found, "_one")
        .join(partial_files, "_one")
        .drop("_one")
        .withColumn("reason", reason)
        .withColumn("publishable", F.col("reason").isNull())
    )


def impl_agreement(counted: DataFrame, stored: str, impls: list[str], key: list[str]) -> DataFrame:
    """Long form: one row per document and implementation, with both counts."""
    cases = F.array(
        *(F.struct(F.lit(name).alias("impl"), F.col(name).alias("computed")) for name in impls)
    )
    return counted.select(
        *key, F.col(stored).alias("stored"), F.explode(cases).alias("case")
    ).select(*key, "stored", "case.impl", "case.computed")


def agreement_summary(long: DataFrame) -> DataFrame:
    """Per implementation: rows, tokens, mismatches, and whether all totals are equal."""
    totals = long.groupBy("impl").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("computed").cast("bigint").alias("tokens"),
        F.count_if(F.col("stored") != F.col("computed")).alias("mismatch_count"),
    )
    every = Window.partitionBy()  # one row per implementation
    agree = F.min("tokens").over(every) == F.max("tokens").over(every)
    clean = F.max("mismatch_count").over(every) == 0
    return totals.select(
        "*",
        (F.col("mismatch_count") == 0).alias("matches_stored"),
        agree.alias("totals_agree"),
        F.when(agree & clean, "PASS").otherwise("FAIL").alias("verdict"),
    )


def agreement_examples(long: DataFrame, key: list[str], k: int = 20) -> DataFrame:
    """The first ``k`` mismatches of each implementation."""
    rank = F.row_number().over(Window.partitionBy("impl").orderBy(*key))
    return (
        long.where(F.col("stored") != F.col("computed"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= k)
    )


def batch_invariance(counted: DataFrame, batched: str, single: str, key: list[str]) -> DataFrame:
    """Documents whose count depends on how they were batched; must be empty."""
    return counted.where(F.col(batched) != F.col(single)).select(*key, batched, single)


def _entry_columns(entries: DataFrame) -> list[str]:
    return [name for name in entries.columns if name != "source_file"]
