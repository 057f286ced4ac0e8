"""Progress of a run from its manifest and plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusledger.functions.text import gib, percent, ratio

DUMP = "source_config"


def progress_snapshot(committed: DataFrame, plans: DataFrame) -> DataFrame:
    """Per dump: what is done, in the unit its plan is measured in (tokens or rows).

    ``committed`` is the manifest of written shards. If it says when shards were committed, the
    snapshot has the age of each dump's last commit, null for dumps not started.
    """
    timed = "committed_at" in committed.columns
    last = [F.max("committed_at").alias("committed_at")] if timed else []
    done = committed.groupBy(DUMP).agg(
        F.sum("rows").cast("bigint").alias("rows"),
        F.sum("tokens").cast("bigint").alias("tokens"),
        F.count(F.lit(1)).alias("shards"),
        *last,
    )
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("committed_at")
    by_tokens = F.col("token_quota").isNotNull()
    zero = F.lit(0).cast("bigint")
    merged = plans.join(done, DUMP, "left").select(
        DUMP,
        "available_rows",
        *(F.coalesce(name, zero).alias(name) for name in ("rows", "tokens", "shards")),
        F.when(by_tokens, "tokens").otherwise("rows").alias("unit"),
        F.when(by_tokens, F.col("token_quota")).otherwise(F.coalesce("row_target", zero)).alias("target"),
        *([age.alias("commit_age_seconds")] if timed else []),
    )
    reached = F.when(F.col("unit") == "tokens", F.col("tokens")).otherwise(F.col("rows"))
    exhausted = (
        (F.col("unit") == "tokens")
        & (F.col("tokens") < F.col("target"))
        & (F.col("rows") >= F.col("available_rows"))
    )
    return merged.withColumns(
        {
            "done": reached,
            "percent": F.coalesce(percent(reached, F.col("target")), F.lit(0.0)),
            "source_exhausted": exhausted,
        }
    ).drop("available_rows")


def progress_totals(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(
        *(F.sum(name).cast("bigint").alias(name) for name in ("rows", "tokens", "shards", "done", "target"))
    ).withColumn("percent", percent(F.col("done"), F.col("target")))


def disk_snapshot(files: DataFrame, leftovers: DataFrame) -> DataFrame:
    """One row: shards on disk, their bytes, and the files still being written."""
    sizes = files.agg(
        F.count(F.lit(1)).alias("shards_on_disk"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("shard_bytes"),
    )
    open_files = leftovers.agg(F.array_sort(F.collect_list("path")).alias("in_flight"))
    joined = sizes.withColumn("_one", F.lit(1)).join(open_files.withColumn("_one", F.lit(1)), "_one")
    return joined.drop("_one").withColumn("shard_gib", gib(F.col("shard_bytes")))


def run_history(commits: DataFrame, plans: DataFrame) -> DataFrame:
    """(commit, taken_at, done, target): how far the run was after each of its commits.

    ``commits`` is what each commit added per dump; work is counted in the unit of the dump's plan.
    The running sum sees one row per commit.
    """
    by_tokens = F.col("token_quota").isNotNull()
    unit = F.when(by_tokens, F.col("tokens")).otherwise(F.col("rows"))
    wanted = F.when(by_tokens, F.col("token_quota")).otherwise(F.coalesce("row_target", F.lit(0)))
    target = plans.agg(F.sum(wanted).cast("bigint").alias("target"))
    turns = (
        commits.join(plans.select(DUMP, "row_target", "token_quota"), DUMP)
        .groupBy("commit")
        .agg(F.max("taken_at").alias("taken_at"), F.sum(unit).alias("gained"))
    )
    upto = Window.orderBy("commit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = turns.select("commit", "taken_at", F.sum("gained").over(upto).cast("bigint").alias("done"))
    one = F.lit(1).alias("_one")
    return done.select("*", one).join(F.broadcast(target.select("*", one)), "_one").drop("_one")


def progress_rates(history: DataFrame) -> DataFrame:
    """Rate since the previous snapshot and seconds left at that rate.

    ``history`` has one row per snapshot of one run: ``taken_at`` in seconds, ``done`` and
    ``target``. Work done before the first snapshot earns no rate.
    """
    order = Window.orderBy("taken_at")
    seconds = F.col("taken_at") - F.lag("taken_at").over(order)
    gained = F.col("done") - F.lag("done").over(order)
    rate = F.when((seconds > 0) & (gained > 0), ratio(gained, seconds))
    left = F.greatest(F.lit(0), F.col("target") - F.col("done"))
    return history.withColumn("rate", rate).withColumn("eta_seconds", ratio(left, F.col("rate")))
