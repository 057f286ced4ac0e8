"""Token budgets over arriving documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusledger.operators.select import DUMP, token_budget
from corpusledger.runtime import path_exists, pin_small, stage, staging_under

STATE_SCHEMA = f"{DUMP} string, tokens bigint, rows bigint, batch bigint"


def stream_budget(counted: DataFrame, plans: DataFrame, out: str, checkpoint: str) -> None:
    """Admit arriving documents per dump until its quota is crossed, across batches and restarts.

    ``counted`` is a stream with key, bucket and token_count. Batches are admitted in arrival
    order, documents inside a batch in key order. Both outputs of a batch are directories named
    by its id and replaced on retry: ``out/admitted/batch=<id>`` and ``out/state/batch=<id>``,
    the running totals after it. A retried batch starts from the totals of the one before it.
    """

    def admit(batch: DataFrame, batch_id: int) -> None:
        with staging_under(batch.sparkSession, out):
            admit_batch(batch, batch_id)

    def admit_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = pin_small(running_totals(spark, out, batch_id))
        open_quota = F.col("token_quota") - F.coalesce("tokens", F.lit(0))
        remaining = pin_small(
            plans.select(DUMP, "token_quota")
            .join(before, DUMP, "left")
            .select(DUMP, F.greatest(open_quota, F.lit(0)).alias("token_quota"))
        )
        admitted = token_budget(stage(batch, "arrived"), remaining)
        admitted.write.mode("overwrite").parquet(f"{out}/admitted/batch={batch_id}")
        written = spark.read.schema(admitted.schema).parquet(f"{out}/admitted/batch={batch_id}")
        gained = written.groupBy(DUMP).agg(
            F.sum("token_count").cast("bigint").alias("tokens"), F.count(F.lit(1)).alias("rows")
        )
        after = before.select(DUMP, "tokens", "rows").unionByName(gained)
        (
            after.groupBy(DUMP)
            .agg(F.sum("tokens").alias("tokens"), F.sum("rows").alias("rows"))
            .coalesce(1)
            .write.mode("overwrite")
            .parquet(f"{out}/state/batch={batch_id}")
        )

    query = (
        counted.writeStream.foreachBatch(admit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def running_totals(spark: SparkSession, out: str, before_batch: int | None = None) -> DataFrame:
    """Tokens and rows admitted per dump, as of the last batch (before ``before_batch``)."""
    path = f"{out}/state"
    if not path_exists(spark, path):
        return spark.createDataFrame([], STATE_SCHEMA)
    if before_batch and path_exists(spark, f"{path}/batch={before_batch - 1}"):
        # The usual case: only the state of the batch before is listed and read.
        last = spark.read.schema(STATE_SCHEMA).option("basePath", path)
        return last.parquet(f"{path}/batch={before_batch - 1}")
    states = spark.read.schema(STATE_SCHEMA).parquet(path)
    if before_batch is not None:
        states = states.where(F.col("batch") < before_batch)
    last = states.agg(F.max("batch")).first()[0]
    return states.where(F.col("batch") == F.lit(-1 if last is None else last))


def admitted(spark: SparkSession, out: str, schema) -> DataFrame:
    """Everything admitted so far."""
    return spark.read.schema(schema).parquet(f"{out}/admitted")
