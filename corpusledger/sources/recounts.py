"""Recounts as files: the records and the contract they were counted under, kept together."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusledger.operators.reconcile import check_contracts, pair_recounts

RECORD = (
    "shard string, row bigint, date int, text_sha256 string, text_chars bigint, text_utf8_bytes bigint, "
    "stored_token_count bigint, recounted_token_count bigint"
)
#: A published recount: one JSON document. What describes the counter is its contract.
DOCUMENT = f"documents array<struct<{RECORD.replace(' ', ': ').replace(',:', ',')}>>, rows bigint, " \
    "recounted_token_total bigint, stored_token_total bigint, tokenizer string, tokenizer_class string, " \
    "tokenizer_is_fast boolean, tokenizer_vocab_size bigint"
CONTRACT = ("tokenizer", "tokenizer_class", "tokenizer_is_fast", "tokenizer_vocab_size")


def write_recount(records: DataFrame, contract: dict, path: str) -> None:
    """``records`` as Parquet and, once they are written, the contract with their totals beside them."""
    spark = records.sparkSession
    names = [part.split()[0] for part in RECORD.split(", ")]
    missing = {"date": F.lit(None).cast("int")} if "date" not in records.columns else {}
    kept = records.withColumns(missing).select(*names)
    kept.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/records")
    totals = _totals(spark.read.schema(RECORD).parquet(f"{path}/records")).withColumn(
        "contract", F.lit(json.dumps(contract, sort_keys=True))
    )
    totals.coalesce(1).write.mode("overwrite").json(f"{path}/contract")


def read_recount(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """Records and contract of a folder of ``write_recount`` or of a published document (``*.json``).

    A recount whose totals are not those of its records is refused, and one without a contract cannot
    be read: the folder's writer did not get that far.
    """
    if path.endswith(".json"):
        # One document holds one sample; it is a row of Spark's reader, not the driver's.
        whole = spark.read.schema(DOCUMENT).option("multiLine", True).json(path)
        head = whole.select(
            "rows", "recounted_token_total", "stored_token_total", F.to_json(F.struct(*CONTRACT)).alias("contract")
        ).first()
        contract = json.loads(head["contract"])
        contract["tokenizer"] = json.loads(contract["tokenizer"]) if contract.get("tokenizer") else None
        records = whole.select(F.explode("documents").alias("record")).select("record.*")
    else:
        schema = "rows bigint, recounted_token_total bigint, stored_token_total bigint, contract string"
        head = spark.read.schema(schema).json(f"{path}/contract").first()
        if head is None:
            raise ValueError(f"{path}: the recount has no contract")
        contract = json.loads(head["contract"])
        records = spark.read.schema(RECORD).parquet(f"{path}/records")
    found = _totals(records).first()
    said = tuple(head[name] for name in ("rows", "recounted_token_total", "stored_token_total"))
    if tuple(found) != said:
        raise ValueError(f"{path}: records add up to {tuple(found)}, the recount says {said}")
    return records, contract


def compare_recount_files(spark: SparkSession, baseline: str, candidate: str) -> DataFrame:
    """Both recounts side by side (``pair_recounts``), if they counted under one contract."""
    (base, agreed), (other, theirs) = read_recount(spark, baseline), read_recount(spark, candidate)
    check_contracts(agreed, theirs)
    return pair_recounts(base, other)


def _totals(records: DataFrame) -> DataFrame:
    whole = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("bigint")
    return records.agg(
        F.count(F.lit(1)).alias("rows"),
        whole("recounted_token_count").alias("recounted_token_total"),
        whole("stored_token_count").alias("stored_token_total"),
    )
