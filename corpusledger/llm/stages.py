"""The stages of the training-data pipeline: each takes documents and returns documents.

Every stage works on all rows it is given, and all but the last return the columns they were given.
Where rows are compared with others, each has a number of its own, so rows whose doc_id is null or
repeats are judged by their own texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusledger.llm import circulant_minhash, decontaminate, mixing, quality_rules, virtual_slots
from corpusledger.llm.common import staged, staged_texts
from corpusledger.runtime import scratch_path


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``, staged, so that a row keeps its number."""
    return staged_texts(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the plain rules and the perplexity bands keep.

    Other columns travel in one of their own, out of the way of the operator's names.
    """
    own = ["doc_id", "text", "lang"]
    rest = [name for name in docs.columns if name not in own]
    packed = docs.select(*own, F.struct(F.lit(0).alias("__none"), *rest).alias("__rest"))
    judged = quality_rules.quality_rules(packed).where("kept")
    return judged.select(
        *(F.col(name) if name in own else F.col("__rest").getField(name).alias(name) for name in docs.columns)
    )


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near copies: the one with the smallest doc_id."""
    rows = numbered(docs)
    found = circulant_minhash.near_duplicates(rows.select(F.col("__row").alias("row"), "doc_id", "text"))
    stay = staged(found.where("first").select(F.col("row").alias("__row")), "kept")
    return rows.join(stay, "__row", "left_semi").select(*docs.columns)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    rows = numbered(docs)
    hits = decontaminate.contaminated(rows.select(F.col("__row").alias("doc_id"), "text"), benchmark)
    found = staged(hits.select(F.col("doc_id").alias("__row")).distinct(), "hits")
    return rows.join(found, "__row", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: up to three rows, or none.

    The mix is decided on narrow rows; a document's number of rows follows from its source's plan
    and its hash, so the texts are not shuffled.
    """
    taken = mixing.decided(docs)
    copies = F.sequence(F.lit(1).cast("bigint"), F.col("__repeats"))
    return taken.where("__repeats > 0").withColumn("__copy", F.explode(copies)).select(*docs.columns)


def split_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every row goes: shard and place in it."""
    return virtual_slots.shard_records(docs.select("doc_id", "text"), scratch_path(spark, "slot-map"))
