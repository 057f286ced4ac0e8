"""A training-data pipeline over ``documents``: five stages, each written before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusledger.llm.common import staged_texts
from corpusledger.llm.stages import (
    keep_good, mix_sources, remove_benchmarks, remove_copies, split_shards,
)

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_good),
    ("MinHash near-dedup", remove_copies),
    ("benchmark decontamination", remove_benchmarks),
    ("mixing sources to target weights", mix_sources),
    ("sharding", split_shards),
]

#: The stages hold a language model and hashes that SQL has not; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged_texts(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
