"""Digests over ordered documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusledger.functions.text import int_div

#: Shards whose digests are folded together before a dump's digest is taken.
SHARDS_PER_BLOCK = 1024


def _fold(order: list[str], digest: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(digest).alias("digest"))))
    return F.sha2(F.concat_ws("", F.transform(rows, lambda row: row["digest"])), 256)


def digest_tree(rows: DataFrame) -> DataFrame:
    """Digest per dump from ``(source_config, shard, row, digest)``.

    SHA-256 of concatenated child digests, folded shard by shard, then blocks of shards, then
    dumps. A fold sees one shard (bounded by the shard size), one block of shards, or one dump's
    blocks, so no step gathers a dump's documents in one task. It equals the flat digest of the
    same documents only where each level holds a single child.
    """
    shards = rows.groupBy("source_config", "shard").agg(
        F.count(F.lit(1)).alias("rows"), _fold(["row"], "digest").alias("digest")
    )
    block = int_div("shard", SHARDS_PER_BLOCK).alias("block")
    blocks = shards.groupBy("source_config", block).agg(
        F.count(F.lit(1)).alias("shards"),
        F.sum("rows").alias("rows"),
        _fold(["shard"], "digest").alias("digest"),
    )
    return blocks.groupBy("source_config").agg(
        F.sum("shards").cast("bigint").alias("shards"),
        F.sum("rows").cast("bigint").alias("rows"),
        _fold(["block"], "digest").alias("digest"),
    )


def sample_digest(sample: DataFrame) -> DataFrame:
    """One row: SHA-256 over the digests of the sample's shards, each that of its rows in order.

    Folded like ``digest_tree``: rows meet by shard, shards by block of their names' hashes, so a
    sample of any size is digested without meeting in one task.
    """
    shards = sample.groupBy("shard").agg(
        F.count(F.lit(1)).alias("rows"), _fold(["row"], "digest").alias("digest")
    )
    block = F.substring(F.sha2(F.col("shard").cast("string"), 256), 1, 3).alias("block")
    blocks = shards.groupBy(block).agg(
        F.sum("rows").alias("rows"), _fold(["shard"], "digest").alias("digest")
    )
    return blocks.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"), _fold(["block"], "digest").alias("digest")
    )
