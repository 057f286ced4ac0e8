"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into ``SLOTS`` slots, a number that never changes. Which shard a slot belongs to
is a table of versions: version 0 deals the slots out in turn, and every later version edits the one
before by moving slots from the heaviest to the lightest shard as long as that brings their bytes
closer together. Rebalancing moves only the slots it names, never single records.

Only the table of slots (``SLOTS`` rows, whatever the corpus) goes to the driver. A record's place in
its shard is the rows of the shard's earlier slots plus its place in its own slot, so no task sees
more than one slot.

A record's key decides its slot if no other record has it. Records whose key is null or repeats cannot be
told apart by it and would all meet in one slot, so they are dealt out by key and row number.

Defined cases: a null text has no bytes and a size of 1; a null key or one that repeats is spread over
the slots; repeated rows have places of their own; one record larger than all others together leaves its shard
heavier than the rest; an empty table gives an empty table and a map with all slots.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusledger.llm.common import staged, staged_texts
from corpusledger.runtime import path_exists

SLOTS = 4096
SHARDS = 8
MAP = "version int, virtual_slot int, shard int"


def size_of(text: str) -> Column:
    return F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint") + 1


def virtual_slot(key: str, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(slots)).cast("int")


def dealt(records: DataFrame, key: str, slots: int) -> DataFrame:
    """``records`` (a staged table with ``__row``, the number of the row) with ``virtual_slot``.

    Keys are counted on narrow rows, summed up before the shuffle; those that repeat are joined back.
    """
    known, unknown = records.where(F.col(key).isNotNull()), records.where(F.col(key).isNull())
    often = known.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__times")).where("__times > 1")
    spread = F.pmod(F.xxhash64(F.col(key).cast("string"), F.col("__row")), F.lit(slots)).cast("int")
    named = known.join(often.select("__key"), F.col(key) == F.col("__key"), "left")
    slot = F.when(F.col("__key").isNull(), virtual_slot(key, slots)).otherwise(spread)
    return named.withColumn("virtual_slot", slot).drop("__key").unionByName(
        unknown.withColumn("virtual_slot", spread)
    )


def first_map(slots: int, shards: int) -> list[int]:
    """Version 0: slots dealt out in turn."""
    return [slot % shards for slot in range(slots)]


def edited(owners: list[int], weights: dict[int, int], shards: int) -> list[int]:
    """The map after moving slots from the heaviest to the lightest shard while the gap shrinks.

    A shard number that the map does not have yet begins empty; slots of shards beyond ``shards``
    are dealt out first. Ties go to the smaller number, so the same weights give the same map.
    """
    owners = [owner if owner < shards else slot % shards for slot, owner in enumerate(owners)]
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, owner in enumerate(owners):
        if weights.get(slot):
            held[owner].append((weights[slot], slot))
    for own in held:
        own.sort()
    totals = [sum(weight for weight, _ in own) for own in held]
    while True:
        heavy = max(range(shards), key=lambda i: (totals[i], -i))
        light = min(range(shards), key=lambda i: (totals[i], i))
        gap = totals[heavy] - totals[light]
        at = bisect.bisect_right(held[heavy], (gap // 2, len(owners)))
        near = [i for i in (at - 1, at) if 0 <= i < len(held[heavy]) and held[heavy][i][0] < gap]
        if not near:
            return owners
        best = min(near, key=lambda i: (abs(gap - 2 * held[heavy][i][0]), i))
        weight, slot = held[heavy].pop(best)
        bisect.insort(held[light], (weight, slot))
        totals[heavy] -= weight
        totals[light] += weight
        owners[slot] = light


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(version, virtual_slot, shard) of a stored version, the last by default."""
    versions = spark.read.schema(MAP).parquet(path)
    if version is None:
        version = versions.agg(F.max("version")).first()[0]
    return versions.where(F.col("version") == version)


def store_map(spark: SparkSession, path: str, version: int, owners: list[int]) -> None:
    """Add one version to the table at ``path``; earlier ones stay."""
    rows = [(version, slot, shard) for slot, shard in enumerate(owners)]
    spark.createDataFrame(rows, MAP).coalesce(1).write.mode("append").parquet(path)


def rebalance(spark: SparkSession, path: str, weights: DataFrame, slots: int, shards: int) -> int:
    """Edit the stored map by (virtual_slot, bytes); begins version 0 if there is none."""
    rows = load_map(spark, path).collect() if path_exists(spark, path) else []
    if not rows:
        owners, version = first_map(slots, shards), 0
        store_map(spark, path, version, owners)
    else:
        version = rows[0]["version"]
        owners = [row["shard"] for row in sorted(rows, key=lambda row: row["virtual_slot"])]
    held = {row["virtual_slot"]: row["bytes"] for row in weights.collect()}
    changed = edited(owners, held, shards)
    if changed != owners:
        version += 1
        store_map(spark, path, version, changed)
    return version


def placed(records: DataFrame, owners: DataFrame, order: list[str]) -> DataFrame:
    """``records`` (with ``virtual_slot``) with ``shard`` and ``slot``, its place there from 0."""
    per_slot = records.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = owners.select("virtual_slot", "shard").join(per_slot, "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("virtual_slot").orderBy(*order)
    numbered = records.withColumn("__place", F.row_number().over(inside) - 1)
    return numbered.join(starts, "virtual_slot").withColumn(
        "slot", (F.col("start") + F.col("__place")).cast("bigint")
    ).drop("start", "__place")


def shard_records(docs: DataFrame, map_path: str, slots: int = SLOTS, shards: int = SHARDS,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, virtual_slot, shard, slot, grown_shard) of every row.

    The map at ``map_path`` is edited for these rows' bytes and its last version applied.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col(key), size_of(text).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("__row"),
    )
    records = staged(dealt(staged(narrow, "rows"), key, slots), "records")
    weights = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    version = rebalance(spark, map_path, weights, slots, shards)
    out = placed(records, load_map(spark, map_path, version), [key, "text_crc32", "size", "__row"])
    return out.select(
        key, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
        F.lit(version).alias("map_version"),
    )


def write_shards(docs: DataFrame, map_path: str, out: str, slots: int = SLOTS, key: str = "doc_id") -> None:
    """All columns of ``docs`` as Parquet under ``out/shard=<n>/``, by the last stored map.

    Rows are shuffled by slot, so a shard is written by as many tasks as it has slots.
    """
    owners = load_map(docs.sparkSession, map_path).select("virtual_slot", "shard")
    rows = staged_texts(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    tagged = dealt(rows, key, slots).join(owners, "virtual_slot")
    tagged.repartition("virtual_slot").drop("virtual_slot", "__row").write.partitionBy("shard").parquet(out)
