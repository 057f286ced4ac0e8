"""Build one year: plan, count, select, shard, write, report."""

from __future__ import annotations

import hashlib
import json
import math
import re
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusledger.functions.counters import CounterSpec, token_count
from corpusledger.functions.keys import BUCKET_ROWS, ID_BUCKET_BITS, bucket_bits, id_bits, id_bucket, key_bucket
from corpusledger.functions.text import checked_text, int_div
from corpusledger.operators.prefix import assign_shards, find_cuts, keep_prefix, shard_bounds
from corpusledger.operators.select import (
    DUMP, SEEDED_ORDER, SOURCE_ORDER, budget_cuts, in_source_order, quota_outcome, seeded,
)
from corpusledger.plans.build import build_plans, config_dumps, dump_subset
from corpusledger.plans.config import RunConfig
from corpusledger.runtime import (
    delete, file_digest, path_exists, pin_small, read_by, spread, staging_under, write_by,
)
from corpusledger.sinks.commits import CommitLog, ConcurrentRun
from corpusledger.sinks.report import run_report
from corpusledger.sinks.shards import (
    MANIFEST_SCHEMA, clear_shards, commit_shards, committed_shards, in_wave, last_commit, timed_by,
    waves, write_shards,
)

#: Candidates counted beyond the estimated share of a dump, so that one pass usually suffices.
MARGIN = 1.05
#: Candidate ranges are cut at multiples of 1/65,536 of the key space (four hex digits).
SLOTS = 16**4
ROWS_PER_WAVE = 500_000_000
#: A row is compared with the starts of all shards of its bucket, so a bucket should have few.
SHARDS_PER_BUCKET = 64
#: Ids may leave out this many numbers for each one they use.
MOST_GAPS = 1_000
#: Drops the rows a year does not keep and gives the others their shard.
Placement = Callable[[DataFrame], DataFrame]
DUMP_NAME = re.compile(r"[\w.-]+")


def run_year(
    docs: DataFrame,
    config: RunConfig,
    root: str,
    *,
    mode: str = "full",
    counter: CounterSpec,
    rows_per_shard: int = 50_000,
    dumps: list[str] | None = None,
    sample_rows: int | None = None,
    rows_per_wave: int = ROWS_PER_WAVE,
    clock: Callable[[], float] = time.time,
    takeover: bool = False,
) -> DataFrame:
    """Write the year's shards under ``root`` and return its report row.

    ``docs`` is (source_config, doc_id, text) with a ``doc_id`` that numbers a dump's documents in
    source order, with few gaps and no repeats (``numbered_documents`` reads such a table); other
    ids are refused. Shards are committed wave by wave. A rerun goes on behind the committed ones:
    a dump is finished only if it holds what its plan asks for, so a larger sample or budget in the
    same root extends what is there. Since every order is a function of the seed or of the ids, the
    outcome is that of one undisturbed run. A rerun with another seed, counter, vocabulary, shard
    size or other settings that change shards is refused. Sample runs go to ``root/sample``.
    ``clock`` gives the time in seconds that a commit is noted with.

    One run at a time may write under a root: a second one raises ``ConcurrentRun`` before it touches
    anything. A run that fails gives the root free; after a killed driver pass ``takeover``.
    """
    if rows_per_shard < 1:
        raise ValueError("rows_per_shard must be positive")
    spark = docs.sparkSession
    target_root = f"{root}/sample" if mode == "sample" else root
    log = CommitLog(spark, target_root)
    log.begin(takeover)
    try:
        with staging_under(spark, target_root), timed_by(clock):
            report = _build(
                docs, config, target_root, mode, counter, rows_per_shard, dumps, sample_rows,
                rows_per_wave, log,
            )
            # One row, with one entry per dump of the config; what it came from is dropped.
            rows = report.collect()
    except ConcurrentRun:
        raise  # the root is another's
    except BaseException:
        log.end()
        raise
    log.end()
    return spark.createDataFrame(rows, report.schema)


def _build(
    docs: DataFrame, config: RunConfig, target_root: str, mode: str, counter: CounterSpec,
    rows_per_shard: int, dumps: list[str] | None, sample_rows: int | None, rows_per_wave: int,
    log: CommitLog,
) -> DataFrame:
    spark = docs.sparkSession
    every = build_plans(config_dumps(spark, config), config, mode, sample_rows)
    plans = pin_small(dump_subset(every, dumps))
    # Plans and totals are one row per dump of the config file.
    rows = {row[DUMP]: row.asDict() for row in plans.collect()}
    unsafe = sorted(name for name in rows if not DUMP_NAME.fullmatch(name))
    if unsafe:
        raise ValueError(f"Dump names become directory names and must be plain: {unsafe}")
    docs = docs.where(F.col(DUMP).isin(*rows))
    docs = docs.select(DUMP, "doc_id", checked_text(docs).alias("text"))

    run = run_identity(config, next(iter(rows.values())), counter, rows_per_shard, mode) if rows else ""
    done = _committed(committed_shards(spark, target_root), rows, run, rows_per_shard)
    held = _held(docs.select(DUMP, "doc_id"), rows)
    left = [name for name in rows if not _finished(rows[name], done.get(name), held[name])]
    if left:
        mine = F.col(DUMP).isin(*left)
        _write_dumps(
            docs.where(mine), plans.where(mine), {name: rows[name] for name in left}, config,
            target_root, counter, rows_per_shard, rows_per_wave, held, done, run, log,
        )
    # A year whose quotas are all zero writes nothing and has no manifest.
    manifest = committed_shards(spark, target_root)
    if manifest is None:
        manifest = spark.createDataFrame([], MANIFEST_SCHEMA)
    totals = manifest.groupBy(DUMP).agg(
        F.sum("rows").alias("rows"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("shards")
    )
    known = plans
    if any(row["token_quota"] is not None for row in rows.values()):
        # Whether a source ran out is judged by what it holds, not by what the config expects.
        known = plans.withColumn("available_rows", _by_dump({name: held[name]["rows"] for name in rows}))
    return run_report(
        quota_outcome(totals, known, rows_per_shard), config.settings, list(config.dumps),
        mode=mode, counter=counter.kind, batch_size=counter.batch_size,
    )


RANGES = f"round int, {DUMP} string, first int, last int"


def count_candidates(docs: DataFrame, plans: DataFrame, count, fraction: float, folder: str) -> DataFrame:
    """Documents with key, bucket, text and token_count, enough of them for every quota.

    Selection is a prefix in key order, so documents beyond it need no counting. Each round
    counts the next range of keys per dump; dumps that met their quota, or have no keys left,
    drop out. ``fraction`` estimates the share a budget keeps; 1 counts everything at once. Rounds
    are kept in ``folder`` with the ranges they cover, so a rerun counts nothing twice.
    """
    spark = docs.sparkSession
    schema = docs.withColumn("token_count", F.lit(0).cast("bigint")).schema
    # Everything kept here is one number per dump of the config and round.
    quotas = {row[DUMP]: row["token_quota"] for row in plans.select(DUMP, "token_quota").collect()}
    done = _counted_ranges(spark, folder)
    ends: dict[str, int] = {}
    for row in done:
        ends[row[DUMP]] = max(row["last"], ends.get(row[DUMP], 0))
    parts = [read_by(spark, f"{folder}/round={n}", schema) for n in sorted({row["round"] for row in done})]
    staged = reduce(DataFrame.unionByName, parts).where(F.col(DUMP).isin(*quotas)) if parts else None
    number = max((row["round"] for row in done), default=-1) + 1
    ranges = {name: (0, _slots(fraction * MARGIN)) for name in quotas if name not in ends}
    if staged is not None:
        ranges |= _next_ranges(staged, quotas, {name: end for name, end in ends.items() if name in quotas})
    while ranges:
        limits = spark.createDataFrame(
            [(name, _slot_key(first), _slot_key(last)) for name, (first, last) in ranges.items()],
            f"{DUMP} string, first string, last string",
        )
        inside = (F.col("key") >= F.col("first")) & (F.col("key") < F.col("last"))
        short = docs.where(F.col(DUMP).isin(*ranges))  # prunes the dumps that are done
        part = short.join(pin_small(limits), DUMP).where(inside).drop("first", "last")
        part = spread(part, "doc_id", source=docs).withColumn("token_count", count(F.col("text")))
        part = write_by(part.select(*schema.names), f"{folder}/round={number}", DUMP)
        covered = [(number, name, first, last) for name, (first, last) in ranges.items()]
        spark.createDataFrame(covered, RANGES).coalesce(1).write.mode("append").parquet(f"{folder}/ranges")
        number += 1
        staged = part if staged is None else staged.unionByName(part)
        ranges = _next_ranges(staged, quotas, {name: last for name, (_, last) in ranges.items()})
    return staged if staged is not None else spark.createDataFrame([], schema)


def _counted_ranges(spark: SparkSession, folder: str) -> list:
    """(round, dump, first, last) of finished rounds; one without ranges was interrupted."""
    if not path_exists(spark, f"{folder}/ranges"):
        return []
    return spark.read.schema(RANGES).parquet(f"{folder}/ranges").collect()


def _next_ranges(staged: DataFrame, quotas: dict, ends: dict[str, int]) -> dict[str, tuple[int, int]]:
    """The next range of keys of every dump in ``ends`` whose quota is not met yet."""
    totals = staged.groupBy(DUMP).agg(F.sum("token_count").alias("tokens")).collect()
    counted = {row[DUMP]: row["tokens"] for row in totals}
    return {
        name: (last, _slots(last / SLOTS * MARGIN * _growth(quotas[name], counted.get(name, 0)), last + 1))
        for name, last in ends.items()
        if last < SLOTS and counted.get(name, 0) < quotas[name]
    }


def _slots(fraction: float, at_least: int = 1) -> int:
    return min(SLOTS, max(at_least, math.ceil(fraction * SLOTS)))


def _slot_key(slot: int) -> str:
    """The key a slot starts with; the end of the last slot sorts after every key."""
    return format(slot, "04x") if slot < SLOTS else "g"


def _growth(quota: int, tokens: int) -> float:
    """How much longer a prefix must get to meet its quota, at most fourfold per round."""
    return min(quota / max(tokens, 1), 4.0)


def _write_dumps(
    docs: DataFrame, plans: DataFrame, plan_rows: dict, config: RunConfig, root: str,
    counter: CounterSpec, rows_per_shard: int, rows_per_wave: int, held: dict, done: dict, run: str,
    log: CommitLog,
) -> None:
    spark = docs.sparkSession
    count = token_count(spark, counter)
    one = next(iter(plan_rows.values()))
    budget = one["token_quota"] is not None
    quota = "token_quota" if budget else "row_target"

    bits = _bucket_bits(plan_rows, held, rows_per_shard, one["shuffle"])
    if one["shuffle"]:
        ordered, order = seeded(docs, one["seed"], bits), SEEDED_ORDER
    else:
        ordered, order = in_source_order(docs, bits), SOURCE_ORDER

    counts = f"{root}/_counted/{run}"
    source = ordered
    if budget:
        # Counts kept by an interrupted run may have the buckets of a source that was smaller.
        bucket = key_bucket("key", bits) if one["shuffle"] else id_bucket("doc_id", bits)
        counted = count_candidates(ordered, plans, count, keep_estimate(config), counts)
        source = counted.withColumn("bucket", bucket)
    narrow = source.select(DUMP, "bucket", *order, *(["token_count"] if budget else []))
    positions = all(held[name]["last"] == held[name]["rows"] - 1 for name in plan_rows)
    if not budget and not one["shuffle"] and positions:
        place, planned = _place_numbered(plan_rows, rows_per_shard)
    else:
        cuts = None
        if budget:
            cuts = budget_cuts(narrow, plans)
        elif any(held[name]["rows"] > row["row_target"] for name, row in plan_rows.items()):
            cuts = find_cuts(
                narrow, plans, group=DUMP, bucket="bucket", order=order, weight=F.lit(1),
                quota=quota,
            )
        place, planned = _place_ordered(narrow, cuts, order, quota, rows_per_shard)

    # Behind the full shards that are committed; a short last one is written anew if it grows.
    pending = {}
    for name, rows in planned.items():
        before = done[name]["rows"] if name in done else 0
        if rows < before:
            raise ValueError(f"{name}: the manifest has {before} rows, its plan {rows}")
        if rows > before:
            pending[name] = (before // rows_per_shard, -(-rows // rows_per_shard))
    commit = last_commit(spark, root) + 1
    log.commit()
    clear_shards(spark, root, {name: first for name, (first, _) in pending.items()}, run, commit)
    tokens = F.col("token_count") if budget else count(F.col("text"))
    for wave in waves(pending, max(1, rows_per_wave // rows_per_shard)):
        sharded = place(source.where(F.col(DUMP).isin(*wave))).where(in_wave(wave))
        log.commit()
        write_shards(
            sharded, root, order=order, year=config.year, tokens=tokens,
            shards=sum(end - first for first, end in wave.values()), compression=config.compression,
            rows_per_shard=rows_per_shard,
        )
        commit += 1
        log.commit()
        commit_shards(spark, root, wave, run, commit)
    delete(spark, f"{root}/_counted")


def run_identity(config: RunConfig, plan: dict, counter: CounterSpec, rows_per_shard: int, mode: str) -> str:
    """A digest of all that decides what a shard holds, but not of how far a run goes.

    Targets are left out, since a larger one extends what a smaller one wrote.
    """
    vocabulary = file_digest(counter.path) if counter.path else None
    decides = {
        "year": config.year, "dumps": config.dumps, "rule": config.rule, "mode": mode,
        "shuffle": plan["shuffle"], "seed": plan["seed"] if plan["shuffle"] else None,
        "counter": counter.kind, "pattern": counter.pattern, "vocabulary": vocabulary,
        "rows_per_shard": rows_per_shard, "compression": config.compression,
    }
    return hashlib.sha256(json.dumps(decides, sort_keys=True).encode()).hexdigest()


def _place_numbered(plan_rows: dict, rows_per_shard: int) -> tuple[Placement, dict[str, int]]:
    """Shards of dumps whose ids are their positions: plain arithmetic, nothing is shuffled.

    Returns how to place rows, and the rows each dump gets.
    """
    targets = {name: row["row_target"] for name, row in plan_rows.items()}

    def place(rows: DataFrame) -> DataFrame:
        kept = rows.where(F.col("doc_id") < _by_dump(targets))
        return kept.withColumn("shard", int_div("doc_id", rows_per_shard).cast("int"))

    return place, targets


def _place_ordered(
    narrow: DataFrame, cuts: DataFrame | None, order: list[str], quota: str, rows_per_shard: int
) -> tuple[Placement, dict[str, int]]:
    """Shards by position among the kept documents of each dump, in the given order."""
    names = dict(group=DUMP, bucket="bucket", order=order)

    def keep(rows: DataFrame) -> DataFrame:
        return rows if cuts is None else keep_prefix(rows, cuts, group=DUMP, order=order, quota=quota)

    kept = keep(narrow)
    bounds = shard_bounds(kept, rows_per_shard=rows_per_shard, **names)
    counts = kept.groupBy(DUMP).count().collect()
    return (
        lambda rows: assign_shards(keep(rows), bounds, **names),
        {row[DUMP]: row["count"] for row in counts},
    )


def keep_estimate(config: RunConfig) -> float:
    """Share of the year a budget keeps, from the token estimate in the settings if there is one."""
    estimate = config.selection.get("estimated_tokens_available")
    return min(1.0, config.target_tokens / estimate) if estimate else 1.0


def _committed(manifest: DataFrame | None, plan_rows: dict, run: str, rows_per_shard: int) -> dict[str, dict]:
    """Rows and tokens committed per dump; commits of other settings or with gaps stop the run."""
    if manifest is None:
        return {}
    found = manifest.groupBy(DUMP).agg(
        F.sum("rows").alias("rows"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("shards"),
        F.max("shard").alias("last"), F.count_if(F.col("run") != run).alias("foreign"),
    ).collect()
    foreign = sorted(row[DUMP] for row in found if row["foreign"])
    if foreign:
        raise ValueError(f"the manifest has shards of a run with other settings: {foreign}")
    for row in found:
        if row["last"] != row["shards"] - 1 or row["shards"] != -(-row["rows"] // rows_per_shard):
            raise ValueError(f"the manifest of {row[DUMP]} has gaps or short shards")
    return {row[DUMP]: row.asDict() for row in found if row[DUMP] in plan_rows}


def _finished(plan: dict, done: dict | None, held: dict) -> bool:
    """Whether a dump's commits are what its plan asks for, or all the source has."""
    rows, tokens = (done["rows"], done["tokens"]) if done else (0, 0)
    if plan["row_target"] is not None:
        if rows > plan["row_target"]:
            raise ValueError(f"{plan[DUMP]}: the manifest has {rows} rows, its plan {plan['row_target']}")
        return rows == plan["row_target"]
    return tokens >= plan["token_quota"] or rows >= held["rows"]


def _held(ids: DataFrame, plan_rows: dict) -> dict[str, dict]:
    """Rows and last id of each dump.

    Ids that repeat, or that are so sparse that each would be a bucket of its own, and dumps with
    fewer rows than planned stop the run. Repeats are found with bitmaps per range of ids.
    """
    place = F.col("doc_id") + 1
    ranges = ids.groupBy(DUMP, F.bitmap_bucket_number(place).alias("range")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(place))).alias("different"),
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
    )
    found = ranges.groupBy(DUMP).agg(
        F.sum("rows").alias("rows"), F.sum("different").alias("different"),
        F.min("first").alias("first"), F.max("last").alias("last"),
    )
    held = {name: {"rows": 0, "different": 0, "first": 0, "last": -1} for name in plan_rows}
    held.update({row[DUMP]: row.asDict() for row in found.collect()})
    for name, own in held.items():
        if own["rows"] != own["different"] or own["first"] is not None and own["first"] < 0:
            raise ValueError(f"{name}: doc_id must number the documents from 0 on without repeats")
        if own["last"] >= MOST_GAPS * max(own["rows"], 1_000):
            raise ValueError(f"{name}: doc_id is too sparse; number the documents first")
    short = [
        f"{name} holds {held[name]['rows']} of {row['row_target']} rows"
        for name, row in sorted(plan_rows.items())
        if row["row_target"] is not None and held[name]["rows"] < row["row_target"]
    ]
    if short:
        raise RuntimeError("; ".join(short))
    return held


def _by_dump(values: dict[str, int]) -> Column:
    """A number per dump of the config as a literal map, so that no join is needed."""
    pairs = [F.lit(part) for pair in values.items() for part in pair]
    return F.element_at(F.create_map(*pairs), F.col(DUMP))


def _bucket_bits(plan_rows: dict, held: dict, rows_per_shard: int, shuffle: bool) -> Column:
    """Bucket bits by dump size, so that small dumps do not get the buckets of a large one.

    With small shards the buckets are smaller, so that none has many shards.
    """
    most = SHARDS_PER_BUCKET * rows_per_shard
    if shuffle:
        size = min(BUCKET_ROWS, most)
        return _by_dump({name: bucket_bits(row["available_rows"], size) for name, row in plan_rows.items()})
    if most >= 1 << ID_BUCKET_BITS:
        return F.lit(ID_BUCKET_BITS)
    return _by_dump({name: id_bits(held[name]["rows"], held[name]["last"], most) for name in plan_rows})
