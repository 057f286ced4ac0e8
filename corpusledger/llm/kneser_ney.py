"""An interpolated modified Kneser-Ney model over characters, counted and estimated by Spark.

Tokens are code points, so that a block of text repeats its n-grams many times over and can be
pre-aggregated before anything is shuffled. There is one model for all languages, so that a text
that passes from one language to another is not odd by itself. The text goes to *blocks* of one
language and about ``BLOCK_CHARS`` characters each (by a hash of the document, so no source or group
of copies fills one). Three steps, none of which holds the model in one place:

1. ``block_counts``: every block counts its distinct n-grams of the highest order;
2. ``estimate``: counts summed over blocks, lower orders and probabilities as grouped tables and
   joins on the n-gram, stored as arrays of sorted hashes with their log probabilities;
3. ``score``: each block asks for its own n-grams only, gets them back as one sorted hash array
   and looks them up by binary search.

What is shuffled grows with the number of blocks, that is with the corpus. A worker holds one
block's n-grams and ``CHUNK_CHARS`` characters of its text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusledger.llm.common import staged

ORDER = 4
BLOCK_CHARS = 16_000_000
CHUNK_CHARS = 1 << 20
#: Stands before a document's first character; never predicted.
START = "\x02"
SHARD_ENTRIES = 50_000
_TABLE = 1 << 25
_FLUSH = 2_000_000
COUNTS = "block string, gram string, key bigint, n bigint"


def language(column: str = "lang") -> Column:
    """A null language is a language of its own."""
    return F.coalesce(F.col(column).cast("string"), F.lit("und"))


def blocks_of(docs: DataFrame, text: str, lang: str) -> dict[str, int]:
    """How many blocks each language's text needs."""
    chars = F.sum(F.length(F.col(text))).alias("chars")
    sizes = docs.groupBy(language(lang).alias("lang")).agg(chars).collect()
    return {row[0]: 1 + (row[1] or 0) // BLOCK_CHARS for row in sizes} or {"und": 1}


def with_blocks(docs: DataFrame, blocks: dict[str, int], text: str, lang: str, identity: str) -> DataFrame:
    """``docs`` with ``__lang`` and ``__block``.

    A block is a language and a hash of the identity (of the text where that is null), over as many
    as ``blocks`` has for the language.
    """
    named = docs.withColumn("__lang", language(lang))
    pairs = [F.lit(x) for item in blocks.items() for x in item]
    of_lang = F.coalesce(F.element_at(F.create_map(*pairs), F.col("__lang")), F.lit(1))
    named_by = F.coalesce(F.col(identity).cast("string"), F.col(text))
    number = F.pmod(F.xxhash64(named_by), of_lang.cast("bigint"))
    block = F.concat_ws("/", "__lang", number.cast("string"))
    return named.withColumn("__block", block)


def block_counts(docs: DataFrame, blocks: dict[str, int], text: str, identity: str,
                 trusted: DataFrame | None, order: int) -> DataFrame:
    """(block, gram, key, n): n-grams of every block, n counting those in trusted documents.

    ``trusted`` has (identity, __block) of the trusted documents; None trusts all. Its rows
    travel to the blocks with the documents and come first in them.
    """
    slots = max(sum(blocks.values()), docs.sparkSession.sparkContext.defaultParallelism)
    rows = docs.select(
        F.lit(1).alias("kind"), F.col("__block").alias("block"),
        F.col(identity).cast("string").alias("id"), F.col(text).alias("text"),
    )
    if trusted is not None:
        marks = trusted.select(
            F.lit(0).alias("kind"), F.col("__block").alias("block"),
            F.col(identity).cast("string").alias("id"), F.lit(None).cast("string").alias("text"),
        )
        rows = rows.unionByName(marks).repartition(slots, "block").sortWithinPartitions("kind")
    else:
        rows = rows.repartition(slots, "block")
    count = _counter(order, trusted is None)
    return rows.mapInArrow(count, COUNTS)


def estimate(counts: DataFrame, order: int) -> DataFrame:
    """(shard, keys, logps): log probabilities of every n-gram in arrays sorted by hash.

    Modified Kneser-Ney with three discounts per order: highest-order counts, below them the number
    of distinct left neighbours; the lowest order is interpolated with the uniform distribution over
    the characters and one unknown. An n-gram that only untrusted text has (n = 0) gets what its
    context leaves to the order below. Only counts of counts, one row per order, go to the driver.
    """
    grams = staged(counts.groupBy("gram", "key").agg(F.sum("n").alias("c")), "grams")
    levels = {order: grams.select("gram", "c")}
    for k in range(order - 1, 0, -1):
        shorter = F.expr("substring(gram, 2)").alias("gram")
        neighbours = F.sum((F.col("c") > 0).cast("bigint")).alias("c")
        levels[k] = levels[k + 1].groupBy(shorter).agg(neighbours)
    tallies = None
    for k, level in levels.items():
        tally = level.agg(
            F.lit(k).alias("k"), F.count(F.lit(1)).alias("types"), F.sum("c").alias("total"),
            *(F.sum((F.col("c") == i).cast("bigint")).alias(f"n{i}") for i in (1, 2, 3, 4)),
            F.sum((F.col("c") >= 3).cast("bigint")).alias("more"),
        )
        tallies = tally if tallies is None else tallies.unionByName(tally)
    held = {row["k"]: row for row in tallies.collect()}
    lower = None
    for k in range(1, order + 1):
        row, c = held[k], F.col("c")
        d1, d2, d3 = _discounts(*(row[f"n{i}"] or 0 for i in (1, 2, 3, 4)))
        if k == 1:
            of_context = {
                "total": F.lit(row["total"] or 0), "one": F.lit(row["n1"] or 0),
                "two": F.lit(row["n2"] or 0), "more": F.lit(row["more"] or 0),
            }
            table = levels[1].withColumns(of_context | {"p_low": F.lit(1.0 / (row["types"] + 1))})
        else:
            context = Window.partitionBy(F.expr(f"substring(gram, 1, {k - 1})"))
            table = levels[k].select(
                "gram", "c", F.expr("substring(gram, 2)").alias("tail"),
                F.sum("c").over(context).alias("total"),
                F.sum((c == 1).cast("bigint")).over(context).alias("one"),
                F.sum((c == 2).cast("bigint")).over(context).alias("two"),
                F.sum((c >= 3).cast("bigint")).over(context).alias("more"),
            ).join(lower.select(F.col("gram").alias("tail"), "p_low"), "tail")
        cut = F.when(c == 1, d1).when(c == 2, d2).when(c >= 3, d3).otherwise(0.0)
        left = d1 * F.col("one") + d2 * F.col("two") + d3 * F.col("more")
        p = F.when(
            F.col("total") > 0,
            F.greatest(c - cut, F.lit(0.0)) / F.col("total") + left / F.col("total") * F.col("p_low"),
        ).otherwise(F.col("p_low"))
        lower = table.select("gram", p.alias("p_low"))
    shard = F.pmod(F.xxhash64("key"), F.lit(1 + held[order]["types"] // SHARD_ENTRIES))
    entries = lower.join(grams.select("gram", "key"), "gram").select(
        shard.alias("shard"), F.struct("key", F.log("p_low").alias("logp")).alias("entry")
    )
    arrays = entries.groupBy("shard").agg(F.sort_array(F.collect_list("entry")).alias("e"))
    return staged(
        arrays.select("shard", F.col("e.key").alias("keys"), F.col("e.logp").alias("logps")), "model"
    )


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Chen and Goodman's estimates; where counts of counts are missing or odd, 0.5, 1 and 1.5."""
    fallback = (0.5, 1.0, 1.5)
    if not (n1 and n2 and n3 and n4):
        return fallback
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(d if 0 < d <= i + 1 else fallback[i] for i, d in enumerate(found))


def score(docs: DataFrame, text: str, counts: DataFrame, model: DataFrame, order: int, more: str,
          rows) -> DataFrame:
    """``docs`` without the block columns, with ``log_prob`` (nats, summed) and ``rows``'s columns.

    ``rows(texts)`` gives the columns named in the DDL ``more`` for a list of texts without nulls.
    """
    flat = model.select(F.explode(F.arrays_zip("keys", "logps")).alias("e")).select(
        F.col("e.keys").alias("key"), F.col("e.logps").alias("logp")
    )
    asked = counts.select("block", "key").join(flat, "key")
    answers = asked.groupBy("block").agg(
        F.sort_array(F.collect_set(F.struct("key", "logp"))).alias("e")
    ).select(
        F.col("block").alias("__block"), F.col("e.key").alias("keys"), F.col("e.logp").alias("logps")
    )
    out = docs.drop("__lang", "__block")
    added = T.StructType.fromDDL("log_prob double" + (", " + more if more else ""))
    schema = T.StructType([*out.schema.fields, *added.fields])
    place = docs.columns.index(text)
    names, kept = [field.name for field in schema], [i for i, c in enumerate(docs.columns) if c not in ("__lang", "__block")]

    def lookup(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = [x or "" for x in left.column(place).to_pylist()]
        keys, logps = np.empty(0, np.int64), np.empty(0)
        if right.num_rows:
            keys = right.column("keys").combine_chunks().values.to_numpy(zero_copy_only=False)
            logps = right.column("logps").combine_chunks().values.to_numpy(zero_copy_only=False)
        sums = log_probs(texts, keys, logps, order)
        columns = [left.column(i) for i in kept] + [pa.array(sums)] + list(rows(texts))
        return pa.table(columns, names=names)

    blocked = docs.groupBy("__block").cogroup(answers.groupBy("__block"))
    return blocked.applyInArrow(lookup, schema)


# --- inside the tasks --------------------------------------------------------------------------


def segments(texts, order: int, limit: int = CHUNK_CHARS):
    """Lists of (index of the text, its context, a piece of it) of about ``limit`` characters.

    A piece carries the ``order - 1`` characters before it, so cutting long texts changes nothing.
    """
    batch, size, pad = [], 0, START * (order - 1)
    for i, text in enumerate(texts):
        for at in range(0, len(text), limit):
            piece = text[at:at + limit]
            context = (pad + text[max(0, at - order + 1):at])[1 - order:] if order > 1 else ""
            batch.append((i, context, piece))
            size += len(piece)
            if size >= limit:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


def gram_ids(batch, order: int):
    """(codes, keys, ids, predicted): the distinct n-grams as code rows and hashes, and at every
    character position the number of the n-gram that ends there; ``predicted`` is false on contexts.

    Numbers are dealt order by order through direct tables, so nothing is sorted.
    """
    joined = "".join(context + piece for _, context, piece in batch)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter((len(piece) for _, _, piece in batch), np.int64, len(batch))
    starts = np.cumsum(lengths + order - 1) - lengths - order + 1
    predicted = np.ones(len(codes), bool)
    for i in range(order - 1):
        predicted[starts + i] = False
    alphabet, symbols = _renumber(codes, 0x110000)
    size, current, parents = len(alphabet), symbols, []
    known = size
    for k in range(2, order + 1):
        pair = current[:-1].astype(np.int64) * size + symbols[k - 1:]
        found, current = _renumber(pair, known * size)
        parents.append(found)
        known = len(found)
    rows = np.empty((known, order), np.uint32)
    at = np.arange(known)
    for k in range(order - 1, 0, -1):
        pair = parents[k - 1][at]
        rows[:, k] = alphabet[pair % size]
        at = pair // size
    rows[:, 0] = alphabet[at]
    ids = np.zeros(len(codes), np.int64)
    ids[order - 1:] = current
    return rows, gram_keys(rows), ids, predicted, starts


def _renumber(values, span: int):
    """The distinct values in order, and each value's place among them."""
    if span > _TABLE:
        return np.unique(values, return_inverse=True)
    flags = np.zeros(span, bool)
    flags[values] = True
    found = np.flatnonzero(flags)
    place = np.zeros(span, np.int32)
    place[found] = np.arange(len(found), dtype=np.int32)
    return found, place[values]


def gram_keys(rows) -> np.ndarray:
    """64-bit hashes of rows of code points."""
    h = np.full(len(rows), 0x9E3779B97F4A7C15, np.uint64)
    for k in range(rows.shape[1]):
        h = (h ^ rows[:, k].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def log_probs(texts, keys, logps, order: int) -> np.ndarray:
    """Per text the sum of the log probabilities of its characters; 0 for an empty text."""
    sums = np.zeros(len(texts))
    for batch in segments(texts, order):
        _, wanted, ids, predicted, starts = gram_ids(batch, order)
        place = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        each = logps[place][ids]
        each[~predicted] = 0.0
        totals = np.add.reduceat(each, starts)
        np.add.at(sums, [i for i, _, _ in batch], totals)
    return sums


def _counter(order: int, all_trusted: bool):
    def merged(parts):
        rows = np.concatenate([p[0] for p in parts])
        keys = np.concatenate([p[1] for p in parts])
        n = np.concatenate([p[2] for p in parts])
        found, first, place = np.unique(keys, return_index=True, return_inverse=True)
        return rows[first], found, np.bincount(place, n, len(found)).astype(np.int64)

    def batches(key: str, part):
        rows, keys, n = part
        for at in range(0, len(keys), 50_000):
            cut = np.ascontiguousarray(rows[at:at + 50_000])
            text = cut.tobytes().decode("utf-32-le", "surrogatepass")
            grams = [text[i:i + order] for i in range(0, len(text), order)]
            size = len(grams)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * size), pa.array(grams),
                 pa.array(keys[at:at + 50_000]), pa.array(n[at:at + 50_000])],
                names=["block", "gram", "key", "n"],
            )

    def count(arrow):
        held: dict[str, list] = {}
        trusted: dict[str, set] = {}
        size = 0
        for batch in arrow:
            groups: dict[tuple, list] = {}
            kinds, blocks, ids, texts = (column.to_pylist() for column in batch.columns)
            for kind, block, name, text in zip(kinds, blocks, ids, texts):
                if kind == 0:
                    trusted.setdefault(block, set()).add(name)
                elif text:
                    known = all_trusted or name in trusted.get(block, ())
                    groups.setdefault((block, known), []).append(text)
            for (block, known), found in groups.items():
                for piece in segments(found, order):
                    rows, keys, places, predicted, _ = gram_ids(piece, order)
                    n = np.bincount(places[predicted], minlength=len(keys))
                    use = n > 0
                    n = n if known else np.zeros_like(n)
                    parts = held.setdefault(block, [])
                    parts.append((rows[use], keys[use], n[use]))
                    size += int(use.sum())
                    if len(parts) > 8:
                        before = sum(len(p[1]) for p in parts)
                        held[block] = [merged(parts)]
                        size += len(held[block][0][1]) - before
            if size > _FLUSH:
                for key, parts in held.items():
                    yield from batches(key, merged(parts))
                held, size = {}, 0
        for key, parts in held.items():
            yield from batches(key, merged(parts))

    return count
