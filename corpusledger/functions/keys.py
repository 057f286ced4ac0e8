"""Seeded order keys and position buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A bucket of seeded order should hold at most about this many rows.
BUCKET_ROWS = 1 << 18
#: Leading bits of the order key that number its bucket where the dump sizes are not known.
DEFAULT_BITS = 12
#: Bits of the key a bucket number may use.
KEY_BITS = 32
#: ``id >> ID_BUCKET_BITS`` is the bucket of a unique integer id, so a bucket never holds more
#: than 2**20 rows however the rows are spread over dumps.
ID_BUCKET_BITS = 20


def shuffle_key(seed: int, dump: Column | str, doc_id: Column | str) -> Column:
    """A pseudo-random order that depends on the seed and the document only.

    Partitioning, retries and file layout do not change it, so a rerun replays the same order.
    """
    dump, doc_id = _col(dump), _col(doc_id)
    return F.md5(F.concat_ws(":", F.lit(str(seed)), dump, doc_id.cast("string")))


def bucket_bits(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Leading key bits that split a dump of ``rows`` rows into buckets of about ``bucket_rows``."""
    bits = 6
    while rows > bucket_rows << bits and bits < KEY_BITS:
        bits += 1
    return bits


def id_bits(rows: int, last: int, bucket_rows: int) -> int:
    """Last bits of ids up to ``last`` that leave out about ``bucket_rows`` of a dump's ``rows`` ids."""
    bits = 0
    while (rows << bits + 1) <= bucket_rows * (last + 1) and bits < ID_BUCKET_BITS:
        bits += 1
    return bits


def key_bucket(key: Column | str, bits: int | Column = DEFAULT_BITS) -> Column:
    """Number of an order key's bucket: its leading bits, uniform whatever the dump sizes are."""
    head = F.conv(F.substring(_col(key), 1, KEY_BITS // 4), 16, 10).cast("bigint")
    shift = F.lit(KEY_BITS) - (F.lit(bits) if isinstance(bits, int) else bits)
    return F.call_function("shiftright", head, shift)


def id_bucket(doc_id: Column | str, bits: int | Column = ID_BUCKET_BITS) -> Column:
    """Bucket of a unique integer id, monotone in the id: the id without its last ``bits``.

    Meant for ids that number documents. Random 64-bit ids would get a bucket each, and the
    running sum over buckets would be as long as the dump; number such documents first.
    """
    return F.call_function("shiftright", _col(doc_id), F.lit(bits) if isinstance(bits, int) else bits)


def dump_of_shard(name: Column | str) -> Column:
    """Dump name inside a shard name: everything before the last dash."""
    return F.regexp_extract(_col(name), r"^(.*)-[^-]*$", 1)


def shard_name(dump: Column | str, shard: Column | str) -> Column:
    """``{dump}-{shard:05d}.parquet``"""
    return F.format_string("%s-%05d.parquet", _col(dump), _col(shard))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
