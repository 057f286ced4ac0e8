"""Byte-level BPE by a published rank file: encoding in two tiers, and decoding.

A text is split by the tokenizer's pattern. Tier one: every piece of a megabyte of text is hashed at
once from running sums of its bytes, and a minimal perfect hash over the vocabulary (hash and displace,
one slot per token, none free) gives the only token that the piece can be; the bytes are compared, so a
hit is exact. Tier two, for pieces that are no token: a heap holds the neighbouring parts that can be
merged by rank and place, the parts themselves are a linked list over the piece's bytes, so a piece of
n bytes takes n log n steps. Such pieces repeat, so a worker remembers short ones: at least the last
``REMEMBERED`` different ones, at most twice as many.

The vocabulary is read on the driver and goes to the tasks with the function; its file bounds it.
Texts are encoded where they lie, and nothing is shuffled. A long text is worked through in parts,
cut where white space follows something else: there a piece starts whatever stands on either side.

Defined cases: a null or empty text has no ids, and no ids are the empty text; the strings of special
tokens are ordinary text; an id outside the vocabulary fails the decoding; an empty table gives an
empty result; other columns are kept (``token_ids`` and ``decoded`` are replaced).
"""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusledger.llm.common import staged

#: Fixed value: the pattern whose matches are found by runs of character classes; others by ``regex``.
RUNS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that are worked on at once.
PART = 1 << 20
#: Pieces of at most so many bytes are remembered, so many of them.
SHORT, REMEMBERED = 64, 1 << 18
_PLACE = (1 << 32) - 1
_LETTER, _NUMBER, _SPACE = 1, 2, 3
_U64 = np.uint64
_BASE = _U64(0x9E3779B97F4A7C15)
_BACK = _U64(pow(int(_BASE), -1, 1 << 64))
_KEYS_PER_BUCKET = 4
_SEAM = regex.compile(r"(?<=\S)\s")


@functools.cache
def _classes() -> np.ndarray:
    """The class of every code point: letter, number, white space or (0) another."""
    every = "".join(map(chr, range(0xD800))) + "\0" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    out = np.zeros(len(every), np.uint8)
    for number, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for match in regex.finditer(pattern, every):
            out[match.start():match.end()] = number
    return out


def sizes_by_runs(text: str) -> np.ndarray:
    """The lengths of the matches of ``RUNS``: runs of one class, with these four turns.

    A space before a run of another class belongs to it. So the last of several white-space characters
    before something else stands alone, or goes with what follows; at the text's end they are one match.
    An apostrophe that begins a match takes one of the listed endings; letters behind it begin anew.
    """
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kinds = _classes()[codes]
    new = np.empty(len(codes) + 1, bool)
    new[0] = new[-1] = True
    np.not_equal(kinds[1:], kinds[:-1], out=new[1:-1])
    space = kinds == _SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:])
    new[last] = True
    new[last[codes[last] == 32] + 1] = False
    marks = np.flatnonzero((codes == 39) & new[:-1])
    for at in marks.tolist():
        ending = text[at + 1:at + 3]
        taken = 1 if ending[:1] in ("s", "t") else 2 if ending in ("re", "ve", "ll") else ending[:1] in ("m", "d")
        if ending and taken:
            new[at + 1:at + 1 + taken] = False
            new[at + 1 + taken] = True
    return np.diff(np.flatnonzero(new))


def _by_pattern(pattern: str) -> Callable[[str], np.ndarray]:
    if pattern == RUNS:
        return sizes_by_runs
    found = regex.compile(pattern).findall
    return lambda text: np.fromiter(map(len, found(text)), np.int64)


def _powers(of: np.uint64, number: int) -> np.ndarray:
    out = np.full(number, of, _U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray, salt) -> np.ndarray:
    h = (h + salt) * _U64(0xBF58476D1CE4E5B9)
    h ^= h >> _U64(29)
    h *= _U64(0x94D049BB133111EB)
    return h ^ (h >> _U64(32))


class Hasher:
    """64-bit hashes of slices of a byte array, all at once: differences of running sums."""

    def __init__(self) -> None:
        self.up, self.down = _powers(_BASE, 1), _powers(_BACK, 1)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.up):
            room = 1 << int(len(data)).bit_length()
            self.up, self.down = _powers(_BASE, room), _powers(_BACK, room)
        sums = np.zeros(len(data) + 1, _U64)
        np.cumsum((data.astype(_U64) + _U64(1)) * self.up[:len(data)], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.down[starts]


class Vocabulary:
    """Tokens by id, with the minimal perfect hash from a token's hash to its slot."""

    def __init__(self, tokens: dict[bytes, int]) -> None:
        order = sorted(tokens.items(), key=lambda item: item[1])
        self.tokens = [token for token, _ in order]
        self.ids = np.array([number for _, number in order], np.int32)
        lengths = np.array([len(token) for token in self.tokens], np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.digest = hashlib.sha256(self.bytes.tobytes() + self.ends.tobytes() + self.ids.tobytes()).hexdigest()
        hashes = Hasher()(self.bytes, self.starts, self.ends)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two tokens have one hash")
        self._displace(hashes)

    def _displace(self, hashes: np.ndarray) -> None:
        """For each bucket the salt that sends its tokens to free slots, buckets with most tokens first.

        A bucket of one token names a free slot itself, as -1 - slot; so the last slots cost no search.
        """
        n = len(hashes)
        self.displaced = np.zeros(max(1, n // _KEYS_PER_BUCKET), np.int64)
        self.token_at = np.zeros(n, np.int64)
        buckets = (_mixed(hashes, _U64(0)) % _U64(len(self.displaced))).astype(np.int64)
        by_bucket = np.argsort(buckets, kind="stable")
        sizes = np.bincount(buckets, minlength=len(self.displaced))
        firsts = np.cumsum(sizes) - sizes
        taken = np.zeros(n, bool)
        for bucket in np.argsort(-sizes, kind="stable"):
            size = sizes[bucket]
            if size < 2:
                break
            own = by_bucket[firsts[bucket]:firsts[bucket] + size]
            salt, found = 0, None
            while found is None:
                salts = np.arange(salt + 1, salt + 65, dtype=_U64)
                slots = (_mixed(hashes[own][None, :], salts[:, None]) % _U64(n)).astype(np.int64)
                ordered = np.sort(slots, axis=1)
                fits = ~taken[slots].any(axis=1) & (np.diff(ordered, axis=1) > 0).all(axis=1)
                if fits.any():
                    found = int(fits.argmax())
                    taken[slots[found]] = True
                    self.token_at[slots[found]] = own
                    self.displaced[bucket] = salts[found]
                salt += 64
        single = np.flatnonzero(sizes == 1)
        free = np.flatnonzero(~taken)
        self.displaced[single] = -1 - free
        self.token_at[free] = by_bucket[firsts[single]]

    def places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hasher: Hasher) -> np.ndarray:
        """For each slice of ``data`` its place in ``tokens``, or -1 if it is no token."""
        hashes = hasher(data, starts, ends)
        moved = self.displaced[(_mixed(hashes, _U64(0)) % _U64(len(self.displaced))).astype(np.int64)]
        slots = (_mixed(hashes, moved.astype(_U64)) % _U64(len(self.tokens))).astype(np.int64)
        places = self.token_at[np.where(moved < 0, -1 - moved, slots)]
        lengths = ends - starts
        same = lengths == self.ends[places] - self.starts[places]
        # Byte by byte, for slices of the right length.
        at, size = np.flatnonzero(same), lengths[same]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        differ = (
            data[np.repeat(starts[at], size) + within]
            != self.bytes[np.repeat(self.starts[places[at]], size) + within]
        )
        same[np.repeat(at, size)[differ]] = False
        return np.where(same, places, -1)


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merged(piece: bytes, rank: Callable[[bytes, int], int]) -> list[int]:
    """The ids of a piece that is no token: lowest rank first, leftmost among equal ones.

    ``rank`` is a dictionary's ``get``. Parts are known by the byte they start at; ``best`` has the rank
    of a part joined with the next, and an entry of the heap counts only while it agrees with that.
    """
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n))
    best = [rank(piece[i:i + 2], -1) for i in range(n - 1)]
    best.append(-1)
    heap = [joined << 32 | i for i, joined in enumerate(best) if joined >= 0]
    heapify(heap)
    while heap:
        entry = heappop(heap)
        left = entry & _PLACE
        if best[left] != entry >> 32:
            continue
        middle = after[left]
        end = after[left] = after[middle]
        before[end], best[middle] = left, -1
        joined = best[left] = rank(piece[left:after[end]], -1) if end < n else -1
        if joined >= 0:
            heappush(heap, joined << 32 | left)
        start = before[left]
        if start >= 0:
            joined = best[start] = rank(piece[start:end], -1)
            if joined >= 0:
                heappush(heap, joined << 32 | start)
    ids, i = [], 0
    while i < n:
        ids.append(rank(piece[i:after[i]], -1))
        i = after[i]
    if -1 in ids:
        raise KeyError("a byte of the text is no token of the vocabulary")
    return ids


class Encoder:
    """Encodes texts; one per Python worker and vocabulary."""

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        self.vocabulary, self.sizes = vocabulary, _by_pattern(pattern)
        self.rank = dict(zip(vocabulary.tokens, vocabulary.ids.tolist())).get
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.hasher = Hasher()

    def _missed(self, piece: bytes) -> bytes:
        """The ids of a piece as 32-bit integers."""
        ids = self.older.get(piece) or array("i", merged(piece, self.rank)).tobytes()
        if len(piece) <= SHORT:
            if len(self.known) >= REMEMBERED:
                self.known, self.older = {}, self.known
            self.known[piece] = ids
        return ids

    def _part(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts after each other, and the number of each."""
        found = [self.sizes(text) for text in texts]
        raw = "".join(texts).encode()
        data = np.frombuffer(raw, np.uint8)
        ends = np.cumsum(np.concatenate(found))
        if ends[-1] != len(data):  # from characters to bytes
            firsts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            ends = firsts[ends]
        starts = np.concatenate(([0], ends[:-1]))
        places = self.vocabulary.places(data, starts, ends, self.hasher)
        misses = np.flatnonzero(places < 0)
        lists = []
        for a, b in zip(starts[misses].tolist(), ends[misses].tolist()):
            piece = raw[a:b]
            lists.append(self.known.get(piece) or self._missed(piece))
        counts = np.ones(len(places), np.int64)
        counts[misses] = own = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        out = np.repeat(self.vocabulary.ids[places], counts)
        where = np.cumsum(counts) - counts
        inside = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        out[np.repeat(where[misses], own) + inside] = np.frombuffer(b"".join(lists), np.int32)
        upto = np.concatenate(([0], np.cumsum(counts)))
        edges = upto[np.concatenate(([0], np.cumsum([len(x) for x in found])))]
        return out, np.diff(edges)

    def encode(self, texts: list[str | None]) -> pa.Array:
        """A list of ids for each text."""
        rows, parts, room = [], [], PART
        found, counts = [], np.zeros(len(texts), np.int64)

        def work() -> None:
            ids, numbers = self._part(parts)
            found.append(ids)
            np.add.at(counts, rows, numbers)
            rows.clear()
            parts.clear()

        for row, text in enumerate(texts):
            for part in cut(text) if text else ():
                if parts and len(part) > room:
                    work()
                    room = PART
                rows.append(row)
                parts.append(part)
                room -= len(part)
        if parts:
            work()
        values = np.concatenate(found) if found else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values, pa.int32())
        )


_encoders: dict[tuple[str, str], Encoder] = {}


def _encoder(vocabulary: Vocabulary, pattern: str) -> Encoder:
    """The worker's encoder, with what it remembers from earlier tasks."""
    key = vocabulary.digest, pattern
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary, pattern)
    return _encoders[key]


def cut(text: str) -> Iterator[str]:
    """A text in parts of about ``PART`` characters, cut only where a piece of the pattern starts."""
    at = 0
    while len(text) - at > PART and (seam := _SEAM.search(text, at + PART)):
        yield text[at:seam.start()]
        at = seam.start()
    yield text[at:] if at else text


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``token_ids``, the ids of the column ``text``."""
    vocabulary = Vocabulary(read_ranks(path))

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(vocabulary, pattern)
        for batch in batches:
            yield encoder.encode(batch.to_pylist())

    return docs.withColumn("token_ids", encode(F.col("text")))


def decoded(docs: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """``docs`` with ``decoded``, the bytes that the ids stand for."""
    tokens = {number: token for token, number in read_ranks(path).items()}

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = batch.values.to_numpy(zero_copy_only=False).tolist()
            edges = batch.offsets.to_pylist()
            yield pa.array(
                (b"".join([tokens[i] for i in values[a:b]]) for a, b in zip(edges, edges[1:])),
                pa.binary(),
            )

    return docs.withColumn("decoded", decode(F.coalesce(F.col(ids), F.array().cast("array<int>"))))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, encoded and decoded again."""
    both = decoded(encoded(docs.select("doc_id", "text"), path, pattern), path)
    joined: Column = F.concat_ws(",", F.col("token_ids").cast("array<string>"))
    return staged(both.select(
        "doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    ), "tokens")
