"""Token counters: one pinned definition, several interchangeable implementations.

The count of a document is the number of token ids of its unmodified text, without special
tokens, truncation or padding.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpusledger.runtime import ship_file

#: Fixed value: runs of letters, single digits, runs of other visible characters.
WORD_PATTERN = r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: Fixed value: as above, but a run of digits is one token.
WORD_PATTERN_DIGIT_RUNS = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+"

KINDS = ("regex", "bpe_fast", "bpe_batch", "bpe_ranks")


@dataclass(frozen=True)
class CounterSpec:
    """Which counter to use.

    ``regex``      native regular expression ``pattern``; no Python worker involved
    ``bpe_fast``   tokenizer file at ``path``, batch encoding without offsets
    ``bpe_batch``  tokenizer file at ``path``, plain batch encoding
    ``bpe_ranks``  rank file at ``path`` split by ``pattern`` before merging
    """

    kind: str
    path: str | None = None
    pattern: str = WORD_PATTERN
    batch_size: int = 1024

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"Unknown counter {self.kind!r}; expected one of {KINDS}")
        if self.batch_size < 1:
            raise ValueError("Batch size must be positive")
        if self.kind != "regex" and not self.path:
            raise ValueError(f"Counter {self.kind!r} needs a vocabulary file")


def token_count(spark: SparkSession, spec: CounterSpec) -> Callable[[Column | str], Column]:
    """A function from a text column to its ``bigint`` token count.

    Several counters of one text share a Python worker, which gets the text once.
    """
    if spec.kind == "regex":
        return lambda text: F.regexp_count(text, F.lit(spec.pattern)).cast("bigint")

    encoder = _opened_once(_encoder(spec, ship_file(spark, spec.path), lambda item: item))
    size = spec.batch_size

    @F.arrow_udf("bigint")
    def count(batch: pa.Array) -> pa.Array:
        encode = encoder()
        lengths: list[int] = []
        for start in range(0, len(batch), size):
            texts = batch.slice(start, size).to_pylist()
            if None in texts:
                raise TypeError("cannot count the tokens of a null text")
            lengths.extend(map(len, encode(texts)))  # of encodings, not of lists of ids
        return pa.array(lengths, pa.int64())

    return count


def token_ids_digest(spark: SparkSession, spec: CounterSpec) -> Callable[[Column | str], Column]:
    """Count and SHA-256 of the comma-joined token ids; the ids never leave the worker."""
    if spec.kind == "regex":
        raise ValueError("The regex counter has no token ids")
    encoder = _opened_once(_encoder(spec, ship_file(spark, spec.path), lambda item: item.ids))
    size = spec.batch_size

    @F.arrow_udf("struct<token_count: bigint, token_ids_sha256: string>")
    def digest(batch: pa.Array) -> pa.Array:
        from hashlib import sha256

        encode = encoder()
        lengths: list[int] = []
        hashes: list[str] = []
        for start in range(0, len(batch), size):
            texts = batch.slice(start, size).to_pylist()
            if None in texts:
                raise TypeError("cannot count the tokens of a null text")
            for ids in encode(texts):
                lengths.append(len(ids))
                hashes.append(sha256(",".join(map(str, ids)).encode()).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(lengths, pa.int64()), pa.array(hashes, pa.string())],
            names=["token_count", "token_ids_sha256"],
        )

    return digest


def _opened_once(open_encoder: Callable) -> Callable:
    """``open_encoder`` with its result kept; each task gets a copy that has opened nothing yet."""
    opened: list = []

    def encoder() -> Callable[[list[str]], list]:
        if not opened:
            opened.append(open_encoder())
        return opened[0]

    return encoder


def _encoder(
    spec: CounterSpec, name: str, wanted: Callable
) -> Callable[[], Callable[[list[str]], list]]:
    """A worker-side opener of the vocabulary; called once per task.

    ``wanted`` picks what is needed of an encoding: itself, if only its length counts, or its ids.
    """
    kind, pattern = spec.kind, spec.pattern

    def open_ranks() -> Callable[[list[str]], list]:
        import tiktoken

        with open(SparkFiles.get(name), "rb") as lines:
            pairs = (line.split() for line in lines)
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        encoding = tiktoken.Encoding(
            name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        return lambda texts: [encoding.encode_ordinary(text) for text in texts]

    def open_tokenizer() -> Callable[[list[str]], list]:
        # One task slot is one core: threads inside the library would oversubscribe the host.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(SparkFiles.get(name))
        tokenizer.encode_special_tokens = True
        encode = tokenizer.encode_batch_fast if kind == "bpe_fast" else tokenizer.encode_batch
        return lambda texts: [wanted(item) for item in encode(texts, add_special_tokens=False)]

    return open_ranks if kind == "bpe_ranks" else open_tokenizer
