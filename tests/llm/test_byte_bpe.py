"""Byte-level BPE against the tiktoken library, and decoding as an exact round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from corpusledger.llm import byte_bpe as op

from .shared import empty, messy

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
LETTERS = "'s tre vmld12 \n\t\x1c\x85　é漢́\U0001f600.,!A_"


@pytest.fixture(scope="module")
def ranks():
    return op.read_ranks(PATH)


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return op.Vocabulary(ranks)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(number, seed=5, most=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, most))) for _ in range(number)]


def test_hash_is_minimal_and_perfect(vocabulary):
    n = len(vocabulary.tokens)
    assert sorted(vocabulary.token_at.tolist()) == list(range(n))
    places = vocabulary.places(vocabulary.bytes, vocabulary.starts, vocabulary.ends, op.Hasher())
    assert places.tolist() == list(range(n))


def test_hash_refuses_what_is_no_token(vocabulary):
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 200_000).astype(np.uint8)
    starts = rng.integers(0, len(data) - 9, 50_000)
    ends = starts + rng.integers(1, 9, len(starts))
    known = {token: i for i, token in enumerate(vocabulary.tokens)}
    wanted = [known.get(data[a:b].tobytes(), -1) for a, b in zip(starts, ends)]
    assert vocabulary.places(data, starts, ends, op.Hasher()).tolist() == wanted


def test_small_vocabularies():
    for tokens in ({b"a": 0}, {b"a": 5, b"b": 3}, {bytes([i]): i for i in range(256)}):
        own = op.Vocabulary(tokens)
        assert own.places(own.bytes, own.starts, own.ends, op.Hasher()).tolist() == list(range(len(tokens)))


def test_pattern_by_runs():
    assert op.RUNS == PATTERN
    found = regex.compile(PATTERN).findall
    words = ["'s", "'re", "'ll", "'", "''s", " 's", "\n's", "'d've", "!'s", "'sa's", "s'", "'v", "'l", "1's2"]
    rng = random.Random(2)
    mixed = ["".join(rng.choice(words) for _ in range(6)) for _ in range(500)]
    for text in random_texts(3_000) + words + mixed:
        if text:
            assert op.sizes_by_runs(text).tolist() == [len(x) for x in found(text)], repr(text)


def test_every_code_point(vocabulary, library):
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}{c} {c}b1{c}  {c}\n" for c in every[i:i + 64]) for i in range(0, len(every), 64)]
    assert op.Encoder(vocabulary, PATTERN).encode(texts).to_pylist() == library.encode_ordinary_batch(texts)


def test_random_texts(vocabulary, library, monkeypatch):
    texts = random_texts(2_000)
    wanted = library.encode_ordinary_batch(texts)
    assert op.Encoder(vocabulary, PATTERN).encode(texts).to_pylist() == wanted
    assert op.Encoder(vocabulary, f"(?:{PATTERN})").encode(texts).to_pylist() == wanted
    monkeypatch.setattr(op, "PART", 7)
    monkeypatch.setattr(op, "REMEMBERED", 5)
    small = op.Encoder(vocabulary, PATTERN)
    assert small.encode(texts).to_pylist() == wanted and len(small.known) <= 5 and len(small.older) <= 5


def test_long_pieces(vocabulary, library):
    texts = ["ab" * 40_000 + "c" * 20_000, "\n" * 30_000, "é" * 30_000 + " " * 30_000 + "x", "0" * 10_001]
    assert op.Encoder(vocabulary, PATTERN).encode(texts).to_pylist() == library.encode_ordinary_batch(texts)


def test_no_token_for_a_byte():
    with pytest.raises(KeyError):
        op.Encoder(op.Vocabulary({b"a": 0, b"b": 1}), PATTERN).encode(["abc"])


def check(df, library):
    rows = op.digests(df, PATH, PATTERN).collect()
    wanted = []
    for row in df.select("doc_id", "text").collect():
        ids = library.encode_ordinary(row["text"] or "")
        sha = lambda data: hashlib.sha256(data).hexdigest()
        wanted.append((row["doc_id"], len(ids), sha(",".join(map(str, ids)).encode()), sha((row["text"] or "").encode())))
    order = lambda row: tuple((x is None, x) for x in row)
    assert sorted(map(tuple, rows), key=order) == sorted(wanted, key=order)


def test_documents(spark, library):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), library)


def test_messy_rows(spark, library):
    check(messy(spark), library)
    both = op.decoded(op.encoded(messy(spark), PATH, PATTERN), PATH)
    assert both.columns == [*messy(spark).columns, "token_ids", "decoded"]
    assert op.digests(empty(spark), PATH, PATTERN).count() == 0


def test_null_ids_decode_to_nothing(spark):
    df = spark.createDataFrame([(None,), ([],), ([64, 65],)], "token_ids array<int>")
    decoded = [bytes(r["decoded"]) for r in op.decoded(df, PATH).collect()]
    tokens = {i: t for t, i in op.read_ranks(PATH).items()}
    assert decoded == [b"", b"", tokens[64] + tokens[65]]


def test_encoded_once(spark, capsys):
    both = op.decoded(op.encoded(messy(spark), PATH, PATTERN), PATH)
    both.selectExpr("size(token_ids)", "concat_ws(',', token_ids)", "decoded").explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 2
