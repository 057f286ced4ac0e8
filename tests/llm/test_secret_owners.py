"""Spans against Python's regular expressions, verdicts against direct counts."""

import hashlib
import re

from corpusledger.llm import secret_owners as op

from .shared import SCHEMA, empty, messy

ASSIGN = re.compile(
    r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(found)


def named(spans):
    return ",".join(f"{op.KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def check(docs, column="text"):
    out = op.secrets(docs).collect()
    wanted = sorted(
        (str(r["doc_id"]), hashlib.sha256(named(base(r["text"])).encode()).hexdigest(),
         *(sum(k == kind for _, k, _ in base(r["text"])) for kind in range(3)))
        for r in docs.collect()
    )
    got = sorted(
        (str(r["doc_id"]), r["base_sha256"], r["n_assign"], r["n_access"], r["n_hex"]) for r in out
    )
    assert got == wanted
    return out


def test_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_odd_texts(spark):
    texts = [
        "token=token:abcdefgh", "password = 'hunter2x' API_KEY:\"abc.def-1/2+3\" apikey=a", "é\U0001f600 Secret==value77",
        "PASSWD:  \tnope", "passwd\" : x12345", "AKIA" + "A" * 15, "xAKIA" + "B" * 16 + "AKIA" + "C" * 20, "AKIAAKIAAKIA" + "D" * 12,
        "0" * 23, "f" * 24 + "g" + "a" * 30, "token=" + "ab12" * 10, "ſecret=abcdef Key", "secret=\nabcdef", "token:=abcdef",
        " ".join(f"token={i:08d}" for i in range(300)),
    ]
    rows = [(i, text, "en", f"s{i % 2}", 0) for i, text in enumerate(texts)]
    out = check(spark.createDataFrame(rows, SCHEMA))
    for r in out:
        assert set(filter(None, named(base(texts[r["doc_id"]])).split(","))) <= set(r["spans"].split(","))


def test_ownership(spark):
    live, copied = "Zk3xQ9pLm2Wv8Rt5Yb7c", "Qw8eRt5yUi2oPa9sDf3g"
    rows = [(1, f"a {live} b", "en", "a", 0), (2, f"again {live}", "en", "a", 0)]
    rows += [(10 + i, f"sample {copied} there", "en", f"s{i}", 0) for i in range(4)]
    rows += [(20, "plainwordthatislongbutnotoken zzzzzzzzzzzzzzzzzzzzzzzz1", "en", "a", 0)]
    rows += [(30 + i, "password=example123456", "en", f"s{i}", 0) for i in range(3)]
    out = {r["doc_id"]: r for r in op.secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[1]["spans"] == f"token:2:{2 + len(live)}" and out[1]["n_token"] == 1
    assert out[2]["n_token"] == 1 and out[10]["spans"] == "" and out[20]["spans"] == ""
    assert out[30]["n_copied"] == 1 and out[30]["spans"] == "assign:0:22"
    held = spark.createDataFrame(
        [("h", f"o{i % 3}", f"r{i}", 12) for i in range(9)] + [("g", "o", "r", 12), ("k", "o", "r", 3)],
        "hash string, owner string, repository string, distinct int",
    )
    rows = {r["hash"]: (r["owners"], r["repositories"], r["verdict"]) for r in op.ownership(held).collect()}
    assert rows == {"h": (3, 9, "copied"), "g": (1, 1, "live"), "k": (1, 1, "unclear")}


def test_messy(spark):
    check(messy(spark))
    assert op.secrets(empty(spark)).count() == 0


def test_repositories_decide_too(spark):
    """Verdicts counted by hand: pasted by one owner, a few of a large owner's documents, two owners."""
    example, few, one, two = ("password=" + x for x in ("exampleABCDEF123", "liveZYXWVU987654", "singleQPONML4321", "pairedHGFEDC5678"))
    rows = [(i, example, "en", "big", 0) for i in range(12)] + [(20 + i, few, "en", "big", 0) for i in range(9)]
    rows += [(40, one, "en", "big", 0), (41, two, "en", "a", 0), (42, two, "en", "b", 0), (40, one, "en", "big", 0)]
    rows += [(None, one, "en", "big", 0), (None, one, "en", "big", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {}
    for r in check(docs):
        found.setdefault(r["doc_id"], set()).add((r["n_live"], r["n_copied"], r["max_owners"], r["max_repositories"]))
    assert found[0] == {(0, 1, 1, 12)} and found[20] == {(1, 0, 1, 9)}
    assert found[40] == found[None] == {(1, 0, 1, 2)} and found[41] == found[42] == {(0, 0, 2, 2)}
    # Ten documents of an owner of more than ten thousand are neither an example nor one owner's slip.
    held = spark.createDataFrame([("h", "o", f"r{i}", 12) for i in range(10)], "hash string, owner string, repository string, distinct int")
    for size, verdict in ((10_000, "copied"), (10_001, "unclear")):
        sizes = spark.createDataFrame([("o", size), ("other", 5)], "owner string, size bigint")
        assert op.ownership(held, sizes).first()["verdict"] == verdict
