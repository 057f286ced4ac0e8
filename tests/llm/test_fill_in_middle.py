"""Fill-in-middle outputs against a direct computation and an exact round trip."""

import hashlib
import re

import pytest

from corpusledger.llm import fill_in_middle as op

from .shared import SCHEMA, empty, messy


def brute(doc, text, rate=100, suffix_first=50, unit=r"[^\n]*\n|[^\n]+", seed=7):
    text = text or ""
    units = re.findall(unit, text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc, n, "plain", text, None, None
    if h[3] % 100 < suffix_first:
        return doc, n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return doc, n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


def check(df, **kinds):
    done = op.fill_in_middle(df, **kinds)
    back = done.select("doc_id", "text", "fim.*", op.restored(done["fim.output"], done["fim.form"]).alias("back"))
    rows = back.collect()
    key = lambda row: tuple((x is None, x) for x in row)
    got = sorted(((r["doc_id"], r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"]) for r in rows), key=key)
    wanted = sorted((brute(r["doc_id"], r["text"], **kinds) for r in df.select("doc_id", "text").collect()), key=key)
    assert got == wanted
    assert all(r["back"] == (r["text"] or "") for r in rows)
    return rows


def test_documents(spark):
    rows = check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert {r["form"] for r in rows} >= {"psm", "spm"} and any(r["prefix_chars"] and r["middle_chars"] for r in rows)


def test_messy_rows(spark):
    docs = messy(spark)
    assert len(check(docs)) == docs.count()
    assert op.fill_in_middle(docs).columns == [*docs.columns, "fim"]
    assert op.digests(op.fill_in_middle(empty(spark))).count() == 0


@pytest.mark.parametrize("kinds", [
    {"rate": 40}, {"suffix_first": 0}, {"suffix_first": 100}, {"seed": 3}, {"unit": r"\S*\s|\S+"}, {"rate": 0},
])
def test_parameters(spark, kinds):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60), **kinds)


def test_markers_dollars_and_odd_ends(spark):
    texts = [
        "a <P> b\n", "<S>", "x<M>", "<P\n>", "<\nP>", "$1 \\2 $\n${name}\n\\", "\n\n\n", "\r\n\r\n", "a\rb c\u0085d\n",
        "no end", "<S\n<M\n<\n", "é\U0001f600\n漢\n\U0001f600", "\x00\n\x00",
    ]
    rows = check(spark.createDataFrame([(i * 13 + j, t, None, None, 0) for i, t in enumerate(texts) for j in range(13)], SCHEMA))
    assert sum(r["form"] == "plain" for r in rows) == 39


def test_long_texts(spark):
    texts = ["ab\n" * 400_000, "x" * 1_000_000, "\n" * 500_000, "é\n" * 3 + "y" * 300_000]
    check(spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], SCHEMA))


def test_only_column_functions(spark, capsys):
    op.digests(op.fill_in_middle(messy(spark))).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan
