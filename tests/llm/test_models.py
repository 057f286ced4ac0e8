"""Classifier and language identification: held-out accuracy and defined cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusledger.llm import language_id, quality_classifier

from .shared import empty, messy, prose

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = language_id.identify(docs)
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    right = [r["lang"] == r["lang_pred"] for r in held]
    assert len(held) > 150 and np.mean(right) >= 0.97
    sure = [r["lang"] == r["lang_pred"] for r in held if not r["rejected"]]
    assert np.mean(sure) >= 0.98 and len(sure) > 0.8 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_learns_only_from_the_other_folds(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    hidden = docs.withColumn("lang", F.when(language_id.fold() != 2, F.col("lang")).otherwise("zz"))
    wanted = sorted(map(tuple, language_id.identify(docs).collect()))
    assert sorted(map(tuple, language_id.identify(hidden).collect())) == wanted


def test_features_against_definition():
    used, share = language_id.features("Aé 漢")
    assert share.sum() == pytest.approx(1) and len(used) <= 12
    assert sum(map(len, language_id.hashed("abc"))) == 4 + 3 + 2


def test_language_messy(spark):
    docs = messy(spark)
    rows = language_id.identify(docs).collect()
    assert len(rows) == docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"]}
    for r in rows:
        if r["doc_id"] and not any(c.isalpha() for c in texts[r["doc_id"]] or ""):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        assert r["lang_pred"] in ("en", "fr", "xx", "und")
    assert language_id.identify(empty(spark)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_classifier_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    trusted = labels.where("quality = 1 AND doc_id % 3 <> 0").select("doc_id")
    out = quality_classifier.classify(docs, trusted)
    rows = out.join(labels, "doc_id").collect()
    assert out.count() == docs.count()
    good = [r["accepted"] for r in rows if r["quality"] == 1 and not r["trusted"]]
    bad = [r["measure"] for r in rows if r["quality"] == 0]
    fine = [r["measure"] for r in rows if r["quality"] == 1 and not r["trusted"]]
    assert np.mean(good) >= 0.95
    order = np.mean([b > f for b in bad for f in fine])
    assert order > 0.8


def test_classifier_rejects_other_text(spark):
    rows = [(i, prose(i, 150, 80), "en") for i in range(60)]
    rows += [(100 + i, "".join(chr(33 + (j * 31 * (i + 1) + j * j) % 90) for j in range(500)), "en") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = quality_classifier.classify(docs, spark.range(40).withColumnRenamed("id", "doc_id")).collect()
    accepted = {r["doc_id"] for r in out if r["accepted"]}
    assert not accepted & set(range(100, 105)) and len(accepted & set(range(40, 60))) >= 18


def test_classifier_messy(spark):
    docs = messy(spark)
    trusted = spark.createDataFrame([(1,), (1,), (None,), (9,), (77,)], "doc_id bigint")
    rows = quality_classifier.classify(docs, trusted).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["trusted"] == (r["doc_id"] in (1, 9))
        if r["log_perplexity"] is None:
            assert not r["accepted"]
    nobody = quality_classifier.classify(docs, trusted.where("doc_id = 77")).collect()
    assert not any(r["accepted"] for r in nobody)
    assert quality_classifier.classify(empty(spark), trusted).count() == 0


def test_language_sample_is_bounded_and_the_smallest_hashes(spark, monkeypatch):
    """Hot ids and rows, ids with several texts and null ids: never more than the bound, and which ones."""
    rows = [(1, f"same id, text {i % 3}", "en") for i in range(300)] + [(i, f"text {i}", "en") for i in range(2, 90)]
    rows += [(None, f"none {i % 7}", "fr") for i in range(500)] + [(1, "same id, text 0", "fr")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(6)
    keyed = docs.where(language_id.fold() != 2).select("lang", F.xxhash64("doc_id", "text").alias("h")).distinct()
    for sample, most in ((20, 10**6), (1_000, 10**6), (20, 10)):
        monkeypatch.setattr(language_id, "MOST", most)
        found = language_id.sampled(docs, sample).collect()
        each = min(sample, most // 2)
        for lang in ("en", "fr"):
            ranks = sorted(r["rank"] for r in found if r["lang"] == lang)
            wanted = min(each, keyed.where(F.col("lang") == lang).count())
            assert ranks == list(range(1, wanted + 1))
    chosen = language_id._smallest(keyed.withColumnRenamed("h", "hash"), 15).collect()
    for lang in ("en", "fr"):
        every = sorted((r["h"] % (1 << 64) for r in keyed.where(F.col("lang") == lang).collect()))
        assert sorted(r["hash"] % (1 << 64) for r in chosen if r["lang"] == lang) == every[:15]


def test_language_predictions_against_definition():
    """Scores from the n-grams counted one by one."""
    rng = np.random.default_rng(3)
    table = rng.normal(size=(language_id.BUCKETS, 3)).astype(np.float32)
    langs = ["aa", "bb", "cc"]
    texts = [prose(i, 30) for i in range(12)] + ["x", "É 漢字", "12 !", None, ""]
    for text, (lang, score) in zip(texts, language_id.predict(texts, langs, table, 0.7)):
        if not text or not any(c.isalpha() for c in text):
            assert (lang, score) == ("und", 0.0)
            continue
        padded = f" {text.lower()} "
        logits, number = np.zeros(3), 0
        for n in (2, 3, 4):
            for i in range(len(padded) - n + 1):
                h = 0
                for j, c in enumerate(padded[i:i + n]):
                    code = ord(c) * 0x9E3779B1 % 2**32
                    h = code if not j else ((h ^ h >> 15) * 0x85EBCA6B + code) % 2**32
                logits += table[((h ^ h >> 13) * 0xC2B2AE35 % 2**32) >> 17]
                number += 1
        shares = np.exp((logits / number - (logits / number).max()) / 0.7)
        shares /= shares.sum()
        assert lang == langs[int(shares.argmax())] and score == pytest.approx(shares.max(), rel=1e-6)
