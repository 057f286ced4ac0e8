"""The pipeline: every stage's rows against direct computations on what the stage before kept."""

from collections import Counter

import corpus_pipeline
from corpusledger.llm.common import staged

from . import test_circulant_minhash, test_decontaminate, test_mixing, test_quality_rules
from .shared import SCHEMA, empty, messy, prose

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(staged(stage(spark, kept[-1], SF), name.split()[0]))
    columns = docs.columns
    assert all(df.columns == columns for df in kept[:-1])
    rows = [df.collect() for df in kept]
    held = [[r["doc_id"] for r in own] for own in rows]

    for r in rows[0]:  # plain rules take effect
        n, *_, repeated = test_quality_rules.brute_measures(r["text"])
        if n < 10 or 100 * repeated > 20 * n:
            assert r["doc_id"] not in held[1]
    assert len(held[1]) > 0.8 * len(held[0])

    groups = test_circulant_minhash.brute([(r["doc_id"], r["text"]) for r in rows[1]])
    assert sorted(held[2]) == sorted(doc for doc, _, _, stays in groups.elements() if stays)

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = {doc for doc, _ in test_decontaminate.brute([(r["doc_id"], r["text"]) for r in rows[2]], items)}
    assert sorted(held[3]) == sorted(set(held[2]) - hits)

    taken = {r["doc_id"]: r["repeats"] for r in test_mixing.check(kept[3])}
    assert Counter(held[4]) == Counter({doc: n for doc, n in taken.items() if n})

    assert sorted(held[5]) == sorted(held[4])
    places = Counter(r["shard"] for r in rows[5])
    assert {(r["shard"], r["slot"]) for r in rows[5]} == {(s, i) for s, n in places.items() for i in range(n)}


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "shard", "slot"} <= set(out.columns)


def test_stages_on_messy_and_empty_tables(spark):
    for docs in (messy(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = staged(stage(spark, docs, SF), name.split()[0])
            out.collect()
            if stage is not corpus_pipeline.STAGES[-1][1]:
                assert out.dtypes == docs.dtypes
                assert not {tuple(r) for r in out.collect()} - {tuple(r) for r in docs.collect()}
        assert docs.columns


def test_copies_and_benchmarks_of_rows_without_own_ids(spark):
    """Rows with null or repeated ids are judged by their own texts; nothing else is lost."""
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    texts = [prose(i, 60) for i in range(6)]
    rows = [(None, texts[0], "en", "a", 1), (None, texts[0], "en", "a", 1), (None, texts[1], "en", "a", 1),
            (1, texts[2], "en", "a", 1), (1, texts[3], "en", "a", 1), (2, texts[3], "en", "b", 1),
            (None, f"{texts[4]} {bench}", "en", "a", 1), (3, texts[5], "en", "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    _, copies = corpus_pipeline.STAGES[1]
    left = staged(copies(spark, docs, SF), "left")
    assert sorted(r["text"] for r in left.collect()) == sorted({r[1] for r in rows})
    assert {r["doc_id"] for r in left.where(left.text == texts[3]).collect()} == {1}
    _, benchmarks = corpus_pipeline.STAGES[2]
    clean = benchmarks(spark, docs, SF).collect()
    assert sorted(r["text"] for r in clean) == sorted(r[1] for r in rows if not r[1].endswith(bench))
