"""Quality classifier: perplexity under a model of trusted text, thresholds per language.

The interpolated modified Kneser-Ney model of ``kneser_ney`` is estimated from trusted documents
only; its counts are joined shard by shard with the n-grams of all documents. Every ``FOLDS``-th
trusted document, by a hash of its id, is not learned from: per language, the threshold follows from
the quantiles of these, the larger of the ``SHARE`` quantile and ``REACH`` interquartile ranges above
the upper quartile. So a document is rejected only if it is odder than nearly all trusted ones that
the model has not seen. Short texts scatter more: the measure that is compared is the log perplexity
per character less ``NOISE`` over the root of the length.

Defined cases: null and empty texts have a null perplexity and are not accepted; a null language is
the language ``und``; a language without unseen trusted documents takes its threshold from the learned
ones, and one without any trusted document the highest of the others;
without any trusted document nothing is accepted; a document with several labels is trusted if any of
them says so; labels of no document do nothing; an empty table gives an empty result. Rows with a null
doc_id are scored but never trusted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusledger.llm import kneser_ney as lm
from corpusledger.llm.common import quantiles, staged

SHARE = 0.999
REACH = 2.0
FOLDS = 5
NOISE = 2.0
STEP = 0.001


def classify(docs: DataFrame, trusted: DataFrame, text: str = "text", lang: str = "lang",
             identity: str = "doc_id", order: int = lm.ORDER, share: float = SHARE) -> DataFrame:
    """(identity, lang, log_perplexity, measure, threshold, trusted, accepted) of every row.

    ``trusted`` has the identities of the trusted documents.
    """
    rows = docs.select(identity, text, F.col(lang).alias("lang"))
    blocks = lm.blocks_of(rows, text, "lang")
    blocked = lm.with_blocks(rows, blocks, text, "lang", identity)
    marked = trusted.select(identity).where(F.col(identity).isNotNull()).distinct()
    unseen = F.pmod(F.crc32(F.col(identity).cast("string").cast("binary")), F.lit(FOLDS)) == 0
    # The identities' blocks need no text: only rows without an identity are dealt by it.
    narrow = rows.select(identity, F.lit(None).cast("string").alias(text), "lang").join(marked.where(~unseen), identity)
    marks = staged(lm.with_blocks(narrow, blocks, text, "lang", identity).select(identity, "__block").distinct(), "trusted")
    counts = staged(lm.block_counts(blocked, blocks, text, identity, marks, order), "counts")
    model = lm.estimate(counts, order)
    scored = lm.score(blocked, text, counts, model, order, "", lambda texts: [])
    length = F.length(F.coalesce(F.col(text), F.lit("")))
    each = F.when(length > 0, -F.col("log_prob") / length)
    narrow = scored.select(
        identity, "lang", each.alias("log_perplexity"),
        (each - NOISE / F.sqrt(F.greatest(length, F.lit(1)))).alias("measure"),
    )
    measured = staged(narrow, "measured")
    known = marked.select(F.col(identity).alias("__known")).withColumn("__trusted", F.lit(True))
    full = staged(
        measured.join(known, F.col(identity) == F.col("__known"), "left")
        .withColumn("trusted", F.coalesce("__trusted", F.lit(False)))
        .withColumn("__lang", lm.language()).drop("__known", "__trusted"),
        "judged",
    )
    limits = staged(
        _limits(full.where(F.col("trusted")), share, "any")
        .join(_limits(full.where(F.col("trusted") & unseen), share, "fair"), "__lang", "left")
        .select("__lang", F.coalesce("fair", "any").alias("threshold")),
        "limits",
    )
    highest = limits.agg(F.max("threshold")).first()[0]
    limit = F.coalesce("threshold", F.lit(highest).cast("double"))
    return full.join(limits, "__lang", "left").select(
        identity, "lang", "log_perplexity", "measure", limit.alias("threshold"), "trusted",
        F.coalesce(F.col("measure") <= limit, F.lit(False)).alias("accepted"),
    )


def _limits(measured: DataFrame, share: float, name: str) -> DataFrame:
    found = quantiles(measured, "__lang", "measure", STEP, {"q1": 0.25, "q3": 0.75, "high": share})
    fence = F.col("q3") + REACH * (F.col("q3") - F.col("q1"))
    return found.select("__lang", F.greatest("high", fence).alias(name))
