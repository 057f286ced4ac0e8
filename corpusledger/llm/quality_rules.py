"""Quality rules: plain counts per document, and perplexity bands per language.

The language model is a character model estimated from all documents (``kneser_ney``). A document
is rejected when a plain rule fails, or when its log perplexity lies outside its language's band:
``reach`` interquartile ranges below the lower or above the upper quartile of the documents that
pass the plain rules, and wider by ``NOISE`` over the root of the document's length, as short texts
scatter more. Bands follow the corpus; a language of ordinary documents loses none.

Defined cases: a null or empty text has no words, fails the plain rules and has a null perplexity;
a null language is the language ``und``; repeated rows are judged each for itself; an empty table
gives an empty table. All columns of the input are returned first; the operator's own columns
replace input columns of the same names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusledger.llm import kneser_ney as lm
from corpusledger.llm.common import quantiles, staged

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: Interquartile ranges beyond the quartiles, and the least range taken (nats per character).
REACH = 2.0
LEAST_RANGE = 0.02
NOISE = 2.0
STEP = 0.001
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
OWN = [*MEASURES, "log_prob", "log_perplexity", "lower_band", "upper_band", "base_failed", "kept"]


def measured(docs: DataFrame, text: str = "text", lang: str = "lang", identity: str = "doc_id",
             order: int = lm.ORDER) -> DataFrame:
    """``docs`` with the plain counts, ``log_perplexity`` per character and ``base_failed``."""
    plain = docs.drop(*(set(OWN) - {text, lang, identity}))
    blocks = lm.blocks_of(plain, text, lang)
    blocked = lm.with_blocks(plain, blocks, text, lang, identity)
    counts = staged(lm.block_counts(blocked, blocks, text, identity, None, order), "counts")
    model = lm.estimate(counts, order)
    more = ", ".join(f"{name} bigint" for name in MEASURES)
    scored = lm.score(blocked, text, counts, model, order, more, base_measures)
    chars = F.length(F.coalesce(F.col(text), F.lit("")))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return scored.withColumns(
        {
            "log_perplexity": F.when(chars > 0, -F.col("log_prob") / chars),
            "base_failed": failed,
        }
    )


def judged(scored: DataFrame, lang: str = "lang", reach: float = REACH) -> DataFrame:
    """``measured`` rows with their language's band and ``kept``; read ``scored`` twice."""
    named = scored.withColumn("__lang", lm.language(lang))
    held = quantiles(
        named.where(~F.col("base_failed")), "__lang", "log_perplexity", STEP, {"q1": 0.25, "q3": 0.75}
    )
    spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(LEAST_RANGE)) * reach
    bands = held.select(
        "__lang", (F.col("q1") - spread).alias("lower_band"), (F.col("q3") + spread).alias("upper_band")
    )
    value = F.col("log_perplexity")
    noise = NOISE / F.sqrt(F.greatest(F.col("word_chars"), F.lit(1)))
    inside = value.between(F.col("lower_band") - noise, F.col("upper_band") + noise)
    return (
        named.join(bands, "__lang", "left")
        .withColumn("kept", F.coalesce(~F.col("base_failed") & inside, F.lit(False)))
        .drop("__lang")
    )


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", identity: str = "doc_id",
                  order: int = lm.ORDER, reach: float = REACH) -> DataFrame:
    """Every row of ``docs`` with its counts, perplexity, band and ``kept``."""
    scored = staged(measured(docs, text, lang, identity, order), "measured")
    return judged(scored, lang, reach)


def base_measures(texts: list[str]) -> list[pa.Array]:
    """``MEASURES`` of each text."""
    found = [_measures(text) for text in texts]
    return [pa.array([row[i] for row in found], pa.int64()) for i in range(len(MEASURES))]


def _measures(text: str) -> tuple[int, int, int, int, int]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    blanks = len(raw) - len(raw.translate(None, b" \t\n\x0b\x0c\r"))
    symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of five that the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + h[i:n + i]
    mixed.sort()
    if not (mixed[1:] == mixed[:-1]).any():
        return 0
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    times = Counter(windows)
    edges = np.zeros(len(words) + 1, np.int64)
    again = np.fromiter((times[w] > 1 for w in windows), bool, n)
    edges[:n] += again
    edges[WINDOW:] -= again
    return int((np.cumsum(edges[:-1]) > 0).sum())
