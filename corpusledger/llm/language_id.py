"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the average of the embeddings of its character n-grams (two to four characters, hashed
into ``BUCKETS`` rows); a linear layer and a softmax give the languages' probabilities. Embeddings
and layer are learned together by stochastic gradient descent in numpy, on at most ``SAMPLE`` labelled
documents per language and ``MOST`` of all languages, the ones with the smallest hashes of id and text;
this bounds what the driver holds. Rows alike in language, id and text are one document of the sample,
however often they repeat. The smallest hashes are found below a threshold from a histogram, so that no
language's documents meet in a task.
A fifth of the sample is kept out to fit the softmax's temperature and the score below which an answer
is marked as rejected, so that at most ``ERRORS`` of the accepted ones are wrong there.

Every text is then predicted in whole where it lies. The trained layer and embeddings are multiplied
once, so a task holds one row per bucket with a number per language.

Defined cases: a null text, or one without a letter, is ``und`` with the score 0 and rejected; rows
with a null language are predicted but not learned from; a null doc_id counts as the empty string in
the fold; ties go to the language first in order; without anything to learn from every text is ``und``;
an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusledger.llm.common import staged

BUCKETS = 1 << 15
SIZES = (2, 3, 4)
WIDTH = 16
SAMPLE = 1_000
MOST = 100_000
#: Bits of a hash that name its bin in a language's histogram.
BIN_BITS = 16
EPOCHS = 6
RATE = 0.5
SEED = 11
ERRORS = 0.01
CHUNK = 1 << 20
FOLDS = 4
HELD_OUT = 2
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_GOLD = np.uint32(0x9E3779B1)


def hashed(text: str) -> list[np.ndarray]:
    """For each n-gram size, the bucket of every n-gram of a (piece of) text in lower case."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    out, h = [], codes * _GOLD
    for n in range(2, max(SIZES) + 1):
        if len(codes) < n:
            break
        h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + codes[n - 1:] * _GOLD
        if n in SIZES:
            out.append(((h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(17)).astype(np.int32))
    return out


def pieces(text: str):
    """A long text in pieces of whole n-grams' worth; the seams count for nothing beside the rest."""
    return (text[at:at + CHUNK] for at in range(0, len(text), CHUNK))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's buckets and their shares of its n-grams."""
    counts = np.zeros(BUCKETS, np.int64)
    for piece in pieces(text):
        for h in hashed(piece):
            counts += np.bincount(h, minlength=BUCKETS)
    used = np.flatnonzero(counts)
    return used.astype(np.int32), (counts[used] / max(1, counts.sum())).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def fold(identity: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(identity).cast("string"), F.lit("")).cast("binary")) % FOLDS


def _smallest(hashes: DataFrame, sample: int) -> DataFrame:
    """(lang, hash, rank) of the ``sample`` smallest hashes of each language.

    Only hashes up to the bin in which the number is reached are ranked.
    """
    binned = hashes.withColumn("bin", F.shiftrightunsigned("hash", 64 - BIN_BITS))
    upto = Window.partitionBy("lang").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.groupBy("lang", "bin").count().withColumn("before", F.coalesce(F.sum("count").over(upto), F.lit(0)))
    wanted = staged(bins.where(F.col("before") < sample).select("lang", "bin"), "bins")
    order = Window.partitionBy("lang").orderBy("bin", "hash")
    ranked = binned.join(wanted, ["lang", "bin"], "left_semi").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= sample).select("lang", "hash", "rank")


def sampled(docs: DataFrame, sample: int) -> DataFrame:
    """(lang, rank, idx, share): features of at most ``sample`` learnable documents per language."""
    known = docs.where((fold() != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("hash")
    )
    hashes = staged(known.select("lang", "hash").distinct(), "hashes")
    languages = hashes.select(F.count_distinct("lang")).first()[0]
    chosen = staged(_smallest(hashes, max(1, min(sample, MOST // max(1, languages)))), "chosen")

    def extracted(batches):
        seen = set()  # of the chosen ones only
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            new = [i for i, key in enumerate(keys) if key not in seen and not seen.add(key)]
            found = [features(batch.column(2)[i].as_py()) for i in new]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(new, pa.int64())), batch.column(1).take(pa.array(new, pa.int64())),
                 pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1] for f in found], pa.list_(pa.float32()))],
                names=["lang", "rank", "idx", "share"],
            )

    rows = known.join(chosen, ["lang", "hash"]).select("lang", "rank", "text")
    schema = "lang string, rank int, idx array<int>, share array<float>"
    return rows.mapInArrow(extracted, schema).dropDuplicates(["lang", "rank"])


def _learned_from(found: pa.Table) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, idx, share) of the sample in a fixed order; the arrays are views of the table's."""
    parts = {}
    for name in ("idx", "share"):
        column = found.column(name).combine_chunks()
        lists = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
        parts[name] = [
            values[start:end]
            for part in lists
            for values, ends in [(part.values.to_numpy(zero_copy_only=False), part.offsets.to_numpy())]
            for start, end in zip(ends[:-1], ends[1:])
        ]
    keys = [found.column(name).to_pylist() for name in ("lang", "rank")]
    rows = sorted(zip(*keys, parts["idx"], parts["share"]), key=lambda row: row[:2])
    return [(lang, idx, share) for lang, _, idx, share in rows]


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = EPOCHS):
    """(languages, table of BUCKETS x languages, temperature, least score) from (lang, idx, share).

    The table is embeddings times layer. Every fifth row of each language calibrates.
    """
    languages = sorted({row[0] for row in rows})
    if not languages:
        return [], np.zeros((BUCKETS, 0), np.float32), 1.0, 1.0
    random = np.random.default_rng(SEED)
    embeddings = random.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    layer = np.zeros((WIDTH, len(languages)), np.float32)
    layer += random.uniform(-0.1, 0.1, layer.shape).astype(np.float32)
    seen: dict[str, int] = {}
    learn, check = [], []
    for lang, idx, share in rows:
        seen[lang] = seen.get(lang, 0) + 1
        (check if seen[lang] % 5 == 0 else learn).append((languages.index(lang), idx, share))
    steps, done = max(1, epochs * len(learn)), 0
    for _ in range(epochs):
        for i in random.permutation(len(learn)):
            label, idx, share = learn[i]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            if not len(idx):
                continue
            own = embeddings[idx]
            mean = share @ own
            error = _softmax(mean @ layer)
            error[label] -= 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            # A bucket moves by its share; shares are small, so the step is scaled by their number.
            embeddings[idx] = own - (rate * len(idx) / 10) * np.outer(share, back)
    table = embeddings @ layer
    return (languages, table, *_calibrated(check or learn, table))


def _calibrated(rows, table: np.ndarray) -> tuple[float, float]:
    """The temperature with the best likelihood, and the least score with few enough errors."""
    usable = [(label, share @ table[idx]) for label, idx, share in rows if len(idx)]
    if not usable:
        return 1.0, 0.0
    labels = np.array([label for label, _ in usable])
    logits = np.stack([x for _, x in usable]).astype(np.float64)
    at = np.arange(len(labels))
    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
    loss = [-np.log(_softmax(logits / t)[at, labels] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    scores = _softmax(logits / temperature)
    top, wrong = scores.max(axis=1), scores.argmax(axis=1) != labels
    order = np.argsort(-top, kind="stable")
    rates = np.cumsum(wrong[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(rates <= ERRORS)
    return temperature, float(top[order[good[-1]]]) if len(good) else 1.0


def predict(texts: list[str | None], languages: list[str], table: np.ndarray, temperature: float):
    """(language, score) of each text."""
    out = []
    for text in texts:
        if not languages or not has_letter(text):
            out.append((UNKNOWN, 0.0))
            continue
        total, number = np.zeros(len(languages)), 0
        for piece in pieces(text):
            for h in hashed(piece):
                total += table[h].sum(axis=0, dtype=np.float64)
                number += len(h)
        scores = _softmax(total / max(1, number) / temperature)
        best = int(scores.argmax())
        out.append((languages[best], float(scores[best])))
    return out


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row."""
    found = staged(sampled(docs.select("doc_id", "text", "lang"), sample), "sample").toArrow()
    languages, table, temperature, least = train(_learned_from(found))

    def predicted(batches):
        for batch in batches:
            found = predict([text.as_py() for text in batch.column(2)], languages, table, temperature)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64()),
                 pa.array([x[0] == UNKNOWN or x[1] < least for x in found], pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean"
    narrow = docs.select("doc_id", (fold() == HELD_OUT).alias("held_out"), "text")
    return staged(narrow.mapInArrow(predicted, schema), "languages")
