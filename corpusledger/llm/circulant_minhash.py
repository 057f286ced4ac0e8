"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 32-bit integers make a whole signature: sigma scatters the shingle hashes,
and coordinate k is the smallest pi(sigma(x) - k) over the set, pi shifted circularly by k. Bands of
coordinates find candidates; every link is confirmed on full shingle sets.

Rows are compared, not ids: every row has a number of its own, given once in a staged table, and ids
serve for reporting only.

1. ``signed``: one pass over the texts gives set size, set hash and band hashes of each row.
2. Rows with one and the same set (a 128-bit hash of it) are one class; one of them goes on.
3. In every band bucket the members are compared with its smallest one only: linear in the bucket.
   First each row meets the smallest of all its buckets' smallest rows; what is confirmed is joined into
   components, and of the other pairs those within one component need no comparison (``_stars``). A
   group of near copies so takes about one comparison per row, not one per row and band.
4. Buckets that then still hold more than one component are settled exactly: of their documents
   every pair of different components is compared whose rarest shingles leave the similarity
   possible (``_rare_pairs``). The rarest come first, so neither a passage that many documents share
   nor a crowd of texts that are nearly similar enough makes pairs. Where a rare shingle would still
   make many, rows first meet a few rows of the shingle's largest component, others each round
   (``_rare_stars``): a row on the rim of a group needs one link to it, not a comparison with all of it.
5. Components of all confirmed links, by rounds of neighbour minima, kept in the shared folder.

With 32 bands of 4, a pair with a similarity of 0.75 shares no bucket with a probability of 5e-6.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with
nothing; a text of fewer words than a shingle is one shingle; every row is a document with a row in
the result, also one whose doc_id is null or repeats; a component has the smallest doc_id of its
rows, null if none has one; a row is ``kept`` if its doc_id is that (null is equal to null), and
``first`` holds for exactly one row of each component: smallest doc_id, then smallest row number; an
empty table gives an empty result. Only the named columns of the input are used, ids of any type that
has an order.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusledger.llm.common import staged, staged_texts

WORDS = 5
PERCENT = 75
BANDS = 32
ROWS = 4
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_PIECE = 1024
#: Pairs of one first document that meet in one group: a document with more of them has several groups.
PAIRS_PER_GROUP = 512
#: A shingle that would make more pairs of different components than this per row is first met by stars,
#: with so many centers in a round, in at most so many rounds, as long as one comparison in ``WORTH`` finds a link.
CROWDED = 4
CENTERS = 16
STAR_ROUNDS = 8
WORTH = 500
SIGNED = "n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"


# --- inside the tasks --------------------------------------------------------------------------


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


class _WordHashes(dict):
    """64-bit hashes of words, kept for the frequent ones."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 500_000:
            self[word] = h
        return h


def shingle_set(text: str | None, hashes: dict, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles of words, A-Z in lower case."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.array([hashes[word] for word in found], np.uint64)
    size = min(words, len(h))
    mixed = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        mixed = mixed * _GOLD + h[i:len(h) - size + 1 + i]
        mixed ^= mixed >> np.uint64(32)
    mixed = np.sort(_finish(mixed))
    return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` minima: shingles scattered by sigma, then pi shifted by 0, 1, 2, ... places."""
    scattered = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)  # sigma, on hashes
    scattered *= np.uint32(0x85EBCA6B)
    scattered ^= scattered >> np.uint32(16)
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    best = np.full(size, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(scattered), _PIECE):
        x = scattered[None, at:at + _PIECE] - shifts
        # pi: a chain of one-to-one steps on 32 bits.
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        np.minimum(best, x.min(axis=1), out=best)
    return best


def _sign(bands: int, rows: int, words: int):
    def sign(batches):
        hashes = _WordHashes()
        weights = np.arange(1, bands + 1, dtype=np.uint64) * _MIX
        for batch in batches:
            n, a, b, keys = [], [], [], []
            for text in batch.column(2):
                shingles = shingle_set(text.as_py(), hashes, words)
                n.append(len(shingles))
                if not len(shingles):
                    a.append(0)
                    b.append(0)
                    keys.append([])
                    continue
                a.append(int(_finish(shingles * _GOLD).sum(dtype=np.uint64).view(np.int64)))
                b.append(int(_finish(shingles ^ _MIX2).sum(dtype=np.uint64).view(np.int64)))
                minima = signature(shingles, bands * rows).reshape(bands, rows).astype(np.uint64)
                h = weights.copy()
                for i in range(rows):
                    h = _finish(h ^ minima[:, i]) + _GOLD
                keys.append(h.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(a, pa.int64()),
                 pa.array(b, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["row", "doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )

    return sign


def _confirm(percent: int, words: int):
    """Rows (a, b, text_a, text_b) in the order of a: those whose sets are similar enough."""

    def confirm(batches):
        hashes = _WordHashes()
        last, left = None, None
        for batch in batches:
            first, second = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            good_a, good_b = [], []
            for i, (a, b) in enumerate(zip(first, second)):
                text = batch.column(2)[i].as_py()
                if text != last:
                    last, left = text, shingle_set(text, hashes, words)
                right = shingle_set(batch.column(3)[i].as_py(), hashes, words)
                both = len(np.intersect1d(left, right, assume_unique=True))
                if both and 100 * both >= percent * (len(left) + len(right) - both):
                    good_a.append(a)
                    good_b.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(good_a, pa.int64()), pa.array(good_b, pa.int64())], names=["a", "b"]
            )

    return confirm


def _shingles(words: int):
    def explode(batches):
        hashes = _WordHashes()
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                found = shingle_set(text.as_py(), hashes, words).view(np.int64)
                for at in range(0, len(found), 100_000):
                    part = found[at:at + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), batch.column(0)[i].as_py(), np.int64)),
                         pa.array(np.full(len(part), len(found), np.int64)), pa.array(part)],
                        names=["row", "n", "shingle"],
                    )

    return explode


# --- the job -----------------------------------------------------------------------------------


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text), staged, so that a row keeps its number."""
    return staged_texts(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "rows")


def signed(texts: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """(row, doc_id, n_shingles, set_a, set_b, bands) of each of (row, doc_id, text)."""
    schema = f"row bigint, doc_id {dict(texts.dtypes)['doc_id']}, {SIGNED}"
    return texts.select("row", "doc_id", "text").mapInArrow(_sign(bands, rows, words), schema)


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """Of (a, b), those whose full shingle sets reach the similarity.

    The second text travels to the first document's place; the first is read once per
    ``PAIRS_PER_GROUP`` of its pairs, and its set computed once as they follow each other.
    """
    pairs = staged(pairs.select("a", "b"), "pairs")
    groups = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_GROUP).cast("bigint").alias("groups"))
    placed = pairs.join(groups, "a").select("a", F.pmod(F.xxhash64("b"), "groups").alias("part"), "b")
    second = placed.join(texts.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
    parts = groups.select("a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1)).alias("part"))
    first = parts.join(texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
    both = second.join(first, ["a", "part"]).select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_confirm(percent, words), "a bigint, b bigint")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(row, root) of every node: the smallest row reachable over ``links`` (a, b).

    Each round every node takes the smallest root among its neighbours' roots, then roots point to
    their own root; the rounds end when no link joins two roots. Hot nodes are only summed over.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = staged(edges, "links")
    ends = edges.select(F.col("a").alias("row")).union(edges.select("b")).distinct()
    roots = staged(ends.select("row", F.col("row").alias("root")), "roots")
    while edges.take(1):
        # Every root that a link joins to a smaller one hangs itself under the smallest of these.
        under = edges.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("next"))
        under = staged(under, "under")
        while True:  # and chains of roots become short
            up = under.select(F.col("root").alias("next"), F.col("next").alias("far"))
            shorter = staged(
                under.join(up, "next", "left").select("root", F.coalesce("far", "next").alias("next"),
                                                      F.col("far").isNotNull().alias("moved")),
                "under",
            )
            moved = shorter.where("moved").take(1)
            under = shorter.select("root", "next")
            if not moved:
                break
        roots = staged(
            roots.join(under, "root", "left").select("row", F.coalesce("next", "root").alias("root")),
            "roots",
        )
        at = under.select(F.col("root").alias("a"), F.col("next").alias("at_a"))
        bt = under.select(F.col("root").alias("b"), F.col("next").alias("at_b"))
        moved_edges = (
            edges.join(at, "a", "left").join(bt, "b", "left")
            .select(F.coalesce("at_a", "a").alias("x"), F.coalesce("at_b", "b").alias("y"))
            .where("x <> y")
        )
        edges = staged(
            moved_edges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "links",
        )
    return nodes.join(roots, "row", "left").select("row", F.coalesce("root", "row").alias("root"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
                    words: int = WORDS) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, kept, first), one row per row of ``docs``.

    If ``docs`` has a column ``row``, it must number the rows of a staged table; otherwise they are
    numbered here.
    """
    texts = docs.select("row", "doc_id", "text") if "row" in docs.columns else numbered(docs)
    sets = staged(signed(texts, bands, rows, words), "sets")
    filled = sets.where("n_shingles > 0")
    # A class is all rows of one set; the smallest stands for it, the copies are members.
    classes = filled.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min("row").alias("head"), F.min("bands").alias("bands")
    )
    classes = staged(classes, "classes")
    heads = classes.select(F.col("head").alias("row"), "n_shingles", "bands")
    buckets = heads.select("row", "n_shingles", F.explode("bands").alias("band"))
    shared = buckets.groupBy("band").agg(
        F.min("row").alias("low"), F.count(F.lit(1)).alias("members")
    ).where("members > 1")
    members = staged(
        buckets.join(shared.select("band", "low"), "band").select("band", "low", "row", "n_shingles"),
        "buckets",
    )
    in_buckets = members.select("row").distinct()
    links, grouped = _stars(members, in_buckets, texts, percent, words)
    # Buckets that are not yet one component.
    named = members.join(grouped, "row")
    open_bands = named.groupBy("band").agg(
        F.min("root").alias("least"), F.max("root").alias("most")
    ).where("least <> most")
    rest = named.join(open_bands.select("band"), "band", "left_semi").select("row", "root")
    rest = staged(rest.distinct(), "rest")
    if rest.take(1):
        rare = _rare_shingles(rest, texts, percent, words)
        rest, stars = _rare_stars(rare, rest, texts, percent, words)
        more = confirmed(_pairs_of(rare, rest, percent), texts, percent, words)
        links = reduce(DataFrame.unionByName, [links, *stars, staged(more, "more")])
        grouped = components(in_buckets, links)
    key = ["set_a", "set_b", "n_shingles"]
    rooted = classes.join(
        grouped.select(F.col("row").alias("head"), "root"), "head", "left"
    ).select(*key, F.coalesce("root", "head").alias("root"))
    # Rows are summed up by class before classes are by component, so no component meets in one task.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least")
    of_class = filled.groupBy(*key).agg(least).join(rooted, key)
    of_class = staged(of_class, "roots")
    of_root = of_class.groupBy("root").agg(F.min("least").alias("least"))
    chosen = of_class.select(*key, "root").join(of_root, "root").select(*key, "least")
    found = filled.join(chosen, key).select(
        "row", "doc_id", "n_shingles", F.col("least.doc_id").alias("component_id"),
        (F.col("row") == F.col("least.row")).alias("first"),
    )
    empty = sets.where("n_shingles = 0").select(
        "row", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first")
    )
    return found.unionByName(empty).select(
        "row", "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "first",
    )


def _stars(members: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int, words: int):
    """Links between rows and the smallest ones of their buckets, and the components they make.

    All such pairs are compared but those whose rows are in one component without it.
    """
    stars = members.where("row <> low").select(F.col("low").alias("a"), F.col("row").alias("b")).distinct()
    stars = staged(stars, "pairs")
    nearest = staged(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "nearest")
    links = staged(confirmed(nearest, texts, percent, words), "stars")
    grouped = staged(components(nodes, links), "grouped")
    at, bt = (
        grouped.select(F.col("row").alias(x), F.col("root").alias(f"root_{x}")) for x in ("a", "b")
    )
    apart = stars.join(at, "a").join(bt, "b").where("root_a <> root_b").select("a", "b")
    rest = staged(apart.join(nearest, ["a", "b"], "left_anti"), "apart")
    if rest.take(1):
        links = links.unionByName(staged(confirmed(rest, texts, percent, words), "stars"))
        grouped = staged(components(nodes, links), "grouped")
    return links, grouped


def _rare_pairs(rest: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """(a, b) of different components that can be similar enough by their rarest shingles.

    With shingles in one order, rarest first, sets of na <= nb shingles with an overlap of at least
    o = t / (1 + t) (na + nb) have their first common shingle among the first na - 2t / (1 + t) na + 1
    of the smaller and the first nb - t nb + 1 of the larger one, and behind it there must be room for
    the rest of the overlap. Only pairs that meet all of this leave the join.
    """
    return _pairs_of(_rare_shingles(rest, texts, percent, words), rest, percent)


def _rare_shingles(rest: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """(row, n, shingle, place): the leading shingles of each row of ``rest`` that other rows have too."""
    own = texts.select("row", "text").join(rest, "row", "left_semi")
    listed = staged(own.mapInArrow(_shingles(words), "row bigint, n bigint, shingle bigint"), "shingles")
    often = listed.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # A shingle that no other document has makes no pair, but it takes a place in the order.
    ranked = listed.join(often, "shingle", "left").withColumn("df", F.coalesce("df", F.lit(1)))
    order = Window.partitionBy("row").orderBy("df", "shingle")
    n, place = F.col("n"), F.col("place")
    first = ranked.withColumn("place", F.row_number().over(order)).where(
        (place <= n - F.floor((n * percent + 99) / 100) + 1) & (F.col("df") > 1)
    )
    return staged(first.select("row", "n", "shingle", "place"), "rare")


def _crowds(named: DataFrame) -> DataFrame:
    """(shingle, rows, pairs, main) of shingles with rows of several components.

    ``pairs`` are those of different components, ``main`` is the component with most rows.
    """
    size = F.col("rows").cast("double")
    return (
        named.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("shingle")
        .agg(F.sum("rows").alias("rows"), F.sum(size * size).alias("own"), F.max(F.struct("rows", "root")).alias("most"))
        .where(F.col("rows") > F.col("most.rows"))
        .select("shingle", "rows", ((size * size - F.col("own")) / 2).alias("pairs"), F.col("most.root").alias("main"))
    )


def _centers(inside: DataFrame, turn: int) -> DataFrame:
    """(shingle, center): up to ``CENTERS`` rows (n, row, place) of each shingle, others for each shingle and turn."""

    def pick(number: int):
        mask = F.xxhash64("shingle", F.lit(turn * CENTERS + number))
        masked = F.col("row").bitwiseXOR(mask).alias("masked")
        return F.min(F.struct(masked, "n", "row", "place")).alias(f"pick{number}")

    picked = inside.groupBy("shingle").agg(*map(pick, range(CENTERS)))
    rows = F.array(*(
        F.struct(*(F.col(f"pick{number}.{name}") for name in ("n", "row", "place"))) for number in range(CENTERS)
    ))
    return picked.select("shingle", F.explode(F.array_distinct(rows)).alias("center"))


def _rare_stars(rare: DataFrame, rest: DataFrame, texts: DataFrame, percent: int, words: int):
    """``rest`` with fewer components, and the links that joined them.

    In each round every row of a crowded shingle is compared with ``CENTERS`` rows of the shingle's
    largest component, unless it is in that or the two cannot be similar enough. Rounds end when no shingle is crowded or few links are found; what is left is for
    ``_pairs_of``, so nothing is lost.
    """
    found = []
    for turn in range(STAR_ROUNDS):
        named = rare.join(rest, "row")
        crowds = staged(_crowds(named).where(F.col("pairs") > CROWDED * F.col("rows")), "crowds")
        if not crowds.take(1):
            break
        own = F.struct("n", "row", "place")
        crowded = named.join(crowds.select("shingle", "main"), "shingle")
        centers = staged(_centers(crowded.where("root = main"), turn), "centers")
        met = crowded.where("root <> main").join(centers, "shingle")
        met = met.select(F.least(own, "center").alias("a"), F.greatest(own, "center").alias("b"))
        met = met.where(
            (F.col("a.place") <= _prefix("a.n", percent))
            & _possible(*(F.col(name) for name in ("a.n", "b.n", "a.place", "b.place")), percent)
        )
        pairs = met.select(F.least("a.row", "b.row").alias("a"), F.greatest("a.row", "b.row").alias("b"))
        pairs = staged(pairs.distinct(), "pairs")
        links = staged(confirmed(pairs, texts, percent, words), "stars")
        linked = links.count()
        if not linked:
            break
        found.append(links)
        at, bt = (rest.select(F.col("row").alias(end), F.col("root").alias(f"root_{end}")) for end in ("a", "b"))
        met = links.join(at, "a").join(bt, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        now = components(rest.select(F.col("root").alias("row")).distinct(), met)
        now = now.select(F.col("row").alias("root"), F.col("root").alias("now"))
        rest = staged(rest.join(now, "root").select("row", F.col("now").alias("root")), "rest")
        if linked * WORTH < pairs.count():
            break
    return rest, found


def _prefix(n: str, percent: int):
    """The last place at which the smaller of two sets can have their first common shingle."""
    n, whole = F.col(n), 100 + percent
    return n - F.floor((2 * percent * n + whole - 1) / whole) + 1


def _possible(na, nb, pa, pb, percent: int):
    """Whether sets of na <= nb shingles whose first common one is at these places can be similar enough."""
    room = F.least(na - pa, nb - pb) + 1
    return (100 * na >= percent * nb) & ((100 + percent) * room >= percent * (na + nb))


def _pairs_of(rare: DataFrame, rest: DataFrame, percent: int) -> DataFrame:
    """The pairs of ``_rare_pairs``. Rows of a shingle's largest component do not meet each other."""
    crowds = staged(_crowds(rare.join(rest, "row")).select("shingle", "main"), "crowds")
    first = staged(
        rare.join(rest, "row").join(crowds, "shingle")
        .select("row", "n", "shingle", "place", "root", (F.col("root") == F.col("main")).alias("inside")),
        "named",
    )
    smaller = first.where(F.col("place") <= _prefix("n", percent))
    sides = F.when(F.col("inside"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    smaller = smaller.withColumn("inside", F.explode(sides))
    left, right = (
        side.select(
            F.col("shingle").alias(f"s{x}"), F.col("row").alias(x), F.col("n").alias(f"n{x}"),
            F.col("place").alias(f"p{x}"), F.col("root").alias(f"c{x}"), F.col("inside").alias(f"i{x}"),
        )
        for x, side in (("a", smaller), ("b", first))
    )
    pairs = left.join(
        right,
        (F.col("sa") == F.col("sb")) & (F.col("ia") == F.col("ib")) & (F.col("ca") != F.col("cb"))
        & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
        & _possible(*(F.col(name) for name in ("na", "nb", "pa", "pb")), percent),
    )
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
