"""Secret scan with corpus-wide ownership, in DataFrame functions only.

Every text is scanned for three kinds of secrets and for bare tokens. Each found value is hashed,
and the hashes are counted over the whole corpus: by how many documents (repositories) and by how
many sources (owners) they are held. Both decide. A value is a widely copied example if
``COPIED_OWNERS`` owners hold it, or if ``COPIED_REPOSITORIES`` repositories do and these are at least
one in ``SHARE`` of all that its owners have: an example pasted into a single owner's documents, too. One
that a single owner holds in fewer repositories and that mixes enough characters looks live. All else
is unclear. Kinds with a telling prefix or name are reported either way with their verdict; bare tokens
only where live.

Spans count code points, ends are exclusive. Matches are the regular expression's leftmost ones that
do not overlap, per kind; their places follow from the pieces of text between them.

Defined cases: a null text is empty; empty texts have no spans and the hash of the empty string;
repeated rows, also with one doc_id or a null one, are scanned each for itself; a null source is an
owner, all null ids of an owner are one repository; an empty table gives an empty result. Only the named columns are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusledger.llm.common import staged

KINDS = ["assign", "access", "hex", "token"]
#: Fixed values: (pattern, group with the secret, least length of that group).
PATTERNS = {
    "assign": (
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
    ),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    "token": (r"[A-Za-z0-9+/_=-]{20,}", 0, 20),
}
#: Texts without a match are passed over by the first of these.
HINTS = {"assign": r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""}
COPIED_OWNERS = 3
COPIED_REPOSITORIES, SHARE = 10, 1_000
LEAST_DISTINCT = 10
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def spans_of(text: Column, kind: str) -> Column:
    """Spans of one kind in the order of the text."""
    pattern, group, least = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    steps = F.arrays_zip(
        F.transform(between, F.length).alias("gap"), F.transform(found, F.length).alias("long"),
        values.alias("value"),
    )
    nothing = F.array().cast(SPAN)
    walked = F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), nothing.alias("spans")),
        lambda acc, step: F.struct(
            (acc["at"] + step["gap"] + step["long"]).alias("at"),
            F.concat(
                acc["spans"],
                F.array(
                    F.struct(
                        (acc["at"] + step["gap"]).alias("start"),
                        F.lit(KINDS.index(kind)).alias("kind"),
                        (acc["at"] + step["gap"] + step["long"]).alias("end"),
                        step["value"].alias("value"),
                    )
                ),
            ).cast(SPAN).alias("spans"),
        ),
    )["spans"]
    kept = F.filter(walked, lambda span: F.length(span["value"]) >= least)
    if kind == "token":
        kept = F.filter(kept, lambda span: span["value"].rlike("[0-9]") & span["value"].rlike("[A-Za-z]"))
    return F.when(text.rlike(HINTS.get(kind, pattern)), kept).otherwise(nothing)


def named(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def scanned(docs: DataFrame, identity: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """(row, identity, owner, base, bare): base spans, and bare tokens that meet none of them."""
    whole = F.coalesce(F.col(text), F.lit(""))
    each = docs.select(
        F.col(identity), F.coalesce(F.concat(F.lit("s"), F.col(owner).cast("string")), F.lit("")).alias("owner"),
        *(spans_of(whole, kind).alias(kind) for kind in KINDS),
    )
    base = F.concat("assign", "access", "hex")
    bare = F.filter(
        "token",
        lambda t: ~F.exists("base", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])),
    )
    return each.withColumn("base", base).select(
        F.monotonically_increasing_id().alias("row"), identity, "owner", "base", bare.alias("bare")
    )


def ownership(held: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """(hash, owners, repositories, verdict) of (hash, owner, repository, distinct) candidates.

    ``sizes`` is (owner, size): the repositories that each owner has, by default those with candidates.
    Candidates are counted per owner before owners are, so a value that all rows hold is summed up in
    steps.
    """
    if sizes is None:
        sizes = repositories_of(held)
    by_owner = held.groupBy("hash", "owner", "repository").agg(F.max("distinct").alias("distinct"))
    per_owner = by_owner.groupBy("hash", "owner").agg(
        F.count(F.lit(1)).alias("repositories"), F.max("distinct").alias("distinct")
    )
    counted = per_owner.join(sizes, "owner").groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"),
        F.sum("size").alias("size"), F.max("distinct").alias("distinct"),
    )
    many = F.col("repositories") >= COPIED_REPOSITORIES
    verdict = (
        F.when(F.col("owners") >= COPIED_OWNERS, "copied")
        .when(many & (F.col("repositories") * SHARE >= F.col("size")), "copied")
        .when((F.col("owners") == 1) & ~many & (F.col("distinct") >= LEAST_DISTINCT), "live")
        .otherwise("unclear")
    )
    return counted.select("hash", "owners", "repositories", verdict.alias("verdict"))


def repositories_of(rows: DataFrame) -> DataFrame:
    """(owner, size) of rows with owner and repository."""
    return rows.select("owner", "repository").distinct().groupBy("owner").agg(F.count(F.lit(1)).alias("size"))


def repository(identity: str) -> Column:
    """A document's name as a repository; null ids have one name."""
    return F.coalesce(F.concat(F.lit("d"), F.col(identity).cast("string")), F.lit(""))


def secrets(docs: DataFrame, identity: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """One row per row of ``docs``: counts, spans and verdicts.

    ``max_owners`` and ``max_repositories`` are the most that hold one of its base values.
    """
    rows = staged(scanned(docs, identity, text, owner), "scanned")
    sizes = repositories_of(rows.select("owner", repository(identity).alias("repository")))
    listed = rows.where((F.size("base") > 0) | (F.size("bare") > 0)).select(
        "row", "owner", repository(identity).alias("repository"),
        F.explode(F.concat("base", "bare")).alias("span"),
    )
    value = F.col("span.value")
    held = listed.select(
        "row", "owner", "repository", "span", F.sha2(value, 256).alias("hash"),
        F.size(F.array_distinct(F.split(value, ""))).alias("distinct"),
    )
    judged = held.select("row", "span", "hash").join(ownership(held, sizes), "hash")
    known = F.col("span.kind") < 3
    of_row = judged.groupBy("row").agg(
        F.max(F.when(known, F.col("owners"))).alias("max_owners"),
        F.max(F.when(known, F.col("repositories"))).alias("max_repositories"),
        F.collect_list(F.when(F.col("span.kind") < 3, F.struct("span", "verdict"))).alias("known"),
        F.collect_list(F.when((F.col("span.kind") == 3) & (F.col("verdict") == "live"), F.col("span"))).alias("live"),
    )
    out = rows.join(of_row, "row", "left")
    live = F.coalesce("live", F.array().cast(SPAN))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    verdicts = lambda name: F.coalesce(
        F.size(F.filter("known", lambda s: s["verdict"] == name)), F.lit(0)
    ).cast("bigint")
    return out.select(
        identity, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(named(F.col("base")), 256).alias("base_sha256"),
        named(F.concat("base", live)).alias("spans"),
        F.size(live).cast("bigint").alias("n_token"),
        verdicts("live").alias("n_live"), verdicts("copied").alias("n_copied"),
        *(F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in ("max_owners", "max_repositories")),
    )
