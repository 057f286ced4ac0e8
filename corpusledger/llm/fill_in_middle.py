"""Fill-in-middle transformation by a regular expression with counted quantifiers.

A text is cut into units (lines, unless another pattern is given). ``regexp_count`` gives their number
n; hashes of the row's id draw two cuts among the n + 1 places between units, the form and whether the
text is left plain. A pattern made for the row, ``((?:unit){a}+)((?:unit){b-a}+)(.*+)``, then captures
prefix, middle and suffix in one match, and the replacement writes them in the order of the form. The
quantifiers are possessive: they are matched by a loop, without a step back or a deeper call for each
unit, so a text of a million lines costs no more stack than one of two. Since no text that is cut
holds a marker, the markers' places in the output give the lengths of the parts, and the text comes
back from output and form by a second match.

All of it are column functions on the row alone: nothing is shuffled, and a rerun gives the same output.

Defined cases: a null text is empty; an empty text, or one with a marker in it, is plain, as is a text
that the rate leaves out; a null id hashes as the empty string; rows with one id are cut by the same
hashes; an empty table gives an empty result; other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line with its end, or a last line without one. Neither alternative can match shorter or longer.
LINE = r"[^\n]*+\n|[^\n]++"
SEED = 7
#: Of a hundred texts, how many are transformed, and how many of those have the suffix first.
RATE = 100
SUFFIX_FIRST = 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKER = "|".join((PREFIX, SUFFIX, MIDDLE))
#: How each form is written from (prefix, middle, suffix), and read back.
_WRITTEN = {
    "psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2",
    "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2",
}
_READ = {
    "psm": (rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\z", "$1$3$2"),
    "spm": (rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\z", "$2$3$1"),
}


def draws(identity: Column, seed: int) -> list[Column]:
    """Four unsigned numbers of 32 bits that depend on seed and id only."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(hashed, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def _formed(text: Column, n: Column, draw: list[Column], rate: int, suffix_first: int) -> Column:
    plain = (n == 0) | F.regexp_like(text, F.lit(_MARKER)) | (draw[2] % 100 >= rate)
    return (
        F.when(plain, F.lit("plain")).when(draw[3] % 100 < suffix_first, F.lit("spm")).otherwise(F.lit("psm"))
    )


def _cut(n: Column, draw: list[Column], unit: str) -> Column:
    """The row's own pattern: so many units, so many more, and the rest."""
    one, two = draw[0] % (n + 1), draw[1] % (n + 1)
    units = lambda count: F.concat(F.lit(f"((?:{unit}){{"), count.cast("string"), F.lit("}+)"))
    return F.concat(
        F.lit(r"(?s)\A"), units(F.least(one, two)), units(F.abs(one - two)), F.lit(r"(.*+)\z")
    )


def restored(output: Column, form: Column) -> Column:
    """The text, from output and form alone."""
    back = F.when(form == "plain", output)
    for name, (pattern, order) in _READ.items():
        back = back.when(form == name, F.regexp_replace(output, pattern, order))
    return back


def fill_in_middle(
    docs: DataFrame, unit: str = LINE, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """``docs`` with a struct ``fim`` (n, form, output, prefix_chars, middle_chars).

    ``unit`` must match every text from end to end by matches that follow each other. A column of
    ``docs`` called ``fim`` is replaced.
    """
    text, draw = F.coalesce(F.col("text"), F.lit("")), draws(F.col("doc_id"), seed)
    # One struct after the other, so that a step is not computed again by each use of it.
    counted = F.struct(text.alias("text"), F.regexp_count(text, F.lit(unit)).cast("bigint").alias("n"))
    got = F.col("fim")
    formed = F.struct(
        got["text"].alias("text"), got["n"].alias("n"),
        _formed(got["text"], got["n"], draw, rate, suffix_first).alias("form"),
    )
    order = F.when(got["form"] == "spm", F.lit(_WRITTEN["spm"])).otherwise(F.lit(_WRITTEN["psm"]))
    written = F.struct(
        got["n"].alias("n"), got["form"].alias("form"),
        F.when(got["form"] == "plain", got["text"])
        .otherwise(F.regexp_replace(got["text"], _cut(got["n"], draw, unit), order)).alias("output"),
    )
    # A marker's place is where the part before it ends; markers have three characters.
    after = {mark: F.instr(got["output"], mark) for mark in (PREFIX, SUFFIX, MIDDLE)}
    prefix = F.when(got["form"] == "psm", after[SUFFIX]).otherwise(after[MIDDLE]) - after[PREFIX] - 3
    middle = F.length(got["output"]) - after[MIDDLE] - 2
    cut = got["form"] != "plain"
    measured = F.struct(
        got["n"].alias("n"), got["form"].alias("form"), got["output"].alias("output"),
        F.when(cut, prefix.cast("bigint")).alias("prefix_chars"),
        F.when(cut, middle.cast("bigint")).alias("middle_chars"),
    )
    steps = docs.withColumn("fim", counted).withColumn("fim", formed)
    return steps.withColumn("fim", written).withColumn("fim", measured)


def digests(transformed: DataFrame) -> DataFrame:
    """Per row the parts' sizes and the digests of the output and of the text restored from it."""
    fim = F.col("fim")
    return transformed.select(
        "doc_id", fim["n"].alias("n"), fim["form"].alias("form"), fim["prefix_chars"].alias("prefix_chars"),
        fim["middle_chars"].alias("middle_chars"), F.sha2(fim["output"], 256).alias("output_sha256"),
        F.sha2(restored(fim["output"], fim["form"]), 256).alias("restored_sha256"),
    )
