"""Fill-in-middle transformation by regular expressions with counted quantifiers.

A text is a run of units (code points, unless another unit pattern is given).
``regexp_count`` gives their number n; two hashes of the doc_id give the cuts a <= b.
A pattern made for the row from these counts,

    ^( unit{a}+ )( unit{b-a}+ )( rest )$

captures prefix, middle and suffix in one match, and the replacement, also made for
the row, writes them down in the order of its form: ``psm`` (prefix, suffix,
middle), ``spm`` (suffix, prefix, middle) or ``plain`` (the text as it is).  The quantifiers
are possessive: a match walks the text once and never steps back, whatever its length.
``restore`` reads the marks of an output and puts the parts back.

Texts that hold one of the marks stay plain, so the first marks of an output are those
that were written.  (A mark starts with a character that occurs in it once, so
text before it cannot complete one early.)

Defined cases: null texts are empty, empty texts are plain; a null doc_id is hashed as
no digits; repeated rows (same doc_id, same text) come out alike; what the unit
pattern does not match at the end of a text counts to the suffix; an empty table gives an
empty result; columns that are not named here are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 1
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CODE_POINT = "(?s:.)"
#: Of 100 texts: those below are cut, and of the cut ones those below have the suffix first.
CUT_PERCENT, SPM_PERCENT = 90, 20


def hashes(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit integers of a doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def _units(unit: str, count: Column) -> Column:
    return F.concat(F.lit(f"(?:{unit}){{"), count.cast("string"), F.lit("}+"))


def transform(docs: DataFrame, seed: int = SEED, unit: str = CODE_POINT, cut_percent: int = CUT_PERCENT,
              spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, text, n, form, prefix_units, middle_units, output of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    h1, h2, h3, h4 = hashes(F.col("doc_id"), seed)
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    counted = docs.select("doc_id", text.alias("text")).withColumn("n", F.regexp_count("text", F.lit(unit)).cast("long"))
    form = (F.when((F.length("text") == 0) | marked | (h3 % 100 >= cut_percent), "plain")
             .when(h4 % 100 < spm_percent, "spm").otherwise("psm"))
    cut = counted.withColumns({"form": form, "_a": h1 % (F.col("n") + 1), "_b": h2 % (F.col("n") + 1)})
    plain = F.col("form") == "plain"
    first, second = F.least("_a", "_b"), F.greatest("_a", "_b")
    cut = cut.select("doc_id", "text", "n", "form", F.when(~plain, first).alias("prefix_units"),
                     F.when(~plain, second - first).alias("middle_units"))
    pattern = F.concat(F.lit("\\A("), _units(unit, F.col("prefix_units")), F.lit(")("), _units(unit, F.col("middle_units")),
                       F.lit(")((?s:.*+))\\z"))
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    return cut.withColumn("output", F.when(plain, F.col("text")).otherwise(F.regexp_replace("text", pattern, order)))


def restore(output: Column, form: Column) -> Column:
    """The text from an output and its form."""
    def parts(*marks: str) -> str:
        return "\\A" + "".join(re.escape(m) + ("((?s:.*?))" if m != MIDDLE else "((?s:.*+))") for m in marks) + "\\z"

    return (F.when(form == "plain", output)
             .when(form == "spm", F.regexp_replace(output, F.lit(parts(SUFFIX, PREFIX, MIDDLE)), F.lit("$2$3$1")))
             .otherwise(F.regexp_replace(output, F.lit(parts(PREFIX, SUFFIX, MIDDLE)), F.lit("$1$3$2"))))


def digest(docs: DataFrame) -> DataFrame:
    return transform(docs).select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
