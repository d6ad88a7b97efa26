"""Document fingerprints by I-Match, in DataFrame functions only.

The lexicon holds the terms whose inverse document frequency lies in a chosen band:
neither so common that every text has them nor so rare that one edit brings a new
one.  A text keeps its distinct terms of the lexicon, in order of their codes (64 bits
of a salted md5).  The first two digits of the code deal the lexicon at random into 256
subsets; for each subset that the text has terms of, its sorted terms are hashed
together.  The fingerprint is the list of these hashes: an edit changes those of the
subsets it touches and leaves the others as they are.

``likeness`` of two fingerprints is the number of subsets with the same hash divided by
the number of subsets that either text has terms of.

The lexicon's size does not follow the number of documents: a term in one of
``RARE`` documents or more takes that share of them, so there are at most
``RARE`` times the mean number of distinct terms.  It is counted, and broadcast up to
``BROADCAST_TERMS`` terms; a larger one is joined by an exchange, with the same result.

The texts are exchanged once, by a digest of id and text (so no id, source or group of
copies gathers in a task).  Everything on whole texts follows inside these
partitions: words are exploded, looked up and grouped again without another exchange.
Only the beginning that the edit takes from the next document travels, with that
document's fingerprint.

Defined cases: null texts are empty; a text without a term of the lexicon (an empty one too) has
the digest of its whole text as fingerprint, so equal texts always have equal
fingerprints, with likeness 1, and such a text is like no other; repeated rows come out
alike and count as one document for what is next; the order is falling doc_id, null last, then
falling md5 of the text; a single document is its own next; an empty table gives an empty result; columns that
are not named here are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editsurge.llm.common import cut
from editsurge.llm.sharding import number_rows

#: What lies between words: ASCII other than digits and (lower-cased) letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The band: terms in at least one of RARE and at most one of COMMON documents.
RARE, COMMON = 500, 10
SALT = "1:"
CODE_DIGITS, HASH_DIGITS = 16, 6
MARK = "."
BROADCAST_TERMS = 400_000


def words(text: Column) -> Column:
    """The distinct words of a text, A-Z lower-cased."""
    return F.array_remove(F.array_distinct(F.split(F.translate(text, UPPER, LOWER), BETWEEN)), "")


def build_lexicon(docs: DataFrame, rare: int = RARE, common: int = COMMON) -> DataFrame:
    """(term, code) of the terms in the band, counted over all documents."""
    n = docs.count()
    terms = docs.filter(F.col("text").isNotNull()).select(F.explode(words(F.col("text"))).alias("term"))
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    code = F.substring(F.md5(F.concat(F.lit(SALT), F.col("term")).cast("binary")), 1, CODE_DIGITS)
    return df.filter((F.col("df") * rare >= n) & (F.col("df") * common <= n)).select("term", code.alias("code"))


def codes_of(texts: DataFrame, lexicon: DataFrame, *columns: str, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """_key and, for each of the columns, the set of the codes of its terms, as a column of
    the same name.  Rows of ``texts`` are partitioned by _key, so only the lexicon moves."""
    side = F.broadcast(lexicon) if lexicon.count() <= broadcast_terms else lexicon
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).alias("t")) for k, c in enumerate(columns)]))
    terms = texts.select("_key", each.alias("_e")).select("_key", "_e.k", F.explode(words(F.col("_e.t"))).alias("term"))
    return terms.join(side, "term").groupBy("_key").agg(
        *[F.collect_set(F.when(F.col("k") == k, F.col("code"))).alias(c) for k, c in enumerate(columns)])


def fingerprint_of(codes: Column, text: Column) -> Column:
    """Fingerprint from the codes of a text's terms."""
    tail = CODE_DIGITS - 2
    runs = F.regexp_extract_all(F.array_join(F.array_sort(codes), ""), F.lit(f"(..).{{{tail}}}(?:\\1.{{{tail}}})*+"), F.lit(0))
    entries = F.transform(runs, lambda r: F.concat(F.substring(r, 1, 2), F.substring(F.md5(r.cast("binary")), 1, HASH_DIGITS)))
    return F.when(F.size(codes) == 0, F.concat(F.lit("="), F.sha2(text, 256))).otherwise(F.array_join(entries, MARK))


def entries_of(fingerprint: Column) -> Column:
    """The subset hashes of a fingerprint (none of a digest)."""
    return F.when(fingerprint.startswith("="), F.array().cast("array<string>")).otherwise(F.split(fingerprint, "[.]"))


def likeness(a: Column, b: Column, x: Column | None = None, y: Column | None = None) -> Column:
    """0 to 1 for two fingerprints (``x``, ``y``: their entries, where they are columns already)."""
    x, y = entries_of(a) if x is None else x, entries_of(b) if y is None else y
    subsets = lambda e: F.transform(e, lambda s: F.substring(s, 1, 2))
    either = F.size(F.array_union(subsets(x), subsets(y)))
    return (F.when(a == b, F.lit(1.0)).when(F.size(x) + F.size(y) == 0, F.lit(0.0))
             .otherwise(F.size(F.array_intersect(x, y)).cast("double") / either))


def third(text: str) -> Column:
    return F.call_function("div", F.length(text), F.lit(3)).cast("int")


def neighbours(base: DataFrame) -> DataFrame:
    """(_key, doc_id, need, _next): each document, the code points its edit takes, and the key
    of the one after it in falling order.  Ids and digests only."""
    ids = base.select("_key", "doc_id", F.md5(F.col("text").cast("binary")).alias("_md5"), third("text").alias("need"))
    rows = number_rows(ids.groupBy("_key").agg(*[F.any_value(c).alias(c) for c in ("doc_id", "_md5", "need")]), ["doc_id", "_md5"])
    n = rows.count()
    after = rows.select(F.col("_key").alias("_next"), ((F.col("row") + 1) % max(n, 1)).alias("row"))
    return rows.join(after, "row").select("_key", "doc_id", "need", "_next")


def fingerprints(docs: DataFrame, lexicon: DataFrame, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """doc_id, text, edited_text, fingerprint, edited_fingerprint, next_fingerprint of every row."""
    none = F.array().cast("array<string>")
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "_key", F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "text").cast("binary"))))
    given = cut(neighbours(base))
    # Every branch below reads the same two columns of this exchange, so that it runs once.
    texts = base.select("_key", "text").repartition("_key")

    own = codes_of(texts, lexicon, "text", broadcast_terms=broadcast_terms).withColumnRenamed("text", "_codes")
    marked = texts.join(own, "_key", "left").select(
        "_key", "text", fingerprint_of(F.coalesce("_codes", none), F.col("text")).alias("_mark"))
    sent = (marked.join(given.select(F.col("_key").alias("_to"), F.col("_next").alias("_key"), "need"), "_key")
                  .select("_to", F.concat_ws(" ", "_mark", F.expr("substring(text, 1, need)")).alias("_load")))
    # One column, used whole by every branch: the fingerprint (without spaces) and the beginning.
    loads = sent.groupBy("_to").agg(F.any_value("_load").alias("_load")).withColumnRenamed("_to", "_key")
    k, at = third("text"), F.locate(" ", F.col("_load"))
    pairs = texts.join(loads, "_key").withColumn(
        "edited_text", F.concat(F.substring("text", F.lit(1), F.length("text") - k), F.substring("_load", at + 1, k)))
    codes = codes_of(pairs, lexicon, "text", "edited_text", broadcast_terms=broadcast_terms)
    codes = codes.select("_key", F.col("text").alias("_own"), F.col("edited_text").alias("_edited"))
    rows = pairs.join(codes, "_key", "left").join(given.select("_key", "doc_id"), "_key")
    return rows.select(
        "doc_id", "text", "edited_text", fingerprint_of(F.coalesce("_own", none), F.col("text")).alias("fingerprint"),
        fingerprint_of(F.coalesce("_edited", none), F.col("edited_text")).alias("edited_fingerprint"),
        F.substring_index("_load", " ", 1).alias("next_fingerprint"))


def digest(docs: DataFrame, rare: int = RARE, common: int = COMMON, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    rows = fingerprints(docs, cut(build_lexicon(docs, rare, common)), broadcast_terms)
    own, edit, after = (F.col(f"{n}fingerprint") for n in ("", "edited_", "next_"))
    rows = rows.withColumns({"_x": entries_of(own), "_y": entries_of(edit), "_z": entries_of(after)})
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", likeness(own, edit, F.col("_x"), F.col("_y")).alias("near_edited"),
        likeness(own, after, F.col("_x"), F.col("_z")).alias("near_next"))
