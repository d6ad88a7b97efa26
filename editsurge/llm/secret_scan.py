"""Secret scan with multipart credential linking, in DataFrame functions only.

Base spans come from three patterns.  Beside them weak parts are looked for:
account identifiers (``ident``), bare mixed-case keys (``key``) and service
addresses (``endpoint``).  Alone they are ordinary text; they are reported
only when complementary parts lie in the same scope: an identifier or a key
needs the other one (weak or base), an address needs both.  A scope reaches
``SCOPE`` code points around a part and never over a blank line.

The interval join runs inside the row: the parts of a text are sorted by start, and
running maxima from either side give each part the nearest one of each role; they
are kept by blocks between blank lines.  Positions are running sums of the lengths
between and of the matches.  Running values are made by doubling steps, so a text with n
matches takes n log n small steps, whole arrays at a time; no pairs are made and nothing is
shuffled.  Redaction takes its pieces from chunks of the text, not from its start.

Defined cases: a null or empty text has no spans; offsets are code points, end
exclusive; repeated rows are scanned each; ties at one start are ordered by
kind as in ``KINDS``; extra columns are kept by ``scan`` and ``redact``, and ``scan``
replaces an input column that is named like one it adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editsurge.llm.common import fresh_name

KINDS = ["assign", "access", "hex", "ident", "key", "endpoint"]
# The three base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}"  # a run of [0-9a-f]+ is maximal, so its least length can stand in the pattern
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

IDENT = (r"""(?i:access_?key_?id|client_?id|account_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?"""
         r"""[A-Za-z0-9_.@-]{4,}""")
KEY = "[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"""(?:https?|wss?|ftps?|sftp|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\s"'<>]{4,}"""
BLANK_LINE = r"\n[\x20\t\r]*\n"
SCOPE = 400
SPAN = "struct<s:int,e:int,k:int>"
FAR = 1 << 30
PLACEHOLDER = "[SECRET]"
#: Code points of the pieces a text is cut into for redaction.
CHUNK = 1024


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, op) -> Column:
    """Running sums or maxima (``op`` of two columns) of an array, by doubling steps."""
    powers = F.array(*[F.lit(1 << k) for k in range(31)])

    def steps(v: Column) -> Column:
        return F.aggregate(F.filter(powers, lambda p: p < F.size(v)), v, lambda acc, p: F.transform(
            acc, lambda x, i: F.when(i >= p, op(F.get(acc, i - p), x)).otherwise(x)))
    return let(values, steps)


def _sum(a: Column, b: Column) -> Column:
    return a + b


def find(text: Column, pattern: str, kind: int, least: int = 0, group: int = 0, keep=None) -> Column:
    """Leftmost non-overlapping matches as array<struct<s, e, k>>.  Splitting at
    the pattern gives the text between the matches, so the running sum of both
    lengths is the position.  Matches whose ``group`` is shorter than ``least``, or that
    ``keep`` does not accept, are dropped afterwards; they still take their place."""
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    fits = lambda x: (F.length(x["c" if group else "m"]) >= least) & (keep(x["m"]) if keep else F.lit(True))
    zipped = F.arrays_zip(matches.alias("m"), checked.alias("c")) if group else F.transform(matches, lambda m: F.struct(m.alias("m")))
    sizes = F.zip_with(between, zipped, lambda p, x: F.struct(
        F.length(p).alias("p"), F.length(x["m"]).alias("m"), F.coalesce(fits(x), F.lit(False)).alias("ok")))

    def placed(v: Column) -> Column:
        ends = running(F.transform(v, lambda x: x["p"] + F.coalesce(x["m"], F.lit(0))), _sum)
        spans = F.zip_with(v, ends, lambda x, e: F.struct((e - x["m"]).alias("s"), e.alias("e"), F.lit(kind).alias("k"), x["ok"].alias("ok")))
        return F.transform(F.filter(spans, lambda x: x["ok"]), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k")))
    return F.when(text.rlike(pattern), let(sizes, placed)).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    """All base spans, sorted by start, then kind."""
    order = lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["k"] - b["k"])
    return F.array_sort(F.concat(find(text, ASSIGN, 0, ASSIGN_LEAST, 2), find(text, ACCESS, 1, ACCESS_LEAST),
                                 find(text, HEX, 2)), order)


def _mixed(word: Column) -> Column:
    """Whether a key-like match holds a digit, a capital and a small letter."""
    return word.rlike("[0-9]") & word.rlike("[A-Z]") & word.rlike("[a-z]")


def _in_block(value: Column, block: Column) -> Column:
    """A position below FAR and the block it lies in, as one number: a later block is always larger."""
    return block * F.lit(FAR).cast("long") + value


def _seen(parts: Column, roles: list[int], backwards: bool) -> Column:
    """For each part in sweep order (``parts`` is reversed for a sweep backwards): does a part of
    the roles lie in its scope on the side the sweep comes from, with no blank line between?"""
    blocks = running(F.transform(parts, lambda x: F.when(x["k"] == -1, F.lit(1)).otherwise(F.lit(0)).cast("long")), _sum)
    edge = (lambda x: F.lit(FAR - 1) - x["s"]) if backwards else (lambda x: x["e"])
    mine = (lambda x: F.lit(FAR - 1) - x["e"]) if backwards else (lambda x: x["s"])

    def over(b: Column) -> Column:
        values = F.zip_with(parts, b, lambda x, k: F.when(x["k"].isin(roles), _in_block(edge(x), k)).otherwise(F.lit(-1).cast("long")))
        return let(running(values, F.greatest), lambda top: F.zip_with(
            parts, F.transform(b, lambda k, i: F.struct(k.alias("b"), F.get(top, i - 1).alias("last"))),
            lambda x, v: F.coalesce((v["last"] >= _in_block(F.lit(0), v["b"])) & (_in_block(mine(x), v["b"]) - v["last"] <= SCOPE), F.lit(False))))
    return let(blocks, over)


def _free(base: Column, weak: Column) -> Column:
    """The weak spans that no base span overlaps."""
    tagged = F.concat(F.transform(base, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"), F.lit(True).alias("base"))),
                      F.transform(weak, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"), F.lit(False).alias("base"))))

    def kept(v: Column) -> Column:
        ends = running(F.transform(v, lambda x: F.when(x["base"], x["e"]).otherwise(F.lit(-1))), F.greatest)
        starts = F.reverse(running(F.reverse(F.transform(v, lambda x: F.when(x["base"], x["s"]).otherwise(F.lit(FAR)))), F.least))
        sides = F.zip_with(ends, starts, lambda e, s: F.struct(e.alias("e"), s.alias("s")))
        found = F.zip_with(v, sides, lambda x, o: F.when(~x["base"] & (o["e"] <= x["s"]) & (o["s"] >= x["e"]), F.struct(
            x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
        return F.filter(found, lambda x: x.isNotNull())
    return F.when(F.size(weak) == 0, weak).otherwise(let(F.array_sort(tagged), kept))


def linked_spans(text: Column, base: Column) -> Column:
    """Weak parts whose complementary parts co-occur in their scope."""
    weak = let(F.concat(find(text, IDENT, 3), find(text, KEY, 4, keep=_mixed)), lambda w: _free(base, w))
    parts = F.array_sort(F.concat(base, weak, find(text, ENDPOINT, 5), find(text, BLANK_LINE, -1)))

    def linked(v: Column) -> Column:
        def both(roles: list[int]) -> Column:
            after = let(F.reverse(v), lambda r: F.reverse(_seen(r, roles, True)))
            return F.zip_with(_seen(v, roles, False), after, lambda a, b: a | b)
        sides = F.zip_with(both([1, 3]), both([0, 2, 4]), lambda i, z: F.struct(i.alias("i"), z.alias("z")))
        flags = F.zip_with(v, sides, lambda x, o: F.when(
            ((x["k"] == 3) & o["z"]) | ((x["k"] == 4) & o["i"]) | ((x["k"] == 5) & o["i"] & o["z"]), x))
        return F.filter(flags, lambda x: x.isNotNull())
    # without a weak part nothing can be linked; base spans alone can complete an address
    return F.when(text.rlike(f"{IDENT}|{KEY}|{ENDPOINT}"), let(parts, linked)).otherwise(F.array().cast(f"array<{SPAN}>"))


def scan(docs: DataFrame, text_col: str = "text", base: str = "base_spans", linked: str = "linked_spans") -> DataFrame:
    """``docs`` with two columns of spans (array<struct<s, e, k>>, k indexes ``KINDS``)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(base, base_spans(text)).withColumn(linked, linked_spans(text, F.col(base)))


def _listed(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts, base_sha256 and the listed spans of every document."""
    order = lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["k"] - b["k"])
    n = lambda k: F.size(F.filter("base_spans", lambda x: x["k"] == k)).cast("long")
    return scan(docs.select("doc_id", "text")).select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(_listed(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base_spans", "linked_spans"), order)).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every reported span replaced by ``PLACEHOLDER`` (overlapping
    spans by one); ``n_chars``, where it exists, follows.  Same columns as ``docs``."""
    text = F.col(text_col)
    base, linked = fresh_name(docs, "base_spans"), fresh_name(docs, "linked_spans")
    spans = F.array_sort(F.concat(base, linked))

    def without(chunks: Column) -> Column:
        """The text outside the spans, with one placeholder for each run of overlapping ones."""
        def piece(at: Column, to: Column) -> Column:
            first, last = F.floor(at / CHUNK).cast("int"), F.floor(to / CHUNK).cast("int")
            return F.substring(F.array_join(F.slice(chunks, first + 1, last - first + 1), ""), at - first * CHUNK + 1, to - at)

        def joined(v: Column) -> Column:
            ends = running(F.transform(v, lambda x: x["e"]), F.greatest)
            return let(ends, lambda reach: F.concat(
                F.array_join(F.transform(v, lambda x, i: let(F.when(i == 0, F.lit(0)).otherwise(F.get(reach, i - 1)), lambda at: F.when(
                    x["s"] >= at, F.concat(piece(at, x["s"]), F.lit(PLACEHOLDER))).otherwise(F.lit("")))), ""),
                piece(F.element_at(reach, -1), F.length(text))))
        return let(spans, joined)

    cut = let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}+"), F.lit(0)), without)
    found = scan(docs, text_col, base, linked)
    out = found.withColumn(text_col, F.when(F.size(spans) > 0, cut).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length(text_col).cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
