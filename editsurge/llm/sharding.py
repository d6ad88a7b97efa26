"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0 .. N-1 in (doc_id, crc, size) order.  Row r goes to the
place P(r), where P permutes 0 .. N-1; its shard is P(r) mod the shard count
and its slot P(r) div the shard count, so shard sizes are at most one row apart
(the ``rows`` law) and slots have no gaps.  ``place`` computes the same for any
row number without the table; ``row_at`` inverts it.

P is a Feistel network on pairs (l, r) of Z_a x Z_b with a*b >= N and a*b < N + a:
alternately l and r get a keyed function of the other added.  A value that
lands at N or beyond is permuted again until it is below N (cycle walking);
fewer than a values can start such a walk, and ``longest_walk`` computes the
longest one exactly, so the column expression repeats as often as is needed and no
more.  The numbering is a range sort plus per-partition offsets: no task sees
all rows, and identical rows are spread by their place in the input, which
changes no result.

Defined cases: a null text has no bytes (size 1) and the crc of the empty
text; null doc_ids come first; rows that are equal in id, crc and size are
interchangeable; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editsurge.llm.common import cut, shuffle_partitions

PRIME = (1 << 31) - 1
ROUNDS = 6
KEY = 20_240_229


def domain(n: int) -> tuple[int, int]:
    """(a, b) with a*b >= n, as square as possible."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def round_keys(key: int = KEY) -> list[tuple[int, int]]:
    """A pair of constants for each round, from the key by a linear congruence."""
    out, x = [], key % PRIME
    for _ in range(ROUNDS):
        x = (x * 48_271 + 11) % PRIME
        y = (x * 69_621 + 7) % PRIME
        out.append((x, y | 1))
        x = y
    return out


def mix(value, keys):
    """Round function; the same on integers and on long columns (products below 2**62)."""
    y = (value + keys[0]) % PRIME
    z = (y * y) % PRIME
    return (z * keys[1] + y) % PRIME


def permute_pair(left, right, a: int, b: int, key: int = KEY):
    for k, keys in enumerate(round_keys(key)):
        if k % 2:
            right = (right + mix(left, keys)) % b
        else:
            left = (left + mix(right, keys)) % a
    return left, right


def permute(x: int, n: int, key: int = KEY) -> int:
    """One application of the permutation of 0 .. a*b-1."""
    a, b = domain(n)
    left, right = permute_pair(x // b, x % b, a, b, key)
    return left * b + right


def place(row: int, n: int, key: int = KEY) -> int:
    """P(row): the permutation with cycle walking."""
    x = permute(row, n, key)
    while x >= n:
        x = permute(x, n, key)
    return x


def row_at(position: int, n: int, key: int = KEY) -> int:
    """The row number whose place is ``position`` (walks the inverse)."""
    a, b = domain(n)
    x = position
    while True:
        left, right = divmod(x, b)
        for k, keys in reversed([*enumerate(round_keys(key))]):
            if k % 2:
                right = (right - mix(left, keys)) % b
            else:
                left = (left - mix(right, keys)) % a
        x = left * b + right
        if x < n:
            return x


def longest_walk(n: int, key: int = KEY) -> int:
    """The most applications any row needs: 1 plus the longest chain of values at or
    beyond n.  There are fewer than sqrt(n) + 1 such values."""
    a, b = domain(n)
    over = {x: permute(x, n, key) for x in range(n, a * b)}
    heads, longest = set(over) - set(over.values()), 0
    for x in heads:
        steps = 0
        while x in over:
            x, steps = over[x], steps + 1
        longest = max(longest, steps)
    return 1 + longest


def place_column(row: Column, n: int, key: int = KEY) -> Column:
    """P(row) as a column expression."""
    a, b = domain(n)
    keys = F.array(*[F.struct(F.lit(x).cast("long").alias("x"), F.lit(y).cast("long").alias("y"), F.lit(k % 2 == 1).alias("odd"))
                     for k, (x, y) in enumerate(round_keys(key))])
    f = lambda v, c: _mix_column(v, c["x"], c["y"])

    def apply(x: Column) -> Column:
        return F.aggregate(
            keys, F.struct(_div(x, b).alias("l"), (x % F.lit(b)).alias("r")),
            lambda acc, c: F.struct(
                F.when(c["odd"], acc["l"]).otherwise((acc["l"] + f(acc["r"], c)) % F.lit(a)).alias("l"),
                F.when(c["odd"], (acc["r"] + f(acc["l"], c)) % F.lit(b)).otherwise(acc["r"]).alias("r")),
            lambda acc: acc["l"] * F.lit(b) + acc["r"])

    walks = longest_walk(n, key)
    first = apply(row)
    if walks == 1:
        return first
    return F.aggregate(F.sequence(F.lit(1), F.lit(walks - 1)), first,
                       lambda acc, _: F.when(acc < n, acc).otherwise(apply(acc)))


def _div(x: Column, b: int) -> Column:
    """Integer division of non-negative longs."""
    return F.call_function("div", x, F.lit(b)).cast("long")


def _mix_column(value: Column, x: Column, y: Column) -> Column:
    p = F.lit(PRIME).cast("long")
    v = (value + x) % p
    return (((v * v) % p) * y + v) % p


def number_rows(rows: DataFrame, order: list[str], name: str = "row") -> DataFrame:
    """``rows`` with global row numbers from 0 in ``order``.

    A range exchange by ``order`` and, last, the row's place in the input (which
    splits runs of equal rows), a sort inside each partition, one write to the
    shared folder, then the count of the partitions before."""
    spark = rows.sparkSession
    parts = shuffle_partitions(spark)
    laid = cut(rows.withColumn("_at", F.monotonically_increasing_id())
                   .repartitionByRange(parts, *order, "_at").sortWithinPartitions(*order, "_at"))
    numbered = laid.withColumn("_m", F.monotonically_increasing_id()).select(
        *rows.columns, F.shiftright("_m", 33).alias("_p"), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)).alias("_i"))
    sizes = numbered.groupBy("_p").agg(F.count("*").alias("_n"))  # a row for each partition
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    return (numbered.join(F.broadcast(offsets), "_p")
                    .select(*rows.columns, (F.col("_o") + F.col("_i")).alias(name)))


def shard(docs: DataFrame, shards: int = 8, key: int = KEY) -> DataFrame:
    """doc_id, size, text_crc32, row, shard, slot of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    facts = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = number_rows(facts, ["doc_id", "text_crc32", "size"])
    n = rows.count()
    at = rows.withColumn("place", place_column(F.col("row"), max(n, 1), key))
    return at.select("doc_id", "size", "text_crc32", "row",
                     (F.col("place") % shards).cast("int").alias("shard"), _div(F.col("place"), shards).alias("slot"))


def digest(docs: DataFrame, shards: int = 8) -> DataFrame:
    return shard(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row")
