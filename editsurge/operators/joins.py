"""Join and ranking helpers for keys that may be hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editsurge.session import ensure_checkpoint_dir

#: Pieces over which rows without a key are spread.
NULL_PIECES = 64
#: Spark limits groups before the exchange up to this n (spark.sql.optimizer.windowGroupLimitThreshold).
RANK_LIMIT = 1000
#: Pieces a large group is ranked in before its leaders are ranked together.
RANK_PIECES = 32


def skew_safe_lookup(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Many-to-one lookup of ``right`` (unique on ``keys``) for every ``left`` row.

    One pass over either side.  Both are exchanged for the join itself, so AQE
    measures the partitions and splits those that a hot key makes large
    (``spark.sql.adaptive.skewJoin``), copying only the matching ``right`` rows; a small
    ``right`` is broadcast by its measured size.  Rows with a null key match
    nothing; they are dealt by a hash of the row instead of meeting on one task."""
    unknown = F.lit(False)
    for k in keys:
        unknown = unknown | F.col(k).isNull()
    piece = F.pmod(F.xxhash64(*left.columns), F.lit(NULL_PIECES)).cast("int")
    dealt = left.withColumn("_piece", F.when(unknown, piece).otherwise(0))
    return dealt.join(right.withColumn("_piece", F.lit(0)), [*keys, "_piece"], how).drop("_piece")


def first_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str) -> DataFrame:
    """The first max(1, n) rows of each group with their position ``name``.

    Up to ``RANK_LIMIT`` Spark keeps n rows of a group and task before the exchange
    (WindowGroupLimit).  For a larger n it does not; then groups are ranked in
    pieces first, so that no task holds a whole hot group, and the pieces'
    leaders together.  The rows are the same."""
    n = max(1, n)
    piece = Window.partitionBy(*keys, "_piece").orderBy(*order)
    group = Window.partitionBy(*keys).orderBy(*order)
    if n > RANK_LIMIT:
        pieces = df.withColumn("_piece", F.pmod(F.xxhash64(*[c for c in df.columns if c not in keys]), F.lit(RANK_PIECES)))
        df = pieces.withColumn(name, F.row_number().over(piece)).filter(F.col(name) <= n).drop("_piece", name)
    return df.withColumn(name, F.row_number().over(group)).filter(F.col(name) <= n)



#: Rows of a report's list that may come to the driver.
LIST_ROWS = 5000


def limited(df: DataFrame, most: int) -> DataFrame:
    """A list of at most ``most`` rows whose plan ends here, so that what uses it several times
    does not compute it again.  Up to ``LIST_ROWS`` rows become a local relation, which the
    planner broadcasts without an exchange; a longer list is checkpointed."""
    if most > LIST_ROWS:
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint()
    return df.sparkSession.createDataFrame(df.toArrow(), schema=df.schema)
