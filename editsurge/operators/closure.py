"""J-13 maintained: the class closure of the start classes, kept from batch to batch.

``class_closure`` walks the graph anew for the classes it is given.  ``ClassClosure`` stores
its pairs (cls, anc) and the subclass edges as run tables and changes only what a
batch touches:

* new start classes and new edges are followed semi-naively, from the pairs they
  extend;
* for removed edges, all pairs with a derivation over them are taken out first
  (over-deletion), then those that have another derivation from what is left are
  put back, and followed like new ones.

Only pairs of affected start classes are read again: those that reach the tail of a
changed edge, and the new ones.  A batch that changes nothing runs no round, and each round
joins the pairs of the round before with their own edges.  Every step reads the
state of earlier batches only, so a replayed batch writes the same rows again.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editsurge.session import ensure_checkpoint_dir
from editsurge.sources.runs import GONE, RunTable

EDGE, PAIR = ["child", "parent"], ["cls", "anc"]


def _cut(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _follow(start: DataFrame, step: Callable[[DataFrame], DataFrame], known: DataFrame) -> tuple[DataFrame, int]:
    """All pairs that ``start`` leads to and that ``known`` does not hold, and the rounds run."""
    delta = _cut(start.distinct().join(known, PAIR, "left_anti"))
    parts, rounds = [delta], 0
    while not delta.isEmpty():
        rounds += 1
        delta = _cut(step(delta).distinct().join(_union([known, *parts]), PAIR, "left_anti"))
        parts.append(delta)
    return _union(parts), rounds


class ClassClosure:
    def __init__(self, spark: SparkSession, path: str, fan: int = 8, depth: int = 2):
        self.spark = spark
        self.edges = RunTable(spark, os.path.join(path, "edges"), EDGE, fan=fan, depth=depth)
        self.pairs = RunTable(spark, os.path.join(path, "pairs"), PAIR, fan=fan, depth=depth)

    def _empty(self, columns: list[str]) -> DataFrame:
        return self.spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))

    def _edges(self, before: int, only: DataFrame | None = None) -> DataFrame:
        found = self.edges.read(before, only)
        return self._empty(EDGE) if found is None else found.select(*EDGE)

    def _pairs(self, before: int, only: DataFrame | None = None) -> DataFrame:
        found = self.pairs.read(before, only)
        return self._empty(PAIR) if found is None else found.select(*PAIR)

    def read(self, before: int | None = None) -> DataFrame:
        """(cls, anc): every maintained start class with each class it reaches, itself included."""
        return self._pairs(self.pairs.next_batch() if before is None else before)

    def update(self, batch_id: int, starts: DataFrame | None = None, added: DataFrame | None = None,
               removed: DataFrame | None = None) -> int:
        """Take in start classes (cls) and edges (child, parent) of a batch; returns the rounds run.
        An edge that one batch removes and adds is there afterwards.  Rows with a null are ignored."""
        rows = []
        if starts is not None:
            s = starts.select("cls", F.col("cls").alias("anc")).dropna().distinct()
            known = self._pairs(batch_id, s)
            rows.append(s.join(known, PAIR, "left_anti").select(F.lit("start").alias("kind"), F.col("cls").alias("a"), F.col("anc").alias("b")))
        plus = self._empty(EDGE) if added is None else added.select(*EDGE).dropna().distinct()
        if added is not None:
            known = self._edges(batch_id, plus)
            rows.append(plus.join(known, EDGE, "left_anti").select(F.lit("add").alias("kind"), F.col("child").alias("a"), F.col("parent").alias("b")))
        if removed is not None:
            minus = removed.select(*EDGE).dropna().distinct().join(plus, EDGE, "left_anti")
            rows.append(self._edges(batch_id, minus).join(minus, EDGE, "left_semi")
                            .select(F.lit("remove").alias("kind"), F.col("child").alias("a"), F.col("parent").alias("b")))
        changes = _cut(_union(rows)) if rows else None
        kinds = {r.kind for r in changes.select("kind").distinct().collect()} if rows else set()  # three at most
        if not kinds:
            self.edges.write(None, batch_id)
            self.pairs.write(None, batch_id)
            return 0
        of = lambda kind, names: changes.filter(F.col("kind") == kind).select(
            F.col("a").alias(names[0]), F.col("b").alias(names[1]))
        new, ins, del_ = of("start", PAIR), of("add", EDGE), of("remove", EDGE)

        tails = ins.unionByName(del_).select(F.col("child").alias("anc"))
        touched = self._pairs(batch_id, tails).select("cls").unionByName(new.select("cls")).distinct()
        before = _cut(self._pairs(batch_id, touched))

        def up(pairs: DataFrame, edges: DataFrame) -> DataFrame:
            return pairs.join(edges, pairs.anc == edges.child).select("cls", F.col("parent").alias("anc"))

        # The edges are folded and written once; each round joins them with its few pairs.
        edges = _cut(self._edges(batch_id))
        after = edges if kinds == {"start"} else _cut(edges.join(del_, EDGE, "left_anti").unionByName(ins))

        def old_step(delta: DataFrame) -> DataFrame:
            return up(delta, edges).filter("cls <> anc")

        def new_step(delta: DataFrame) -> DataFrame:
            return up(delta, after)

        rounds, over, kept, seeds = 0, self._empty(PAIR), before, [new, up(before, ins)]
        if "remove" in kinds:
            over, rounds = _follow(up(before, del_).filter("cls <> anc"), old_step, self._empty(PAIR))
            over = _cut(over)
            kept = _cut(before.join(over, PAIR, "left_anti"))
            other = over.join(after, over.anc == after.parent).select("cls", "anc", "child")
            again = other.join(kept.select("cls", F.col("anc").alias("child")), ["cls", "child"], "left_semi").select(*PAIR)
            seeds = [new, up(kept, ins), again]
        found, more = _follow(_union(seeds), new_step, kept)
        found = _cut(found)
        gone = over.join(found, PAIR, "left_anti").withColumn(GONE, F.lit(True))
        fresh = found.join(before, PAIR, "left_anti").withColumn(GONE, F.lit(False))
        self.pairs.write(gone.unionByName(fresh), batch_id)
        self.edges.write(ins.withColumn(GONE, F.lit(False)).unionByName(del_.withColumn(GONE, F.lit(True))), batch_id)
        return rounds + more
