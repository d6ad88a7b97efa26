"""Keyed tables written batch by batch as a bounded number of sorted runs.

A streaming job that keeps a table up to date (article versions, class pairs, counts)
writes one small run for each micro-batch.  Read as they are, the runs of a day would be
thousands of files; rewriting the table in each batch would move all of it.  A
``RunTable`` merges runs in levels instead: every ``fan`` runs of a level become one run
of the next, and the last level is the base, which every ``fan ** depth`` batches
takes in all that came after it.  So a batch reads the base and at most
``depth * (fan - 1)`` runs, whatever its number, and a row is rewritten ``depth``
times between two bases.

Which runs make up the table before batch N follows from N alone.  A batch that is
replayed therefore reads what it read the first time, writes over its own run and
repeats its merges with the same rows; merges change no result.

Runs lie in ``level=L/batch_id=H`` (H is the last batch in it), sorted by key.  Rows of
one key are folded by the table's rule: ``latest`` keeps those of the newest batch (one
row for each key and batch; a true ``gone`` column deletes), ``sum`` adds all other columns.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GONE = "gone"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


class RunTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], fold: str | dict[str, Callable[[str], Column]] = "latest", fan: int = 8, depth: int = 2,
                 horizon: tuple[str, str] | None = None):
        if not isinstance(fold, dict) and fold not in ("latest", "sum"):
            raise ValueError(f"unknown fold {fold}")
        if fan < 2 or depth < 1:
            raise ValueError("fan must be 2 or more and depth 1 or more")
        self.spark, self.path, self.keys, self.fold, self.fan, self.depth = spark, path.rstrip("/"), keys, fold, fan, depth
        self.horizon = horizon

    def _run(self, level: int, last: int) -> str:
        return os.path.join(self.path, f"level={level}", f"batch_id={last}")

    def cover(self, before: int) -> list[tuple[int, int]]:
        """(level, last batch) of the runs that hold the batches below ``before``, oldest first."""
        span = self.fan ** self.depth
        at = before // span * span
        out = [(self.depth, at - 1)] if at else []
        for level in range(self.depth - 1, -1, -1):
            size = self.fan ** level
            while at + size <= before:
                at += size
                out.append((level, at - 1))
        return out

    def runs(self, before: int) -> list[str]:
        """Folders of the runs that hold the batches below ``before`` (batches without rows have none)."""
        return [p for p in (self._run(*r) for r in self.cover(before)) if _exists(self.spark, os.path.join(p, "_SUCCESS"))]

    def _listed(self, level: int) -> list[tuple[object, object, int]]:
        """(file system, folder, last batch) of every run of a level."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, f"level={level}"))
        fs = folder.getFileSystem(conf)
        if not fs.exists(folder):
            return []
        found = [(s.getPath(), s.getPath().getName()) for s in fs.listStatus(folder)]
        return [(fs, p, int(n.split("=")[1])) for p, n in found if n.startswith("batch_id=")]

    def next_batch(self) -> int:
        """One more than the newest batch that a run holds."""
        return 1 + max((last for level in range(self.depth + 1) for _, _, last in self._listed(level)), default=-1)

    def _load(self, paths: list[str]) -> DataFrame:
        return self.spark.read.option("basePath", self.path).parquet(*paths).drop("level")

    def _folded(self, df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c not in self.keys and c != "batch_id"]
        if isinstance(self.fold, dict):
            return df.groupBy(*self.keys).agg(*[agg(c).alias(c) for c, agg in self.fold.items()])
        if self.fold == "sum":
            return df.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in rest])
        if not rest:
            return df.select(*self.keys).distinct()
        newest = df.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_v"))
        return newest.select(*self.keys, "_v.*")

    def read(self, before: int | None = None, only: DataFrame | None = None) -> DataFrame | None:
        """The table as of the batches below ``before`` (all, if None); None without a run.
        ``only`` (some of the key columns) keeps the keys it holds, before any exchange of rows."""
        before = self.next_batch() if before is None else before
        paths = self.runs(before)
        if not paths:
            return None
        df = self._load(paths)
        if only is not None:
            df = df.join(only.distinct(), only.columns, "left_semi")
        out = self._folded(df)
        return out.filter(~F.col(GONE)).drop(GONE) if GONE in out.columns else out

    def write(self, df: DataFrame | None, batch_id: int) -> None:
        """Write the rows of a batch (None: there are none), then the merges that are due after it."""
        if df is not None:
            df.sortWithinPartitions(*self.keys).write.mode("overwrite").parquet(self._run(0, batch_id))
        n = batch_id + 1
        for level in range(1, self.depth + 1):
            if n % self.fan ** level:
                break
            self._merge(level, n)
        if n % self.fan ** self.depth == 0:
            self._forget(n - self.fan ** self.depth)

    def _merge(self, level: int, n: int) -> None:
        """Fold the ``fan`` runs of the level below (and the base before them) into one."""
        size = self.fan ** (level - 1)
        parts = [(level - 1, n - 1 - k * size) for k in range(self.fan - 1, -1, -1)]
        if level == self.depth and n > self.fan ** level:
            parts.insert(0, (level, n - 1 - self.fan ** level))
        paths = [p for p in (self._run(*r) for r in parts) if _exists(self.spark, os.path.join(p, "_SUCCESS"))]
        if not paths:
            return
        out = self._folded(self._load(paths))
        if level == self.depth and GONE in out.columns:  # nothing older is left to be deleted
            out = out.filter(~F.col(GONE))
        if level == self.depth and self.horizon:
            column, reach = self.horizon
            newest = out.agg(F.max(column).alias("_newest"))  # one row
            out = out.join(F.broadcast(newest), F.col(column) >= F.col("_newest") - F.expr(f"INTERVAL {reach}")).drop("_newest")
        out.sortWithinPartitions(*self.keys).write.mode("overwrite").parquet(self._run(level, n - 1))

    def _forget(self, base: int) -> None:
        """Delete the runs below the base that ends before batch ``base``.  The newer base and
        the runs behind it are kept, so the batch that made it can still be replayed."""
        for level in range(self.depth + 1):
            for fs, run, last in self._listed(level):
                if last < base - (1 if level == self.depth else 0):
                    fs.delete(run, True)
