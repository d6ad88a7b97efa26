"""Counts kept from batch to batch, so that hourly and minutely reports read no history.

``DailyCounts`` (A-02, A-03): edits by topic, day of the edit and hour of the effective time.
The baseline needs a day's edits whose effective time lies in the lookback; whole hours come
from the counts, and only where the lookback starts inside an hour are the edits of
that hour read.  An edit that arrives days late adds to its own day.

``TrailingCounts`` (T-11): edits by topic and minute, hour and day of the effective time.  A
trailing window is covered by the fewest buckets: days, then the hours before the first
whole day, then the minutes before the first whole hour, and the edits of the minute it starts
in.  Minutes and hours that no window can need any more are dropped.

``ActivitySketches`` (A-12): edits, newest edit and a distinct-count sketch of the editors by topic
and day.  Sketches of days merge, so the editors of any run of days are known within the
sketch's error (about 1.6 %) without reading edits; ``topic_stats`` stays the exact way.

All are run tables that merge: a batch writes its own counts, a replay writes them again,
and a reader finds a bounded number of runs.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editsurge.functions.scalar import PERIODS, to_day
from editsurge.operators import trends as tr
from editsurge.sources.adapters import epoch_micros, ts_lit
from editsurge.sources.runs import RunTable

#: Bucket lengths in microseconds, shortest first.
BUCKETS = {"minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}
#: How far back minutes and hours can be needed: the longest window and the bucket it starts in.
HORIZONS = {"minute": "169 HOURS", "hour": "192 HOURS", "day": "192 HOURS"}


def floor_to(ts: Column, bucket: str) -> Column:
    """Start of the bucket of a TIMESTAMP_NTZ (no time-zone round trip)."""
    return F.timestamp_add("MICROSECOND", -F.pmod(epoch_micros(ts), F.lit(BUCKETS[bucket])), ts)


def ceil_to(ts: Column, bucket: str) -> Column:
    """The first bucket start that is not before a time."""
    return F.timestamp_add("MICROSECOND", F.pmod(-epoch_micros(ts), F.lit(BUCKETS[bucket])), ts)


class DailyCounts:
    def __init__(self, spark: SparkSession, path: str, **levels):
        self.table = RunTable(spark, path, ["topic_id", "day", "hour"], fold="sum", **levels)

    def update(self, edits: DataFrame, batch_id: int) -> None:
        self.table.write(edits.select(to_day("ts").alias("day"), floor_to(tr.effective_time(), "hour").alias("hour"),
                                      F.explode("topics.topic_id").alias("topic_id"))
                              .groupBy("topic_id", "day", "hour").agg(F.count("*").alias("edits")), batch_id)

    def daily(self, as_of: str, days: int = tr.BASELINE_LOOKBACK_DAYS, edits: DataFrame | None = None) -> DataFrame:
        """A-02 from the counts: topic_id, day, daily_count.  Without ``edits`` the lookback starts
        at the next whole hour; with them it is exact."""
        start = ts_lit(as_of) - F.expr(f"INTERVAL {max(1, days)} DAYS")
        first = ceil_to(start, "hour")
        kept = self.table.read()
        parts = []
        if kept is not None:
            parts.append(kept.filter(F.col("hour") >= first).select("topic_id", "day", "edits"))
        if edits is not None or not parts:
            if edits is None:
                raise ValueError("neither counts nor edits")
            eff = tr.effective_time()
            if kept is not None:
                edge = tr.prune_from(edits, start).filter((eff >= start) & (eff < first))
            else:
                edge = tr.prune_from(edits, start).filter(tr.effective_after(start))
            parts.append(edge.select(F.explode("topics.topic_id").alias("topic_id"), to_day("ts").alias("day"), F.lit(1).cast("long").alias("edits"))
                             .select("topic_id", "day", "edits"))
        both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return both.groupBy("topic_id", "day").agg(F.sum("edits").alias("daily_count"))

    def baselines(self, as_of: str, days: int = tr.BASELINE_LOOKBACK_DAYS, edits: DataFrame | None = None) -> DataFrame:
        """A-03: as ``recalculate_baselines``, from the counts."""
        return (self.daily(as_of, days, edits).groupBy("topic_id")
                    .agg(F.avg("daily_count").cast("float").alias("baseline_daily"))
                    .select(F.col("topic_id").cast("int").alias("topic_id"), "baseline_daily", ts_lit(as_of).alias("calculated_at")))


class TrailingCounts:
    def __init__(self, spark: SparkSession, path: str, **levels):
        self.tables = {b: RunTable(spark, os.path.join(path, b), ["topic_id", "at"], fold="sum", horizon=("at", HORIZONS[b]), **levels)
                       for b in BUCKETS}

    def update(self, edits: DataFrame, batch_id: int) -> None:
        one = edits.select(tr.effective_time().alias("eff"), F.explode("topics.topic_id").alias("topic_id")).filter("eff IS NOT NULL")
        below = None
        for bucket, table in self.tables.items():   # each level from the one below: one scan of the batch
            if below is None:
                counts = one.groupBy("topic_id", floor_to(F.col("eff"), bucket).alias("at")).agg(F.count("*").alias("edits"))
            else:
                counts = below.groupBy("topic_id", floor_to(F.col("at"), bucket).alias("at")).agg(F.sum("edits").alias("edits"))
            below = counts.checkpoint()
            table.write(below, batch_id)

    def cover(self, as_of: str, period: str) -> list[tuple[str, Column, Column | None]]:
        """(bucket, from, to) of the buckets of a window; the last ones have no end."""
        start = tr.window_start(as_of, period)
        cuts = [ceil_to(start, b) for b in BUCKETS]
        return list(zip(BUCKETS, cuts, [*cuts[1:], None]))

    def counts(self, as_of: str, edits: DataFrame) -> DataFrame:
        """A-01 from the buckets: period, topic_id, edit_count.  Of ``edits`` only the minute in
        which each window starts is read."""
        eff, parts = tr.effective_time(), []
        read = {b: t.read() for b, t in self.tables.items()}
        for period in PERIODS:
            start = tr.window_start(as_of, period)
            for bucket, lo, hi in self.cover(as_of, period):
                if read[bucket] is None:
                    continue
                inside = F.col("at") >= lo if hi is None else (F.col("at") >= lo) & (F.col("at") < hi)
                parts.append(read[bucket].filter(inside).select(F.lit(period).alias("period"), "topic_id", "edits"))
            edge = tr.prune_from(edits, start).filter((eff >= start) & (eff < ceil_to(start, "minute")))
            parts.append(edge.select(F.lit(period).alias("period"), F.explode("topics.topic_id").alias("topic_id"),
                                     F.lit(1).cast("long").alias("edits")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.groupBy("period", "topic_id").agg(F.sum("edits").alias("edit_count"))


#: log2 of a sketch's registers: a relative error of about 1.04 / sqrt(2 ** 12).
SKETCH_K = 12


class ActivitySketches:
    def __init__(self, spark: SparkSession, path: str, **levels):
        self.table = RunTable(spark, path, ["topic_id", "day"], fold={
            "edits": F.sum, "last_edit_at": F.max, "editors": F.hll_union_agg}, **levels)

    def update(self, edits: DataFrame, batch_id: int) -> None:
        e = edits.select("user", "ts", to_day("ts").alias("day"), F.explode("topics.topic_id").alias("topic_id"))
        self.table.write(e.groupBy("topic_id", "day").agg(
            F.count("*").alias("edits"), F.max("ts").alias("last_edit_at"),
            F.hll_sketch_agg(F.coalesce("user", F.lit("")), SKETCH_K).alias("editors")), batch_id)

    def stats(self, first_day: str | None = None, last_day: str | None = None) -> DataFrame | None:
        """topic_id, edit_count, unique_editors (estimated), last_edit_at over the days from first to last."""
        kept = self.table.read()
        if kept is None:
            return None
        if first_day is not None:
            kept = kept.filter(F.col("day") >= F.to_date(F.lit(first_day)))
        if last_day is not None:
            kept = kept.filter(F.col("day") <= F.to_date(F.lit(last_day)))
        return kept.groupBy("topic_id").agg(
            F.sum("edits").alias("edit_count"), F.hll_sketch_estimate(F.hll_union_agg("editors")).alias("unique_editors"),
            F.max("last_edit_at").alias("last_edit_at"))
