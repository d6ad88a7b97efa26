"""Operational metrics: collector counters, consumer interval stats, slow
records.  The reference logged these from in-process counters; here they
are aggregates over the record/processing logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Stats interval and slow-message threshold.
STATS_INTERVAL_SECONDS = 10
SLOW_MESSAGE_MS = 2000


def collector_stats(changes: DataFrame, **filters) -> DataFrame:
    """A-14: processed (read), published (kept by the feed filter), skipped
    and the time of the last published event: one global aggregate (partial
    per task, one row out).  Streaming queries get the same numbers from
    ``df.observe``."""
    from editsurge.functions.scalar import parse_epoch
    from editsurge.operators.ingest import reject_reason
    kept = reject_reason(**filters).isNull()
    return (changes.agg(F.count("*").alias("processed"),
                        F.count_if(kept).alias("published"),
                        F.max(F.when(kept, parse_epoch("timestamp"))).alias("last_event_at"))
                   .withColumn("skipped", F.col("processed") - F.col("published")))


def slow_records(log: DataFrame, threshold_ms: int = SLOW_MESSAGE_MS) -> DataFrame:
    """F-13: records whose processing took at least the threshold; 0 turns
    the check off (no rows)."""
    if threshold_ms <= 0:
        return log.filter(F.lit(False))
    return log.filter(F.col("elapsed_ms") >= threshold_ms)


def consumer_interval_stats(log: DataFrame, seconds: int = STATS_INTERVAL_SECONDS,
                            slow_ms: int = SLOW_MESSAGE_MS) -> DataFrame:
    """A-15: per tumbling interval and (topic, group): processed, events/s
    (divisor max(0.001, interval)), average and max ms, slow count."""
    secs = max(1, seconds)
    slow = (F.col("elapsed_ms") >= slow_ms) if slow_ms > 0 else F.lit(False)
    return (log.groupBy(F.window("processed_at", f"{secs} seconds").alias("w"), "topic", "group_id")
               .agg(F.count("*").alias("processed"),
                    F.avg("elapsed_ms").alias("avg_ms"),
                    F.max("elapsed_ms").alias("max_ms"),
                    F.count_if(slow).alias("slow_count"))
               .select(F.col("w.start").alias("interval_start"), "topic", "group_id", "processed",
                       (F.col("processed") / F.lit(max(0.001, float(secs)))).alias("events_per_sec"),
                       "avg_ms", "max_ms", "slow_count"))
