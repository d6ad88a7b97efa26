"""Maintained counts: late days, odd times, merged levels, dropped minutes; dedup state without the table."""
import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from editsurge.operators import trends as tr
from editsurge.operators.rollups import DailyCounts, TrailingCounts
from editsurge.sources.adapters import edits_from_events, max_ts
from editsurge.sources.sinks import to_topic_records
from editsurge.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def folder(spark):
    return J.state_dir(spark, "test-rollups", uuid.uuid4().hex)


def edits_of(spark):
    return edits_from_events(spark.read.parquet(f"{SF}/events.parquet")).checkpoint()


def test_baselines_with_late_days_and_replays(spark):
    edits = edits_of(spark)
    late = F.pmod(F.xxhash64("event_id"), F.lit(5))
    # one edit in five arrives days after its day
    edits = edits.withColumn("classified_at", F.when(late == 0, F.timestamp_add("DAY", F.lit(4), F.col("ts"))).otherwise(F.col("classified_at")))
    as_of = max_ts(edits)
    kept = DailyCounts(spark, folder(spark), fan=2, depth=2)
    for n in range(6):
        for _ in range(1 + (n == 4)):       # batch 4 is replayed
            kept.update(edits.filter(F.pmod(F.xxhash64("event_id", F.lit(1)), F.lit(6)) == n), n)
    rows = lambda df: sorted((r.topic_id, round(r.baseline_daily, 5)) for r in df.collect())
    for days in (1, 3, 8, 40):
        assert rows(kept.baselines(as_of, days, edits)) == rows(tr.recalculate_baselines(edits, as_of, days))
    hour = as_of[:13] + ":00:00"
    assert rows(kept.baselines(hour, 8)) == rows(tr.recalculate_baselines(edits, hour, 8))
    assert len(kept.table.runs(6)) <= 3
    none = DailyCounts(spark, folder(spark))
    assert rows(none.baselines(as_of, 8, edits)) == rows(tr.recalculate_baselines(edits, as_of, 8))


def test_trailing_counts_at_any_time(spark):
    edits = edits_of(spark)
    last = dt.datetime.fromisoformat(max_ts(edits))
    kept = TrailingCounts(spark, folder(spark), fan=2, depth=1)
    day = F.datediff(F.to_date(tr.effective_time()), F.lit("2024-01-01").cast("date"))
    for n in range(4):                      # batches in order of time, so that old minutes go
        kept.update(edits.filter((day >= n * 8) & (day < (n + 1) * 8) if n < 3 else day >= 24), n)
    rows = lambda df, c: sorted((r.period, r.topic_id, r[c]) for r in df.collect())
    for back in (0, 2231, 3600 * 5, 86400 + 1):
        at = last - dt.timedelta(seconds=back)
        if back == 3600 * 5:
            at = at.replace(minute=0, second=0)      # on the hour: no minutes at all
        assert rows(kept.counts(str(at), edits), "edit_count") == rows(tr.trend_counts(edits, str(at)), "edit_count")
    minutes = kept.tables["minute"].read().agg(F.min("at")).first()[0]
    assert last - minutes < dt.timedelta(days=15) and last - edits.agg(F.min("ts")).first()[0] > dt.timedelta(days=25)


def test_cover_is_the_fewest_buckets(spark):
    t = TrailingCounts(spark, "/nowhere")
    row = spark.range(1).select(*[c.alias(f"{b}_{k}") for b, lo, hi in t.cover("2024-01-10 12:34:56", "Last7Days")
                                  for k, c in (("lo", lo), ("hi", hi)) if c is not None]).first()
    at = dt.datetime
    assert (row.minute_lo, row.minute_hi, row.hour_hi, row.day_lo) == (
        at(2024, 1, 3, 12, 35), at(2024, 1, 3, 13), at(2024, 1, 4), at(2024, 1, 4))


def test_dedup_needs_no_stored_table(spark):
    """The second run writes to another table, so ids can only come from the stream's state."""
    d, edits = folder(spark), edits_of(spark)
    topic, ck = os.path.join(d, "topic"), os.path.join(d, "ck")
    for k in range(2):
        more = edits.limit(0) if not k else edits.limit(2).withColumn("event_id", F.concat(F.lit("new-"), "event_id"))
        to_topic_records(edits.unionByName(more), "article_id").coalesce(1).write.mode("append").json(topic)
        J.start_dedup_ingest(spark, topic, os.path.join(d, f"t{k}"), ck, os.path.join(d, f"late{k}"), delay="60 days",
                             trigger={"availableNow": True}).awaitTermination()
    assert spark.read.parquet(os.path.join(d, "t0")).count() == edits.count()
    assert spark.read.parquet(os.path.join(d, "t1")).count() == 2
    assert spark.read.parquet(os.path.join(d, "late1")).count() == 0
