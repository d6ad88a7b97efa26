"""Structured Streaming jobs: exactly-once ingest, dedup, minute rollup."""

import os
import uuid

from pyspark.sql import functions as F

from editsurge.sources.adapters import edits_from_events, max_ts
from editsurge.sources.sinks import to_topic_records
from editsurge.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def topic_dir(spark, copies=1):
    d = J.state_dir(spark, "test-streams", uuid.uuid4().hex)
    ev = spark.read.parquet(f"{SF}/events.parquet")
    edits = edits_from_events(ev)
    rec = to_topic_records(edits, "article_id")
    out = rec
    for _ in range(copies - 1):
        out = out.unionByName(rec)
    out.repartition(3).write.json(os.path.join(d, "topic"))
    return d, edits


def test_ingest_exactly_once_on_restart(spark):
    d, edits = topic_dir(spark)
    args = (os.path.join(d, "topic"), os.path.join(d, "t"), os.path.join(d, "bad"), os.path.join(d, "ck"))
    q = J.start_ingest(spark, *args, trigger={"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    n1 = spark.read.parquet(os.path.join(d, "t")).count()
    # Restart from the same checkpoint: nothing is read twice.
    q = J.start_ingest(spark, *args, trigger={"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(d, "t")).count() == n1 == edits.count()


def test_batch_sink_is_idempotent(spark):
    d = J.state_dir(spark, "test-streams", uuid.uuid4().hex)
    df = spark.range(10)
    J._write_batch(df, d, 7)
    J._write_batch(df, d, 7)   # a replayed batch replaces its own output
    assert spark.read.parquet(d).count() == 10


def test_dedup_within_watermark(spark):
    d, edits = topic_dir(spark, copies=2)
    q = J.start_dedup_ingest(spark, os.path.join(d, "topic"), os.path.join(d, "t"), os.path.join(d, "ck"),
                             os.path.join(d, "late"), delay="60 days", trigger={"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(d, "late")).count() == 0
    t = spark.read.parquet(os.path.join(d, "t"))
    assert t.count() == edits.count() == t.select("event_id").distinct().count()


def test_dedup_keeps_events_without_a_time(spark):
    d, edits = topic_dir(spark)
    args = (os.path.join(d, "topic"), os.path.join(d, "t"), os.path.join(d, "ck"), os.path.join(d, "late"))
    timeless = edits.limit(3).withColumn("event_id", F.concat(F.lit("no-time-"), "event_id")).withColumn(
        "classified_at", F.lit(None).cast("timestamp_ntz"))
    for k in range(3):
        if k:
            to_topic_records(timeless, "article_id").coalesce(1).write.mode("append").json(args[0])
        J.start_dedup_ingest(spark, *args, delay="60 days", trigger={"availableNow": True}).awaitTermination()
    assert spark.read.parquet(args[1]).filter("classified_at IS NULL AND event_id LIKE 'no-time-%'").count() == 3
    assert spark.read.parquet(args[3]).count() == 0


def test_minute_rollup_matches_batch_counts(spark):
    d, edits = topic_dir(spark)
    q = J.start_minute_rollup(spark, os.path.join(d, "topic"), os.path.join(d, "r"), os.path.join(d, "ck"),
                              {"availableNow": True})
    q.awaitTermination()
    as_of = max_ts(edits)
    r = J.trailing_from_rollup(spark.read.parquet(os.path.join(d, "r")), as_of, edits)
    week = {x.topic_id: x.edit_count for x in r.filter(F.col("period") == "Last7Days").collect()}
    # Stream rollup summed over 7 days, with the edge minute's edits, equals a direct count.
    from editsurge.operators import trends as tr
    e = tr.explode_topics(edits.select(tr.effective_time().alias("m"), "topics"), "m")
    direct = {x.topic_id: x.n for x in e.filter(F.col("m") >= tr.window_start(as_of, "Last7Days")).groupBy("topic_id").agg(F.count("*").alias("n")).collect()}
    assert week == direct


def test_enrich_stream_refreshes_once_across_batches(spark):
    """An article refreshed in batch 1 is fresh for batch 2 (no second call,
    no links), because the stream appends its upserts to a change log."""
    import datetime as dt

    from editsurge import schemas as S
    d = J.state_dir(spark, "test-streams", uuid.uuid4().hex)
    local = d[len("file:"):] if d.startswith("file:") else d   # same folder for os.* calls
    now = dt.datetime(2024, 1, 30, 12, 0, 0)
    spark.createDataFrame([(101, "enwiki", 43, "Old", "old", now - dt.timedelta(hours=5))],
                          "article_id long, wiki string, page_id long, title string, extract string, last_enriched_at timestamp_ntz") \
         .write.parquet(os.path.join(d, "articles"))
    spark.createDataFrame([(101, "Gone")], "article_id long, name string").write.parquet(os.path.join(d, "categories"))
    spark.createDataFrame([("enwiki", "T43", 43, "refreshed", ["Category:C3"], ["L3"])],
                          "wiki string, title string, page_id long, extract string, raw_categories array<string>, raw_links array<string>") \
         .write.parquet(os.path.join(d, "responses"))
    for i in (1, 2):
        e = spark.createDataFrame([(f"evt-{i}", i, 43, "T43", "enwiki", "u", False, False, False, 1, 2,
                                    now + dt.timedelta(minutes=i), now)], S.RAW_EDIT)
        to_topic_records(e, "page_id").write.json(os.path.join(d, "raw", f"part{i}"))
    # Two files in two sub-folders: read them as two micro-batches.
    import glob
    import shutil
    flat = os.path.join(local, "rawflat")
    os.makedirs(flat)
    for i, f in enumerate(sorted(glob.glob(os.path.join(local, "raw", "part*", "*.json")))):
        shutil.copy(f, os.path.join(flat, f"{i:03d}.json"))
        os.utime(os.path.join(flat, f"{i:03d}.json"), (1_700_000_000 + i, 1_700_000_000 + i))
    dims = {k: os.path.join(d, k) for k in ("articles", "categories", "responses")}
    q = J.start_enrich_stream(spark, flat, dims, os.path.join(d, "out"), os.path.join(d, "err"), os.path.join(d, "ck"),
                              as_of_fn=lambda: "2024-01-30 12:30:00", trigger={"availableNow": True})
    q.awaitTermination()
    rows = {r.event_id: r for r in spark.read.parquet(os.path.join(d, "out")).collect()}
    assert rows["evt-1"].linked_articles == ["L3"] and rows["evt-2"].linked_articles == []
    assert rows["evt-2"].extract == "refreshed" and rows["evt-2"].categories == ["C3"]
    # The last batch is replayed from the first one's state: its commit goes, its output stays the same.
    before = sorted((r.event_id, tuple(r.linked_articles), r.extract) for r in rows.values())
    ck = os.path.join(local, "ck", "commits")
    for name in ("0", ".0.crc", "1", ".1.crc"):
        if os.path.exists(os.path.join(ck, name)):
            os.remove(os.path.join(ck, name))
    q = J.start_enrich_stream(spark, flat, dims, os.path.join(d, "out"), os.path.join(d, "err"), os.path.join(d, "ck"),
                              as_of_fn=lambda: "2024-01-30 12:30:00", trigger={"availableNow": True})
    q.awaitTermination()
    again = spark.read.parquet(os.path.join(d, "out")).collect()
    assert sorted((r.event_id, tuple(r.linked_articles), r.extract) for r in again) == before
    assert {tuple(r.names) for r in spark.read.parquet(os.path.join(d, "out_category_log")).collect()} >= {("C3",)}


def test_late_events_go_to_their_own_table(spark):
    d = J.state_dir(spark, "test-streams", uuid.uuid4().hex)
    _, edits = topic_dir(spark)
    last = max_ts(edits)
    old = edits.filter(F.col("classified_at") < F.expr(f"timestamp_ntz'{last}' - INTERVAL 10 DAYS"))
    args = (os.path.join(d, "topic"), os.path.join(d, "t"), os.path.join(d, "ck"), os.path.join(d, "late"))
    for part in (edits.join(old.select("event_id"), "event_id", "left_anti").select(*edits.columns), old):
        to_topic_records(part, "article_id").coalesce(1).write.mode("append").json(os.path.join(d, "topic"))
        q = J.start_dedup_ingest(spark, *args, delay="2 days", trigger={"availableNow": True})
        q.awaitTermination()
    n_old = old.count()
    assert n_old > 0 and spark.read.parquet(os.path.join(d, "late")).count() == n_old
    assert spark.read.parquet(os.path.join(d, "t")).count() == edits.count() - n_old


def test_commands_of_two_batches_share_one_table(spark):
    import datetime as dt
    d = J.state_dir(spark, "test-streams", uuid.uuid4().hex)
    now = dt.datetime(2024, 1, 30, 12, 0, 0)
    snap = spark.createDataFrame([(f"v3:trends:{p.lower()}", p, now) for p in ("LastHour", "Last24Hours", "Last7Days")],
                                 "cache_key string, period string, cached_at timestamp_ntz")
    snap.write.parquet(os.path.join(d, "snap"))
    seen = []
    spark.createDataFrame([], "key string, value string").write.json(os.path.join(d, "recalc"))
    for key in ("v3:trends:lasthour", "v3:trends:last7days"):
        cmd = spark.createDataFrame([(None, key, now + dt.timedelta(seconds=5))], "topic_id int, cache_key string, requested_at timestamp_ntz")
        to_topic_records(cmd, "cache_key").coalesce(1).write.mode("append").json(os.path.join(d, "inval"))
        q = J.start_command_stream(spark, os.path.join(d, "recalc"), os.path.join(d, "inval"), os.path.join(d, "log"),
                                   os.path.join(d, "ck"), {"availableNow": True})
        q.awaitTermination()
        seen.append(sorted(r.period for r in J.visible_snapshots(spark, os.path.join(d, "snap"), os.path.join(d, "log")).collect()))
    assert seen == [["Last24Hours", "Last7Days"], ["Last24Hours"]]


def test_streamed_table_is_partitioned_by_day(spark):
    d, _ = topic_dir(spark)
    q = J.start_ingest(spark, os.path.join(d, "topic"), os.path.join(d, "t"), os.path.join(d, "bad"), os.path.join(d, "ck"),
                       trigger={"availableNow": True})
    q.awaitTermination()
    from editsurge.operators import trends as tr
    t = spark.read.parquet(os.path.join(d, "t"))
    plan = tr.trend_counts(t, max_ts(t))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(eff_date" in plan
