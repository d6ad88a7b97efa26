"""Structured Streaming jobs.

Every job reads a file-based topic (the twin of a Kafka topic; with the
connector on the classpath ``readStream.format('kafka')`` yields the same
(key, value) frame) and keeps its progress in a checkpoint under the
cluster's shared ``spark.checkpoint.dir``, so a lost executor or driver
restart resumes from the last committed batch.  Sinks written from
``foreachBatch`` are idempotent per batch id (overwrite of a
``batch_id=N`` directory), which turns Spark's at-least-once
``foreachBatch`` into exactly-once output.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editsurge import schemas as S
from editsurge.operators import metrics as mt
from editsurge.operators import snapshots as sn
from editsurge.operators import trends as tr
from editsurge.session import ensure_checkpoint_dir
from editsurge.sources.json_codec import parse_record
from editsurge.sources.runs import RunTable
from editsurge.sources.sinks import invalid_edits, rejected, valid_edits, write_baselines, write_edit_events

TOPIC_RECORD = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def state_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts)


def read_topic_stream(spark: SparkSession, path: str, schema: T.StructType,
                      max_files_per_trigger: int | None = None,
                      kafka_bootstrap: str | None = None) -> DataFrame:
    """S-03 streaming: keyed JSON records -> (key, value, r = parsed record).

    ``path`` is a topic folder of JSON records, or, with
    ``kafka_bootstrap`` set, a Kafka topic name read from the earliest
    offset (needs the spark-sql-kafka package on the classpath; then
    ``maxOffsetsPerTrigger`` bounds a micro-batch)."""
    if kafka_bootstrap:
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", kafka_bootstrap)
                  .option("subscribe", path).option("startingOffsets", "earliest"))
        if max_files_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_files_per_trigger)
        raw = r.load().select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    else:
        r = spark.readStream.schema(TOPIC_RECORD)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        raw = r.json(path)
    # As a generator the parsing is done once a row: filters on its columns are not moved below it,
    # where each of them would parse the record again.
    return raw.select("key", "value", F.explode(F.array(parse_record("value", schema))).alias("r"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written (asked of the file system, so that a failing
    read is never taken for a missing table)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_batches(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The rows of a per-batch table, or of its batches below ``before``; None if
    there are none yet.  A batch that reads its own table this way finds the same
    rows when it is replayed."""
    if not path_exists(spark, path):
        return None
    df = spark.read.parquet(path)
    if before is None:
        return df
    earlier = df.filter(F.col("batch_id") < before)
    return None if earlier.isEmpty() else earlier


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    # Overwrite this batch's own directory: a replayed batch replaces its
    # earlier partial output instead of appending a second copy.
    df.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))


COLLECTOR_STATS = "processed long, published long, skipped long, last_event_at timestamp_ntz"


def start_collector(spark: SparkSession, feed_path: str, raw_topic: str, stats_path: str, checkpoint: str, collected_at: str,
                    trigger: dict | None = None, max_files_per_trigger: int | None = None):
    """S-01 + F-01 + F-02 + A-14: change feed -> raw-edit topic, with live counters.

    The counters are observed on the rows of the batch as they are written (``observe``), so
    they cost no second pass; each batch stores one row of them in its own folder, which a
    replay overwrites.  ``collector_totals`` adds them up."""
    from pyspark.sql import Observation

    from editsurge.functions.scalar import parse_epoch
    from editsurge.operators import ingest as ig
    from editsurge.sources.sinks import to_topic_records
    reader = spark.readStream.schema(S.RECENT_CHANGE).option("mode", "DROPMALFORMED")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def run(batch: DataFrame, batch_id: int) -> None:
        seen, kept = Observation(), ig.reject_reason().isNull()
        counted = batch.observe(seen, F.count(F.lit(1)).alias("processed"), F.count_if(kept).alias("published"),
                                F.max(F.when(kept, parse_epoch("timestamp"))).alias("last_event_at"))
        raw = ig.to_raw_edits(counted.filter(kept), collected_at)
        to_topic_records(raw, "page_id").write.mode("overwrite").json(os.path.join(raw_topic, f"batch_id={batch_id}"))
        m = seen.get
        row = (m["processed"], m["published"], m["processed"] - m["published"], m["last_event_at"])
        _write_batch(spark.createDataFrame([row], COLLECTOR_STATS), stats_path, batch_id)

    return (reader.json(feed_path).writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
                  .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def collector_totals(spark: SparkSession, stats_path: str) -> DataFrame:
    """A-14 over all batches so far."""
    return read_batches(spark, stats_path).agg(*[F.sum(c).alias(c) for c in ("processed", "published", "skipped")],
                                               F.max("last_event_at").alias("last_event_at"))


def start_ingest(spark: SparkSession, topic_path: str, table_path: str, quarantine_path: str,
                 checkpoint: str, trigger: dict | None = None, max_files_per_trigger: int | None = None,
                 label_state_path: str | None = None, topic_index_path: str | None = None):
    """T-01 + S-05: classified-edit records -> validate -> edit table, each batch in
    its own folder, partitioned by ``eff_date`` and in order of the effective time;
    records that fail validation (or do not parse) go to a
    quarantine table instead of being lost (Q6).  With
    ``label_state_path`` each batch also appends its topic label state
    (A-06 partial), so trend cycles read names from the small merged state
    instead of rescanning the whole edit history.  With ``topic_index_path`` each batch
    notes which of its files hold which topics (F-10)."""
    stream = read_topic_stream(spark, topic_path, S.EDIT_EVENTS, max_files_per_trigger)

    def sink(batch: DataFrame, batch_id: int) -> None:
        # The two passes of the range partitioning and the quarantine read the parsed rows; the text
        # of a record is kept for the quarantine only.
        recs = batch.select(F.when(rejected("r."), F.col("value")).alias("_raw"), "r.*").persist()
        good = valid_edits(recs.filter(F.col("event_id").isNotNull())).drop("_raw")
        bad = invalid_edits(recs).select("_raw")
        write_edit_events(good, table_path, partition_by_day=True, batch_id=batch_id)
        _write_batch(bad, quarantine_path, batch_id)
        recs.unpersist()
        if label_state_path:
            stored = spark.read.schema(S.EDIT_EVENTS).parquet(os.path.join(table_path, f"batch_id={batch_id}"))
            _write_batch(tr.topic_label_state(stored), label_state_path, batch_id)
        if topic_index_path:
            from editsurge.sources.topic_index import index_batch
            index_batch(spark, table_path, topic_index_path, batch_id)

    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark (epoch milliseconds) that a batch runs with, from the offset log that the
    engine writes before the batch starts."""
    lines = spark.read.text(os.path.join(checkpoint, "offsets", str(batch_id)))
    found = lines.select(F.get_json_object("value", "$.batchWatermarkMs").cast("long").alias("ms")).filter("ms IS NOT NULL")
    row = found.first()
    return row.ms if row else 0


def start_dedup_ingest(spark: SparkSession, topic_path: str, table_path: str, checkpoint: str,
                       late_path: str, delay: str = "1 hour", trigger: dict | None = None,
                       max_files_per_trigger: int | None = None):
    """T-09 (optional): as T-01, but each event id is stored once within ``delay``.

    The ids seen are keyed state of the stream (``dropDuplicatesWithinWatermark``), which
    forgets an id ``delay`` after its time; no batch reads the stored table.  Events not newer
    than the watermark (the newest event of earlier batches less ``delay``) cannot be
    compared any more; the state operator drops them, so the batch carries its input
    a second time and writes those to ``late_path``, told by the same watermark.
    Events without a time are never late: their ids are kept for good, apart from
    the others.  State and batches come from the checkpoint, so a replay gives the same."""
    # Watermarks need a TIMESTAMP (not _NTZ) column.
    stream = read_topic_stream(spark, topic_path, S.EDIT_EVENTS, max_files_per_trigger).select("r.*").filter(
        F.col("event_id").isNotNull()).withColumn("_time", F.col("classified_at").cast("timestamp"))
    timed = stream.filter(F.col("_time").isNotNull())
    marked = timed.withWatermark("_time", delay)
    fresh = marked.dropDuplicatesWithinWatermark(["event_id"])
    timeless = stream.filter(F.col("_time").isNull()).dropDuplicates(["event_id"])
    plain = lambda df, part: df.withColumn("_time", F.unix_micros("_time")).withColumn("_part", F.lit(part))
    both = plain(fresh, "fresh").unionByName(plain(timeless, "fresh")).unionByName(plain(timed, "input"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        late = (F.col("_part") == "input") & (F.col("_time") <= 1000 * batch_watermark(spark, checkpoint, batch_id))
        kept = batch.filter((F.col("_part") == "fresh") | late).persist()   # two outputs, one pass through the state
        _write_batch(kept.filter(F.col("_part") == "fresh").drop("_part", "_time"), table_path, batch_id)
        _write_batch(kept.filter(F.col("_part") == "input").drop("_part", "_time"), late_path, batch_id)
        kept.unpersist()

    return (both.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
                .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def start_interval_metrics(spark: SparkSession, log_path: str, out_path: str, checkpoint: str,
                           seconds: int = mt.STATS_INTERVAL_SECONDS, delay: str = "30 seconds",
                           trigger: dict | None = None, schema: T.StructType | None = None):
    """T-08: 10-second tumbling consumer stats with a watermark, emitted in
    append mode once an interval can no longer change."""
    schema = schema or T.StructType([
        T.StructField("topic", T.StringType()), T.StructField("group_id", T.StringType()),
        T.StructField("offset", T.LongType()), T.StructField("processed_at", T.TimestampNTZType()),
        T.StructField("elapsed_ms", T.LongType())])
    # Watermarks need a TIMESTAMP (not _NTZ) event-time column; a 10-second
    # window does not depend on the zone offset.
    log = (spark.readStream.schema(schema).parquet(log_path)
                .withColumn("processed_at", F.col("processed_at").cast("timestamp"))
                .withWatermark("processed_at", delay))
    stats = mt.consumer_interval_stats(log, seconds).withColumn(
        "interval_start", F.col("interval_start").cast("timestamp_ntz"))
    return (stats.writeStream.option("checkpointLocation", checkpoint).format("parquet")
                 .option("path", out_path).outputMode("append")
                 .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def open_intervals(spark: SparkSession, log_path: str, out_path: str,
                   seconds: int = mt.STATS_INTERVAL_SECONDS) -> DataFrame:
    """T-08 final flush: the intervals of the stored log that the stream has not written,
    because no later event closed them."""
    stats = mt.consumer_interval_stats(spark.read.parquet(log_path), seconds)
    if not path_exists(spark, out_path):
        return stats
    return stats.join(spark.read.parquet(out_path).select("interval_start", "topic", "group_id"),
                      ["interval_start", "topic", "group_id"], "left_anti").select(*stats.columns)


def trunc_minute(ts):
    """Start of the minute of a TIMESTAMP_NTZ (no time-zone round trip)."""
    from editsurge.sources.adapters import epoch_micros
    return F.timestamp_add("MICROSECOND", -F.pmod(epoch_micros(ts), F.lit(60_000_000)), ts)


def minute_rollup(edits: DataFrame) -> DataFrame:
    """T-11 stage 1: exploded edits counted per (topic, minute of the
    effective time).  Additive, so trailing windows are sums of buckets."""
    return (edits.select(trunc_minute(tr.effective_time()).alias("minute"),
                         F.explode("topics.topic_id").alias("topic_id"))
                 .groupBy("topic_id", "minute").agg(F.count("*").alias("edits")))


def start_minute_rollup(spark: SparkSession, topic_path: str, out_path: str, checkpoint: str,
                        trigger: dict | None = None):
    """T-11: streaming per-minute pre-aggregate.  Each micro-batch's
    partial counts are written per batch id; the read side sums them, so
    state is not kept in the stream at all."""
    stream = read_topic_stream(spark, topic_path, S.EDIT_EVENTS).select("r.*")

    def sink(batch: DataFrame, batch_id: int) -> None:
        _write_batch(minute_rollup(batch.filter(F.col("event_id").isNotNull())), out_path, batch_id)

    return (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
                  .trigger(**(trigger or {"processingTime": "60 seconds"})).start())


def trailing_from_rollup(rollup: DataFrame, as_of: str, edits: DataFrame) -> DataFrame:
    """T-11 read: trailing-window counts per (period, topic), equal to A-01.

    Whole minutes come from the rollup.  A window that starts inside a minute takes
    that minute's edits from the fact table: three scans of less than a minute
    each, pruned by the effective time."""
    from editsurge.functions.scalar import PERIODS
    minute = F.expr("INTERVAL 1 MINUTE")
    r = rollup.groupBy("topic_id", "minute").agg(F.sum("edits").alias("edits"))
    whole, edges = [], None
    for i, p in enumerate(PERIODS):
        start = tr.window_start(as_of, p)
        first = F.when(trunc_minute(start) == start, start).otherwise(trunc_minute(start) + minute)
        whole.append(F.sum(F.when(F.col("minute") >= first, F.col("edits")).otherwise(0)).alias(f"c{i}"))
        eff = tr.effective_time()
        part = (tr.prune_from(edits, start).filter((eff >= start) & (eff < first))
                  .select(F.lit(p).alias("period"), F.explode("topics.topic_id").alias("topic_id"), F.lit(1).cast("long").alias("edit_count")))
        edges = part if edges is None else edges.unionByName(part)
    pairs = ", ".join(f"'{p}', CAST(c{i} AS BIGINT)" for i, p in enumerate(PERIODS))
    lo = trunc_minute(tr.window_start(as_of, PERIODS[-1]))
    per = r.filter(F.col("minute") >= lo).groupBy("topic_id").agg(*whole)
    counts = per.select(F.expr(f"stack(3, {pairs}) AS (period, edit_count)"), "topic_id")
    return (counts.unionByName(edges.select("edit_count", "period", "topic_id"))
                  .groupBy("period", "topic_id").agg(F.sum("edit_count").alias("edit_count")).filter(F.col("edit_count") > 0))


def start_counts(spark: SparkSession, topic_path: str, checkpoint: str, daily_path: str | None = None,
                 trailing_path: str | None = None, trigger: dict | None = None, max_files_per_trigger: int | None = None):
    """A-02 + T-11 maintained: each batch of edits adds its counts to ``DailyCounts`` and
    ``TrailingCounts``; the stream itself keeps no state."""
    from editsurge.operators.rollups import DailyCounts, TrailingCounts
    stream = read_topic_stream(spark, topic_path, S.EDIT_EVENTS, max_files_per_trigger).select("r.*")
    kept = ([DailyCounts(spark, daily_path)] if daily_path else []) + ([TrailingCounts(spark, trailing_path)] if trailing_path else [])

    def sink(batch: DataFrame, batch_id: int) -> None:
        for counts in kept:
            counts.update(batch.filter(F.col("event_id").isNotNull()), batch_id)

    return (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
                  .trigger(**(trigger or {"processingTime": "60 seconds"})).start())


def start_trend_cycle(spark: SparkSession, tick_path: str, table_path: str, snapshot_path: str,
                      checkpoint: str, trigger: dict | None = None, baselines_path: str | None = None,
                      label_state_path: str | None = None):
    """T-04 + T-06 + T-12: on every trigger (60 s by default) recompute the
    three periods over the stored edit table and replace each period's
    snapshot (cached_at = calculation time).  The tick stream only paces
    the job; the work is a batch plan over the table.  With the stored
    baselines and the ingest's label state the cycle reads only the
    trailing windows of the table."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load() if tick_path == "rate" \
        else spark.readStream.schema(TOPIC_RECORD).json(tick_path)

    def cycle(batch: DataFrame, batch_id: int) -> None:
        edits = spark.read.parquet(table_path)
        as_of = tr_as_of(edits)
        base = spark.read.parquet(baselines_path) if baselines_path else None
        labels = spark.read.parquet(label_state_path) if label_state_path else None
        upd = tr.trend_updates(edits, as_of, base, label_state=labels)
        sn_rows = sn.snapshot_rows(upd)
        from editsurge.sources.sinks import write_trend_snapshot
        write_trend_snapshot(sn_rows, snapshot_path)

    return (ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(cycle)
                 .trigger(**(trigger or {"processingTime": "60 seconds"})).start())


def start_snapshot_warmup(spark: SparkSession, tick_path: str, table_path: str, snapshot_path: str,
                          checkpoint: str, as_of_fn, ttl_seconds: int = sn.SNAPSHOT_TTL_SECONDS,
                          trigger: dict | None = None, baselines_path: str | None = None,
                          label_state_path: str | None = None):
    """T-12: on every tick rebuild only the periods whose snapshot is
    missing or older than the TTL at the tick time; fresh ones stay.  With the
    stored baselines and label state only the trailing windows are read."""
    from editsurge.functions.scalar import PERIODS
    from editsurge.sources.sinks import write_trend_snapshot
    ticks = spark.readStream.schema(TOPIC_RECORD).json(tick_path)

    def warm(batch: DataFrame, batch_id: int) -> None:
        now = as_of_fn()
        fresh = set()
        if path_exists(spark, snapshot_path):
            live = sn.live_snapshots(spark.read.parquet(snapshot_path), now, ttl_seconds)
            fresh = {r.period for r in live.select("period").distinct().collect()}  # at most 3 rows
        expired = [p for p in PERIODS if p not in fresh]
        if not expired:
            return
        edits = spark.read.parquet(table_path)
        base = spark.read.parquet(baselines_path) if baselines_path else None
        labels = spark.read.parquet(label_state_path) if label_state_path else None
        upd = tr.trend_updates(edits, tr_as_of(edits), base, label_state=labels).filter(F.col("period").isin(expired))
        write_trend_snapshot(sn.snapshot_rows(upd, cached_at=sn_ts(now)), snapshot_path)

    return (ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(warm)
                 .trigger(**(trigger or {"processingTime": "60 seconds"})).start())


def sn_ts(value: str):
    from editsurge.sources.adapters import ts_lit
    return ts_lit(value)


def tr_as_of(edits: DataFrame) -> str:
    from editsurge.sources.adapters import max_ts
    return max_ts(edits)


def start_command_stream(spark: SparkSession, recalc_path: str, invalidate_path: str, log_path: str,
                         checkpoint: str, trigger: dict | None = None, max_files_per_trigger: int | None = None):
    """T-07 + J-20: the two command topics unioned with a kind column; each batch
    adds its invalidation times to a log.  ``visible_snapshots`` reads the snapshot
    table of T-04 through that log, so what a batch invalidates stays hidden until
    the snapshot is cached anew, and both jobs share one table."""
    cmd = T.StructType([T.StructField("topic_id", T.IntegerType()), T.StructField("cache_key", T.StringType()),
                        T.StructField("requested_at", T.TimestampNTZType())])
    a = read_topic_stream(spark, recalc_path, cmd, max_files_per_trigger).select(F.lit("recalculate").alias("kind"), "r.*")
    b = read_topic_stream(spark, invalidate_path, cmd, max_files_per_trigger).select(F.lit("invalidate").alias("kind"), "r.*")

    def apply(batch: DataFrame, batch_id: int) -> None:
        _write_batch(sn.invalidation_times(batch), log_path, batch_id)

    return (a.unionByName(b).writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
             .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def visible_snapshots(spark: SparkSession, snapshot_path: str, log_path: str) -> DataFrame:
    """The snapshot table without what the command stream has invalidated."""
    snap, log = spark.read.parquet(snapshot_path), read_batches(spark, log_path)
    return snap if log is None else sn.hide_invalidated(snap, log.select("cache_key", "requested_at"))


def start_baseline_refresh(spark: SparkSession, command_path: str, table_path: str, baselines_path: str,
                           checkpoint: str, days: int = tr.BASELINE_LOOKBACK_DAYS, trigger: dict | None = None,
                           daily_path: str | None = None):
    """T-05: every recalculate command batch recomputes the baselines over
    the stored edits and appends them (S-07); readers keep the newest.  With the
    maintained ``DailyCounts`` (``daily_path``) only the edits of the hour in which the
    lookback starts are read."""
    cmd = T.StructType([T.StructField("topic_id", T.IntegerType()), T.StructField("requested_at", T.TimestampNTZType())])
    s = read_topic_stream(spark, command_path, cmd)

    def recalc(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        edits = spark.read.parquet(table_path)
        if daily_path:
            from editsurge.operators.rollups import DailyCounts
            b = DailyCounts(spark, daily_path).baselines(tr_as_of(edits), days, edits)
        else:
            b = tr.recalculate_baselines(edits, tr_as_of(edits), days)
        write_baselines(b, baselines_path, batch_id)

    return (s.writeStream.option("checkpointLocation", checkpoint).foreachBatch(recalc)
             .trigger(**(trigger or {"availableNow": True})).start())


def start_notifications(spark: SparkSession, tick_path: str, table_path: str, out_path: str, checkpoint: str,
                        trigger: dict | None = None, baselines_path: str | None = None,
                        label_state_path: str | None = None):
    """T-13: every 15 s take the 24 h list (limit 10), emit the first five
    as notifications fanned out to their audiences (W-08 + J-21 + S-04).  With the
    stored baselines and label state only the trailing window is read."""
    from editsurge.operators import serving as sv
    from editsurge.sources.sinks import to_topic_records
    ticks = spark.readStream.schema(TOPIC_RECORD).json(tick_path)

    def emit(batch: DataFrame, batch_id: int) -> None:
        edits = spark.read.parquet(table_path)
        as_of = tr_as_of(edits)
        base = spark.read.parquet(baselines_path) if baselines_path else None
        labels = spark.read.parquet(label_state_path) if label_state_path else None
        lst = sv.trends_response(edits, as_of, "Last24Hours", limit=sn.NOTIFY_LIMIT, min_anomaly_score=0.0,
                                 baselines=base, label_state=labels)
        notes = sn.notification_fanout(sn.notifications(lst, as_of))
        recs = to_topic_records(notes, "audience")
        recs.write.mode("overwrite").json(os.path.join(out_path, f"batch_id={batch_id}"))

    return (ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(emit)
                 .trigger(**(trigger or {"processingTime": "15 seconds"})).start())


def start_enrich_stream(spark: SparkSession, raw_topic: str, dims: dict, out_path: str, error_path: str,
                        checkpoint: str, as_of_fn=None, trigger: dict | None = None):
    """T-02: raw edits -> enrichment against the article table -> enriched
    records and errors.  The dimension tables are read per micro-batch
    (stream-static joins) as base table + the changes this job keeps
    (``dims['article_log']``, ``dims['category_log']``), newest version per
    key, so an article refreshed in one batch is fresh for the next.  The changes are
    run tables: a batch reads a bounded number of merged runs, however many batches
    came before it.  It reads those of earlier batches only: replayed, it finds the
    state of its first run and replaces its outputs with the same rows."""
    from editsurge.operators import enrich as en
    s = read_topic_stream(spark, raw_topic, S.RAW_EDIT).select("r.*")
    art_log = RunTable(spark, dims.get("article_log") or out_path + "_article_log", ["wiki", "page_id"])
    cat_log = RunTable(spark, dims.get("category_log") or out_path + "_category_log", ["article_id"])

    def run(batch: DataFrame, batch_id: int) -> None:
        # Five outputs come from this batch: keep its rows instead of
        # re-reading the source for each (recomputed if an executor is lost).
        batch = batch.persist()
        arts = en.latest_articles(spark.read.parquet(dims["articles"]), art_log.read(batch_id))
        cats = en.latest_categories(spark.read.parquet(dims["categories"]), cat_log.read(batch_id))
        resp = spark.read.parquet(dims["responses"])
        as_of = as_of_fn() if as_of_fn else tr_as_of(batch.withColumnRenamed("timestamp", "ts"))
        out = en.enrich(batch, arts, cats, resp, as_of)
        _write_batch(out["enriched"], out_path, batch_id)
        _write_batch(out["errors"], error_path, batch_id)
        art_log.write(out["article_changes"], batch_id)
        cat_log.write(out["category_sets"].withColumn("version", F.lit(batch_id + 1).cast("long")), batch_id)
        batch.unpersist()

    return (s.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
             .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def start_classify_stream(spark: SparkSession, enriched_topic: str, resolved_path: str, out_path: str,
                          checkpoint: str, trigger: dict | None = None, topics_path: str | None = None):
    """T-03: valid enriched edits (F-06) -> classified edits by a stream-static join with
    the resolved-topic table (article_id -> topic), one topic per edit and
    an empty embedding; articles without a resolved topic get the fallback
    topic with its stored id (``topics_path``: topic_id, name, path)."""
    from editsurge.operators import ingest as ig
    from editsurge.operators.classify import FALLBACK_CONFIDENCE, FALLBACK_TOPIC
    from editsurge.operators.joins import skew_safe_lookup
    s = read_topic_stream(spark, enriched_topic, S.ENRICHED_EDIT).select("r.*")

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()             # its newest time and its rows are read from one parsing
        res = spark.read.parquet(resolved_path)
        stored = None
        if topics_path:
            stored = spark.read.parquet(topics_path).filter(F.col("path") == FALLBACK_TOPIC).agg(F.min("topic_id")).first()[0]
        j = skew_safe_lookup(ig.split_errors(batch, ig.classify_input_error())[0], res, ["article_id"]).select(
            "*", F.coalesce("topic_id", F.lit(stored or 0)).alias("_tid"))
        j = (j.withColumn("topic_name", F.coalesce("name", F.lit(FALLBACK_TOPIC)))
              .withColumn("topic_path", F.coalesce("path", F.lit(FALLBACK_TOPIC)))
              .withColumn("confidence", F.coalesce("confidence", F.lit(FALLBACK_CONFIDENCE)))
              .withColumn("topic_id", F.col("_tid")))
        as_of = tr_as_of(batch.withColumnRenamed("timestamp", "ts"))
        _write_batch(ig.to_classified(j, as_of), out_path, batch_id)
        batch.unpersist()

    return (s.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
             .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def start_resolving_classify_stream(spark: SparkSession, enriched_topic: str, tables: dict, state_path: str, out_path: str,
                                    resolution_path: str, checkpoint: str, as_of_fn=None, trigger: dict | None = None,
                                    max_files_per_trigger: int | None = None, graph_change_path: str | None = None):
    """T-03 with the cascade inside: valid enriched edits (F-06) -> topics of unseen articles
    resolved, stored and attached -> classified edits.

    ``tables``: folders of ``topics``, ``article_topics``, ``mapping``, ``edges``, ``nodes``,
    ``labels`` and, where there are any, ``responses`` and ``entities``.  What the job learns is kept
    under ``state_path`` as run tables over them: topics by path (J-07), links by article
    (J-10), QID mappings (J-08) and the class closure (J-13).  An article is resolved when a
    batch first brings it; from then on its stored topic is taken and the batch costs it
    one join.  The closure follows only start classes it has not seen; changed subclass
    edges (``graph_change_path``: child, parent, gone; one ``batch_id=N`` folder for each batch
    that brings any) are taken in by the batch.

    Every batch reads the state of earlier batches only and writes its outputs and runs
    over those of a failed attempt.  ``resolution_path`` gets one row for each article a
    batch resolved or found stored, with its source."""
    from editsurge.functions.scalar import language_of_wiki
    from editsurge.operators import classify as cl
    from editsurge.operators import ingest as ig
    from editsurge.operators.closure import ClassClosure
    from editsurge.operators.joins import skew_safe_lookup
    s = read_topic_stream(spark, enriched_topic, S.ENRICHED_EDIT, max_files_per_trigger).select("r.*")
    part = lambda name: os.path.join(state_path, name)
    topic_runs = RunTable(spark, part("topics"), ["path"])
    link_runs = RunTable(spark, part("article_topics"), ["article_id"])
    mapping_runs = RunTable(spark, part("mapping"), ["wiki", "title"])
    closure = ClassClosure(spark, part("closure"))

    def table(name: str) -> DataFrame | None:
        return spark.read.parquet(tables[name]) if name in tables else None

    def subclass(edges: DataFrame) -> DataFrame:
        return edges.filter(F.col("prop") == "P279").select("child", "parent")

    if not closure.edges.runs(1):          # batch 0 of the closure is the stored graph
        closure.update(0, added=subclass(table("edges")))

    def changed(base: DataFrame, runs: RunTable, batch_id: int, columns: list[str]) -> DataFrame:
        """A base table with what earlier batches replaced in it."""
        new = runs.read(batch_id)
        if new is None:
            return base.select(*columns)
        return base.join(new.select(*runs.keys), runs.keys, "left_anti").select(*columns).unionByName(new.select(*columns))

    def run(batch: DataFrame, batch_id: int) -> None:
        good = ig.split_errors(batch, ig.classify_input_error())[0].checkpoint()
        as_of = as_of_fn() if as_of_fn else tr_as_of(good.withColumnRenamed("timestamp", "ts"))
        arts = good.groupBy("article_id").agg(F.min(F.struct("timestamp", "event_id", "title", "wiki")).alias("a")).select(
            "article_id", "a.title", F.lower(F.trim(language_of_wiki("a.wiki"))).alias("lang"))
        topics = changed(table("topics"), topic_runs, batch_id, ["topic_id", "name", "path"]).checkpoint()
        ids = arts.select("article_id")
        mine = table("article_topics").join(ids, "article_id", "left_semi").groupBy("article_id").agg(
            F.collect_list(F.struct("topic_id", "confidence")).alias("links"))
        links = changed(mine, link_runs, batch_id, ["article_id", "links"]).join(ids, "article_id", "left_semi")
        links = links.select("article_id", F.explode("links").alias("l")).select("article_id", "l.*")
        stored = cl.max_confidence_topic(links, topics).checkpoint()
        unseen = arts.join(stored, "article_id", "left_anti").checkpoint()

        edges, added, removed = table("edges"), None, None
        if graph_change_path and path_exists(spark, os.path.join(graph_change_path, f"batch_id={batch_id}")):
            change = spark.read.parquet(os.path.join(graph_change_path, f"batch_id={batch_id}"))
            added, removed = change.filter("NOT gone"), change.filter("gone")
        if unseen.isEmpty():
            if added is None:
                closure.update(batch_id + 1)
            else:
                closure.update(batch_id + 1, added=added, removed=removed)
            for runs in (topic_runs, link_runs, mapping_runs):
                runs.write(None, batch_id)
            found = None
        else:
            mapping = changed(table("mapping"), mapping_runs, batch_id, ["wiki", "title", "qid", "cached_at"])
            checked = cl.checked_qids(unseen, mapping, as_of, table("responses")).checkpoint()
            items = checked.filter((F.col("qid_state") != "negative") & F.col("qid").isNotNull()).select("qid")
            starts = cl.start_nodes(items, edges).select(F.col("start").alias("cls"))
            closure.update(batch_id + 1, starts=starts, added=added, removed=removed)
            found = cl.resolve_topics(unseen, links, topics, mapping, edges, table("nodes"), table("labels"), as_of,
                                      closure=closure.read(batch_id + 2), entities=table("entities"), checked=checked).checkpoint()
            upserted = cl.upsert_topics(topics, found.select("name", "path")).join(
                found.select("path").distinct(), "path", "left_semi").checkpoint()
            topic_runs.write(upserted.select("path", "topic_id", "name"), batch_id)
            found = found.join(upserted.select("path", "topic_id"), "path")
            link_runs.write(found.select("article_id", F.array(F.struct("topic_id", "confidence")).alias("links")), batch_id)
            mapping_runs.write(cl.new_mappings(checked, as_of).groupBy("wiki", "title").agg(
                F.max("qid").alias("qid"), F.max("cached_at").alias("cached_at")), batch_id)
        columns = ["article_id", "topic_id", "name", "path", "confidence", "resolution_source"]
        all_found = stored.withColumn("resolution_source", F.lit("stored")).select(*columns)
        if found is not None:
            all_found = all_found.unionByName(found.select(*columns))
        _write_batch(all_found, resolution_path, batch_id)
        named = all_found.select("article_id", "topic_id", F.col("name").alias("topic_name"), F.col("path").alias("topic_path"), "confidence")
        _write_batch(ig.to_classified(skew_safe_lookup(good, named, ["article_id"]), as_of), out_path, batch_id)

    return (s.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
             .trigger(**(trigger or {"processingTime": "5 seconds"})).start())
