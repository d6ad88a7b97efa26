"""Registered queries for the remaining inventory keys (S-05, F-17, X-07,
X-11, X-13, X-23, T-06, T-12)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from editsurge.functions import scalar as X
from editsurge.operators import classify as cl
from editsurge.operators import enrich as en
from editsurge.operators import ingest as ig
from editsurge.operators import serving as sv
from editsurge.operators import snapshots as sn
from editsurge.operators import trends as tr
from editsurge.plans.oracle_ctes import (CLASSIFIED, DIMS, EDITS, GRAPH_NO_CLOCK, RECENT, REFRESH, TOPIC_FIX,
                                         with_ctes, with_recursive)
from editsurge.plans.registry import register
from editsurge.plans.serving_queries import _MEMBERS
from editsurge.plans.trend_queries import TRENDS_REPORT_SQL
from editsurge.plans.stream_queries import AVAILABLE_NOW, _run, _scratch, _stored_edits
from editsurge.sources import adapters as ad
from editsurge.sources.sinks import nest_topic_columns, write_edit_events
from editsurge.sources.tables import read_table
from editsurge.streaming import jobs as J


@register("sink_edit_events", with_ctes(EDITS) + """
SELECT CAST(greatest(e.ts, e.classified_at) AS DATE) AS eff_date, count(*) AS edits, count(DISTINCT e.event_id) AS events,
  CAST(sum(coalesce(t.s, 0)) AS BIGINT) AS topic_ids
FROM e LEFT JOIN (SELECT event_id, sum(topic_id) AS s FROM et GROUP BY 1) t ON e.event_id = t.event_id GROUP BY 1""")
def q_sink_edit_events(spark, sf_dir):
    """S-05 (batch): validated edits written to the fact table with flattened topics,
    partitioned by the day of the effective time, read back per partition."""
    d = _scratch(spark, "facts")
    edits, _ = ad.load_edits(spark, sf_dir)
    for _ in range(2):      # a replayed batch leaves one copy
        write_edit_events(edits, os.path.join(d, "t"), partition_by_day=True, batch_id=0, flatten=True)
    t = nest_topic_columns(spark.read.parquet(os.path.join(d, "t")))
    return t.groupBy("eff_date").agg(F.count("*").alias("edits"), F.countDistinct("event_id").alias("events"),
                                     F.sum(F.aggregate("topics", F.lit(0), lambda a, x: a + x["topic_id"])).alias("topic_ids"))


@register("to_classified_edits", with_recursive(RECENT, DIMS, REFRESH, GRAPH_NO_CLOCK.format(min_sitelinks=50, source="checked"),
                                                TOPIC_FIX.format(), CLASSIFIED) + """
SELECT enr.event_id, enr.article_id, enr.title, enr.wiki, coalesce(rt.topic_id, 0) AS topic_id,
  coalesce(rt.name, 'Uncategorized') AS topic_name, coalesce(rt.path, 'Uncategorized') AS topic_path,
  round(coalesce(rt.confidence, 0.1), 4) AS confidence, 1 AS n_topics, 0 AS embedding_size,
  strftime(enr."timestamp", '%Y-%m-%d %H:%M:%S') AS ts
FROM enr LEFT JOIN rt ON enr.article_id = rt.article_id""")
def q_to_classified_edits(spark, sf_dir):
    """F-17: enriched edits with their resolved topic as ClassifiedEdit rows
    (one-element topic list, empty embedding; unresolved -> fallback)."""
    from editsurge.plans.classify_queries import _resolved
    from editsurge.plans.ingest_queries import _enriched
    out, _, _, _, _, as_of = _enriched(spark, sf_dir)
    res, topics, _, _ = _resolved(spark, sf_dir)
    up = cl.upsert_topics(topics, res.select("name", "path"))
    rt = res.join(up.select("topic_id", "path"), "path").select(
        "article_id", "topic_id", F.col("name").alias("topic_name"), F.col("path").alias("topic_path"), "confidence")
    e = (out["enriched"].join(rt, "article_id", "left")
         .withColumn("topic_id", F.coalesce("topic_id", F.lit(0)))
         .withColumn("topic_name", F.coalesce("topic_name", F.lit(cl.FALLBACK_TOPIC)))
         .withColumn("topic_path", F.coalesce("topic_path", F.lit(cl.FALLBACK_TOPIC)))
         .withColumn("confidence", F.coalesce(F.col("confidence"), F.lit(cl.FALLBACK_CONFIDENCE).cast("float"))))
    c = ig.to_classified(e, as_of)
    t = F.col("topics")[0]
    return c.select("event_id", "article_id", "title", "wiki", t["topic_id"].alias("topic_id"), t["name"].alias("topic_name"),
                    t["path"].alias("topic_path"), F.round(t["confidence"].cast("double"), 4).alias("confidence"),
                    F.size("topics").alias("n_topics"), F.size("embedding").alias("embedding_size"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@register("cluster_id", with_ctes(*_MEMBERS) + """
SELECT DISTINCT label, replace(lower(label), ' ', '-') AS cluster_id FROM m""")
def q_cluster_id(spark, sf_dir):
    """X-07: cluster ids of the 24 h cluster labels."""
    edits, as_of = ad.load_edits(spark, sf_dir)
    m = sv.cluster_members(edits, as_of, "Last24Hours")
    return m.select("label", X.cluster_id("label").alias("cluster_id")).distinct()


@register("to_day", with_ctes(EDITS) + """
SELECT CAST(ts AS DATE) AS day, count(*) AS edits FROM e GROUP BY 1""")
def q_to_day(spark, sf_dir):
    """X-11: UTC calendar day of every edit, counted."""
    edits, _ = ad.load_edits(spark, sf_dir)
    return edits.groupBy(X.to_day("ts").alias("day")).agg(F.count("*").alias("edits"))


@register("safe_int", """
SELECT DISTINCT raw, coalesce(TRY_CAST(raw AS INTEGER), 0) AS value FROM (
  SELECT json_extract_string(props, '$.k') AS raw FROM events UNION ALL SELECT event_type FROM events)""")
def q_safe_int(spark, sf_dir):
    """X-13: text -> int, else 0 (numbers inside props, and event type
    names, which are not numbers)."""
    ev = read_table(spark, sf_dir, "events", "props", "event_type")
    raw = ev.select(F.get_json_object("props", "$.k").alias("raw")).unionByName(ev.select(F.col("event_type").alias("raw")))
    return raw.select("raw", X.safe_int("raw").alias("value")).distinct()


@register("audit_columns", with_ctes(RECENT, DIMS, REFRESH, """
before AS (SELECT art.*, art.last_enriched_at AS created_at, art.last_enriched_at AS updated_at FROM art)""") + """
SELECT ups.article_id, ups.wiki, ups.page_id,
  strftime(CASE WHEN b.article_id IS NULL THEN (SELECT as_of FROM clock) ELSE b.created_at END, '%Y-%m-%d %H:%M:%S') AS created_at,
  strftime(CASE WHEN b.article_id IS NULL OR ups.title IS DISTINCT FROM b.title OR ups.extract IS DISTINCT FROM b.extract
                     OR ups.last_enriched_at IS DISTINCT FROM b.last_enriched_at THEN (SELECT as_of FROM clock)
                ELSE b.updated_at END, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM ups LEFT JOIN before b ON ups.wiki = b.wiki AND ups.page_id = b.page_id""")
def q_audit_columns(spark, sf_dir):
    """X-23: created_at / updated_at of the article table after the upsert."""
    from editsurge.plans.ingest_queries import _enriched
    out, _, arts, _, _, as_of = _enriched(spark, sf_dir)
    before = arts.withColumn("created_at", F.col("last_enriched_at")).withColumn("updated_at", F.col("last_enriched_at"))
    a = en.with_audit(before, out["articles"], ["wiki", "page_id"], ["title", "extract", "last_enriched_at"], as_of)
    return a.select("article_id", "wiki", "page_id", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
                    F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))


@register("stream_snapshot_cache", with_ctes(EDITS) + """
SELECT DISTINCT 'v3:trends:' || lower(p.period) AS cache_key, p.period, true AS live_now, false AS live_later, false AS live_fallback
FROM et, clock, periods p WHERE et.eff >= clock.as_of - to_hours(p.hours)""")
def q_stream_snapshot_cache(spark, sf_dir):
    """T-06: snapshots written by the trend cycle, with their liveness at
    as_of (30 s TTL) and 40 s later (expired), and under the 5 s fallback
    TTL."""
    d = _scratch(spark, "cache")
    as_of = _stored_edits(spark, sf_dir, d)
    _run(J.start_trend_cycle(spark, os.path.join(d, "ticks"), os.path.join(d, "table"), os.path.join(d, "snap"),
                             os.path.join(d, "ckpt"), AVAILABLE_NOW))
    snap = spark.read.parquet(os.path.join(d, "snap"))
    import datetime as dt
    later = (dt.datetime.strptime(as_of, "%Y-%m-%d %H:%M:%S") + dt.timedelta(seconds=40)).strftime("%Y-%m-%d %H:%M:%S")
    live_now = sn.live_snapshots(snap, as_of).select("cache_key", F.lit(True).alias("live_now"))
    live_later = sn.live_snapshots(snap, later).select("cache_key", F.lit(True).alias("live_later"))
    live_fb = sn.live_snapshots(snap, later, sn.FALLBACK_TTL_SECONDS).select("cache_key", F.lit(True).alias("live_fallback"))
    base = snap.select("cache_key", "period")
    return (base.join(live_now, "cache_key", "left").join(live_later, "cache_key", "left").join(live_fb, "cache_key", "left")
                .select("cache_key", "period", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("live_now", "live_later", "live_fallback")]))


@register("stream_snapshot_warmup", with_ctes(EDITS) + ", report AS (" + TRENDS_REPORT_SQL + ")" + """
SELECT period, 'v3:trends:' || lower(period) AS cache_key,
  strftime(CASE WHEN period = 'Last24Hours' THEN max(as_of) ELSE max(as_of) + to_seconds(10) END, '%Y-%m-%d %H:%M:%S') AS cached_at,
  count(DISTINCT topic_id) AS topics FROM report, clock GROUP BY period""")
def q_stream_snapshot_warmup(spark, sf_dir):
    """T-12: a warm-up tick rebuilds only expired period snapshots: the
    24 h snapshot is fresh and kept, the other two are rebuilt."""
    import datetime as dt

    from editsurge.sources.sinks import write_trend_snapshot
    d = _scratch(spark, "warmup")
    as_of = _stored_edits(spark, sf_dir, d)
    edits = spark.read.parquet(os.path.join(d, "table"))
    old = (dt.datetime.strptime(as_of, "%Y-%m-%d %H:%M:%S") - dt.timedelta(hours=1)).strftime("%Y-%m-%d %H:%M:%S")
    upd = tr.trend_updates(edits, as_of)
    cached = F.when(F.col("period") == "Last24Hours", ad.ts_lit(as_of)).otherwise(ad.ts_lit(old))
    write_trend_snapshot(sn.snapshot_rows(upd, cached_at=cached), os.path.join(d, "snap"))
    tick = (dt.datetime.strptime(as_of, "%Y-%m-%d %H:%M:%S") + dt.timedelta(seconds=10)).strftime("%Y-%m-%d %H:%M:%S")
    _run(J.start_snapshot_warmup(spark, os.path.join(d, "ticks"), os.path.join(d, "table"), os.path.join(d, "snap"),
                                 os.path.join(d, "ckpt"), lambda: tick, trigger=AVAILABLE_NOW))
    s = spark.read.parquet(os.path.join(d, "snap"))
    return s.select("period", "cache_key", F.date_format("cached_at", "yyyy-MM-dd HH:mm:ss").alias("cached_at"),
                    F.size("topics").alias("topics"))


@register("trends_report_maintained", TRENDS_REPORT_SQL)
def q_trends_report_maintained(spark, sf_dir):
    """A-10 in production mode: baselines from the stored baseline table
    (S-07) and topic names from label states built per time slice (as the
    ingest stream appends them), merged; must equal the flagship."""
    import datetime as dt
    d = _scratch(spark, "maintained")
    edits, as_of = ad.load_edits(spark, sf_dir)
    end = dt.datetime.strptime(as_of, "%Y-%m-%d %H:%M:%S")
    cuts = [ad.ts_lit((end - dt.timedelta(days=k)).strftime("%Y-%m-%d %H:%M:%S")) for k in (20, 10)]
    eff = X.effective_time()
    slices = [edits.filter(eff < cuts[0]), edits.filter((eff >= cuts[0]) & (eff < cuts[1])), edits.filter(eff >= cuts[1])]
    for i, part in enumerate(slices):
        tr.topic_label_state(part).write.mode("overwrite").parquet(os.path.join(d, "labels", f"batch_id={i}"))
    from editsurge.sources.sinks import write_baselines
    write_baselines(tr.recalculate_baselines(edits, as_of), os.path.join(d, "baselines"))
    labels = spark.read.parquet(os.path.join(d, "labels")).select("topic_id", "n", "p")
    return tr.trends_report(edits, as_of, spark.read.parquet(os.path.join(d, "baselines")), label_state=labels)
