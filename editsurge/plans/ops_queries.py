"""Registered metrics, snapshot, command and notification queries (A-14,
A-15, F-13, J-19..J-21, W-05, W-07, W-08, S-04, S-06, S-09, S-11, S-12,
X-09..X-11, X-14, X-15, X-22, X-24)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from editsurge.functions import scalar as X
from editsurge.operators import metrics as mt
from editsurge.operators import serving as sv
from editsurge.operators import snapshots as sn
from editsurge.operators import trends as tr
from editsurge.plans.ingest_queries import _changes
from editsurge.plans.oracle_ctes import EDITS, RECENT, with_ctes
from editsurge.plans.registry import register
from editsurge.plans.serving_queries import _api_sql
from editsurge.plans.trend_queries import TRENDS_REPORT_SQL
from editsurge.sources import adapters as ad
from editsurge.sources.sinks import to_topic_records
from editsurge.sources.tables import read_table

LOG_SQL = """
plog AS (SELECT 'classified-edits' AS topic, 'group-' || event_type AS group_id, event_id AS "offset", ts AS processed_at,
                CAST(floor(value * 10) AS BIGINT) AS elapsed_ms FROM events)
"""


def _log(spark, sf_dir):
    return ad.processing_log_from_events(read_table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value"))


@register("collector_stats", with_ctes(RECENT) + """
SELECT count(*) AS processed, count(*) FILTER (WHERE reason IS NULL) AS published,
  count(*) - count(*) FILTER (WHERE reason IS NULL) AS skipped,
  strftime(max(CASE WHEN "timestamp" > 10000000000 THEN TIMESTAMP '1970-01-01' + to_milliseconds("timestamp")
      ELSE TIMESTAMP '1970-01-01' + to_seconds("timestamp") END) FILTER (WHERE reason IS NULL), '%Y-%m-%d %H:%M:%S.%f') AS last_event_at
FROM rcr""")
def q_collector_stats(spark, sf_dir):
    """A-14: processed / published / skipped and the last event time."""
    rc, _ = _changes(spark, sf_dir)
    s = mt.collector_stats(rc)
    return s.select("processed", "published", "skipped",
                    F.date_format("last_event_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_event_at"))


@register("slow_records", with_ctes(LOG_SQL) + """
SELECT group_id, "offset", elapsed_ms FROM plog WHERE elapsed_ms >= 2000""")
def q_slow_records(spark, sf_dir):
    """F-13: processing-log rows at or above 2000 ms."""
    return mt.slow_records(_log(spark, sf_dir)).select("group_id", "offset", "elapsed_ms")


@register("consumer_interval_stats", with_ctes(LOG_SQL) + """
SELECT strftime(time_bucket(INTERVAL 10 SECONDS, processed_at), '%Y-%m-%d %H:%M:%S') AS interval_start, topic, group_id,
  count(*) AS processed, round(count(*) / 10.0, 4) AS events_per_sec, round(avg(elapsed_ms), 4) AS avg_ms,
  max(elapsed_ms) AS max_ms, count(*) FILTER (WHERE elapsed_ms >= 2000) AS slow_count
FROM plog GROUP BY 1, 2, 3""")
def q_consumer_interval_stats(spark, sf_dir):
    """A-15: 10-second tumbling stats per (topic, group)."""
    s = mt.consumer_interval_stats(_log(spark, sf_dir))
    return s.select(F.date_format("interval_start", "yyyy-MM-dd HH:mm:ss").alias("interval_start"), "topic", "group_id",
                    "processed", F.round("events_per_sec", 4).alias("events_per_sec"), F.round("avg_ms", 4).alias("avg_ms"),
                    "max_ms", "slow_count")


def _snapshots(spark, sf_dir):
    edits, as_of = ad.load_edits(spark, sf_dir)
    return sn.snapshot_rows(tr.trend_updates(edits, as_of)), as_of


REPORT_CTE = "report AS (" + TRENDS_REPORT_SQL + ")"


@register("reshape_trend_update", with_ctes(EDITS) + ", " + REPORT_CTE.replace("WITH ", "WITH ", 1) + """
SELECT period, topic_id, topic_name AS name, topic_name AS path, edit_count, anomaly_score, change_percent,
  CASE WHEN CAST(change_percent AS FLOAT) > CAST(0.05 AS FLOAT) THEN 'Rising' WHEN CAST(change_percent AS FLOAT) < CAST(-0.05 AS FLOAT) THEN 'Falling' ELSE 'Stable' END AS direction,
  article_id, article_title AS title, article_edits,
  CASE WHEN article_id IS NOT NULL THEN 0 END AS wiki_page_id, CASE WHEN article_id IS NOT NULL THEN 'unknown' END AS wiki,
  CASE WHEN article_id IS NOT NULL THEN '' END AS wiki_url
FROM report""")
def q_reshape_trend_update(spark, sf_dir):
    """X-24: snapshot TrendUpdate -> response rows (path = name, wiki 'unknown')."""
    snap, _ = _snapshots(spark, sf_dir)
    r = sn.reshape_trend_update(snap)
    return r.select("period", "topic_id", "name", "path", "edit_count", "anomaly_score", "change_percent", "direction",
                    "article_id", "title", "article_edits", "wiki_page_id", "wiki", "wiki_url")


def _snap_detail_sql(topic_id: int, period: str) -> str:
    return with_ctes(EDITS) + ", " + REPORT_CTE + f""",
asked AS (SELECT DISTINCT topic_id, topic_name, anomaly_score FROM report WHERE topic_id = {topic_id} AND period = '{period}'),
counts3 AS (SELECT max(edit_count) FILTER (WHERE period = 'LastHour') AS c1, max(edit_count) FILTER (WHERE period = 'Last24Hours') AS c24,
                   max(edit_count) FILTER (WHERE period = 'Last7Days') AS c7 FROM report WHERE topic_id = {topic_id})
SELECT a.topic_id, '{period}' AS period, a.topic_name AS name, a.topic_name AS path, coalesce(c.c1, 0) AS edit_count_last_hour,
  coalesce(c.c24, 0) AS edit_count_last_24_hours, coalesce(c.c7, 0) AS edit_count_last_7_days, 0.0 AS baseline_daily,
  a.anomaly_score, r.article_id, r.article_title AS title, r.article_edits
FROM asked a, counts3 c LEFT JOIN (SELECT * FROM report WHERE topic_id = {topic_id} AND period = '{period}') r ON TRUE"""


@register("snapshot_topic_detail", _snap_detail_sql(5, "Last7Days"))
def q_snapshot_topic_detail(spark, sf_dir):
    """J-19: topic 5's detail for 7 days rebuilt from the period snapshots."""
    snap, _ = _snapshots(spark, sf_dir)
    return sn.snapshot_topic_detail(snap, 5, "Last7Days")


CMD_SQL = """
cmds AS (
  SELECT CASE WHEN event_type = 'error' THEN 'invalidate' ELSE 'recalculate' END AS kind,
    CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 5 + 1 AS INTEGER) END AS topic_id,
    CASE WHEN event_type = 'error' THEN 'v3:trends:' || ['lasthour', 'last24hours', 'last7days'][event_id % 3 + 1] END AS cache_key,
    date_trunc('second', ts) AS requested_at
  FROM events WHERE event_type IN ('error', 'signup')
)
"""


@register("command_records", with_ctes(CMD_SQL) + """
SELECT CASE WHEN kind = 'recalculate' THEN coalesce(CAST(topic_id AS VARCHAR), 'all') ELSE cache_key END AS key,
  kind, topic_id, cache_key, strftime(requested_at, '%Y-%m-%d %H:%M:%S') AS requested_at FROM cmds""")
def q_command_records(spark, sf_dir):
    """S-12 + S-11: command rows with their record keys."""
    cmds = ad.commands_from_events(read_table(spark, sf_dir, "events", "event_id", "ts", "event_type"))
    return sn.command_records(cmds).withColumn("requested_at", F.date_format("requested_at", "yyyy-MM-dd HH:mm:ss"))


@register("invalidate_snapshots", with_ctes(EDITS, CMD_SQL, """
counts0 AS (SELECT p.period FROM et, clock, periods p WHERE et.eff >= clock.as_of - to_hours(p.hours) GROUP BY 1),
snap AS (SELECT 'v3:trends:' || lower(p.period) AS cache_key, p.period,
                CASE WHEN p.period = 'Last24Hours' THEN clock.as_of - to_hours(24) ELSE clock.as_of END AS cached_at
         FROM periods p, clock WHERE p.period IN (SELECT DISTINCT period FROM counts0)),
ck AS (SELECT unnest(CASE WHEN kind = 'recalculate' THEN ['v3:trends:lasthour', 'v3:trends:last24hours', 'v3:trends:last7days']
                          ELSE [cache_key] END) AS cache_key, requested_at FROM cmds),
latest AS (SELECT cache_key, max(requested_at) AS requested_at FROM ck GROUP BY 1)""") + """
SELECT cache_key, period FROM snap WHERE cache_key NOT IN (
  SELECT s.cache_key FROM snap s JOIN latest l ON s.cache_key = l.cache_key WHERE l.requested_at >= s.cached_at)""")
def q_invalidate_snapshots(spark, sf_dir):
    """J-20: period snapshots that survive the invalidate and recalculate
    commands; the 24 h snapshot was cached a day before as_of (so later
    commands drop it), the others at as_of (no command is newer)."""
    edits, as_of = ad.load_edits(spark, sf_dir)
    periods = tr.trend_counts(edits, as_of).select("period").distinct()
    hours = F.when(F.col("period") == "Last24Hours", 24).otherwise(0)
    snap = periods.select(X.trends_snapshot_key("period").alias("cache_key"), "period",
                          F.timestamp_add("HOUR", -hours, ad.ts_lit(as_of)).alias("cached_at"))
    cmds = ad.commands_from_events(read_table(spark, sf_dir, "events", "event_id", "ts", "event_type"))
    return sn.apply_invalidations(snap, cmds).select("cache_key", "period")


NOTES_SQL = "api AS (" + _api_sql("Last24Hours", 10, 0.0, 10) + ")"


@register("first_notifications", with_ctes(EDITS) + ", " + NOTES_SQL + """
SELECT DISTINCT topic_rank, topic_id, topic_name, 'TrendUpdate' AS type, anomaly_score, 'Trend updated' AS message
FROM api WHERE topic_rank <= 5""")
def q_first_notifications(spark, sf_dir):
    """W-08: the first five topics of the 24 h list (limit 10) as notifications."""
    edits, as_of = ad.load_edits(spark, sf_dir)
    lst = sv.trends_response(edits, as_of, "Last24Hours", limit=10, min_anomaly_score=0.0)
    return sn.notifications(lst, as_of).drop("timestamp")


@register("notification_fanout", with_ctes(EDITS) + ", " + NOTES_SQL + """
SELECT topic_id, topic_name, unnest(['topic:' || CAST(topic_id AS VARCHAR), 'all']) AS audience
FROM (SELECT DISTINCT topic_rank, topic_id, topic_name FROM api WHERE topic_rank <= 5)""")
def q_notification_fanout(spark, sf_dir):
    """J-21: each notification to everyone and to its topic group."""
    edits, as_of = ad.load_edits(spark, sf_dir)
    lst = sv.trends_response(edits, as_of, "Last24Hours", limit=10, min_anomaly_score=0.0)
    return sn.notification_fanout(sn.notifications(lst, as_of)).select("topic_id", "topic_name", "audience")


@register("page_of_articles", with_ctes(EDITS, """
ad0 AS (SELECT DISTINCT event_id, article_id, title, ts, topic_id FROM et),
ac AS (SELECT topic_id, article_id, min(title) AS title, count(*) AS edits FROM ad0, clock
       WHERE ts >= clock.as_of - to_hours(168) GROUP BY 1, 2),
rn AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY edits DESC, article_id) AS row_number,
              count(*) OVER (PARTITION BY topic_id) AS total_count FROM ac)""") + """
SELECT topic_id, article_id, title, edits, row_number, total_count, 2 AS page, 20 AS page_size,
  CAST(ceil(total_count / 20.0) AS INTEGER) AS total_pages, 2 < CAST(ceil(total_count / 20.0) AS INTEGER) AS has_next, true AS has_previous
FROM rn WHERE row_number > 20 AND row_number <= 40""")
def q_page_of_articles(spark, sf_dir):
    """W-07: page 2 (size 20) of each topic's 7-day article list."""
    edits, as_of = ad.load_edits(spark, sf_dir)
    ac = tr.article_counts(edits, as_of, periods=["Last7Days"]).drop("period")
    return sn.page_of(ac, [F.desc("edits"), F.asc("article_id")], page=2, page_size=20, partition_cols=["topic_id"]) \
             .select("topic_id", "article_id", "title", "edits", "row_number", "total_count", "page", "page_size",
                     "total_pages", "has_next", "has_previous")


@register("snapshot_key", with_ctes(EDITS) + """
SELECT DISTINCT topic_id, p.period, 'v2:topic:' || CAST(topic_id AS VARCHAR) || ':' || lower(p.period) AS cache_key,
  'v3:trends:' || lower(p.period) AS trends_key FROM et, periods p""")
def q_snapshot_key(spark, sf_dir):
    """X-14: cache keys of every (topic, period) and period."""
    edits, _ = ad.load_edits(spark, sf_dir)
    ids = tr.known_topic_ids(tr.explode_topics(edits))
    k = sn.topic_detail_keys(ids)
    return k.select("topic_id", "period", "cache_key", X.trends_snapshot_key("period").alias("trends_key"))


@register("topic_partition_key", with_ctes(RECENT, """
ek AS (SELECT 'raw' AS stream, CAST(page_id AS VARCHAR) AS key FROM raw
       UNION ALL SELECT 'classified', CAST(n % 97 + 1 AS VARCHAR) FROM (SELECT event_id AS n FROM events WHERE event_id % 50 <> 0)
       UNION ALL SELECT 'trends', p FROM (VALUES ('LastHour'), ('Last24Hours'), ('Last7Days')) t(p))""") + """
SELECT stream, key, count(*) AS n FROM ek GROUP BY 1, 2""")
def q_topic_partition_key(spark, sf_dir):
    """S-11: record keys per stream (raw: page id, classified: article id,
    trends: period), counted per key (the partitioning they give)."""
    from editsurge.plans.ingest_queries import _raw
    raw, _ = _raw(spark, sf_dir)
    edits, _ = ad.load_edits(spark, sf_dir)
    a = raw.select(F.lit("raw").alias("stream"), F.col("page_id").cast("string").alias("key"))
    b = edits.filter(F.size("topics") > 0).select(F.lit("classified").alias("stream"), F.col("article_id").cast("string").alias("key"))
    c = spark.createDataFrame([(p,) for p in X.PERIODS], "key string").select(F.lit("trends").alias("stream"), "key")
    return a.unionByName(b).unionByName(c).groupBy("stream", "key").agg(F.count("*").alias("n"))


@register("sink_event_topic", with_ctes(EDITS) + """
SELECT CAST(article_id AS VARCHAR) AS key, to_json({'eventId': event_id, 'wikiEditId': wiki_edit_id, 'articleId': article_id, 'title': title,
  'wiki': wiki}) AS value FROM e""")
def q_sink_event_topic(spark, sf_dir):
    """S-04 + X-17: keyed camelCase JSON records (nulls dropped)."""
    edits, _ = ad.load_edits(spark, sf_dir)
    return to_topic_records(edits, "article_id", ["event_id", "wiki_edit_id", "article_id", "title", "wiki"])


@register("scan_edit_events", with_ctes(EDITS) + """
SELECT wiki, CAST(ts AS DATE) AS day, count(*) AS edits FROM e GROUP BY 1, 2""")
def q_scan_edit_events(spark, sf_dir):
    """S-06: columnar scan of the edit table (wiki, day) with pruned columns."""
    edits, _ = ad.load_edits(spark, sf_dir)
    return edits.groupBy("wiki", X.to_day("ts").alias("day")).agg(F.count("*").alias("edits"))


@register("source_reference_dims", """
SELECT 'articles' AS dim, count(*) AS n FROM documents UNION ALL SELECT 'class_nodes', (SELECT count(*) FROM nation) + (SELECT count(*) FROM region) + 2
UNION ALL SELECT 'customers', count(*) FROM customer""")
def q_source_reference_dims(spark, sf_dir):
    """S-09: dimension tables loaded with explicit column lists."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    events = read_table(spark, sf_dir, "events", "ts")
    arts = ad.articles_from_documents(docs, ad.max_ts(events))
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    _, nodes = ad.class_graph(cust.withColumn("c_name", F.lit("")), nation, region)
    return (arts.agg(F.count("*").alias("n")).select(F.lit("articles").alias("dim"), "n")
                .unionByName(nodes.agg(F.count("*").alias("n")).select(F.lit("class_nodes").alias("dim"), "n"))
                .unionByName(cust.agg(F.count("*").alias("n")).select(F.lit("customers").alias("dim"), "n")))


@register("placeholder_name", with_ctes(EDITS) + r"""
SELECT DISTINCT name, regexp_matches(lower(name), '^topic\s*\d+$') OR regexp_matches(lower(name), '^topic\d+$') AS placeholder_name,
  path, regexp_matches(lower(path), '^topic-\d+$') AS placeholder_path FROM et""")
def q_placeholder_name(spark, sf_dir):
    """X-09: placeholder topic names and paths."""
    edits, _ = ad.load_edits(spark, sf_dir)
    t = tr.explode_topics(edits)
    return t.select("name", X.is_placeholder_name("name").alias("placeholder_name"), "path",
                    X.is_placeholder_path("path").alias("placeholder_path")).distinct()


@register("effective_time", with_ctes(EDITS) + """
SELECT event_id, strftime(greatest(ts, classified_at), '%Y-%m-%d %H:%M:%S') AS eff, CAST(ts AS DATE) AS day FROM e""")
def q_effective_time(spark, sf_dir):
    """X-10 + X-11: greatest(ts, classified_at) and the UTC day of ts."""
    edits, _ = ad.load_edits(spark, sf_dir)
    return edits.select("event_id", F.date_format(X.effective_time(), "yyyy-MM-dd HH:mm:ss").alias("eff"),
                        X.to_day("ts").alias("day"))


@register("period_enum", """
SELECT v, CASE WHEN TRY_CAST(TRY_CAST(v AS DOUBLE) AS INTEGER) = 0 THEN 'LastHour' WHEN TRY_CAST(TRY_CAST(v AS DOUBLE) AS INTEGER) = 1 THEN 'Last24Hours'
  WHEN TRY_CAST(TRY_CAST(v AS DOUBLE) AS INTEGER) = 2 THEN 'Last7Days' WHEN lower(v) = 'lasthour' THEN 'LastHour'
  WHEN lower(v) = 'last24hours' THEN 'Last24Hours' WHEN lower(v) = 'last7days' THEN 'Last7Days' END AS period
FROM (SELECT DISTINCT CAST(event_id % 3 AS VARCHAR) AS v FROM events
      UNION SELECT DISTINCT CASE event_id % 3 WHEN 0 THEN 'LastHour' WHEN 1 THEN 'last24hours' ELSE 'LAST7DAYS' END FROM events
      UNION SELECT '2.0' UNION SELECT 'x')""")
def q_period_enum(spark, sf_dir):
    """X-22: period given as a number or a name (any case)."""
    ev = read_table(spark, sf_dir, "events", "event_id")
    a = ev.select((F.col("event_id") % 3).cast("string").alias("v")).distinct()
    b = ev.select(F.element_at(F.array(F.lit("LastHour"), F.lit("last24hours"), F.lit("LAST7DAYS")),
                               (F.col("event_id") % 3 + 1).cast("int")).alias("v")).distinct()
    c = spark.createDataFrame([("2.0",), ("x",)], "v string")
    return a.union(b).union(c).distinct().select("v", X.period_from_value("v").alias("period"))


@register("latest_article_version", with_ctes(RECENT) + """
SELECT wiki, page_id, title, wiki_edit_id FROM (
  SELECT *, row_number() OVER (PARTITION BY wiki, page_id ORDER BY "timestamp" DESC, wiki_edit_id DESC) AS rk FROM raw)
WHERE rk = 1""")
def q_latest_article_version(spark, sf_dir):
    """W-05: last write wins per (wiki, page_id) among the raw edits
    (aggregate max_by instead of a window, so a hot page is combined map
    side)."""
    from editsurge.plans.ingest_queries import _raw
    raw, _ = _raw(spark, sf_dir)
    return (raw.groupBy("wiki", "page_id")
               .agg(F.max_by(F.struct("title", "wiki_edit_id"), F.struct("timestamp", "wiki_edit_id")).alias("v"))
               .select("wiki", "page_id", "v.title", "v.wiki_edit_id"))


@register("sum_round_casts", with_ctes(EDITS) + """
SELECT CAST(article_id AS BIGINT) AS article_id, CAST(count(*) AS INTEGER) AS edits FROM e GROUP BY 1""")
def q_sum_round_casts(spark, sf_dir):
    """X-15: toInt64 ids and toInt32 counts."""
    edits, _ = ad.load_edits(spark, sf_dir)
    return edits.groupBy(F.col("article_id").cast("long").alias("article_id")).agg(F.count("*").cast("int").alias("edits"))
