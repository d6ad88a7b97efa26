"""Registered trend queries (A-01..A-06, A-10, J-01, J-17, J-18, F-07..F-11,
W-01..W-04, U-04) over edits derived from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from editsurge.operators import trends as tr
from editsurge.plans.oracle_ctes import (ARTICLE_COUNTS, BASELINES, COUNTS, EDITS, INFO,
                                         anomaly_sql, with_ctes)
from editsurge.plans.registry import register
from editsurge.sources.adapters import load_edits


def _r4(c):
    return F.round(F.col(c).cast("double"), 4).alias(c)


TRENDS_REPORT_SQL = with_ctes(
    EDITS, COUNTS,
    "top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY period ORDER BY edit_count DESC, topic_id) AS topic_rank FROM counts) WHERE topic_rank <= 50)",
    BASELINES.format(days=30),
    INFO.format(ids="top"),
    """scored0 AS (
      SELECT top.period, top.topic_id, top.edit_count, coalesce(bl.baseline_daily, CAST(0 AS FLOAT)) AS baseline_daily,
        CASE WHEN info.name IS NULL OR trim(info.name) = '' THEN 'topic-' || CAST(top.topic_id AS VARCHAR) ELSE info.name END AS topic_name
      FROM top LEFT JOIN bl ON top.topic_id = bl.topic_id LEFT JOIN info ON top.topic_id = info.topic_id)""",
    "scored AS (" + anomaly_sql("scored0") + ")",
    """rep AS (SELECT *, row_number() OVER (PARTITION BY period ORDER BY anomaly_score DESC, topic_id) AS score_rank
      FROM scored WHERE NOT (anomaly_score < CAST(1.1 AS FLOAT) AND change_percent < CAST(0.2 AS FLOAT)))""",
    ARTICLE_COUNTS,
    """arts AS (SELECT * FROM (SELECT ac.*, row_number() OVER (PARTITION BY ac.period, ac.topic_id ORDER BY edits DESC, article_id) AS article_rank
      FROM ac JOIN rep ON ac.period = rep.period AND ac.topic_id = rep.topic_id) WHERE article_rank <= 20)""",
) + """
SELECT rep.period, rep.topic_id, rep.topic_name, rep.edit_count,
  round(CAST(rep.baseline_daily AS DOUBLE), 4) AS baseline_daily,
  round(CAST(rep.anomaly_score AS DOUBLE), 4) AS anomaly_score,
  round(CAST(rep.change_percent AS DOUBLE), 4) AS change_percent,
  rep.score_rank, arts.article_rank, arts.article_id, arts.title AS article_title, arts.edits AS article_edits
FROM rep LEFT JOIN arts ON rep.period = arts.period AND rep.topic_id = arts.topic_id
"""


@register("trends_report", TRENDS_REPORT_SQL)
def q_trends_report(spark, sf_dir):
    """A-10: the flagship trend report, flattened."""
    edits, as_of = load_edits(spark, sf_dir)
    return tr.trends_report(edits, as_of)


@register("trend_aggregation", with_ctes(EDITS, COUNTS) + """
SELECT period, topic_id, edit_count, 0 AS unique_editors FROM counts""")
def q_trend_aggregation(spark, sf_dir):
    """A-01 for all three periods in one scan."""
    edits, as_of = load_edits(spark, sf_dir)
    return tr.trend_counts(edits, as_of)


@register("explode_topics", with_ctes(EDITS) + """
SELECT event_id, topic_id, name, path, round(CAST(confidence AS DOUBLE), 4) AS confidence FROM et""")
def q_explode_topics(spark, sf_dir):
    """J-01: one row per (edit, topic entry)."""
    edits, _ = load_edits(spark, sf_dir)
    return tr.explode_topics(edits, "event_id").select(
        "event_id", "topic_id", "name", "path", _r4("confidence"))


@register("daily_topic_counts", with_ctes(EDITS, BASELINES.format(days=30)) + """
SELECT topic_id, CAST(day AS VARCHAR) AS day, daily_count FROM daily""")
def q_daily_topic_counts(spark, sf_dir):
    """A-02: per (topic, day) counts within 30 days."""
    edits, as_of = load_edits(spark, sf_dir)
    return tr.daily_topic_counts(edits, as_of, 30).select(
        F.col("topic_id").cast("int").alias("topic_id"), F.col("day").cast("string").alias("day"), "daily_count")


@register("recalculate_baselines", with_ctes(EDITS, BASELINES.format(days=30)) + """
SELECT topic_id, round(CAST(baseline_daily AS DOUBLE), 4) AS baseline_daily FROM bl""")
def q_recalculate_baselines(spark, sf_dir):
    """A-03: average daily count over days with edits (30-day lookback)."""
    edits, as_of = load_edits(spark, sf_dir)
    return tr.recalculate_baselines(edits, as_of, 30).select("topic_id", _r4("baseline_daily"))


_BL_VERSIONS = r"""
daily_old AS (
  SELECT topic_id, CAST(ts AS DATE) AS day, count(*) AS daily_count
  FROM et, clock WHERE eff >= as_of - to_days(8) - to_days(7) AND eff <= as_of - to_days(8) GROUP BY 1, 2
),
versions AS (
  SELECT topic_id, CAST(avg(daily_count) AS FLOAT) AS baseline_daily, 0 AS v FROM daily_old GROUP BY 1
  UNION ALL SELECT topic_id, baseline_daily, 1 AS v FROM bl
)
"""


def _baseline_versions(edits, as_of):
    """Two versions of each baseline row: an older one computed 8 days
    before as_of over 7 days, and the current one."""
    import datetime as dt

    from editsurge.sources.adapters import ts_lit
    t = dt.datetime.strptime(as_of, "%Y-%m-%d %H:%M:%S") - dt.timedelta(days=8)
    old = t.strftime("%Y-%m-%d %H:%M:%S")
    older = (edits.filter(tr.effective_after(ts_lit(old) - F.expr("INTERVAL 7 DAYS")))
                  .filter(F.greatest("ts", "classified_at") <= ts_lit(old)))
    return tr.recalculate_baselines(older, old, 7).unionByName(tr.recalculate_baselines(edits, as_of, 30))


@register("latest_baseline", with_ctes(EDITS, BASELINES.format(days=30), _BL_VERSIONS) + """
SELECT topic_id, round(CAST(max_by(baseline_daily, v) AS DOUBLE), 4) AS baseline_daily FROM versions GROUP BY topic_id""")
def q_latest_baseline(spark, sf_dir):
    """W-02: newest baseline per topic out of appended versions."""
    edits, as_of = load_edits(spark, sf_dir)
    return tr.latest_baseline(_baseline_versions(edits, as_of)).select("topic_id", _r4("baseline_daily"))


@register("baseline_join", with_ctes(EDITS, COUNTS, BASELINES.format(days=3)) + """
SELECT c.period, c.topic_id, c.edit_count, round(CAST(coalesce(bl.baseline_daily, CAST(0 AS FLOAT)) AS DOUBLE), 4) AS baseline_daily
FROM counts c LEFT JOIN bl ON c.topic_id = bl.topic_id""")
def q_baseline_join(spark, sf_dir):
    """J-17: trend rows with their latest baseline (missing -> 0)."""
    edits, as_of = load_edits(spark, sf_dir)
    out = tr.with_baseline(tr.trend_counts(edits, as_of), tr.recalculate_baselines(edits, as_of, 3))
    return out.select("period", "topic_id", "edit_count", _r4("baseline_daily"))


@register("anomaly_score", with_ctes(EDITS, COUNTS, BASELINES.format(days=30),
                                     """j AS (SELECT c.period, c.topic_id, c.edit_count, coalesce(bl.baseline_daily, CAST(0 AS FLOAT)) AS baseline_daily
                                        FROM counts c LEFT JOIN bl ON c.topic_id = bl.topic_id)""",
                                     "s AS (" + anomaly_sql("j") + ")") + """
SELECT period, topic_id, edit_count, round(CAST(baseline_daily AS DOUBLE), 4) AS baseline_daily,
  round(CAST(anomaly_score AS DOUBLE), 4) AS anomaly_score, round(CAST(change_percent AS DOUBLE), 4) AS change_percent FROM s""")
def q_anomaly_score(spark, sf_dir):
    """A-04: score and change for every (period, topic)."""
    edits, as_of = load_edits(spark, sf_dir)
    s = tr.anomaly(tr.with_baseline(tr.trend_counts(edits, as_of), tr.recalculate_baselines(edits, as_of)))
    return s.select("period", "topic_id", "edit_count", _r4("baseline_daily"), _r4("anomaly_score"), _r4("change_percent"))


@register("top_articles", with_ctes(EDITS, ARTICLE_COUNTS) + """
SELECT * FROM (SELECT period, topic_id, article_id, title, edits,
  row_number() OVER (PARTITION BY period, topic_id ORDER BY edits DESC, article_id) AS article_rank FROM ac)
WHERE article_rank <= 20""")
def q_top_articles(spark, sf_dir):
    """A-05 + W-01: top 20 articles per (period, topic) on ts alone."""
    edits, as_of = load_edits(spark, sf_dir)
    return tr.top_articles(tr.article_counts(edits, as_of), 20)


@register("topic_info", with_ctes(EDITS, "ids AS (SELECT DISTINCT topic_id FROM et WHERE topic_id > 0)",
                                  INFO.format(ids="ids")) + """
SELECT topic_id, name, path FROM info""")
def q_topic_info(spark, sf_dir):
    """A-06: latest usable name/path per topic ('' when none)."""
    edits, _ = load_edits(spark, sf_dir)
    return tr.topic_info(edits)


@register("topic_info_join", with_ctes(EDITS, COUNTS, "ids AS (SELECT DISTINCT topic_id FROM counts)", INFO.format(ids="ids")) + """
SELECT c.period, c.topic_id, c.edit_count, coalesce(info.name, '') AS name, coalesce(info.path, '') AS path
FROM counts c LEFT JOIN info ON c.topic_id = info.topic_id""")
def q_topic_info_join(spark, sf_dir):
    """J-18: trend rows with name and path."""
    edits, as_of = load_edits(spark, sf_dir)
    c = tr.trend_counts(edits, as_of)
    return tr.with_topic_info(c, tr.topic_info(edits)).select("period", "topic_id", "edit_count", "name", "path")


@register("top_topics", with_ctes(EDITS, COUNTS) + """
SELECT period, topic_id, edit_count, topic_rank FROM (SELECT *, row_number() OVER (PARTITION BY period ORDER BY edit_count DESC, topic_id) AS topic_rank FROM counts)
WHERE topic_rank <= 3""")
def q_top_topics(spark, sf_dir):
    """W-03: the first N topics per period by count (N = 3 here)."""
    edits, as_of = load_edits(spark, sf_dir)
    return tr.top_topics(tr.trend_counts(edits, as_of), 3).select("period", "topic_id", "edit_count", "topic_rank")


_SCORED = with_ctes(EDITS, COUNTS, BASELINES.format(days=30),
                    """j AS (SELECT c.period, c.topic_id, c.edit_count, coalesce(bl.baseline_daily, CAST(0 AS FLOAT)) AS baseline_daily
                       FROM counts c LEFT JOIN bl ON c.topic_id = bl.topic_id)""",
                    "s AS (" + anomaly_sql("j") + ")")


def _scored_all(spark, sf_dir):
    edits, as_of = load_edits(spark, sf_dir)
    return tr.anomaly(tr.with_baseline(tr.trend_counts(edits, as_of), tr.recalculate_baselines(edits, as_of)))


@register("report_filter", _SCORED + """
SELECT period, topic_id, round(CAST(anomaly_score AS DOUBLE), 4) AS anomaly_score, round(CAST(change_percent AS DOUBLE), 4) AS change_percent
FROM s WHERE NOT (anomaly_score < CAST(1.1 AS FLOAT) AND change_percent < CAST(0.2 AS FLOAT))""")
def q_report_filter(spark, sf_dir):
    """F-07: keep score >= 1.1 or change >= 0.2."""
    return tr.reportable(_scored_all(spark, sf_dir)).select("period", "topic_id", _r4("anomaly_score"), _r4("change_percent"))


@register("rank_by_score", _SCORED + """
SELECT period, topic_id, row_number() OVER (PARTITION BY period ORDER BY anomaly_score DESC, topic_id) AS score_rank FROM s""")
def q_rank_by_score(spark, sf_dir):
    """W-04: order topics by score, highest first (id breaks ties)."""
    from pyspark.sql import Window
    w = Window.partitionBy("period").orderBy(F.desc("anomaly_score"), F.asc("topic_id"))
    return _scored_all(spark, sf_dir).select("period", "topic_id", F.row_number().over(w).alias("score_rank"))


@register("period_window_filter", with_ctes(EDITS) + """
SELECT p.period, CAST(count(*) AS BIGINT) AS edits_in_window
FROM e, clock, periods p WHERE e.ts >= clock.as_of - to_hours(p.hours) GROUP BY p.period""")
def q_period_window_filter(spark, sf_dir):
    """F-09: edits whose ts lies in each trailing window (lower bound only)."""
    edits, as_of = load_edits(spark, sf_dir)
    from editsurge.functions.scalar import PERIODS
    aggs = [F.count_if(F.col("ts") >= tr.window_start(as_of, p)).alias(p) for p in PERIODS]
    wide = edits.filter(F.col("ts") >= tr.window_start(as_of, "Last7Days")).agg(*aggs)
    return wide.select(F.expr("stack(3, 'LastHour', LastHour, 'Last24Hours', Last24Hours, 'Last7Days', Last7Days) AS (period, edits_in_window)")) \
               .filter(F.col("edits_in_window") > 0)


@register("topic_membership_filter", with_ctes(EDITS) + """
SELECT DISTINCT event_id, article_id FROM et WHERE topic_id = 3""")
def q_topic_membership_filter(spark, sf_dir):
    """F-10: edits whose topic list holds topic 3."""
    edits, _ = load_edits(spark, sf_dir)
    return edits.filter(tr.has_topic(3)).select("event_id", "article_id")


@register("known_topic_ids", with_ctes(EDITS) + """
SELECT DISTINCT topic_id FROM et WHERE topic_id > 0""")
def q_known_topic_ids(spark, sf_dir):
    """F-11: positive distinct topic ids."""
    edits, _ = load_edits(spark, sf_dir)
    return tr.known_topic_ids(tr.explode_topics(edits))


@register("all_periods_union", with_ctes(EDITS, COUNTS) + """
SELECT period, CAST(count(*) AS BIGINT) AS topics, CAST(sum(edit_count) AS BIGINT) AS edits FROM counts GROUP BY period""")
def q_all_periods_union(spark, sf_dir):
    """U-04: the three periods from one scan, summarised per period."""
    edits, as_of = load_edits(spark, sf_dir)
    c = tr.trend_counts(edits, as_of)
    return c.groupBy("period").agg(F.count("*").alias("topics"), F.sum("edit_count").cast("long").alias("edits"))
