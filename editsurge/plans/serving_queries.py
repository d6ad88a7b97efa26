"""Registered read-side queries (A-07..A-09, A-11, A-12, F-08, F-14, F-15,
F-19, W-01, X-06..X-08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from editsurge.functions import scalar as X
from editsurge.operators import serving as sv
from editsurge.operators import trends as tr
from editsurge.plans.oracle_ctes import (ARTICLE_COUNTS, BASELINES, COUNTS, EDITS, INFO,
                                         anomaly_sql, with_ctes)
from editsurge.plans.registry import register
from editsurge.sources.adapters import load_edits

URL_SQL = "'https://en.wikipedia.org/wiki/' || url_encode({t})"
NAME_SQL = "CASE WHEN info.name IS NULL OR trim(info.name) = '' THEN 'topic-' || CAST({src}.topic_id AS VARCHAR) ELSE info.name END"
PATH_SQL = "CASE WHEN info.path IS NULL OR trim(info.path) = '' THEN ({name}) ELSE info.path END"
DIR_SQL = ("CASE WHEN change_percent > CAST(0.05 AS FLOAT) THEN 'Rising' "
           "WHEN change_percent < CAST(-0.05 AS FLOAT) THEN 'Falling' ELSE 'Stable' END")
ALL_IDS = "ids AS (SELECT DISTINCT topic_id FROM et WHERE topic_id > 0)"


def _api_sql(period: str, limit: int, min_score: float, n_articles: int) -> str:
    name = NAME_SQL.format(src="f")
    return with_ctes(
        EDITS, COUNTS, BASELINES.format(days=30),
        f"""top AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY edit_count DESC, topic_id) AS topic_rank
              FROM counts WHERE period = '{period}') WHERE topic_rank <= {max(1, limit)})""",
        """j AS (SELECT top.period, top.topic_id, top.edit_count, top.topic_rank,
              coalesce(bl.baseline_daily, CAST(0 AS FLOAT)) AS baseline_daily FROM top LEFT JOIN bl ON top.topic_id = bl.topic_id)""",
        "s AS (" + anomaly_sql("j") + ")",
        f"f AS (SELECT * FROM s WHERE NOT (anomaly_score < CAST({min_score} AS FLOAT)))",
        ALL_IDS, INFO.format(ids="ids"), ARTICLE_COUNTS,
        f"""arts AS (SELECT * FROM (SELECT ac.*, row_number() OVER (PARTITION BY period, topic_id ORDER BY edits DESC, article_id) AS article_rank
              FROM ac WHERE period = '{period}') WHERE article_rank <= {n_articles})""",
    ) + f"""
SELECT f.period, f.topic_rank, f.topic_id, {name} AS topic_name, {PATH_SQL.format(name=name)} AS topic_path,
  f.edit_count, round(CAST(f.anomaly_score AS DOUBLE), 4) AS anomaly_score,
  round(CAST(f.change_percent AS DOUBLE), 4) AS change_percent, {DIR_SQL} AS direction,
  arts.article_rank, arts.article_id, arts.title, arts.edits AS article_edits, {URL_SQL.format(t='arts.title')} AS wiki_url
FROM f LEFT JOIN info ON f.topic_id = info.topic_id
LEFT JOIN arts ON f.period = arts.period AND f.topic_id = arts.topic_id"""


@register("trends_api", _api_sql("Last24Hours", 3, 0.0, 10))
def q_trends_api(spark, sf_dir):
    """A-11: API trend list (24 h, limit 3, min score 0, 10 articles)."""
    edits, as_of = load_edits(spark, sf_dir)
    return sv.trends_response(edits, as_of, "Last24Hours", limit=3, min_anomaly_score=0.0)


@register("min_score_filter", _api_sql("Last7Days", 4, 1.0, 1))
def q_min_score_filter(spark, sf_dir):
    """F-08: the min-score filter runs after the limit (7 d, limit 4, min 1.0)."""
    edits, as_of = load_edits(spark, sf_dir)
    return sv.trends_response(edits, as_of, "Last7Days", limit=4, min_anomaly_score=1.0, articles_n=1)


_LABEL_SQL = """CASE WHEN (CASE WHEN info.path IS NULL OR trim(info.path) = '' THEN info.name ELSE info.path END) IS NULL
         OR trim(CASE WHEN info.path IS NULL OR trim(info.path) = '' THEN info.name ELSE info.path END) = ''
       THEN 'topic-' || CAST(top.topic_id AS VARCHAR)
       ELSE coalesce(list_filter(list_transform(string_split(CASE WHEN info.path IS NULL OR trim(info.path) = '' THEN info.name ELSE info.path END, '>'),
                                                lambda x: trim(x)), lambda x: x <> '')[1],
                     CASE WHEN info.path IS NULL OR trim(info.path) = '' THEN info.name ELSE info.path END) END"""

_MEMBERS = [
    EDITS, COUNTS,
    """top AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY edit_count DESC, topic_id) AS topic_rank
          FROM counts WHERE period = 'Last24Hours') WHERE topic_rank <= 50)""",
    ALL_IDS, INFO.format(ids="ids"),
    f"m AS (SELECT top.*, {_LABEL_SQL} AS label FROM top LEFT JOIN info ON top.topic_id = info.topic_id)",
]


@register("cluster_topics", with_ctes(*_MEMBERS,
                                      """c AS (SELECT label, CAST(sum(edit_count) AS BIGINT) AS total_edits,
                                            list_sort(list(DISTINCT topic_id)) AS ids FROM m GROUP BY label)""",
                                      "r AS (SELECT *, row_number() OVER (ORDER BY total_edits DESC, label) AS cluster_rank FROM c)") + """
SELECT cluster_rank, replace(lower(label), ' ', '-') AS cluster_id, label, total_edits,
  array_to_string(list_transform(ids, lambda x: CAST(x AS VARCHAR)), ',') AS topic_ids
FROM r WHERE cluster_rank <= 20""")
def q_cluster_topics(spark, sf_dir):
    """A-07 + X-07 + X-08: clusters of the top 50 topics (24 h)."""
    edits, as_of = load_edits(spark, sf_dir)
    return sv.clusters(edits, as_of, "Last24Hours")


@register("cluster_articles", with_ctes(
    *_MEMBERS, ARTICLE_COUNTS,
    "lead AS (SELECT * FROM (SELECT topic_id, label, row_number() OVER (PARTITION BY label ORDER BY edit_count DESC, topic_id) AS r FROM m) WHERE r <= 5)",
    """a3 AS (SELECT * FROM (SELECT ac.*, row_number() OVER (PARTITION BY period, topic_id ORDER BY edits DESC, article_id) AS rk
          FROM ac WHERE period = 'Last24Hours') WHERE rk <= 3)""",
    """best AS (SELECT lead.label, a3.article_id, max(a3.edits) AS edit_count, min(a3.title) AS title
          FROM a3 JOIN lead ON a3.topic_id = lead.topic_id GROUP BY lead.label, a3.article_id)""",
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY edit_count DESC, article_id) AS article_rank FROM best)") + f"""
SELECT replace(lower(label), ' ', '-') AS cluster_id, article_rank, article_id, title, edit_count, {URL_SQL.format(t='title')} AS wiki_url
FROM ranked WHERE article_rank <= 10""")
def q_cluster_articles(spark, sf_dir):
    """A-08: per cluster, top articles of its five biggest topics."""
    edits, as_of = load_edits(spark, sf_dir)
    return sv.cluster_articles(edits, as_of, "Last24Hours")


def _detail_sql(topic_id: int, period: str, n: int) -> str:
    name = f"CASE WHEN info.name IS NULL OR trim(info.name) = '' THEN 'topic-{topic_id}' ELSE info.name END"
    return with_ctes(
        EDITS, COUNTS, BASELINES.format(days=30), ALL_IDS, INFO.format(ids="ids"), ARTICLE_COUNTS,
        f"""pv AS (SELECT max(edit_count) FILTER (WHERE period = 'LastHour') AS c1, max(edit_count) FILTER (WHERE period = 'Last24Hours') AS c24,
              max(edit_count) FILTER (WHERE period = 'Last7Days') AS c7, max(edit_count) FILTER (WHERE period = '{period}') AS edit_count
              FROM counts WHERE topic_id = {topic_id})""",
        f"""j AS (SELECT '{period}' AS period, pv.*, coalesce((SELECT baseline_daily FROM bl WHERE topic_id = {topic_id}), CAST(0 AS FLOAT)) AS baseline_daily FROM pv)""",
        "s AS (" + anomaly_sql("j") + ")",
        f"""arts AS (SELECT * FROM (SELECT ac.*, row_number() OVER (ORDER BY edits DESC, article_id) AS article_rank
              FROM ac WHERE period = '{period}' AND topic_id = {topic_id}) WHERE article_rank <= {n})""",
    ) + f"""
SELECT {topic_id} AS topic_id, '{period}' AS period, {name} AS name, {PATH_SQL.format(name=name)} AS path,
  coalesce(s.c1, 0) AS edit_count_last_hour, coalesce(s.c24, 0) AS edit_count_last_24_hours, coalesce(s.c7, 0) AS edit_count_last_7_days,
  round(CAST(s.baseline_daily AS DOUBLE), 4) AS baseline_daily,
  round(CASE WHEN s.edit_count IS NULL THEN 0.0 ELSE CAST(s.anomaly_score AS DOUBLE) END, 4) AS anomaly_score,
  arts.article_rank, arts.article_id, arts.title, arts.edits AS article_edits, {URL_SQL.format(t='arts.title')} AS wiki_url
FROM s LEFT JOIN (SELECT * FROM info WHERE topic_id = {topic_id}) info ON TRUE LEFT JOIN arts ON TRUE"""


@register("topic_detail", _detail_sql(3, "Last7Days", 50))
def q_topic_detail(spark, sf_dir):
    """A-09: detail of topic 3 for 7 days with its 50 top articles."""
    edits, as_of = load_edits(spark, sf_dir)
    return sv.topic_detail(edits, as_of, 3, "Last7Days")


@register("empty_result_fallback", _detail_sql(42, "Last24Hours", 50))
def q_empty_result_fallback(spark, sf_dir):
    """F-19: a topic with no edits gets a zero row named topic-{id}."""
    edits, as_of = load_edits(spark, sf_dir)
    return sv.topic_detail(edits, as_of, 42, "Last24Hours")


@register("topic_activity_stats", with_ctes(EDITS) + """
SELECT topic_id, count(*) AS edit_count, count(DISTINCT "user") AS unique_editors,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_edit_at FROM et GROUP BY topic_id""")
def q_topic_activity_stats(spark, sf_dir):
    """A-12: real edit count, distinct editors and last edit per topic."""
    edits, _ = load_edits(spark, sf_dir)
    return sv.topic_stats(edits).withColumn("last_edit_at", F.date_format("last_edit_at", "yyyy-MM-dd HH:mm:ss"))


@register("top_n_articles_per_topic", with_ctes(EDITS, ARTICLE_COUNTS) + """
SELECT * FROM (SELECT period, topic_id, article_id, title, edits,
  row_number() OVER (PARTITION BY period, topic_id ORDER BY edits DESC, article_id) AS article_rank FROM ac)
WHERE article_rank <= 3""")
def q_top_n_articles_per_topic(spark, sf_dir):
    """W-01: per-topic top N with N = 3 (the cluster setting)."""
    edits, as_of = load_edits(spark, sf_dir)
    return tr.top_articles(tr.article_counts(edits, as_of), 3)


_SCORED = with_ctes(EDITS, COUNTS, BASELINES.format(days=30),
                    """j AS (SELECT c.period, c.topic_id, c.edit_count, coalesce(bl.baseline_daily, CAST(0 AS FLOAT)) AS baseline_daily
                       FROM counts c LEFT JOIN bl ON c.topic_id = bl.topic_id)""",
                    "s AS (" + anomaly_sql("j") + ")")


@register("direction_class", _SCORED + f"""
SELECT period, topic_id, round(CAST(change_percent AS DOUBLE), 4) AS change_percent, {DIR_SQL} AS direction FROM s""")
def q_direction_class(spark, sf_dir):
    """F-14: Rising / Falling / Stable from the change fraction."""
    edits, as_of = load_edits(spark, sf_dir)
    s = tr.anomaly(tr.trend_rollup(edits, as_of))
    return s.select("period", "topic_id", F.round(F.col("change_percent").cast("double"), 4).alias("change_percent"),
                    X.direction("change_percent").alias("direction"))


@register("display_name_fallback", with_ctes(EDITS, ALL_IDS, INFO.format(ids="ids")) + """
SELECT ids.topic_id, CASE WHEN info.name IS NULL OR trim(info.name) = '' THEN 'topic-' || CAST(ids.topic_id AS VARCHAR) ELSE info.name END AS name,
  CASE WHEN info.path IS NULL OR trim(info.path) = '' THEN
    (CASE WHEN info.name IS NULL OR trim(info.name) = '' THEN 'topic-' || CAST(ids.topic_id AS VARCHAR) ELSE info.name END) ELSE info.path END AS path
FROM ids LEFT JOIN info ON ids.topic_id = info.topic_id""")
def q_display_name_fallback(spark, sf_dir):
    """F-15: blank name -> topic-{id}; blank path -> name."""
    edits, _ = load_edits(spark, sf_dir)
    info = tr.topic_info(edits)
    name = X.display_name("name", "topic_id")
    return info.select("topic_id", name.alias("name"), X.display_path(F.col("path"), name).alias("path"))


@register("article_url", with_ctes(EDITS) + f"""
SELECT DISTINCT article_id, title, {URL_SQL.format(t='title')} AS wiki_url FROM e""")
def q_article_url(spark, sf_dir):
    """X-06: article link with percent-encoded title."""
    edits, _ = load_edits(spark, sf_dir)
    return edits.select("article_id", "title", X.article_url("title").alias("wiki_url")).distinct()


@register("path_head", with_ctes(EDITS) + """
SELECT path, coalesce(list_filter(list_transform(string_split(path, '>'), lambda x: trim(x)), lambda x: x <> '')[1], path) AS head,
  replace(lower(coalesce(list_filter(list_transform(string_split(path, '>'), lambda x: trim(x)), lambda x: x <> '')[1], path)), ' ', '-') AS cluster_id
FROM (SELECT DISTINCT path FROM et)""")
def q_path_head(spark, sf_dir):
    """X-08 + X-07: first path segment and the cluster id built from it."""
    edits, _ = load_edits(spark, sf_dir)
    p = tr.explode_topics(edits).select("path").distinct()
    return p.select("path", X.path_head("path").alias("head"), X.cluster_id(X.path_head("path")).alias("cluster_id"))
