"""Read-side queries: API trend list, clusters, topic detail, topic stats.

Each reference endpoint ran one SQL per topic (N+1); here each is one plan:
counts for every topic come from one aggregate, baselines from a join, and
per-topic article lists from a windowed top-N.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editsurge.functions.scalar import (PERIOD_HOURS, PERIODS, TOPIC_NAME_PREFIX, article_url, blank, cluster_id,
                                        direction, display_name, display_path, path_head)
from editsurge.operators import trends as tr
from editsurge.operators.joins import limited

# API defaults (limit 20, 10 articles; clusters take 50 topics,
# 5 topics x 3 articles each, keep 10 articles and 20 clusters; topic detail
# lists 50 articles).
API_LIMIT = 20
API_ARTICLES = 10
CLUSTER_TOPICS = 50
CLUSTER_TOPICS_WITH_ARTICLES = 5
CLUSTER_ARTICLES_PER_TOPIC = 3
CLUSTER_ARTICLES = 10
CLUSTER_LIMIT = 20
DETAIL_ARTICLES = 50


def norm_period(period: str) -> str:
    """Unknown periods fall back to 24 hours (F-09)."""
    return period if period in PERIOD_HOURS else "Last24Hours"


def _info(edits: DataFrame, label_state: DataFrame | None) -> DataFrame:
    """Topic names: from a maintained label state when given (no history
    scan), else from the edit history."""
    if label_state is None:
        return tr.topic_info(edits)
    return tr.topic_info_from_state(tr.merge_label_states(label_state))


def period_counts(edits: DataFrame, as_of: str, period: str, baselines: DataFrame | None = None,
                  lookback_days: int = tr.BASELINE_LOOKBACK_DAYS) -> DataFrame:
    """(period, topic_id, edit_count, baseline_daily) for one period."""
    period = norm_period(period)
    if baselines is None:
        return tr.trend_rollup(edits, as_of, lookback_days).filter(F.col("period") == period)
    return tr.with_baseline(tr.trend_counts(edits, as_of, [period]), baselines)


def _article_rows(arts: DataFrame) -> DataFrame:
    return arts.select("period", "topic_id", "article_rank", "article_id", "title",
                       F.col("edits").alias("article_edits"),
                       article_url("title").alias("wiki_url"))


def trends_response(edits: DataFrame, as_of: str, period: str = "Last24Hours", limit: int = API_LIMIT,
                    min_anomaly_score: float = 0.0, baselines: DataFrame | None = None,
                    lookback_days: int = tr.BASELINE_LOOKBACK_DAYS,
                    articles_n: int = API_ARTICLES, label_state: DataFrame | None = None) -> DataFrame:
    """A-11: the API trend list, flattened to one row per (topic, article).

    Top max(1, limit) topics by count; the min-score filter runs after the
    limit (Q13), so fewer than ``limit`` topics may come back.  Order stays
    by count (topic_rank).  Name falls back to topic-{id}, path to the name.
    """
    period = norm_period(period)
    top = tr.top_topics(period_counts(edits, as_of, period, baselines, lookback_days), max(1, limit))
    scored = tr.anomaly(top)
    # The plan of the list ends here: names and articles are looked for its topics only.
    scored = limited(scored.filter(~(F.col("anomaly_score") < F.lit(min_anomaly_score).cast("float"))), max(1, limit))
    info = tr.topic_info(edits, scored) if label_state is None else _info(edits, label_state)
    scored = scored.join(info, "topic_id", "left")
    name = display_name(F.coalesce("name", F.lit("")), "topic_id")
    scored = scored.select("period", "topic_rank", "topic_id", name.alias("topic_name"),
                           display_path(F.col("path"), name).alias("topic_path"), "edit_count",
                           F.round(F.col("anomaly_score").cast("double"), 4).alias("anomaly_score"),
                           F.round(F.col("change_percent").cast("double"), 4).alias("change_percent"),
                           direction("change_percent").alias("direction"))
    arts = tr.top_articles(tr.article_counts(edits, as_of, topics=scored.select("period", "topic_id"), periods=[period]), articles_n)
    return scored.join(_article_rows(arts), ["period", "topic_id"], "left")


def cluster_label(name, path, topic_id):
    """A-07 label: path (or name when the path is blank) -> first segment;
    both blank -> topic-{id}."""
    src = F.when(blank(path), name).otherwise(path)
    return F.when(blank(src), F.concat(F.lit(TOPIC_NAME_PREFIX), topic_id.cast("string"))).otherwise(path_head(src))


def cluster_members(edits: DataFrame, as_of: str, period: str = "Last24Hours",
                    label_state: DataFrame | None = None) -> DataFrame:
    """Top 50 topics of the period with their cluster label (bounded)."""
    period = norm_period(period)
    top = tr.top_topics(tr.trend_counts(edits, as_of, [period]), CLUSTER_TOPICS)
    info = _info(edits, label_state)
    t = top.join(info, "topic_id", "left")
    return t.withColumn("label", cluster_label(F.col("name"), F.col("path"), F.col("topic_id")))


def clusters(edits: DataFrame, as_of: str, period: str = "Last24Hours",
             label_state: DataFrame | None = None) -> DataFrame:
    """A-07: clusters of the top 50 topics by path head; total = sum of
    counts; ordered by total desc (label breaks ties), first 20.
    Columns: cluster_rank, cluster_id, label, total_edits, topic_ids."""
    m = cluster_members(edits, as_of, period, label_state)
    c = (m.groupBy("label")
          .agg(F.sum("edit_count").cast("long").alias("total_edits"),
               F.array_sort(F.collect_set("topic_id")).alias("topic_ids")))
    w = Window.orderBy(F.desc("total_edits"), F.asc("label"))
    # The input holds at most 50 labels (one per top topic), so this
    # unpartitioned window sorts at most 50 rows.
    return (c.withColumn("cluster_rank", F.row_number().over(w))
             .filter(F.col("cluster_rank") <= CLUSTER_LIMIT)
             .select("cluster_rank", cluster_id("label").alias("cluster_id"), "label", "total_edits",
                     F.array_join(F.transform("topic_ids", lambda x: x.cast("string")), ",").alias("topic_ids")))


def cluster_articles(edits: DataFrame, as_of: str, period: str = "Last24Hours",
                     label_state: DataFrame | None = None) -> DataFrame:
    """A-08: per cluster, its five biggest topics x their three top
    articles; an article kept once with its largest count; ten by count."""
    period = norm_period(period)
    m = cluster_members(edits, as_of, period, label_state)
    wt = Window.partitionBy("label").orderBy(F.desc("edit_count"), F.asc("topic_id"))
    lead = limited(m.withColumn("r", F.row_number().over(wt))
                    .filter(F.col("r") <= CLUSTER_TOPICS_WITH_ARTICLES).select("period", "topic_id", "label"), CLUSTER_TOPICS)
    arts = tr.top_articles(tr.article_counts(edits, as_of, topics=lead.select("period", "topic_id"), periods=[period]),
                           CLUSTER_ARTICLES_PER_TOPIC)
    # lead holds at most 50 rows (top topics), a proven bound for broadcast.
    a = arts.join(F.broadcast(lead.select("topic_id", "label")), "topic_id")
    best = (a.groupBy("label", "article_id")
             .agg(F.max("edits").alias("edit_count"), F.min("title").alias("title")))
    wa = Window.partitionBy("label").orderBy(F.desc("edit_count"), F.asc("article_id"))
    return (best.withColumn("article_rank", F.row_number().over(wa))
                .filter(F.col("article_rank") <= CLUSTER_ARTICLES)
                .select(cluster_id("label").alias("cluster_id"), "article_rank", "article_id", "title",
                        "edit_count", article_url("title").alias("wiki_url")))


def topic_details(edits: DataFrame, as_of: str, period: str = "Last24Hours",
                  topic_ids: list[int] | None = None, baselines: DataFrame | None = None,
                  lookback_days: int = tr.BASELINE_LOOKBACK_DAYS,
                  label_state: DataFrame | None = None) -> DataFrame:
    """A-09 for many topics at once (one row per topic).

    Counts for the three periods come from one conditional aggregate, the
    score is for the asked period (0 when the topic has no edits in it),
    baseline is the latest (0 when none)."""
    period = norm_period(period)
    e = edits
    if topic_ids is not None:
        ids = [int(i) for i in topic_ids]
        e = e.filter(F.arrays_overlap(F.col("topics.topic_id"), F.array(*[F.lit(i) for i in ids])))
    if baselines is None:
        # Counts and baseline from one daily rollup (one scan).
        wide = tr.topic_rollup(e, as_of, lookback_days)
    else:
        counts = tr.trend_counts(e, as_of)
        base = tr.latest_baseline(baselines).select("topic_id", "baseline_daily")
        counts_wide = (counts.groupBy("topic_id")
                             .agg(*[F.max(F.when(F.col("period") == p, F.col("edit_count"))).alias(f"c{i}")
                                    for i, p in enumerate(PERIODS)]))
        wide = counts_wide.join(base, "topic_id", "full_outer")
    pivot = wide.select("topic_id", "baseline_daily",
                        *[F.when(F.col(f"c{i}") > 0, F.col(f"c{i}")).alias(f"c_{p}") for i, p in enumerate(PERIODS)])
    if topic_ids is not None:
        pivot = pivot.filter(F.col("topic_id").isin(ids))
    sel = tr.anomaly(pivot.withColumn("baseline_daily", F.coalesce("baseline_daily", F.lit(0.0).cast("float")))
                          .withColumn("period", F.lit(period))
                          .withColumn("edit_count", F.col(f"c_{period}")))
    d = sel.join(_info(e, label_state), "topic_id", "left")
    name = display_name(F.coalesce("name", F.lit("")), "topic_id")
    return d.select(
        "topic_id", F.lit(period).alias("period"), name.alias("name"), display_path(F.col("path"), name).alias("path"),
        F.coalesce(F.col("c_LastHour"), F.lit(0)).alias("edit_count_last_hour"),
        F.coalesce(F.col("c_Last24Hours"), F.lit(0)).alias("edit_count_last_24_hours"),
        F.coalesce(F.col("c_Last7Days"), F.lit(0)).alias("edit_count_last_7_days"),
        F.round(F.col("baseline_daily").cast("double"), 4).alias("baseline_daily"),
        F.round(F.when(F.col("edit_count").isNull(), F.lit(0.0)).otherwise(F.col("anomaly_score")).cast("double"), 4)
         .alias("anomaly_score"))


def topic_detail(edits: DataFrame, as_of: str, topic_id: int, period: str = "Last24Hours",
                 baselines: DataFrame | None = None, lookback_days: int = tr.BASELINE_LOOKBACK_DAYS,
                 articles_n: int = DETAIL_ARTICLES, label_state: DataFrame | None = None) -> DataFrame:
    """A-09: one topic's detail with its top 50 articles, flattened.

    The id must be positive.  A topic with no edits at all still gets a row
    (zeros, name topic-{id}), which is the F-19 fallback."""
    if int(topic_id) <= 0:
        raise ValueError("topic_id must be positive")
    period = norm_period(period)
    spark = edits.sparkSession
    # The request as a one-row local table: a key taken from data keeps the
    # joins below equi-joins (a literal key would be folded into a
    # nested-loop join).
    ask = spark.createDataFrame([(int(topic_id),)], "topic_id int")
    d = topic_details(edits, as_of, period, [topic_id], baselines, lookback_days, label_state)
    name = F.concat(F.lit(TOPIC_NAME_PREFIX), F.col("topic_id").cast("string"))
    d = ask.join(d, "topic_id", "left").select(
        "topic_id", F.lit(period).alias("period"),
        F.coalesce("name", name).alias("name"), F.coalesce("path", name).alias("path"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("edit_count_last_hour", "edit_count_last_24_hours",
                                                      "edit_count_last_7_days")],
        F.coalesce("baseline_daily", F.lit(0.0)).alias("baseline_daily"),
        F.coalesce("anomaly_score", F.lit(0.0)).alias("anomaly_score"))
    e = edits.filter(tr.has_topic(int(topic_id)))
    arts = tr.top_articles(tr.article_counts(e, as_of, periods=[period])
                           .filter(F.col("topic_id") == int(topic_id)), articles_n)
    return d.join(_article_rows(arts).drop("period"), "topic_id", "left")


def topic_stats(edits: DataFrame, exact: bool = True) -> DataFrame:
    """A-12: per topic edit count, distinct editors, last edit time.
    Exact distinct plans as a two-level aggregate (distinct (topic, user)
    pairs are shuffled once); ``exact=False`` uses a HyperLogLog++ sketch
    (``approx_count_distinct``), which merges map side like a count."""
    t = tr.explode_topics(edits.select("user", "ts", "topics"), "user", "ts")
    editors = F.countDistinct("user") if exact else F.approx_count_distinct("user")
    return (t.groupBy("topic_id")
             .agg(F.count("*").alias("edit_count"),
                  editors.alias("unique_editors"),
                  F.max("ts").alias("last_edit_at")))
