"""Trend operators over the edit_events table.

All three periods are computed in one scan: the widest window bounds the
Parquet scan, and per-period counts are conditional aggregates, so the data
is read and shuffled once (partial + final hash aggregation).  Per-topic
top-N uses ``row_number() <= N``, which Spark plans as a WindowGroupLimit
before the shuffle, so a hot topic never gathers more than N rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editsurge.functions.scalar import (PERIOD_HOURS, PERIODS, SCORE_EPSILON, blank,
                                        display_name, effective_time, is_placeholder_name,
                                        is_placeholder_path, to_day)
from editsurge.operators.joins import first_per_group, limited
from editsurge.sources.adapters import ts_lit

# Report defaults of the trend cycle.
MIN_SCORE_TO_REPORT = 1.1
MIN_CHANGE_TO_REPORT = 0.2
BASELINE_LOOKBACK_DAYS = 30
TOP_TOPICS = 50
TOP_ARTICLES_REPORT = 20


def window_start(as_of: str, period: str) -> Column:
    """F-09: as_of minus the period's trailing window (lower bound only)."""
    return ts_lit(as_of) - F.expr(f"INTERVAL {PERIOD_HOURS.get(period, 24)} HOURS")


def effective_after(start: Column) -> Column:
    """greatest(ts, classified_at) >= start, written as an OR of two column
    ranges so both halves reach the Parquet reader as pushed filters (the
    two forms agree on nulls as well)."""
    return (F.col("ts") >= start) | (F.col("classified_at") >= start)


def prune_from(edits: DataFrame, start: Column) -> DataFrame:
    """Partition pruning on a stored edit table partitioned by ``eff_date``
    (the day of the effective time).  ts <= effective time, so the bound is
    valid for ts windows and effective-time windows alike.  A derived edit
    view without the column is returned unchanged."""
    if "eff_date" in edits.columns:
        return edits.filter(F.col("eff_date") >= F.to_date(start))
    return edits


def explode_topics(edits: DataFrame, *keep: str) -> DataFrame:
    """J-01: one row per (edit, topic) like ARRAY JOIN; empty lists vanish,
    a topic listed twice gives two rows."""
    return edits.select(*keep, F.explode("topics").alias("t")).select(*keep, "t.*")


def has_topic(topic_id: int) -> Column:
    """F-10: the edit's topic list holds the id."""
    return F.array_contains(F.col("topics.topic_id"), F.lit(topic_id))


def known_topic_ids(df: DataFrame, col: str = "topic_id") -> DataFrame:
    """F-11: positive distinct ids (the IN list)."""
    return df.select(F.col(col).cast("int").alias("topic_id")).filter(F.col("topic_id") > 0).distinct()


def _unpivot(df: DataFrame, id_cols: list[str], prefix: str, value: str) -> DataFrame:
    """Per-period count columns -> (period, value) rows, zero counts dropped."""
    pairs = ", ".join(f"'{p}', CAST({prefix}{i} AS BIGINT)" for i, p in enumerate(PERIODS))
    return (df.select(*id_cols, F.expr(f"stack({len(PERIODS)}, {pairs}) AS (period, {value})"))
              .filter(F.col(value) > 0))


def trend_counts(edits: DataFrame, as_of: str, periods: list[str] | None = None) -> DataFrame:
    """A-01 + U-04: exploded edits per (period, topic) whose effective time
    is in the trailing window; unique_editors is the constant 0 like the
    reference.  Columns: period, topic_id, edit_count, unique_editors."""
    periods = periods or PERIODS
    widest = max(periods, key=lambda p: PERIOD_HOURS[p])
    eff = effective_time()
    start = window_start(as_of, widest)
    e = (prune_from(edits, start).filter(effective_after(start))
              .select(eff.alias("eff"), F.explode("topics.topic_id").alias("topic_id")))
    aggs = [F.count_if(F.col("eff") >= window_start(as_of, p)).cast("int").alias(f"c{PERIODS.index(p)}")
            for p in PERIODS if p in periods]
    agg = e.groupBy("topic_id").agg(*aggs)
    for i, p in enumerate(PERIODS):
        if p not in periods:
            agg = agg.withColumn(f"c{i}", F.lit(0))
    out = _unpivot(agg, ["topic_id"], "c", "edit_count")
    return out.select("period", F.col("topic_id").cast("int").alias("topic_id"),
                      F.col("edit_count").cast("int").alias("edit_count"),
                      F.lit(0).alias("unique_editors"))


def daily_topic_counts(edits: DataFrame, as_of: str, days: int = BASELINE_LOOKBACK_DAYS) -> DataFrame:
    """A-02: count per (topic, day of ts) within the lookback; the window
    test uses the effective time, the day uses ts."""
    start = ts_lit(as_of) - F.expr(f"INTERVAL {max(1, days)} DAYS")
    return (prune_from(edits, start).filter(effective_after(start))
                 .select(to_day("ts").alias("day"), F.explode("topics.topic_id").alias("topic_id"))
                 .groupBy("topic_id", "day").agg(F.count("*").alias("daily_count")))


def recalculate_baselines(edits: DataFrame, as_of: str, days: int = BASELINE_LOOKBACK_DAYS) -> DataFrame:
    """A-03: average daily count per topic over days that have edits, as float."""
    daily = daily_topic_counts(edits, as_of, days)
    return (daily.groupBy("topic_id")
                 .agg(F.avg("daily_count").cast("float").alias("baseline_daily"))
                 .select(F.col("topic_id").cast("int").alias("topic_id"), "baseline_daily",
                         ts_lit(as_of).alias("calculated_at")))


def latest_baseline(baselines: DataFrame) -> DataFrame:
    """W-02: latest row per topic by calculated_at (of rows with one time the larger baseline)."""
    return (baselines.groupBy("topic_id")
                     .agg(F.max(F.struct("calculated_at", "baseline_daily")).alias("b"))
                     .select("topic_id", "b.baseline_daily", "b.calculated_at"))


def with_baseline(trends: DataFrame, baselines: DataFrame) -> DataFrame:
    """J-17: attach the latest baseline; a missing one is 0.0."""
    b = latest_baseline(baselines).select("topic_id", "baseline_daily")
    return (trends.join(b, "topic_id", "left")
                  .withColumn("baseline_daily", F.coalesce(F.col("baseline_daily"), F.lit(0.0).cast("float"))))


def anomaly(df: DataFrame, period_col: str = "period", count_col: str = "edit_count",
            baseline_col: str = "baseline_daily") -> DataFrame:
    """A-04: Poisson z-score and fractional change against the baseline.

    expected = baseline/24, baseline or 7*baseline by period; maths in double
    on the float baseline, results cast to float.  No UDF.
    """
    b = F.col(baseline_col).cast("float").cast("double")
    p = F.col(period_col)
    expected = (F.when(p == "LastHour", b / F.lit(24.0))
                 .when(p == "Last7Days", b * F.lit(7.0))
                 .otherwise(b))
    actual = F.col(count_col).cast("double")
    diff = actual - expected
    cold = expected < F.lit(SCORE_EPSILON)
    silent = actual < F.lit(SCORE_EPSILON)
    change = (F.when(cold & silent, F.lit(0.0)).when(cold, F.lit(1.0))
               .otherwise(diff / expected)).cast("float")
    score = (F.when(cold & silent, F.lit(0.0)).when(cold, actual)
              .otherwise(diff / F.sqrt(expected))).cast("float")
    return df.withColumn("anomaly_score", score).withColumn("change_percent", change)


def reportable(df: DataFrame, min_score: float = MIN_SCORE_TO_REPORT,
               min_change: float = MIN_CHANGE_TO_REPORT) -> DataFrame:
    """F-07: drop a topic only when both score and change are below the
    thresholds (compared as float, like the reference's options)."""
    low = ((F.col("anomaly_score").cast("float") < F.lit(min_score).cast("float"))
           & (F.col("change_percent").cast("float") < F.lit(min_change).cast("float")))
    return df.filter(~low)


def top_topics(counts: DataFrame, n: int = TOP_TOPICS) -> DataFrame:
    """W-03: per period, the first max(1, n) topics by count (id breaks ties).

    The result is bounded by 3 * n rows; see ``first_per_group`` for the plan.
    """
    return first_per_group(counts, ["period"], [F.desc("edit_count"), F.asc("topic_id")], n, "topic_rank")


def article_counts(edits: DataFrame, as_of: str, topics: DataFrame | None = None,
                   periods: list[str] | None = None) -> DataFrame:
    """A-05 (batch form): edits per (period, topic, article) with ts (only ts,
    not the effective time) in the window.  An edit counts once per topic
    even when the topic is listed twice.  ``topics`` (period, topic_id), if
    given, restricts the work to those pairs before the counts are made; the
    report passes the topics it reports.  Broadcast or not is left to the
    measured size of that side."""
    periods = periods or PERIODS
    widest = max(periods, key=lambda p: PERIOD_HOURS[p])
    start = window_start(as_of, widest)
    e = (prune_from(edits, start).filter(F.col("ts") >= start)
              .select("article_id", "title", "ts",
                      F.explode(F.array_distinct(F.col("topics.topic_id"))).alias("topic_id")))
    if topics is not None:
        e = e.join(topics.select("topic_id"), "topic_id", "left_semi")
    aggs = [F.count_if(F.col("ts") >= window_start(as_of, p)).alias(f"c{PERIODS.index(p)}")
            for p in PERIODS if p in periods]
    # Hash pre-aggregate with the title in the key (fixed-width buffers, map
    # side combine), then fold titles per article on the small result.
    pre = e.groupBy("topic_id", "article_id", "title").agg(*aggs)
    agg = pre.groupBy("topic_id", "article_id").agg(
        *[F.sum(f"c{PERIODS.index(p)}").alias(f"c{PERIODS.index(p)}") for p in PERIODS if p in periods],
        F.min("title").alias("title"))
    for i, p in enumerate(PERIODS):
        if p not in periods:
            agg = agg.withColumn(f"c{i}", F.lit(0))
    out = _unpivot(agg, ["topic_id", "article_id", "title"], "c", "edits")
    if topics is not None:
        out = out.join(topics.select("period", "topic_id"), ["period", "topic_id"], "left_semi")
    return out.select("period", F.col("topic_id").cast("int").alias("topic_id"),
                      F.col("article_id").cast("long").alias("article_id"), "title",
                      F.col("edits").cast("int").alias("edits"))


def top_articles(counts: DataFrame, n: int = TOP_ARTICLES_REPORT) -> DataFrame:
    """W-01: per (period, topic) top max(1, n) articles by edits, id breaks ties."""
    return first_per_group(counts, ["period", "topic_id"], [F.desc("edits"), F.asc("article_id")], n, "article_rank")


def topic_label_state(edits: DataFrame, topic_ids: DataFrame | None = None) -> DataFrame:
    """A-06 partial state: per topic the newest usable (eff, name) and
    (eff, path) structs (null when none).  ``max`` over these structs is
    associative, so states of separate batches merge exactly
    (merge_label_states) and the report never needs to rescan history.

    Two stages: a hash aggregate by (topic, name, path) with partial
    aggregation keeps only the newest time of each distinct label pair, so
    the struct-max stage sees a handful of rows per topic however many
    edits a hot topic has.  ``topic_ids`` must be small; it is broadcast.
    """
    t = explode_topics(edits.select(effective_time().alias("eff"), "topics"), "eff")
    if topic_ids is not None:
        t = t.join(known_topic_ids(topic_ids), "topic_id", "left_semi")
    name_ok = (F.col("name") != "") & ~is_placeholder_name("name")
    path_ok = (F.col("path") != "") & ~is_placeholder_path("path")
    labels = (t.groupBy("topic_id", "name", "path")
               .agg(F.max(F.when(name_ok, F.col("eff"))).alias("name_eff"),
                    F.max(F.when(path_ok, F.col("eff"))).alias("path_eff")))
    return (labels.groupBy(F.col("topic_id").cast("int").alias("topic_id"))
                  .agg(F.max(F.when(F.col("name_eff").isNotNull(),
                                    F.struct(F.col("name_eff").alias("eff"), F.col("name").alias("label")))).alias("n"),
                       F.max(F.when(F.col("path_eff").isNotNull(),
                                    F.struct(F.col("path_eff").alias("eff"), F.col("path").alias("label")))).alias("p")))


def merge_label_states(states: DataFrame) -> DataFrame:
    """Fold label states (e.g. one per ingested batch) into one per topic."""
    return states.groupBy("topic_id").agg(F.max("n").alias("n"), F.max("p").alias("p"))


def topic_info_from_state(state: DataFrame) -> DataFrame:
    """A-06 result from a (merged) label state: '' when nothing usable."""
    return state.select("topic_id", F.coalesce(F.col("n.label"), F.lit("")).alias("name"),
                        F.coalesce(F.col("p.label"), F.lit("")).alias("path"))


def topic_info(edits: DataFrame, topic_ids: DataFrame | None = None) -> DataFrame:
    """A-06: latest usable name and path per topic by effective time.

    Placeholder names ('topic 5', 'topic5') and paths ('topic-5') and empty
    text are skipped; when nothing usable exists the value is '' (the
    reference's argMaxIf default), and callers fall back with F-15.  Ties on
    time go to the larger text so the result is repeatable.
    """
    return topic_info_from_state(topic_label_state(edits, topic_ids))


def with_topic_info(trends: DataFrame, info: DataFrame) -> DataFrame:
    """J-18: attach name/path (missing -> '')."""
    return (trends.join(info, "topic_id", "left")
                  .withColumn("name", F.coalesce("name", F.lit("")))
                  .withColumn("path", F.coalesce("path", F.lit(""))))


def topic_rollup(edits: DataFrame, as_of: str, days: int = BASELINE_LOOKBACK_DAYS) -> DataFrame:
    """Per topic, from one scan: the baseline (average over days with edits
    in the lookback) and the three window counts c0, c1, c2 (LastHour,
    Last24Hours, Last7Days).

    Stage 1 is a daily rollup by (topic, day) with partial aggregation, so
    the shuffle carries one row per topic and day per task; stage 2 folds
    the small rollup per topic."""
    lookback = ts_lit(as_of) - F.expr(f"INTERVAL {max(1, days)} DAYS")
    widest = ts_lit(as_of) - F.expr(f"INTERVAL {max(PERIOD_HOURS.values())} HOURS")
    lowest = F.least(lookback, widest)
    e = (prune_from(edits, lowest).filter(effective_after(lowest))
              .select(effective_time().alias("eff"), to_day("ts").alias("day"),
                      F.explode("topics.topic_id").alias("topic_id")))
    daily = (e.groupBy("topic_id", "day")
              .agg(F.count_if(F.col("eff") >= lookback).alias("daily_count"),
                   *[F.count_if(F.col("eff") >= window_start(as_of, p)).alias(f"c{i}")
                     for i, p in enumerate(PERIODS)]))
    return (daily.groupBy(F.col("topic_id").cast("int").alias("topic_id"))
                 .agg(F.coalesce(F.avg(F.when(F.col("daily_count") > 0, F.col("daily_count"))).cast("float"),
                                 F.lit(0.0).cast("float")).alias("baseline_daily"),
                      *[F.sum(f"c{i}").cast("int").alias(f"c{i}") for i in range(len(PERIODS))]))


def trend_rollup(edits: DataFrame, as_of: str, days: int = BASELINE_LOOKBACK_DAYS) -> DataFrame:
    """A-01 + A-03 in one scan: per (period, topic) the window count and the
    topic's baseline.  Columns: period, topic_id, edit_count,
    baseline_daily (topics with no edits in a period are absent from it)."""
    out = _unpivot(topic_rollup(edits, as_of, days), ["topic_id", "baseline_daily"], "c", "edit_count")
    return out.select("period", "topic_id", F.col("edit_count").cast("int").alias("edit_count"), "baseline_daily")


def scored_topics(edits: DataFrame, as_of: str, baselines: DataFrame | None = None,
                  top_n: int = TOP_TOPICS, min_score: float = MIN_SCORE_TO_REPORT,
                  min_change: float = MIN_CHANGE_TO_REPORT,
                  lookback_days: int = BASELINE_LOOKBACK_DAYS,
                  label_state: DataFrame | None = None) -> DataFrame:
    """A-01 -> W-03 -> J-18 -> J-17 -> A-04 -> F-07 for all periods at once.

    With no stored ``baselines`` the baseline comes from the same scan as
    the counts (trend_rollup).  Topic names come from one more scan of the
    edit history, or from a maintained ``label_state`` (no history scan).
    The top topics are a list of at most 3 * top_n rows; its plan ends there, and names
    are looked for those topics only.
    """
    if baselines is None:
        counts = trend_rollup(edits, as_of, lookback_days)
    else:
        counts = with_baseline(trend_counts(edits, as_of), baselines)
    top = limited(top_topics(counts, top_n), len(PERIODS) * max(1, top_n))
    info = topic_info(edits, top) if label_state is None else topic_info_from_state(merge_label_states(label_state))
    scored = anomaly(top.join(info, "topic_id", "left"))
    scored = scored.withColumn("topic_name", display_name(F.coalesce("name", F.lit("")), "topic_id"))
    return reportable(scored, min_score, min_change)


def trends_report(edits: DataFrame, as_of: str, baselines: DataFrame | None = None,
                  top_n: int = TOP_TOPICS, articles_n: int = TOP_ARTICLES_REPORT,
                  lookback_days: int = BASELINE_LOOKBACK_DAYS,
                  label_state: DataFrame | None = None) -> DataFrame:
    """A-10 flattened: one row per (period, reported topic, top article).

    A reported topic with no article in the window keeps one row with null
    article fields (quirk Q1).  score_rank orders topics by score desc.
    Every input scan runs once: counts+baselines, topic names, articles; the lists of topics
    between them end the plans before (``limited``).  The article side is top-N per topic (bounded by topics x 3 x N rows).
    """
    scored = scored_topics(edits, as_of, baselines, top_n, lookback_days=lookback_days, label_state=label_state)
    scored = limited(scored, len(PERIODS) * max(1, top_n))
    arts = top_articles(article_counts(edits, as_of, topics=scored.select("period", "topic_id")), articles_n)
    w = Window.partitionBy("period").orderBy(F.desc("anomaly_score"), F.asc("topic_id"))
    topics = scored.withColumn("score_rank", F.row_number().over(w))
    out = topics.join(arts, ["period", "topic_id"], "left")
    return out.select(
        "period", "topic_id", "topic_name", "edit_count",
        F.round(F.col("baseline_daily").cast("double"), 4).alias("baseline_daily"),
        F.round(F.col("anomaly_score").cast("double"), 4).alias("anomaly_score"),
        F.round(F.col("change_percent").cast("double"), 4).alias("change_percent"),
        "score_rank", "article_rank", "article_id", F.col("title").alias("article_title"),
        F.col("edits").alias("article_edits"))


def trend_updates(edits: DataFrame, as_of: str, baselines: DataFrame | None = None,
                  top_n: int = TOP_TOPICS, articles_n: int = TOP_ARTICLES_REPORT,
                  label_state: DataFrame | None = None) -> DataFrame:
    """A-10 nested: one TrendUpdate record per period that has topics.

    Each record holds at most top_n topics x articles_n articles, so the
    collect_list per period is bounded by the report limits.
    """
    flat = trends_report(edits, as_of, baselines, top_n, articles_n, label_state=label_state)
    art = F.when(F.col("article_id").isNotNull(), F.struct(
        F.col("article_rank"), F.col("article_id"), F.col("article_title").alias("title"),
        F.col("article_edits").alias("edit_count"), F.lit(0).alias("unique_editors")))
    per_topic = (flat.groupBy("period", "topic_id", "topic_name", "edit_count", "anomaly_score",
                              "change_percent", "score_rank")
                     .agg(F.sort_array(F.collect_list(art)).alias("arts")))
    topic = F.struct("score_rank", "topic_id", "topic_name", "edit_count", "anomaly_score", "change_percent",
                     F.transform("arts", lambda a: a.dropFields("article_rank")).alias("top_articles"))
    return (per_topic.groupBy("period")
                     .agg(F.sort_array(F.collect_list(topic)).alias("topics"))
                     .select(F.sha2(F.concat_ws("|", F.col("period"), F.lit(as_of)), 256).alias("event_id"),
                             "period",
                             F.transform("topics", lambda t: t.dropFields("score_rank")).alias("topics"),
                             ts_lit(as_of).alias("calculated_at")))
