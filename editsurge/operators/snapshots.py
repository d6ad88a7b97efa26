"""Snapshot cache, commands and notifications (the read-side cache of the
reference expressed as tables: snapshot rows keyed by period with a
cached_at, invalidated by command rows, read with a TTL filter)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editsurge.functions.scalar import PERIODS, direction, topic_snapshot_key, trends_snapshot_key
from editsurge.operators.joins import first_per_group
from editsurge.sources.adapters import ts_lit

# Snapshot TTLs (seconds) and the notification settings.
SNAPSHOT_TTL_SECONDS = 30
FALLBACK_TTL_SECONDS = 5
NOTIFY_LIMIT = 10
NOTIFY_FIRST = 5
NOTIFY_MESSAGE = "Trend updated"


def snapshot_rows(updates: DataFrame, cached_at=None) -> DataFrame:
    """T-06 / S-08 rows: one per period with its cache key and time."""
    c = F.col("calculated_at") if cached_at is None else cached_at
    return updates.select(trends_snapshot_key("period").alias("cache_key"), "period", "topics",
                          "calculated_at", c.alias("cached_at"))


def live_snapshots(snap: DataFrame, as_of: str, ttl_seconds: int = SNAPSHOT_TTL_SECONDS) -> DataFrame:
    """T-06 read: snapshots not older than the TTL at as_of."""
    return snap.filter(F.col("cached_at") >= ts_lit(as_of) - F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS"))


def reshape_trend_update(snap: DataFrame) -> DataFrame:
    """X-24: TrendUpdate topics -> response rows (flattened per article):
    path = topic name, article wiki 'unknown', empty URL, page id 0,
    last_edit_at = calculated_at."""
    t = snap.select("period", "calculated_at", F.posexplode("topics").alias("topic_pos", "t"))
    t = t.select("period", "calculated_at", "topic_pos", "t.*")
    base = t.select("period", "topic_pos", "topic_id", F.col("topic_name").alias("name"),
                    F.col("topic_name").alias("path"), "edit_count", "anomaly_score", "change_percent",
                    direction("change_percent").alias("direction"), "calculated_at",
                    F.explode_outer("top_articles").alias("a"))
    return base.select("period", "topic_pos", "topic_id", "name", "path", "edit_count", "anomaly_score",
                       "change_percent", "direction",
                       F.col("a.article_id").alias("article_id"), F.col("a.title").alias("title"),
                       F.col("a.edit_count").alias("article_edits"),
                       F.when(F.col("a").isNotNull(), F.lit(0)).alias("wiki_page_id"),
                       F.when(F.col("a").isNotNull(), F.lit("unknown")).alias("wiki"),
                       F.when(F.col("a").isNotNull(), F.lit("")).alias("wiki_url"),
                       F.when(F.col("a").isNotNull(), F.col("calculated_at")).alias("last_edit_at"))


def snapshot_topic_detail(snap: DataFrame, topic_id: int, period: str) -> DataFrame:
    """J-19: topic detail rebuilt from the three period snapshots, only when
    the asked period's snapshot holds the topic.  Counts of the other
    periods come from their snapshots (absent -> 0); baseline is 0; score
    and articles come from the asked period.  One conditional aggregate
    over at most three snapshot rows."""
    t = (snap.select("period", F.explode("topics").alias("t"))
             .filter(F.col("t.topic_id") == int(topic_id)))
    agg = t.agg(*[F.max(F.when(F.col("period") == p, F.col("t.edit_count"))).alias(f"c_{p}") for p in PERIODS],
                F.max(F.when(F.col("period") == period, F.struct(F.col("t.topic_name"), F.col("t.anomaly_score"),
                                                                 F.col("t.top_articles")))).alias("asked"))
    d = agg.filter(F.col("asked").isNotNull())
    return d.select(
        F.lit(int(topic_id)).alias("topic_id"), F.lit(period).alias("period"),
        F.col("asked.topic_name").alias("name"), F.col("asked.topic_name").alias("path"),
        *[F.coalesce(F.col(f"c_{p}"), F.lit(0)).alias(n) for p, n in
          zip(PERIODS, ["edit_count_last_hour", "edit_count_last_24_hours", "edit_count_last_7_days"])],
        F.lit(0.0).alias("baseline_daily"), F.col("asked.anomaly_score").alias("anomaly_score"),
        F.explode_outer("asked.top_articles").alias("a")
    ).select("*", F.col("a.article_id").alias("article_id"), F.col("a.title").alias("title"),
             F.col("a.edit_count").alias("article_edits")).drop("a")


def invalidation_times(commands: DataFrame) -> DataFrame:
    """J-20 log rows (cache_key, requested_at): the latest time each snapshot key was
    invalidated; a recalculate command names all three trend keys.  The maximum
    merges, so the logs of separate batches can be read together."""
    keys = F.array(*[trends_snapshot_key(F.lit(p)) for p in PERIODS])
    c = commands.select(
        F.explode(F.when(F.col("kind") == "recalculate", keys)
                   .otherwise(F.array(F.col("cache_key")))).alias("cache_key"), "requested_at")
    return c.groupBy("cache_key").agg(F.max("requested_at").alias("requested_at"))


def apply_invalidations(snap: DataFrame, commands: DataFrame) -> DataFrame:
    """J-20: drop snapshots named by an invalidate command issued at or
    after the snapshot was cached; a recalculate command drops all three
    trend keys."""
    return hide_invalidated(snap, invalidation_times(commands))


def hide_invalidated(snap: DataFrame, log: DataFrame) -> DataFrame:
    """Snapshots that no row of an invalidation log (cache_key, requested_at) hides;
    one cached after the last invalidation of its key is visible again."""
    latest = log.groupBy("cache_key").agg(F.max("requested_at").alias("requested_at"))
    gone = snap.join(latest, "cache_key").filter(F.col("requested_at") >= F.col("cached_at")).select("cache_key")
    return snap.join(gone, "cache_key", "left_anti")


def notifications(trend_list: DataFrame, as_of: str, first: int = NOTIFY_FIRST) -> DataFrame:
    """W-08: the first ``first`` topics of the 24 h list (list order =
    topic_rank) as TrendUpdate notifications."""
    t = trend_list.select("topic_rank", "topic_id", "topic_name", "anomaly_score").distinct()
    return (t.filter(F.col("topic_rank") <= first)
             .select("topic_rank", "topic_id", F.col("topic_name"), F.lit("TrendUpdate").alias("type"),
                     "anomaly_score", F.lit(NOTIFY_MESSAGE).alias("message"), ts_lit(as_of).alias("timestamp")))


def notification_fanout(notes: DataFrame) -> DataFrame:
    """J-21: each notification goes to everyone and to group topic:{id}."""
    return notes.select("*", F.explode(F.array(F.concat(F.lit("topic:"), F.col("topic_id").cast("string")),
                                               F.lit("all"))).alias("audience"))


def page_of(df: DataFrame, order_cols, page: int = 1, page_size: int = 50, partition_cols=None) -> DataFrame:
    """W-07: one page of an ordered list plus total_count, total_pages =
    ceil(total / size), has_next and has_previous.  Page and size are
    clamped to >= 1.  ``partition_cols`` pages each group separately.

    Totals come from an aggregate (partial per task).  Without groups the page
    is the top-K of a sort with an offset, merged from each task's own top-K;
    with groups see ``first_per_group``.  No task holds a whole list."""
    page, size = max(1, int(page)), max(1, int(page_size))
    parts = list(partition_cols or [])
    lo, hi = (page - 1) * size, page * size
    if parts:
        ranked = first_per_group(df, parts, order_cols, hi, "_rn").filter(F.col("_rn") > lo)
        totals = df.groupBy(*parts).agg(F.count("*").alias("total_count"))
        x = ranked.join(totals, parts)
    else:
        # at most ``size`` rows are left to be numbered
        w = Window.orderBy(*order_cols)
        rows = df.orderBy(*order_cols).offset(lo).limit(size)
        ranked = rows.withColumn("_rn", F.row_number().over(w) + lo)
        x = ranked.withColumn("total_count", F.lit(df.count()))  # one scalar
    total_pages = F.ceil(F.col("total_count") / F.lit(float(size))).cast("int")
    return x.select(*[c for c in df.columns], F.col("_rn").alias("row_number"), "total_count",
                    F.lit(page).alias("page"), F.lit(size).alias("page_size"),
                    total_pages.alias("total_pages"), (F.lit(page) < total_pages).alias("has_next"),
                    F.lit(page > 1).alias("has_previous"))


def command_records(commands: DataFrame) -> DataFrame:
    """S-12 + S-11: command rows with their record key: recalculate -> topic
    id or 'all'; invalidate -> the cache key."""
    key = F.when(F.col("kind") == "recalculate", F.coalesce(F.col("topic_id").cast("string"), F.lit("all"))) \
           .otherwise(F.col("cache_key"))
    return commands.select(key.alias("key"), "kind", "topic_id", "cache_key", "requested_at")


def topic_detail_keys(topic_ids: DataFrame) -> DataFrame:
    """X-14 for topic detail snapshots of every (topic, period)."""
    p = topic_ids.select("topic_id", F.explode(F.array(*[F.lit(x) for x in PERIODS])).alias("period"))
    return p.select("topic_id", "period", topic_snapshot_key("topic_id", "period").alias("cache_key"))
