"""Commands, keys, invalidation, notifications and paging."""

import datetime as dt

from pyspark.sql import functions as F

from editsurge.operators import metrics as mt
from editsurge.operators import snapshots as sn

NOW = dt.datetime(2024, 1, 30, 12, 0, 0)


def test_command_keys(spark):
    c = spark.createDataFrame([("recalculate", None, None, NOW), ("recalculate", 42, None, NOW),
                               ("invalidate", None, "cache-key", NOW)],
                              "kind string, topic_id int, cache_key string, requested_at timestamp_ntz")
    assert [r.key for r in sn.command_records(c).collect()] == ["all", "42", "cache-key"]


def test_invalidation(spark):
    snap = spark.createDataFrame([("v3:trends:lasthour", NOW), ("v3:trends:last24hours", NOW),
                                  ("v3:trends:last7days", NOW)], "cache_key string, cached_at timestamp_ntz")
    inv = spark.createDataFrame([("invalidate", None, "v3:trends:lasthour", NOW),
                                 ("invalidate", None, "v3:trends:last7days", NOW - dt.timedelta(seconds=1))],
                                "kind string, topic_id int, cache_key string, requested_at timestamp_ntz")
    assert {r.cache_key for r in sn.apply_invalidations(snap, inv).collect()} == {"v3:trends:last24hours",
                                                                                "v3:trends:last7days"}
    rec = spark.createDataFrame([("recalculate", None, None, NOW)], inv.schema)
    assert sn.apply_invalidations(snap, rec).count() == 0


def test_fanout(spark):
    n = spark.createDataFrame([(1, 7, "x", 2.0)], "topic_rank int, topic_id int, topic_name string, anomaly_score float")
    got = sorted(r.audience for r in sn.notification_fanout(n).collect())
    assert got == ["all", "topic:7"]


def test_page_of(spark):
    df = spark.range(1, 106).select(F.col("id").alias("v"))
    p = sn.page_of(df, [F.col("v")], page=3, page_size=50).collect()
    assert [r.v for r in p] == list(range(101, 106))
    assert (p[0].total_count, p[0].total_pages, p[0].has_next, p[0].has_previous) == (105, 3, False, True)
    clamp = sn.page_of(df, [F.col("v")], page=0, page_size=0).collect()
    assert len(clamp) == 1 and clamp[0].page == 1


def test_interval_stats_and_slow(spark):
    log = spark.createDataFrame([("t", "g", 1, NOW, 10), ("t", "g", 2, NOW + dt.timedelta(seconds=3), 2500),
                                 ("t", "g", 3, NOW + dt.timedelta(seconds=11), 5)],
                                "topic string, group_id string, offset long, processed_at timestamp_ntz, elapsed_ms long")
    s = mt.consumer_interval_stats(log).orderBy("interval_start").collect()
    assert [(r.processed, r.max_ms, r.slow_count) for r in s] == [(2, 2500, 1), (1, 5, 0)]
    assert s[0].events_per_sec == 0.2
    assert mt.slow_records(log).count() == 1 and mt.slow_records(log, 0).count() == 0


def test_pages_beyond_the_group_limit(spark):
    df = spark.range(4000).selectExpr("id % 2 AS g", "id AS v")
    p = sn.page_of(df, [F.col("v")], page=30, page_size=50)
    assert [r.v for r in p.orderBy("v").collect()] == list(range(1450, 1500))
    assert "TakeOrderedAndProject" in p._jdf.queryExecution().executedPlan().toString()
    g = sn.page_of(df, [F.col("v")], page=30, page_size=50, partition_cols=["g"])
    rows = [(r.g, r.v, r.row_number) for r in g.collect()]
    assert sorted(rows) == sorted((k, 2 * i + k, i + 1) for k in (0, 1) for i in range(1450, 1500))
    assert "_piece" in g._jdf.queryExecution().executedPlan().toString()
