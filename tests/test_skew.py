"""Hot keys: one topic and one article hold 40% of all edits.  Results must
equal a brute-force count (pandas on the driver, test fixture only)."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from editsurge import schemas as S
from editsurge.operators import serving as sv
from editsurge.operators import trends as tr

AS_OF = "2024-01-30 12:00:00"
T0 = dt.datetime(2024, 1, 30, 12, 0, 0)


def skewed(spark, n=5000):
    rows = []
    for i in range(n):
        hot = i % 5 < 2
        topic = 1 if hot else 2 + i % 7
        article = 1 if hot else 100 + i % 53
        ts = T0 - dt.timedelta(minutes=(i * 37) % (60 * 24 * 9))
        rows.append((f"e{i}", i, article, f"A{article}", "enwiki", f"u{i % 11}", ts, ts,
                     [(topic, f"T{topic}", f"Root > T{topic}", 1.0)], []))
    return spark.createDataFrame(rows, S.EDIT_EVENTS), pd.DataFrame(rows, columns=S.EDIT_EVENTS.fieldNames())


def test_hot_topic_counts_and_articles(spark):
    df, pdf = skewed(spark)
    pdf["topic_id"] = pdf["topics"].map(lambda t: t[0][0])
    as_of = pd.Timestamp(AS_OF)
    for period, hours in (("LastHour", 1), ("Last24Hours", 24), ("Last7Days", 168)):
        win = pdf[pdf["ts"] >= as_of - pd.Timedelta(hours=hours)]
        want = win.groupby("topic_id").size().to_dict()
        got = {r.topic_id: r.edit_count for r in tr.trend_counts(df, AS_OF).filter(F.col("period") == period).collect()}
        assert got == want, period
        arts = win[win["topic_id"] == 1].groupby("article_id").size().sort_values(ascending=False)
        top = tr.top_articles(tr.article_counts(df, AS_OF), 3).filter((F.col("period") == period) & (F.col("topic_id") == 1))
        assert [(r.article_id, r.edits) for r in top.orderBy("article_rank").collect()] == list(arts.head(3).items())
    stats = {r.topic_id: (r.edit_count, r.unique_editors) for r in sv.topic_stats(df).collect()}
    assert stats[1] == (int((pdf["topic_id"] == 1).sum()), pdf[pdf["topic_id"] == 1]["user"].nunique())
    rep = tr.trends_report(df, AS_OF).filter(F.col("topic_id") == 1).collect()
    assert all(r.article_id == 1 for r in rep if r.article_rank == 1)


def test_skew_safe_lookup_equals_plain_join(spark):
    from editsurge.operators.joins import skew_safe_lookup
    left = spark.range(3000).select(F.col("id").alias("row"),
                                    F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    right = right.unionByName(spark.createDataFrame([(999, 1)], "k long, v long"))   # a key nobody asks for
    got = sorted(skew_safe_lookup(left, right, ["k"]).select("row", "k", "v").collect())
    want = sorted(left.join(right, ["k"], "left").select("row", "k", "v").collect())
    assert got == want and len(got) == 3000
