"""Trend operators on hand-made edits: anomaly golden rows, report filter
and the boundary rows every trend query must hold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from editsurge import schemas as S
from editsurge.operators import trends as tr

AS_OF = "2024-01-30 12:00:00"
T0 = dt.datetime(2024, 1, 30, 12, 0, 0)


def edit(i, ts, topics, classified=None, article=None, title=None):
    return (f"e{i}", i, article or i, title or f"A{article or i}", "enwiki", "u", ts, classified or ts,
            [(t, n, p, 1.0) for (t, n, p) in topics], [])


@pytest.fixture(scope="module")
def edits(spark):
    h = dt.timedelta(hours=1)
    rows = [
        edit(1, T0 - h, [(1, "Sci", "Root > Sci")], article=10),                  # exactly at window start: kept
        edit(2, T0 - h - dt.timedelta(seconds=1), [(1, "Sci", "Root > Sci")], article=10),  # 1 s earlier: dropped
        edit(3, T0 - 30 * h, [(1, "Sci", "Root > Sci")], classified=T0 - dt.timedelta(minutes=5), article=11),
        edit(4, T0 - dt.timedelta(minutes=10), []),                                  # no topics: vanishes
        edit(5, T0 - dt.timedelta(minutes=10), [(2, "topic 2", "topic-2"), (2, "topic 2", "topic-2")], article=12),
        edit(6, T0 - dt.timedelta(minutes=20), [(3, "Art", "Culture > Art")], article=13),
        edit(7, T0 - dt.timedelta(minutes=20), [(4, "Law", "Society > Law")], article=14),
        edit(8, T0 + dt.timedelta(hours=5), [(4, "Law", "Society > Law")], article=14),   # future ts kept
    ]
    return spark.createDataFrame(rows, S.EDIT_EVENTS)


def counts(df, period):
    return {r.topic_id: r.edit_count for r in df.filter(F.col("period") == period).collect()}


def test_window_boundaries_and_explode(edits):
    c = counts(tr.trend_counts(edits, AS_OF), "LastHour")
    # topic 1: edit 1 (at the bound) + edit 3 (old ts, recent classified_at)
    assert c[1] == 2
    assert c[2] == 2          # listed twice -> counts twice
    assert c[3] == 1 and c[4] == 2
    assert set(c) == {1, 2, 3, 4}


def test_top_articles_use_ts_only_and_count_once(edits):
    a = tr.article_counts(edits, AS_OF).filter(F.col("period") == "LastHour").collect()
    got = {(r.topic_id, r.article_id): r.edits for r in a}
    assert got[(1, 10)] == 1                  # edit 3 (old ts) not counted here (Q1)
    assert (1, 11) not in got
    assert got[(2, 12)] == 1                  # topic twice in one edit -> once


def test_topic_info_placeholders_fall_back(edits):
    info = {r.topic_id: (r.name, r.path) for r in tr.topic_info(edits).collect()}
    assert info[2] == ("", "")                # only placeholder names and paths
    assert info[1] == ("Sci", "Root > Sci")


def test_equal_counts_tie_on_id(edits):
    top = tr.top_topics(tr.trend_counts(edits, AS_OF), 3).filter(F.col("period") == "LastHour")
    ranks = [r.topic_id for r in top.orderBy("topic_rank").collect()]
    assert ranks == [1, 2, 4]                 # 1, 2 and 4 all have 2 edits: id decides


def test_baseline_averages_only_days_with_edits(spark):
    days = [T0 - dt.timedelta(days=d) for d in (1, 1, 1, 5, 5, 20)]
    rows = [edit(i, ts, [(7, "X", "X")]) for i, ts in enumerate(days)]
    e = spark.createDataFrame(rows, S.EDIT_EVENTS)
    b = tr.recalculate_baselines(e, AS_OF, 30).collect()
    assert len(b) == 1 and b[0].baseline_daily == pytest.approx(2.0)   # (3 + 2 + 1) / 3 days
    roll = {(r.period, r.topic_id): r.baseline_daily for r in tr.trend_rollup(e, AS_OF, 30).collect()}
    assert roll[("Last7Days", 7)] == pytest.approx(2.0)


@pytest.mark.parametrize("period,count,base,change,score", [
    ("Last24Hours", 20, 10.0, 1.0, 3.1622777),
    ("Last24Hours", 0, 0.0, 0.0, 0.0),
    ("Last24Hours", 5, 0.0, 1.0, 5.0),
    ("LastHour", 1, 24.0, 0.0, 0.0),
    ("Last7Days", 0, 10.0, -1.0, -8.3666),
])
def test_anomaly_golden_rows(spark, period, count, base, change, score):
    df = spark.createDataFrame([(period, count, base)], "period string, edit_count int, baseline_daily float")
    r = tr.anomaly(df).collect()[0]
    assert r.change_percent == pytest.approx(change, abs=1e-4)
    assert r.anomaly_score == pytest.approx(score, abs=1e-4)


def test_report_filter(spark):
    df = spark.createDataFrame([(1, 1.1, 0.0), (2, 0.0, 0.2), (3, 1.0, 0.1)],
                               "topic_id int, anomaly_score float, change_percent float")
    assert sorted(r.topic_id for r in tr.reportable(df).collect()) == [1, 2]


def test_missing_baseline_is_zero(spark, edits):
    b = spark.createDataFrame([(1, 4.0, T0)], S.BASELINES)
    j = {r.topic_id: r.baseline_daily for r in tr.with_baseline(tr.trend_counts(edits, AS_OF), b).collect()}
    assert j[1] == 4.0 and j[3] == 0.0


def test_latest_baseline_wins(spark):
    b = spark.createDataFrame([(1, 4.0, T0 - dt.timedelta(days=1)), (1, 9.0, T0)], S.BASELINES)
    assert tr.latest_baseline(b).collect()[0].baseline_daily == 9.0


def test_report_and_updates_shape(edits):
    rep = tr.trends_report(edits, AS_OF)
    assert {"period", "topic_id", "topic_name", "anomaly_score", "article_id"} <= set(rep.columns)
    names = {r.topic_id: r.topic_name for r in rep.collect()}
    assert names.get(2) == "topic-2"          # placeholder-only topic falls back
    upd = tr.trend_updates(edits, AS_OF).collect()
    for u in upd:
        scores = [t.anomaly_score for t in u.topics]
        assert scores == sorted(scores, reverse=True)


def explain_text(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_trailing_window_plan_prunes_and_pushes(spark, tmp_path):
    """On a stored edit table the window bound prunes eff_date partitions and
    both halves of the effective-time test reach the Parquet reader."""
    from editsurge.sources.adapters import edits_from_events
    from editsurge.sources.sinks import write_edit_events
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    path = str(tmp_path / "edits")
    write_edit_events(edits_from_events(ev), path, partition_by_day=True)
    stored = spark.read.parquet(path)
    text = explain_text(tr.trend_counts(stored, "2024-01-20 00:00:00"))
    assert "PartitionFilters: [isnotnull(eff_date" in text
    assert "PushedFilters: [Or(" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,classified_at:timestamp_ntz,topics:array<struct<topic_id:int>>>" in text


def test_label_state_gives_same_results(spark, edits):
    from editsurge.operators import serving as sv
    half1 = edits.filter(F.col("wiki_edit_id") <= 4)
    half2 = edits.filter(F.col("wiki_edit_id") > 4)
    state = tr.topic_label_state(half1).unionByName(tr.topic_label_state(half2))
    assert sorted(tr.trends_report(edits, AS_OF, label_state=state).collect()) == \
        sorted(tr.trends_report(edits, AS_OF).collect())
    assert sorted(sv.trends_response(edits, AS_OF, "LastHour", label_state=state).collect()) == \
        sorted(sv.trends_response(edits, AS_OF, "LastHour").collect())


def test_topic_detail_keeps_baseline_without_recent_edits(spark):
    from editsurge.operators import serving as sv
    rows = [edit(i, T0 - dt.timedelta(days=10), [(9, "Old", "Hist > Old")], article=50) for i in range(4)]
    e = spark.createDataFrame(rows, S.EDIT_EVENTS)
    d = sv.topic_detail(e, AS_OF, 9, "Last7Days").collect()[0]
    assert (d.edit_count_last_7_days, d.anomaly_score) == (0, 0.0)
    assert d.baseline_daily == pytest.approx(4.0) and d.name == "Old"


def test_as_of_on_partitioned_table_is_exact(spark, tmp_path):
    """max ts from the newest partitions equals a full scan, including a row
    whose ts is old but whose effective time is newest."""
    from editsurge.sources.adapters import max_ts
    from editsurge.sources.sinks import write_edit_events
    rows = [edit(1, T0 - dt.timedelta(days=3), [(1, "a", "a")], classified=T0 + dt.timedelta(days=2)),
            edit(2, T0, [(1, "a", "a")]),
            edit(3, T0 - dt.timedelta(days=9), [(1, "a", "a")])]
    path = str(tmp_path / "t")
    write_edit_events(spark.createDataFrame(rows, S.EDIT_EVENTS), path, partition_by_day=True)
    stored = spark.read.parquet(path)
    assert max_ts(stored) == "2024-01-30 12:00:00" == max_ts(stored.drop("eff_date"))


def test_big_day_is_split_across_writers(spark, tmp_path):
    """Range partitioning by (eff_date, effective time): one day's rows are
    written by several tasks (files), not one."""
    import glob
    from editsurge.sources.sinks import write_edit_events
    rows = [edit(i, T0 - dt.timedelta(seconds=i), [(1, "a", "a")]) for i in range(4000)]
    path = str(tmp_path / "t")
    write_edit_events(spark.createDataFrame(rows, S.EDIT_EVENTS).repartition(4), path, partition_by_day=True, num_files=4)
    files = glob.glob(str(tmp_path / "t" / "eff_date=2024-01-30" / "*.parquet"))
    assert len(files) >= 2
    assert spark.read.parquet(path).count() == 4000
