"""Topic-to-file index: only files that hold the topic are read; sketches of any days."""
import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from editsurge import schemas as S
from editsurge.operators.rollups import ActivitySketches
from editsurge.sources import topic_index as ti
from editsurge.sources.sinks import write_edit_events
from editsurge.streaming import jobs as J

START = dt.datetime(2024, 1, 1)


def rows_of(spark, n=2000):
    """Topic 1 in every edit, topic 2 in the first tenth of the time, topic 7 in two edits."""
    out = []
    for i in range(n):
        topics = [(1, "one", "a", 1.0)] + ([(2, "two", "b", 0.5)] if i < n // 10 else []) + ([(7, "rare", "c", 0.1)] if i in (500, 1500) else [])
        at = START + dt.timedelta(minutes=i)
        out.append((f"e{i}", i, i % 13 + 1, f"A{i % 13}", "enwiki", f"u{i % 300}", at, at, topics, []))
    return spark.createDataFrame(out, S.EDIT_EVENTS)


def files_read(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    return df.select(F.input_file_name()).distinct().count(), text


def test_reads_only_files_with_the_topic(spark):
    d = J.state_dir(spark, "test-index", uuid.uuid4().hex)
    table, index, df = os.path.join(d, "t"), os.path.join(d, "i"), rows_of(spark)
    for batch in range(2):
        for _ in range(1 + batch):          # the second batch is replayed
            write_edit_events(df.filter(F.col("wiki_edit_id") % 2 == batch), table, num_files=10, partition_by_day=False, batch_id=batch)
            ti.index_batch(spark, table, index, batch)
    total = len(ti.files_of(spark, index, [1]))
    assert total == 20 and 0 < len(ti.files_of(spark, index, [2])) <= 6 and len(ti.files_of(spark, index, [7])) == 2
    for topics, since in (([1], None), ([2], None), ([7], None), ([2, 7], None), ([1], "2024-01-02 00:00:00"), ([9], None)):
        got = ti.edits_of_topics(spark, table, index, topics, since)
        want = df.filter(F.arrays_overlap("topics.topic_id", F.array(*[F.lit(t) for t in topics])))
        if since:
            want = want.filter(F.greatest("ts", "classified_at") >= F.lit(since).cast("timestamp_ntz"))
        assert sorted(r.event_id for r in got.collect()) == sorted(r.event_id for r in want.collect())
    rare = ti.edits_of_topics(spark, table, index, [7])
    n, text = files_read(rare)
    assert n == 2 and "InMemoryFileIndex(2 paths)" in text       # of 20 files
    assert len(ti.files_of(spark, index, [1], "2024-01-02 00:00:00")) < total


def test_sketches_of_any_days(spark):
    df = rows_of(spark, 6000)
    kept = ActivitySketches(spark, J.state_dir(spark, "test-index", uuid.uuid4().hex), fan=2, depth=2)
    for n in range(5):
        for _ in range(1 + (n == 3)):
            kept.update(df.filter(F.col("wiki_edit_id") % 5 == n), n)
    for first, last in ((None, None), ("2024-01-02", "2024-01-03"), ("2024-01-04", None)):
        part = df.filter(F.lit(True) if first is None else F.to_date("ts") >= F.lit(first).cast("date"))
        part = part.filter(F.lit(True) if last is None else F.to_date("ts") <= F.lit(last).cast("date"))
        want = {r.topic_id: (r.n, r.u) for r in part.select("user", F.explode("topics.topic_id").alias("topic_id"))
                .groupBy("topic_id").agg(F.count("*").alias("n"), F.countDistinct("user").alias("u")).collect()}
        got = {r.topic_id: (r.edit_count, r.unique_editors) for r in kept.stats(first, last).collect()}
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert all(abs(got[k][1] - want[k][1]) <= max(1, 0.08 * want[k][1]) for k in want)
    assert ActivitySketches(spark, J.state_dir(spark, "test-index", uuid.uuid4().hex)).stats() is None
