"""Collector stream: observed counters equal the batch aggregate; a replayed batch counts once."""
import os
import uuid

from pyspark.sql import functions as F

from editsurge.operators import ingest as ig
from editsurge.operators import metrics as mt
from editsurge.sources import adapters as ad
from editsurge.sources import feeds as fd
from editsurge.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def test_counters_of_a_replayed_stream(spark):
    d = J.state_dir(spark, "test-collector", uuid.uuid4().hex)
    local = d[len("file:"):] if d.startswith("file:") else d
    rc = ad.recent_changes_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    feed = rc.select(F.to_json(F.struct(*rc.columns)).alias("value"))
    feed.unionByName(spark.createDataFrame([("{broken",)], "value string")).repartition(3).write.text(os.path.join(d, "feed"))

    def go():
        q = J.start_collector(spark, *(os.path.join(d, x) for x in ("feed", "raw", "stats", "ck")), "2024-02-01 00:00:00",
                              {"availableNow": True}, max_files_per_trigger=1)
        q.awaitTermination()
        assert q.exception() is None
        total = J.collector_totals(spark, os.path.join(d, "stats")).first()
        return tuple(total), spark.read.text(os.path.join(d, "raw")).count()

    first = go()
    stored = fd.read_recent_changes(spark, os.path.join(d, "feed"))
    want = mt.collector_stats(stored).select("processed", "published", "skipped", "last_event_at").first()
    assert first == (tuple(want), ig.filter_changes(stored).count()) and want.published > 0 and want.skipped > 0
    for name in ("2", ".2.crc"):                # the last batch is run again
        path = os.path.join(local, "ck", "commits", name)
        if os.path.exists(path):
            os.remove(path)
    assert go() == first
