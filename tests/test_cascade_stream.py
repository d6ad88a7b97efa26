"""T-03 with the cascade in the stream: replays, stored topics, changed subclass edges; T-02 run tables."""
import os
import uuid

from pyspark.sql import functions as F

from editsurge.plans import stream_queries as sq
from editsurge.sources.runs import RunTable
from editsurge.sources.sinks import to_topic_records
from editsurge.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_replay_and_graph_change(spark):
    d = J.state_dir(spark, "test-cascade", uuid.uuid4().hex)
    tables, cust, as_of = sq._cascade_tables(spark, SF, d)
    edits = sq._customer_edits(cust, 2).filter("article_id <= 60")
    changes = os.path.join(d, "graph")
    # With the first batch the graph gets a class above the root of all.
    spark.createDataFrame([("ROOT", "NEW", False)], "child string, parent string, gone boolean").write.parquet(
        os.path.join(changes, "batch_id=0"))

    def go():
        J.start_resolving_classify_stream(
            spark, os.path.join(d, "topic"), tables, os.path.join(d, "state"), os.path.join(d, "out"), os.path.join(d, "res"),
            os.path.join(d, "ck"), as_of_fn=lambda: as_of, trigger={"availableNow": True}, graph_change_path=changes).awaitTermination()

    for odd in (0, 1):
        to_topic_records(edits.filter(F.col("file") % 2 == odd).drop("file"), "page_id").coalesce(1) \
            .write.mode("append").json(os.path.join(d, "topic"))
        go()
    state = lambda: (
        sorted(tuple(r) for r in spark.read.parquet(os.path.join(d, "res")).collect()),
        sorted((r.event_id, r.topics[0].topic_id, r.batch_id) for r in spark.read.parquet(os.path.join(d, "out")).collect()),
        sorted(tuple(r) for r in RunTable(spark, os.path.join(d, "state", "topics"), ["path"]).read().select("path", "topic_id").collect()),
        sorted(tuple(r) for r in RunTable(spark, os.path.join(d, "state", "closure", "pairs"), ["cls", "anc"]).read().collect()))
    first = state()
    # every article once resolved is stored for the second batch, and topic ids are unique
    n = edits.filter("article_id > 0").select("article_id").distinct().count()
    assert len(first[0]) == 2 * n == len(first[1])
    assert {r[-2] for r in first[0] if r[-1] == 1} == {"stored"}
    assert len({i for _, i in first[2]}) == len(first[2])
    assert any(pair == ("Q5", "Q5") or pair[1] == "NEW" for pair in first[3])
    assert all((cls, "NEW") in first[3] for cls, anc in first[3] if anc == "ROOT")
    # The last batch is replayed: its commit goes, everything comes out the same.
    for name in ("1", ".1.crc"):
        path = os.path.join(local(d), "ck", "commits", name)
        if os.path.exists(path):
            os.remove(path)
    go()
    assert state() == first
