"""Classification: closure with a cycle, root pick, instance-of ranks,
cascade sources."""

import datetime as dt

from pyspark.sql import functions as F

from editsurge.operators import classify as cl

AS_OF = "2024-01-30 12:00:00"
NOW = dt.datetime(2024, 1, 30, 12, 0, 0)


def test_closure_terminates_on_cycle(spark):
    e = spark.createDataFrame([("a", "P279", "b"), ("b", "P279", "c"), ("c", "P279", "a"), ("x", "P31", "a")],
                              "child string, prop string, parent string")
    got = {(r.cls, r.anc) for r in cl.class_closure(e).collect()}
    assert {("a", "a"), ("a", "b"), ("a", "c"), ("c", "b")} <= got and len(got) == 9


def test_pick_root_topic_general_rule(spark):
    h = spark.createDataFrame([("q", 1, "a", 10), ("q", 2, "b", 60), ("q", 3, "c", 90), ("r", 1, "x", 5), ("r", 2, " ", 9),
                               ("r", 3, "y", 7)], "qid string, pos int, label string, sitelinks int")
    got = {r.qid: (r.name, r.path) for r in cl.pick_root_topic(h).collect()}
    assert got["q"] == ("b", "b > a")
    assert got["r"] == ("y", "y > x")       # none reaches 50: the last; blank label dropped first


def test_instance_of_confidence_floor(spark):
    edges = spark.createDataFrame([("Z", "P31", f"Q{i:02d}", i) for i in range(12)] + [("Z", "P31", "q00", 12)],
                                  "child string, prop string, parent string, pos int")
    labels = spark.createDataFrame([("Q00", "en", "zero")], "id string, lang string, label string")
    items = spark.createDataFrame([("Z",)], "qid string")
    rows = cl.instance_of_topics(items, edges, labels).orderBy("rank").collect()
    assert len(rows) == 12                   # q00 is Q00 case-insensitively
    assert [round(r.confidence, 2) for r in rows][:3] == [0.8, 0.75, 0.7]
    assert min(r.confidence for r in rows) >= 0.3 - 1e-6
    assert rows[0].name == "zero" and rows[1].name == "Q01" and rows[1].path == "Wikidata/P31/Q01"


def test_cascade_sources(spark):
    arts = spark.createDataFrame([(1, "Stored", "en"), (2, "Neg", "en"), (3, "Hier", "en"), (4, "Label", "en"),
                                  (5, "Nothing", "en")], "article_id long, title string, lang string")
    at = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.95), (1, 99, 1.0)], "article_id long, topic_id int, confidence float")
    topics = spark.createDataFrame([(1, "Science", "Root/Science"), (2, "Tech", "Root/Tech")],
                                   "topic_id int, name string, path string")
    mapping = spark.createDataFrame([
        ("enwiki", "Neg", None, NOW - dt.timedelta(minutes=30)),
        ("enwiki", "Hier", "I3", NOW), ("enwiki", "Label", "I4", NOW),
        ("enwiki", "Nothing", None, NOW - dt.timedelta(hours=3))],
        "wiki string, title string, qid string, cached_at timestamp_ntz")
    edges = spark.createDataFrame([("I3", "P31", "K", 0), ("K", "P279", "ROOT", 0), ("I4", "P31", "L", 0)],
                                  "child string, prop string, parent string, pos int")
    nodes = spark.createDataFrame([("K", "Kind", 70), ("ROOT", "World", 500), ("L", "Lonely", 3)],
                                  "qid string, label string, sitelinks int")
    labels = spark.createDataFrame([("L", "en", "Lonely"), ("K", "en", "Kind")], "id string, lang string, label string")
    res = {r.article_id: (r.name, r.resolution_source, round(r.confidence, 2))
           for r in cl.resolve_topics(arts, at, topics, mapping, edges, nodes, labels, AS_OF).collect()}
    assert res[1] == ("Tech", "stored", 0.95)
    assert res[2] == ("Uncategorized", "fallback", 0.1)
    assert res[3] == ("Kind", "hierarchy", 1.0)
    assert res[4] == ("Lonely", "label", 0.5)
    assert res[5] == ("Uncategorized", "fallback", 0.1)


def test_upsert_topics_keeps_ids(spark):
    topics = spark.createDataFrame([(1, "Science", "Root/Science"), (4, "Old", "Root/Old")], "topic_id int, name string, path string")
    inc = spark.createDataFrame([("Sci2", "Root/Science"), ("B", "b"), ("A", "a")], "name string, path string")
    got = {r.path: (r.topic_id, r.name) for r in cl.upsert_topics(topics, inc).collect()}
    assert got == {"Root/Science": (1, "Sci2"), "Root/Old": (4, "Old"), "a": (5, "A"), "b": (6, "B")}


def test_seed_report(spark):
    topics = spark.createDataFrame([(1, "Science", "Root/Science")], "topic_id int, name string, path string")
    r = cl.seed_report(topics, cl.seed_topics(spark)).collect()[0]
    assert (r.added, r.updated) == (6, 1)


def test_closure_has_no_depth_limit(spark):
    e = spark.createDataFrame([(f"c{i}", "P279", f"c{i + 1}", 0) for i in range(70)], "child string, prop string, parent string, pos int")
    start = spark.createDataFrame([("c0",)], "cls string")
    assert cl.class_closure(e, start).count() == 71      # seeded: only what the start class reaches


def test_label_language_and_claim_order(spark):
    edges = spark.createDataFrame([("I", "P31", "Z", 0), ("I", "P31", "A", 1), ("Z", "P279", "T", 0)],
                                  "child string, prop string, parent string, pos int")
    nodes = spark.createDataFrame([("Z", "zed", 60), ("T", "top", 90), ("A", "a", 3)], "qid string, label string, sitelinks int")
    labels = spark.createDataFrame([("Z", "de", "Zett"), ("A", "de", "Ah"), ("Z", "en", "zed")], "id string, lang string, label string")
    items = spark.createDataFrame([("I", "de"), ("I", "en")], "qid string, lang string")
    got = {(r.lang, r.pos): r.label for r in cl.class_hierarchy(items, edges, nodes, labels=labels).collect()}
    assert got == {("de", 1): "Zett", ("de", 2): "T", ("en", 1): "zed", ("en", 2): "T"}
    assert {(r.lang, r.name) for r in cl.api_label_topic(items, edges, labels).collect()} == {("de", "Zett"), ("en", "zed")}
    assert [r["class"] for r in cl.instance_of_topics(items, edges, labels).orderBy("rank").collect()] == ["Z", "A"]


def test_checked_mappings(spark):
    arts = spark.createDataFrame([(1, "Found", "en"), (2, "None", "en"), (3, "Down", "en"), (4, "Silent", "en")],
                                 "article_id long, title string, lang string")
    mapping = spark.createDataFrame([("enwiki", "Found", None, NOW - dt.timedelta(hours=5))],
                                    "wiki string, title string, qid string, cached_at timestamp_ntz")
    resp = spark.createDataFrame([("enwiki", "Found", '{"query":{"pages":{"1":{"pageprops":{"wikibase_item":"Q9"}}}}}'),
                                  ("enwiki", "None", '{"query":{"pages":{"1":{"pageprops":{}}}}}'), ("enwiki", "Down", "503")],
                                 "wiki string, title string, body string")
    q = cl.checked_qids(arts, mapping, AS_OF, resp)
    assert {r.title: r.qid for r in q.collect()} == {"Found": "Q9", "None": None, "Down": None, "Silent": None}
    assert {(r.title, r.qid) for r in cl.new_mappings(q, AS_OF).collect()} == {("Found", "Q9"), ("None", None)}
