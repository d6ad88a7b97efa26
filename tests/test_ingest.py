"""Feed filtering/mapping, SSE decoding and the JSON codec."""

import os

from pyspark.sql import functions as F

from editsurge import schemas as S
from editsurge.operators import ingest as ig
from editsurge.sources import feeds as fd


def changes(spark):
    rows = [
        (1, "edit", 0, "T", "u", False, False, (1, 2), None, "enwiki", 1700000000, 42),
        (2, "EDIT", 0, "T", "u", None, None, None, None, "RUWIKI", 1700000000123, None),
        (None, "edit", 0, "T", "u", False, False, None, None, "enwiki", 1, 1),
        (4, "edit", 0, "T", "u", False, False, None, None, " ", 1, 1),
        (5, "log", 0, "T", "u", False, False, None, None, "enwiki", 1, 1),
        (6, None, 1, "T", "u", False, False, None, None, "enwiki", 1, 1),
        (7, "new", 0, "T", "u", False, False, None, None, "enwiki", 1, 1),
        (8, None, None, "T", "u", False, False, None, None, "dewiki", 1, 1),
    ]
    cols = "id long, type string, namespace int, title string, user string, bot boolean, minor boolean, " \
           "length struct<old:int,new:int>, revision struct<old:long,new:long>, wiki string, timestamp long, page_id long"
    return spark.createDataFrame(rows, cols)


def test_filter_and_reasons(spark):
    df = changes(spark)
    assert sorted(r.id for r in ig.filter_changes(df).collect()) == [1, 2]
    rep = {r.reason: r.rejected for r in ig.rejected_changes_report(df).collect()}
    assert rep == {"missing_field": 1, "wiki_not_allowed": 2, "type_not_allowed": 2, "namespace_not_allowed": 1}


def test_raw_mapping_defaults(spark):
    rows = {r.wiki_edit_id: r for r in ig.raw_edits(changes(spark), "2024-01-01 00:00:00").collect()}
    a, b = rows[1], rows[2]
    assert (a.page_id, a.old_length, a.new_length, a.is_new) == (42, 1, 2, False)
    assert (b.page_id, b.old_length, b.is_bot) == (0, 0, False)
    assert b.timestamp.microsecond == 123000
    assert len(a.event_id) == 64


def test_sse_decode(spark, tmp_path):
    text = ("event: message\nid: 1\ndata: {\"id\": 1,\ndata: \"title\": \"T\"}\n\n"
            ": heartbeat\n\n"
            "id: 2\ndata: {bad json\n\n"
            "event: message\nid: 3\ndata: {\"id\": 3, \"title\": \"U\"}\n\n")
    p = tmp_path / "sse.txt"
    p.write_text(text)
    frames = spark.read.option("lineSep", "\n\n").text(str(p))
    dec = fd.decode_sse(frames)
    assert [r.event_id for r in dec.collect()] == ["1", "2", "3"]
    got = fd.parse_changes(dec).select("id", "title").collect()
    assert [(r.id, r.title) for r in got] == [(1, "T"), (3, "U")]


def test_json_codec_case_insensitive(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("some_value", T.IntegerType()), T.StructField("optional", T.StringType())])
    df = spark.createDataFrame([(1, None)], schema)
    from editsurge.sources.sinks import to_topic_records
    rec = to_topic_records(df, F.lit("k")).collect()[0]
    assert rec.value == '{"someValue":1}'
    back = spark.createDataFrame([('{"SomeValue":2}',)], "value string").select(fd.parse_record("value", schema).alias("r"))
    assert back.collect()[0].r.some_value == 2


def test_malformed_lines_dropped_or_quarantined(spark, tmp_path):
    p = tmp_path / "feed"
    os.makedirs(p)
    (p / "a.json").write_text('{"id": 1, "title": "T", "user": "u", "wiki": "enwiki"}\n{"id": 2, "tit\n')
    assert fd.read_recent_changes(spark, str(p)).count() == 1
    q = fd.read_recent_changes(spark, str(p), quarantine=True)
    assert q.filter(F.col("_corrupt_record").isNotNull()).count() == 1


def test_field_presence(spark):
    lines = spark.createDataFrame([('{"id":1,"page_id":2,"title":"t","user":"u","wiki":"w","type":"edit"}',),
                                   ('{"id":2,"title":"t","user":"u","wiki":"w","type":null}',)], "value string")
    got = ig.field_presence(lines).collect()
    assert [(r.id, r.has_page_id, r.has_type) for r in got] == [(2, False, False)]


def test_codec_at_every_level(spark):
    from editsurge import schemas as S
    from editsurge.sources import feeds as fd
    from editsurge.sources.sinks import to_topic_records
    text = '{"eventId":"e","ArticleID":5,"TOPICS":[{"topicId":3,"TopicName":"n","topicPath":"a/b","confidence":0.5},null],"embedding":[0.5]}'
    df = spark.createDataFrame([(text,), ("",), (None,), ("not json",)], "value string")
    rows = [r.r for r in df.select(fd.parse_record("value", S.EDIT_EVENTS).alias("r")).collect()]
    assert rows[1] is None and rows[2] is None
    assert (rows[0].event_id, rows[0].article_id, rows[0].embedding) == ("e", 5, [0.5])
    t = rows[0].topics[0]
    assert (t.topic_id, t.name, t.path, t.confidence) == (3, "n", "a/b", 0.5)
    back = df.limit(1).select(fd.parse_record("value", S.EDIT_EVENTS).alias("r")).select("r.event_id", "r.topics")
    json = to_topic_records(back, "event_id").collect()[0].value
    assert '"topicId":3' in json and '"topicName":"n"' in json and '"topicPath":"a/b"' in json and "topic_id" not in json


def test_crlf_and_lf_frames(spark):
    from editsurge.sources import feeds as fd
    text = "id: 1\r\ndata: a\r\ndata: b\r\n\r\n: note\r\n\r\nid: 2\r\ndata: c\r\n\r\n"
    df = spark.createDataFrame([(text,), (text.replace("\r", ""),)], "value string")
    assert sorted((r.event_id, r.data) for r in fd.decode_sse(df).collect()) == [("1", "a\nb")] * 2 + [("2", "c")] * 2
