"""A topic record is parsed once, whatever number of fields and filters look into it."""

import json
import os
import uuid

from pyspark.sql import functions as F

from editsurge import schemas as S
from editsurge.sources.json_codec import parse_record
from editsurge.streaming import jobs as J

LEVELS = 4  # the record, its topic list, a topic, the embedding


def _parses(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")


def test_record_is_parsed_once_a_level(spark):
    df = spark.createDataFrame([('{"eventId":"a"}',)], "value string")
    assert _parses(df.select(parse_record("value", S.EDIT_EVENTS).alias("r"))) <= LEVELS


def test_keys_in_any_case_last_one_counts(spark):
    topics = [{"TOPICID": 7, "topicName": "n"}, None, {"topicId": "x", "topicid": "8"}]
    text = '{"eventId":"a","EVENTID":"b","eventid":"c","articleId":" 5 ","ts":"no time","Topics":' + json.dumps(topics) + "}"
    rows = spark.createDataFrame([(text,), ("[1]",), (" ",), (None,), ("{}",)], "value string")
    got = [x.r for x in rows.select(parse_record("value", S.EDIT_EVENTS).alias("r")).collect()]
    assert (got[0].event_id, got[0].article_id, got[0].ts, got[0].title) == ("c", 5, None, None)
    assert [t and t.topic_id for t in got[0].topics] == [7, None, 8]
    assert got[1] is got[2] is got[3] is None and got[4].event_id is None


def test_filters_on_a_stream_do_not_parse_again(spark):
    d = J.state_dir(spark, "test-streams", uuid.uuid4().hex)
    spark.createDataFrame([("k", '{"eventId":"a"}')], "key string, value string").write.json(d)
    s = J.read_topic_stream(spark, d, S.EDIT_EVENTS).select("r.*")
    kept = s.filter(F.col("event_id").isNotNull() & F.col("classified_at").isNull() & (F.length("title") > 0))
    q = kept.select("event_id").writeStream.format("noop").option("checkpointLocation", d + "-ck").trigger(availableNow=True).start()
    q.awaitTermination()
    plan = q._jsq.explainInternal(False)
    assert "Generate" in plan and plan.count("from_json(") <= LEVELS


def test_quarantine_keeps_the_text_of_rejected_records_only(spark):
    d = J.state_dir(spark, "test-streams", uuid.uuid4().hex)
    p = {k: os.path.join(d, k) for k in ("topic", "t", "bad", "ck")}
    texts = ['{"eventId":"a","embedding":[],"ts":"2024-01-01T00:00:00"}', '{"eventId":" ","embedding":[]}', '{"eventId":"b"}', "not json"]
    spark.createDataFrame([("k", t) for t in texts], "key string, value string").write.json(p["topic"])
    J.start_ingest(spark, p["topic"], p["t"], p["bad"], p["ck"], trigger={"availableNow": True}).awaitTermination()
    assert [r.event_id for r in spark.read.parquet(p["t"]).collect()] == ["a"]
    assert sorted(r._raw for r in spark.read.parquet(p["bad"]).collect()) == sorted(texts[1:])
