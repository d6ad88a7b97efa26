"""Explicit schemas (nothing is inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

TOPIC_SCORE = T.StructType([
    T.StructField("topic_id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("confidence", T.FloatType()),
])
TOPICS = T.ArrayType(TOPIC_SCORE)
EMBEDDING = T.ArrayType(T.FloatType())

# edit_events fact table (ClassifiedEdit flattened to columns).
EDIT_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("wiki_edit_id", T.LongType()),
    T.StructField("article_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("wiki", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("classified_at", T.TimestampNTZType()),
    T.StructField("topics", TOPICS),
    T.StructField("embedding", EMBEDDING),
])

LENGTH = T.StructType([T.StructField("old", T.IntegerType()), T.StructField("new", T.IntegerType())])
REVISION = T.StructType([T.StructField("old", T.LongType()), T.StructField("new", T.LongType())])
META = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("dt", T.StringType()),
    T.StructField("domain", T.StringType()), T.StructField("uri", T.StringType()),
    T.StructField("request_id", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("topic", T.StringType()),
])

# recent_change record of the public change feed.
RECENT_CHANGE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("namespace", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("bot", T.BooleanType()),
    T.StructField("minor", T.BooleanType()),
    T.StructField("length", LENGTH),
    T.StructField("revision", REVISION),
    T.StructField("server_name", T.StringType()),
    T.StructField("server_url", T.StringType()),
    T.StructField("wiki", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("comment", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("meta", META),
    T.StructField("patrolled", T.BooleanType()),
    T.StructField("parsedcomment", T.StringType()),
])

RAW_EDIT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("wiki_edit_id", T.LongType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("wiki", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("is_bot", T.BooleanType()),
    T.StructField("is_minor", T.BooleanType()),
    T.StructField("is_new", T.BooleanType()),
    T.StructField("old_length", T.IntegerType()),
    T.StructField("new_length", T.IntegerType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("collected_at", T.TimestampNTZType()),
])

ENRICHED_EDIT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("wiki_edit_id", T.LongType()),
    T.StructField("article_id", T.LongType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("wiki", T.StringType()),
    T.StructField("extract", T.StringType()),
    T.StructField("categories", T.ArrayType(T.StringType())),
    T.StructField("linked_articles", T.ArrayType(T.StringType())),
    T.StructField("diff_size", T.IntegerType()),
    T.StructField("is_bot", T.BooleanType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("enriched_at", T.TimestampNTZType()),
])

BASELINES = T.StructType([
    T.StructField("topic_id", T.IntegerType()),
    T.StructField("baseline_daily", T.FloatType()),
    T.StructField("calculated_at", T.TimestampNTZType()),
])

COMMAND = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("topic_id", T.IntegerType()),
    T.StructField("cache_key", T.StringType()),
    T.StructField("requested_at", T.TimestampNTZType()),
])
