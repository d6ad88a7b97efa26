"""The stages composed: change feed -> raw edits -> enrichment ->
classification -> fact table -> trend report, on the sf0.001 tables."""

import os
import uuid

from pyspark.sql import functions as F

from editsurge.operators import classify as cl
from editsurge.operators import enrich as en
from editsurge.operators import ingest as ig
from editsurge.operators import trends as tr
from editsurge.sources import adapters as ad
from editsurge.sources.sinks import write_edit_events
from editsurge.sources.tables import read_table
from editsurge.streaming.jobs import state_dir

SF = "/root/testdata/sf0.001"


def test_feed_to_report(spark):
    events = read_table(spark, SF, "events", "event_id", "ts", "user_id", "event_type", "value")
    as_of = ad.max_ts(events)
    raw = ig.raw_edits(ad.recent_changes_from_events(events), as_of)
    docs = read_table(spark, SF, "documents", "doc_id", "text", "lang", "source")
    pages = read_table(spark, SF, "pages", "page_id", "html")
    out = en.enrich(raw, ad.articles_from_documents(docs, as_of), ad.stored_categories_from_documents(docs),
                    ad.page_responses_from_documents(docs, pages), as_of)
    enriched = out["enriched"]
    # Classify the enriched articles (title + language of their wiki).
    arts = enriched.select("article_id", "title", F.regexp_replace("wiki", "(?i)wiki$", "").alias("lang")).distinct()
    cust = read_table(spark, SF, "customer", "c_custkey", "c_name", "c_nationkey")
    edges, nodes = ad.class_graph(cust, read_table(spark, SF, "nation"), read_table(spark, SF, "region"))
    topics = ad.topics_fixture(spark)
    res = cl.resolve_topics(arts, ad.article_topics_from_customers(cust), topics,
                            ad.qid_mapping_from_customers(cust, as_of), edges, nodes, ad.labels_from_nodes(nodes), as_of)
    up = cl.upsert_topics(topics, res.select("name", "path"))
    rt = res.join(up.select("topic_id", "path"), "path").select(
        "article_id", "topic_id", F.col("name").alias("topic_name"), F.col("path").alias("topic_path"), "confidence")
    classified = ig.to_classified(enriched.join(rt, "article_id"), as_of)
    path = os.path.join(state_dir(spark, "e2e", uuid.uuid4().hex), "edits")
    write_edit_events(classified, path, partition_by_day=True)
    stored = spark.read.parquet(path)
    assert stored.count() == enriched.count() > 0
    report = tr.trends_report(stored, tr_as_of := ad.max_ts(stored)).collect()
    assert tr_as_of and all(r.topic_name for r in report)
    counts = tr.trend_counts(stored, tr_as_of).filter(F.col("period") == "Last7Days").agg(F.sum("edit_count")).first()[0]
    assert counts is None or counts > 0


def test_command_line_report(spark, tmp_path):
    from editsurge.__main__ import main
    out = str(tmp_path / "report")
    main(["report", "--sf-dir", SF, "--out", out])
    df = spark.read.parquet(out)
    assert df.count() > 0 and "anomaly_score" in df.columns
    main(["topic", "--sf-dir", SF, "--topic-id", "3", "--period", "Last7Days", "--out", str(tmp_path / "t")])
    assert spark.read.parquet(str(tmp_path / "t")).select("topic_id").distinct().collect()[0][0] == 3
