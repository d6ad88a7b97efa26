"""Registered source, sink, codec and response-parser queries (S-01..S-03,
S-07, S-08, X-17..X-21).  Inputs are files or JSON bodies Spark derives
from the driver tables; the oracle states the values the parse must give."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from editsurge import schemas as S
from editsurge.functions import scalar as X
from editsurge.operators import trends as tr
from editsurge.plans.oracle_ctes import EDITS, RECENT, with_ctes
from editsurge.plans.registry import register
from editsurge.plans.stream_queries import _scratch
from editsurge.plans.trend_queries import TRENDS_REPORT_SQL
from editsurge.sources import adapters as ad
from editsurge.sources import feeds as fd
from editsurge.sources import responses as rp
from editsurge.sources.sinks import to_topic_records, write_baselines, write_trend_snapshot
from editsurge.sources.tables import read_table


def _rc_json(spark, sf_dir):
    events = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    rc = ad.recent_changes_from_events(events).withColumn("src_n", F.col("revision.old"))
    js = F.to_json(F.struct(*[c for c in rc.columns if c != "src_n"]))
    # Every 200th record is cut short, so it is not valid JSON.
    js = F.when(F.col("src_n") % 200 == 0, F.substring(js, 1, 20)).otherwise(js)
    return rc.select("src_n", js.alias("json"))


RC_OUT = """
SELECT id, title, wiki, type, page_id, "timestamp" FROM rc WHERE src_n % 200 <> 0"""


@register("source_recent_changes", with_ctes(RECENT) + RC_OUT)
def q_source_recent_changes(spark, sf_dir):
    """S-01: JSON-lines change feed read with an explicit schema; the
    malformed lines are dropped and the read goes on."""
    d = _scratch(spark, "feed")
    _rc_json(spark, sf_dir).select("json").repartition(4).write.text(os.path.join(d, "feed"))
    rc = fd.read_recent_changes(spark, os.path.join(d, "feed"))
    return rc.select("id", "title", "wiki", "type", "page_id", "timestamp")


@register("stream_collector", with_ctes(RECENT) + """
SELECT count(*) AS processed, count(*) FILTER (WHERE reason IS NULL) AS published, count(*) FILTER (WHERE reason IS NOT NULL) AS skipped,
  strftime(max(CASE WHEN "timestamp" > 10000000000 THEN TIMESTAMP '1970-01-01' + to_milliseconds("timestamp")
      ELSE TIMESTAMP '1970-01-01' + to_seconds("timestamp") END) FILTER (WHERE reason IS NULL), '%Y-%m-%d %H:%M:%S.%f') AS last_event_at,
  count(*) FILTER (WHERE reason IS NULL) AS raw_edits
FROM rcr WHERE src_n % 200 <> 0""")
def q_stream_collector(spark, sf_dir):
    """S-01 + F-01 + F-02 + A-14: the feed is collected into the raw-edit topic in four micro-batches; the
    counters observed while they are written, added up, and the records of the topic."""
    from editsurge.streaming import jobs as J
    d = _scratch(spark, "collector")
    _rc_json(spark, sf_dir).select("json").repartition(4).write.text(os.path.join(d, "feed"))
    q = J.start_collector(spark, os.path.join(d, "feed"), os.path.join(d, "raw"), os.path.join(d, "stats"), os.path.join(d, "ckpt"),
                          "2024-02-01 00:00:00", {"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    raw = spark.read.schema("key string, value string").json(os.path.join(d, "raw")).count()
    return J.collector_totals(spark, os.path.join(d, "stats")).select(
        "processed", "published", "skipped", F.date_format("last_event_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_event_at"),
        F.lit(raw).cast("long").alias("raw_edits"))


@register("source_sse_capture", with_ctes(RECENT) + """
SELECT CAST(src_n AS VARCHAR) AS event_id, id, title, wiki FROM rc WHERE src_n % 200 <> 0""")
def q_source_sse_capture(spark, sf_dir):
    """S-02: captured event-stream text: frames split by a blank line, JSON
    split over two data: lines, event:/comment lines and empty frames mixed
    in, every 200th frame broken.  Every third frame is in a second capture
    with CRLF line ends."""
    d = _scratch(spark, "sse")
    j = _rc_json(spark, sf_dir)
    cut = F.locate(",", "json")
    d1 = F.when(cut > 0, F.expr("substring(json, 1, locate(',', json))")).otherwise(F.col("json"))
    d2 = F.when(cut > 0, F.expr("substring(json, locate(',', json) + 1)")).otherwise(F.lit(""))
    frame = F.concat_ws("\n",
                        F.lit("event: message"),
                        F.concat(F.lit("id: "), F.col("src_n").cast("string")),
                        F.when(F.col("src_n") % 7 == 0, F.lit(": heartbeat")),
                        F.concat(F.lit("data: "), d1),
                        F.when(d2 != "", F.concat(F.lit("data: "), d2)))
    empty = F.when(F.col("src_n") % 50 == 0, F.lit(": keep-alive\n"))
    text = F.concat(F.coalesce(F.concat(empty, F.lit("\n")), F.lit("")), frame, F.lit("\n"))
    third = F.col("src_n") % 3 == 0
    j.filter(~third).select(text.alias("value")).repartition(4).write.text(os.path.join(d, "lf"))
    crlf = F.replace(text, F.lit("\n"), F.lit("\r\n"))
    j.filter(third).select(crlf.alias("value")).repartition(4).write.option("lineSep", "\r\n").text(os.path.join(d, "crlf"))
    frames = fd.read_sse(spark, os.path.join(d, "lf")).unionByName(fd.read_sse(spark, os.path.join(d, "crlf"), "\r\n"))
    decoded = fd.decode_sse(frames)
    parsed = decoded.select("event_id", F.from_json("data", S.RECENT_CHANGE).alias("r"))
    return (parsed.filter(F.col("r.id").isNotNull() | F.col("r.title").isNotNull())
                  .select("event_id", "r.id", "r.title", "r.wiki"))


@register("source_event_topic", with_ctes(EDITS) + """
SELECT CAST(article_id AS VARCHAR) AS key, event_id, article_id, wiki, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
  (SELECT count(*) FROM et WHERE et.event_id = e.event_id) AS n_topics,
  coalesce((SELECT string_agg(CAST(topic_id AS VARCHAR) || '=' || name || '=' || path, '|' ORDER BY pos) FROM et WHERE et.event_id = e.event_id), '') AS topics
FROM e""")
def q_source_event_topic(spark, sf_dir):
    """S-03 + X-17: keyed camelCase JSON records read back with the typed
    schema (field names matched in any case)."""
    d = _scratch(spark, "topic")
    edits, _ = ad.load_edits(spark, sf_dir)
    to_topic_records(edits, "article_id").repartition(4).write.json(os.path.join(d, "t"))
    t = fd.read_topic(spark, os.path.join(d, "t"), S.EDIT_EVENTS)
    return t.select("key", "record.event_id", "record.article_id", "record.wiki",
                    F.date_format("record.ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
                    F.size("record.topics").alias("n_topics"),
                    F.array_join(F.transform("record.topics", lambda x: F.concat_ws(
                        "=", x["topic_id"].cast("string"), x["name"], x["path"])), "|").alias("topics"))


@register("json_event_codec", with_ctes(EDITS) + """
SELECT e.event_id, to_json({'eventId': e.event_id, 'wikiEditId': e.wiki_edit_id, 'title': e.title,
    'topics': [{'topicId': et.topic_id, 'topicName': et.name, 'topicPath': et.path}]}) AS json,
  e.wiki_edit_id AS parsed_wiki_edit_id, et.path AS parsed_path FROM e JOIN et ON e.event_id = et.event_id AND et.pos = 1""")
def q_json_event_codec(spark, sf_dir):
    """X-17: camelCase JSON without nulls, read back case-insensitively."""
    edits, _ = ad.load_edits(spark, sf_dir)
    first = F.transform(F.slice("topics", 1, 1), lambda x: F.struct(
        x["topic_id"].alias("topic_id"), x["name"].alias("name"), x["path"].alias("path"), F.lit(None).cast("float").alias("confidence")))
    rec = to_topic_records(edits.filter(F.size("topics") > 0).select("event_id", "wiki_edit_id", "title", first.alias("topics")), "event_id")
    odd = F.replace(F.replace("value", F.lit("wikiEditId"), F.lit("WikiEditID")), F.lit("topicPath"), F.lit("TOPICpath"))
    upper = rec.select("key", odd.alias("v2"), "value")
    schema = S.EDIT_EVENTS
    back = upper.select(F.col("key").alias("event_id"), F.col("value").alias("json"),
                        fd.parse_record("v2", schema).alias("r")).select(
        "event_id", "json", F.col("r.wiki_edit_id").alias("parsed_wiki_edit_id"), F.col("r.topics")[0]["path"].alias("parsed_path"))
    return back


@register("sink_baselines", with_ctes(EDITS, """
daily AS (SELECT topic_id, CAST(ts AS DATE) AS day, count(*) AS daily_count FROM et, clock WHERE eff >= as_of - to_days(30) GROUP BY 1, 2)""") + """
SELECT topic_id, round(CAST(CAST(avg(daily_count) AS FLOAT) AS DOUBLE), 4) AS baseline_daily FROM daily GROUP BY topic_id""")
def q_sink_baselines(spark, sf_dir):
    """S-07: two appended baseline versions (7-day and 30-day lookback, the
    second written later); the reader keeps the newest per topic."""
    import datetime as dt
    d = _scratch(spark, "baselines")
    edits, as_of = ad.load_edits(spark, sf_dir)
    earlier = (dt.datetime.strptime(as_of, "%Y-%m-%d %H:%M:%S") - dt.timedelta(hours=1)).strftime("%Y-%m-%d %H:%M:%S")
    old = tr.recalculate_baselines(edits, as_of, 7).withColumn("calculated_at", ad.ts_lit(earlier))
    write_baselines(old, os.path.join(d, "b"))
    write_baselines(tr.recalculate_baselines(edits, as_of, 30), os.path.join(d, "b"))
    b = tr.latest_baseline(spark.read.parquet(os.path.join(d, "b")))
    return b.select("topic_id", F.round(F.col("baseline_daily").cast("double"), 4).alias("baseline_daily"))


@register("sink_trend_snapshot", with_ctes(EDITS) + ", report AS (" + TRENDS_REPORT_SQL + ")" + """
SELECT DISTINCT period, topic_id, edit_count FROM report""")
def q_sink_trend_snapshot(spark, sf_dir):
    """S-08: one snapshot per period; rewriting one period replaces only
    that period (dynamic partition overwrite)."""
    from editsurge.operators import snapshots as sn
    d = _scratch(spark, "snapshot")
    edits, as_of = ad.load_edits(spark, sf_dir)
    upd = sn.snapshot_rows(tr.trend_updates(edits, as_of))
    write_trend_snapshot(upd, os.path.join(d, "s"))
    write_trend_snapshot(upd.filter(F.col("period") == "LastHour"), os.path.join(d, "s"))
    s = spark.read.parquet(os.path.join(d, "s"))
    return s.select("period", F.explode("topics").alias("t")).select("period", "t.topic_id", "t.edit_count")


def _page_bodies(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    pages = read_table(spark, sf_dir, "pages", "page_id", "html")
    resp = ad.page_responses_from_documents(docs, pages)
    k = F.col("page_id")
    page = F.struct(k.alias("pageid"), F.col("title"), F.col("extract"),
                    F.transform("raw_categories", lambda c: F.struct(c.alias("title"))).alias("categories"),
                    F.transform("raw_links", lambda c: F.struct(c.alias("title"))).alias("links"))
    missing = F.struct(F.col("title"), F.lit("").alias("missing"))
    body = (F.when(k % 25 == 0, F.to_json(F.struct(F.struct(F.create_map().cast("map<string,string>").alias("pages")).alias("query"))))
             .when(k % 10 == 0, F.to_json(F.struct(F.struct(F.create_map(F.lit("-1"), missing).alias("pages")).alias("query"))))
             .otherwise(F.to_json(F.struct(F.struct(F.create_map(k.cast("string"), page).alias("pages")).alias("query")))))
    return resp.select("page_id", "title", body.alias("body"))


@register("parse_page_response", """
WITH links AS (SELECT page_id, regexp_extract_all(html, 'href="/([^"]*)"', 1) AS links FROM pages)
SELECT d.doc_id AS page_key,
  CASE WHEN d.doc_id % 25 = 0 THEN 'No pages in response' WHEN d.doc_id % 10 = 0 THEN 'Page not found: Article ' || CAST(d.doc_id AS VARCHAR) END AS error,
  CASE WHEN d.doc_id % 10 <> 0 AND d.doc_id % 25 <> 0 THEN d.doc_id END AS page_id,
  CASE WHEN d.doc_id % 10 <> 0 AND d.doc_id % 25 <> 0 THEN md5(trim(d.text)) END AS extract_md5,
  CASE WHEN d.doc_id % 10 <> 0 AND d.doc_id % 25 <> 0 THEN [trim(regexp_replace((CASE d.lang WHEN 'de' THEN 'Kategorie:' WHEN 'fr' THEN 'Catégorie:' ELSE 'Category:' END) || d.source, '^(Category|Категория|Kategorie|Catégorie):', '', 'i')),
     trim(regexp_replace((CASE d.lang WHEN 'de' THEN 'Kategorie:' WHEN 'fr' THEN 'Catégorie:' ELSE 'Category:' END) || ' Lang ' || upper(d.lang), '^(Category|Категория|Kategorie|Catégorie):', '', 'i'))] END AS categories,
  CASE WHEN d.doc_id % 10 <> 0 AND d.doc_id % 25 <> 0 THEN len(list_filter(coalesce(l.links, []::VARCHAR[]), lambda x: x <> '')) END AS n_links
FROM documents d LEFT JOIN links l ON d.doc_id = l.page_id""")
def q_parse_page_response(spark, sf_dir):
    """X-18: page-API bodies (built from documents and pages, with missing
    and empty responses) parsed to page id, extract, categories, links."""
    src = _page_bodies(spark, sf_dir).withColumnRenamed("page_id", "page_key")
    p = rp.parse_page_response(src)
    return p.select("page_key", "error", "page_id", F.md5("extract").alias("extract_md5"), "categories",
                    F.when(F.col("linked_articles").isNotNull(), F.size("linked_articles")).alias("n_links"))


@register("parse_qid_response", """
SELECT c_custkey AS k, CASE c_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN NULL
  ELSE 'C' || CAST(c_custkey AS VARCHAR) END AS qid,
  CASE c_custkey % 10 WHEN 0 THEN 'Wikipedia page not found.' WHEN 1 THEN 'Wikipedia pageprops not found.'
    WHEN 2 THEN 'Wikipedia page does not have wikibase_item.' WHEN 3 THEN 'Wikipedia returned empty wikibase_item.'
    WHEN 4 THEN 'Wikipedia API response missing pages.' WHEN 5 THEN 'Wikipedia API returned no pages.' END AS error
FROM customer""")
def q_parse_qid_response(spark, sf_dir):
    """X-19: QID-API bodies built per customer, one error kind per key
    class, parsed to a qid or the matching error."""
    c = read_table(spark, sf_dir, "customer", "c_custkey")
    k = F.col("c_custkey")
    ks = k.cast("string")
    body = (F.when(k % 10 == 0, F.concat(F.lit('{"query":{"pages":{"-1":{"missing":""}}}}')))
             .when(k % 10 == 1, F.concat(F.lit('{"query":{"pages":{"'), ks, F.lit('":{"title":"x"}}}}')))
             .when(k % 10 == 2, F.concat(F.lit('{"query":{"pages":{"'), ks, F.lit('":{"pageprops":{}}}}}')))
             .when(k % 10 == 3, F.concat(F.lit('{"query":{"pages":{"'), ks, F.lit('":{"pageprops":{"wikibase_item":" "}}}}}')))
             .when(k % 10 == 4, F.lit('{"query":{}}'))
             .when(k % 10 == 5, F.lit('{"query":{"pages":{}}}'))
             .otherwise(F.concat(F.lit('{"query":{"pages":{"'), ks, F.lit('":{"pageprops":{"wikibase_item":"C'), ks, F.lit('"}}}}}'))))
    return rp.parse_qid_response(c.select(k.alias("k"), body.alias("body"))).select("k", "qid", "error")


@register("parse_class_bindings", """
WITH nat AS (SELECT n.n_nationkey, n.n_name, n.n_regionkey, coalesce(c.k, 0) AS k
             FROM nation n LEFT JOIN (SELECT c_nationkey, count(*) AS k FROM customer GROUP BY 1) c ON n.n_nationkey = c.c_nationkey)
SELECT n_regionkey AS region, 'N' || CAST(n_nationkey AS VARCHAR) AS qid, n_name AS label, CAST(k AS INTEGER) AS sitelinks FROM nat""")
def q_parse_class_bindings(spark, sf_dir):
    """X-20: one graph-query body per region (its nations as bindings, plus
    a binding with a blank label and one with a trailing-slash URI, both
    dropped) parsed to (qid, label, sitelinks)."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    per = c.groupBy("c_nationkey").agg(F.count("*").alias("k"))
    nat = n.join(per, n.n_nationkey == per.c_nationkey, "left").withColumn("k", F.coalesce("k", F.lit(0)))

    def v(x):
        return F.struct(x.alias("value"))

    b = F.struct(v(F.concat(F.lit("http://www.wikidata.org/entity/N"), F.col("n_nationkey").cast("string"))).alias("class"),
                 v(F.col("n_name")).alias("classLabel"), v(F.col("k").cast("string")).alias("sitelinks"))
    junk = F.array(F.struct(v(F.lit("http://www.wikidata.org/entity/Q1")).alias("class"), v(F.lit(" ")).alias("classLabel"),
                            v(F.lit("7")).alias("sitelinks")),
                   F.struct(v(F.lit("http://www.wikidata.org/entity/")).alias("class"), v(F.lit("x")).alias("classLabel"),
                            v(F.lit("9")).alias("sitelinks")))
    # A region holds a handful of nations: the per-region list is bounded.
    bodies = (nat.groupBy("n_regionkey").agg(F.collect_list(b).alias("bs"))
                 .select(F.col("n_regionkey").alias("region"),
                         F.to_json(F.struct(F.struct(F.concat("bs", junk).alias("bindings")).alias("results"))).alias("body")))
    return rp.parse_class_bindings(bodies).select("region", "qid", "label", "sitelinks")


@register("parse_instance_of", """
SELECT c_custkey AS k,
  CASE WHEN c_custkey % 9 = 0 THEN 'Entity not found for title ''' || c_name || ''' on ''enwiki''.' END AS error,
  CASE WHEN c_custkey % 9 <> 0 THEN 'C' || CAST(c_custkey AS VARCHAR) END AS entity_id,
  CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 9 = 1 THEN c_name ELSE 'label ' || c_name END AS label,
  CASE WHEN c_custkey % 9 <> 0 THEN ['N' || CAST(c_nationkey AS VARCHAR)] END AS instance_of,
  CASE WHEN c_custkey % 9 <> 0 THEN ['P31', 'P17'] END AS claims
FROM customer""")
def q_parse_instance_of(spark, sf_dir):
    """X-21: entity bodies per customer (every 9th a '-1' entity, every
    9th + 1 without labels) parsed to label, P31 ids and claim names."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    k = F.col("c_custkey")
    claim = lambda x: F.struct(F.struct(F.struct(F.struct(x.alias("id")).alias("value")).alias("datavalue")).alias("mainsnak"))
    claims = F.create_map(F.lit("P31"), F.array(claim(F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))), claim(F.lit(" "))),
                          F.lit("P17"), F.array(claim(F.lit("Q1"))))
    labels = F.when(k % 9 != 1, F.create_map(F.lit("en"), F.struct(F.concat(F.lit("label "), F.col("c_name")).alias("value"))))
    ent = F.struct(labels.alias("labels"), claims.alias("claims"))
    body = (F.when(k % 9 == 0, F.lit('{"entities":{"-1":{"missing":""}}}'))
             .otherwise(F.to_json(F.struct(F.create_map(F.concat(F.lit("C"), k.cast("string")), ent).alias("entities")))))
    src = c.select(k.alias("k"), F.col("c_name").alias("title"), F.lit("enwiki").alias("wiki"), F.lit("en").alias("lang"),
                   body.alias("body"))
    return rp.parse_instance_of(src).select("k", "error", "entity_id", "label", "instance_of", "claims")
