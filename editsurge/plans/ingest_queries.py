"""Registered ingest and enrichment queries (F-01..F-06, F-12, F-16, F-18,
J-02..J-06, J-09, X-01..X-05, S-01/S-02 parsing, U-02)."""

from __future__ import annotations

from pyspark.sql import functions as F

from editsurge.functions import scalar as X
from editsurge.operators import enrich as en
from editsurge.operators import ingest as ig
from editsurge.plans.oracle_ctes import DIMS, EDITS, RECENT, REFRESH, with_ctes
from editsurge.plans.registry import register
from editsurge.sources import adapters as ad
from editsurge.sources.tables import read_table

TS_FMT = "yyyy-MM-dd HH:mm:ss"


def _fmt(c, name=None):
    return F.date_format(c, TS_FMT).alias(name or c)


def _changes(spark, sf_dir):
    events = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return ad.recent_changes_from_events(events), ad.max_ts(events)


def _raw(spark, sf_dir):
    rc, as_of = _changes(spark, sf_dir)
    return ig.raw_edits(rc, as_of), as_of


def _dims(spark, sf_dir, as_of):
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    pages = read_table(spark, sf_dir, "pages", "page_id", "html")
    return (ad.articles_from_documents(docs, as_of), ad.stored_categories_from_documents(docs),
            ad.page_responses_from_documents(docs, pages))


def _enriched(spark, sf_dir):
    raw, as_of = _raw(spark, sf_dir)
    arts, cats, resp = _dims(spark, sf_dir, as_of)
    return en.enrich(raw, arts, cats, resp, as_of), raw, arts, cats, resp, as_of


@register("filter_recent_changes", with_ctes(RECENT) + """
SELECT id, wiki, type, namespace FROM rcr WHERE reason IS NULL""")
def q_filter_recent_changes(spark, sf_dir):
    """F-01: default filter (enwiki/ruwiki, namespace 0, type edit or null)."""
    rc, _ = _changes(spark, sf_dir)
    return ig.filter_changes(rc).select("id", "wiki", "type", "namespace")


@register("map_raw_edits", with_ctes(RECENT) + """
SELECT event_id, wiki_edit_id, page_id, title, wiki, "user", is_bot, is_minor, is_new, old_length, new_length,
  strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f') AS "timestamp" FROM raw""")
def q_map_raw_edits(spark, sf_dir):
    """F-02: kept changes projected to RawEdit rows."""
    raw, _ = _raw(spark, sf_dir)
    return raw.select("event_id", "wiki_edit_id", "page_id", "title", "wiki", "user", "is_bot", "is_minor",
                      "is_new", "old_length", "new_length",
                      F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"))


@register("rejected_changes_report", with_ctes(RECENT) + """
SELECT reason, count(*) AS rejected FROM rcr WHERE reason IS NOT NULL GROUP BY reason""")
def q_rejected_changes_report(spark, sf_dir):
    """F-03: rejects counted by first failing reason."""
    rc, _ = _changes(spark, sf_dir)
    return ig.rejected_changes_report(rc)


@register("parse_epoch", with_ctes(RECENT) + """
SELECT src_n, "timestamp" AS epoch,
  strftime(CASE WHEN "timestamp" > 10000000000 THEN TIMESTAMP '1970-01-01' + to_milliseconds("timestamp")
                ELSE TIMESTAMP '1970-01-01' + to_seconds("timestamp") END, '%Y-%m-%d %H:%M:%S.%f') AS ts
FROM rc""")
def q_parse_epoch(spark, sf_dir):
    """X-01: epoch seconds or milliseconds (> 10^10) to timestamps."""
    events = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    rc = ad.recent_changes_from_events(events).withColumn("src_n", F.col("revision.old"))
    return rc.select("src_n", F.col("timestamp").alias("epoch"),
                     F.date_format(X.parse_epoch("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@register("language_of_wiki", """
SELECT wiki, regexp_replace(wiki, 'wiki$', '', 'i') AS lang
FROM (SELECT DISTINCT lang || 'wiki' AS wiki FROM documents UNION SELECT 'ENWIKI' UNION SELECT 'wikidata')""")
def q_language_of_wiki(spark, sf_dir):
    """X-02: strip a final 'wiki' (any case) from each wiki code."""
    docs = read_table(spark, sf_dir, "documents", "lang")
    w = docs.select(F.concat("lang", F.lit("wiki")).alias("wiki")).distinct()
    extra = docs.sparkSession.createDataFrame([("ENWIKI",), ("wikidata",)], "wiki string")
    return w.union(extra).distinct().select("wiki", X.language_of_wiki("wiki").alias("lang"))


@register("diff_size", with_ctes(RECENT) + """
SELECT event_id, new_length - old_length AS diff_size FROM raw""")
def q_diff_size(spark, sf_dir):
    """X-05: new minus old length per raw edit."""
    raw, _ = _raw(spark, sf_dir)
    return raw.select("event_id", X.diff_size("new_length", "old_length").alias("diff_size"))


@register("incomplete_change_diagnostics", with_ctes(RECENT) + """
SELECT * FROM (SELECT id, page_id IS NOT NULL AS has_page_id, title IS NOT NULL AS has_title, "user" IS NOT NULL AS has_user,
  wiki IS NOT NULL AS has_wiki, type IS NOT NULL AS has_type FROM rc)
WHERE NOT (has_page_id AND has_title AND has_user AND has_wiki AND has_type)""")
def q_incomplete_change_diagnostics(spark, sf_dir):
    """F-12: JSON records missing one of the key fields, with flags."""
    rc, _ = _changes(spark, sf_dir)
    lines = rc.select(F.to_json(F.struct(*rc.columns)).alias("value"))
    return ig.field_presence(lines)


@register("valid_enrich_input", with_ctes(RECENT) + """
SELECT error, count(*) AS n FROM (
  SELECT CASE WHEN event_id IS NULL THEN 'Edit event is null' WHEN title IS NULL OR title = '' THEN 'Title is required'
              WHEN wiki IS NULL OR wiki = '' THEN 'Wiki is required' END AS error FROM mapped)
WHERE error IS NOT NULL GROUP BY error""")
def q_valid_enrich_input(spark, sf_dir):
    """F-05: enricher input checks over every mapped change."""
    rc, as_of = _changes(spark, sf_dir)
    m = ig.to_raw_edits(rc, as_of)
    _, bad = ig.split_errors(m, ig.enrich_input_error())
    return bad.groupBy("error").agg(F.count("*").alias("n"))


@register("valid_classify_input", with_ctes(RECENT) + """
SELECT error, count(*) AS n FROM (
  SELECT CASE WHEN wiki IS NULL OR trim(wiki) = '' OR title IS NULL OR trim(title) = '' THEN 'Edit event is missing required fields'
              WHEN page_id <= 0 THEN 'ArticleId must be positive'
              WHEN trim(regexp_replace(wiki, 'wiki$', '', 'i')) = '' THEN 'Lang cannot be empty' END AS error FROM mapped)
WHERE error IS NOT NULL GROUP BY error""")
def q_valid_classify_input(spark, sf_dir):
    """F-06: classifier input checks (article id = page id here)."""
    rc, as_of = _changes(spark, sf_dir)
    m = ig.to_raw_edits(rc, as_of).withColumn("article_id", F.col("page_id"))
    _, bad = ig.split_errors(m, ig.classify_input_error())
    return bad.groupBy("error").agg(F.count("*").alias("n"))


@register("enrich_join_article", with_ctes(RECENT, DIMS) + """
SELECT raw.event_id, raw.wiki, raw.page_id, art.article_id
FROM raw LEFT JOIN art ON raw.wiki = art.wiki AND raw.page_id = art.page_id AND raw.page_id > 0""")
def q_enrich_join_article(spark, sf_dir):
    """J-02: article lookup by (wiki, page_id) for page_id > 0."""
    raw, as_of = _raw(spark, sf_dir)
    arts, _, _ = _dims(spark, sf_dir, as_of)
    return en.join_articles(raw, arts).select("event_id", "wiki", "page_id", F.col("a_article_id").alias("article_id"))


@register("stale_articles", with_ctes(RECENT, DIMS) + """
SELECT raw.event_id, CASE WHEN art.article_id IS NULL THEN 'missing'
  WHEN art.last_enriched_at < clock.as_of - to_hours(4) THEN 'stale' ELSE 'fresh' END AS article_state
FROM raw LEFT JOIN art ON raw.wiki = art.wiki AND raw.page_id = art.page_id AND raw.page_id > 0, clock""")
def q_stale_articles(spark, sf_dir):
    """J-04: missing / stale (older than 4 h) / fresh per edit."""
    raw, as_of = _raw(spark, sf_dir)
    arts, _, _ = _dims(spark, sf_dir, as_of)
    return en.article_state(raw, arts, as_of).select("event_id", "article_state")


@register("refresh_articles", with_ctes(RECENT, DIMS, REFRESH) + """
SELECT event_id, resolved_page_id, error, calls, article_title, md5(article_extract) AS extract_md5,
  coalesce(len(linked_articles), 0) AS n_links FROM r""")
def q_refresh_articles(spark, sf_dir):
    """J-05: refresh outcome per edit (page id, error, links, article)."""
    raw, as_of = _raw(spark, sf_dir)
    arts, _, resp = _dims(spark, sf_dir, as_of)
    r = en.refresh(raw, arts, resp, as_of)
    return r.select("event_id", "resolved_page_id", "error", F.col("_calls").alias("calls"), "article_title",
                    F.md5("article_extract").alias("extract_md5"),
                    F.coalesce(F.size("linked_articles"), F.lit(0)).alias("n_links"))


@register("upsert_articles", with_ctes(RECENT, DIMS, REFRESH) + """
SELECT article_id, wiki, page_id, title, md5(extract) AS extract_md5,
  strftime(last_enriched_at, '%Y-%m-%d %H:%M:%S') AS last_enriched_at FROM ups""")
def q_upsert_articles(spark, sf_dir):
    """J-06: the article table after upserting the refreshed articles."""
    out, *_ = _enriched(spark, sf_dir)
    a = out["articles"]
    return a.select("article_id", "wiki", "page_id", "title", F.md5("extract").alias("extract_md5"),
                    _fmt("last_enriched_at"))


@register("replace_categories", with_ctes(RECENT, DIMS, REFRESH) + """
SELECT article_id, name, 'remove' AS change FROM (SELECT DISTINCT article_id, name FROM stored_cats
  WHERE article_id IN (SELECT article_id FROM inc)) o WHERE NOT EXISTS (SELECT 1 FROM inc WHERE inc.article_id = o.article_id AND inc.name = o.name)
UNION ALL
SELECT article_id, name, 'add' AS change FROM inc i WHERE NOT EXISTS (SELECT 1 FROM stored_cats s WHERE s.article_id = i.article_id AND s.name = i.name)""")
def q_replace_categories(spark, sf_dir):
    """J-09 + U-02: category names removed and added per refreshed article."""
    out, *_ = _enriched(spark, sf_dir)
    return out["category_delta"]


@register("category_set_difference", with_ctes(RECENT, DIMS, REFRESH) + """
SELECT article_id, list_sort(list(name)) AS names FROM new_cats GROUP BY article_id""")
def q_category_set_difference(spark, sf_dir):
    """U-02 applied: the category table after replacing the refreshed sets."""
    out, *_ = _enriched(spark, sf_dir)
    return out["categories"].groupBy("article_id").agg(F.array_sort(F.collect_list("name")).alias("names"))


@register("article_with_categories", with_ctes(RECENT, DIMS) + """
SELECT art.article_id, art.title, coalesce(c.names, []::VARCHAR[]) AS categories
FROM art LEFT JOIN (SELECT article_id, list_sort(list(DISTINCT name)) AS names FROM stored_cats GROUP BY article_id) c
ON art.article_id = c.article_id""")
def q_article_with_categories(spark, sf_dir):
    """J-03: each article with its sorted category names."""
    _, as_of = _changes(spark, sf_dir)
    arts, cats, _ = _dims(spark, sf_dir, as_of)
    return en.article_categories(arts, cats).select("article_id", "title", "categories")


@register("to_enriched_edits", with_ctes(RECENT, DIMS, REFRESH) + """
SELECT r.event_id, r.wiki_edit_id, ups.article_id, ups.page_id, ups.title, ups.wiki, md5(ups.extract) AS extract_md5,
  coalesce(c.names, []::VARCHAR[]) AS categories, coalesce(len(r.linked_articles), 0) AS n_links,
  r.new_length - r.old_length AS diff_size, r.is_bot, strftime(r."timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp"
FROM r JOIN ups ON r.wiki = ups.wiki AND r.resolved_page_id = ups.page_id
LEFT JOIN (SELECT article_id, list_sort(list(DISTINCT name)) AS names FROM new_cats GROUP BY article_id) c ON ups.article_id = c.article_id
WHERE r.error IS NULL""")
def q_to_enriched_edits(spark, sf_dir):
    """F-16: EnrichedEdit rows (article fields from the refreshed article)."""
    out, *_ = _enriched(spark, sf_dir)
    e = out["enriched"]
    return e.select("event_id", "wiki_edit_id", "article_id", "page_id", "title", "wiki",
                    F.md5("extract").alias("extract_md5"), "categories",
                    F.coalesce(F.size("linked_articles"), F.lit(0)).alias("n_links"), "diff_size", "is_bot",
                    _fmt("timestamp"))


@register("clean_category", """
SELECT raw, """ + "trim(regexp_replace(raw, '^(Category|Категория|Kategorie|Catégorie):', '', 'i'))" + """ AS name FROM (
  SELECT DISTINCT (CASE lang WHEN 'de' THEN 'Kategorie:' WHEN 'fr' THEN 'Catégorie:' ELSE 'Category:' END) || source AS raw FROM documents
  UNION SELECT 'category: X' UNION SELECT 'Категория:Наука' UNION SELECT 'КАТЕГОРИЯ:Наука' UNION SELECT ' Y ')""")
def q_clean_category(spark, sf_dir):
    """X-03: category prefix removal (any case, first match) and trim."""
    docs = read_table(spark, sf_dir, "documents", "lang", "source")
    pre = (F.when(F.col("lang") == "de", "Kategorie:").when(F.col("lang") == "fr", "Catégorie:").otherwise("Category:"))
    raw = docs.select(F.concat(pre, "source").alias("raw")).distinct()
    extra = docs.sparkSession.createDataFrame([("category: X",), ("Категория:Наука",), ("КАТЕГОРИЯ:Наука",), (" Y ",)], "raw string")
    return raw.union(extra).distinct().select("raw", X.clean_category("raw").alias("name"))


@register("truncate_extract", """
SELECT doc_id, length(CASE WHEN t IS NULL OR t = '' THEN t ELSE substring(t, 1, 4000) END) AS extract_len,
  md5(CASE WHEN t IS NULL OR t = '' THEN t ELSE substring(t, 1, 4000) END) AS extract_md5
FROM (SELECT doc_id, trim(text) AS t FROM documents)""")
def q_truncate_extract(spark, sf_dir):
    """X-04: trimmed extract cut to 4000 characters (whole documents read)."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    t = X.truncate_extract(F.trim("text"))
    return docs.select("doc_id", F.length(t).alias("extract_len"), F.md5(t).alias("extract_md5"))


@register("valid_classified_edits", with_ctes(EDITS) + """
SELECT count(*) AS valid FROM e WHERE event_id IS NOT NULL AND length(trim(event_id)) > 0""")
def q_valid_classified_edits(spark, sf_dir):
    """F-04: classified edits that pass the ingest checks."""
    from editsurge.sources.sinks import valid_edits
    edits, _ = ad.load_edits(spark, sf_dir)
    return valid_edits(edits).agg(F.count("*").alias("valid"))


@register("flatten_topic_columns", with_ctes(EDITS) + """
SELECT e.event_id, coalesce(t.ids, []::INTEGER[]) AS topic_ids, coalesce(t.names, []::VARCHAR[]) AS topic_names,
  coalesce(t.paths, []::VARCHAR[]) AS topic_paths
FROM e LEFT JOIN (SELECT event_id, list(topic_id ORDER BY pos) AS ids, list(name ORDER BY pos) AS names, list(path ORDER BY pos) AS paths
                  FROM et GROUP BY event_id) t ON e.event_id = t.event_id""")
def q_flatten_topic_columns(spark, sf_dir):
    """F-18: topic structs to parallel arrays (empty when none)."""
    from editsurge.sources.sinks import flatten_topic_columns
    edits, _ = ad.load_edits(spark, sf_dir)
    return flatten_topic_columns(edits).select("event_id", "topic_ids", "topic_names", "topic_paths")
