"""DuckDB SQL that repeats the fixture adapters (FIXTURES.md section 3).

These strings are the oracle side of the correctness check only; the engine
itself never runs them.
"""

# edits: ev -> e (one row per edit) -> et (one row per (edit, topic entry)).
EDITS = r"""
ev AS (
  SELECT event_id AS n, user_id, event_type, value, date_trunc('second', ts) AS ts FROM events
),
clock AS (SELECT max(ts) AS as_of FROM ev),
e AS (
  SELECT 'evt-' || CAST(n AS VARCHAR) AS event_id, n AS wiki_edit_id, n % 97 + 1 AS article_id,
         'Article ' || CAST(n % 97 + 1 AS VARCHAR) AS title,
         CASE user_id % 3 WHEN 0 THEN 'enwiki' WHEN 1 THEN 'ruwiki' ELSE 'dewiki' END AS wiki,
         'user-' || CAST(user_id AS VARCHAR) AS "user",
         ts, ts + to_minutes(CAST((n % 11) * 10 AS BIGINT)) AS classified_at, n,
         CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
              WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS INTEGER) AS tid1,
         CAST(n % 5 + 1 AS INTEGER) AS tid2
  FROM ev
),
et0 AS (
  SELECT e.*, tid1 AS topic_id, 1 AS pos FROM e WHERE n % 50 <> 0
  UNION ALL SELECT e.*, tid2 AS topic_id, 2 AS pos FROM e WHERE n % 50 <> 0 AND n % 4 = 0
  UNION ALL SELECT e.*, tid1 AS topic_id, 3 AS pos FROM e WHERE n % 50 <> 0 AND n % 101 = 0
),
et AS (
  SELECT et0.*, greatest(ts, classified_at) AS eff,
    CASE WHEN n % 7 = 0 THEN 'topic ' || CAST(topic_id AS VARCHAR) WHEN n % 11 = 0 THEN ''
         ELSE ['click','error','purchase','signup','view'][topic_id] END AS name,
    CASE WHEN n % 5 = 0 THEN 'topic-' || CAST(topic_id AS VARCHAR)
         ELSE (CASE WHEN topic_id % 2 = 1 THEN 'Activity > ' ELSE 'Lifecycle > ' END)
              || ['click','error','purchase','signup','view'][topic_id] END AS path,
    CAST(CASE n % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 ELSE 0.1 END AS FLOAT) AS confidence
  FROM et0
),
periods(period, hours) AS (VALUES ('LastHour', 1), ('Last24Hours', 24), ('Last7Days', 168))
"""

# trend counts per (period, topic) on the effective time.
COUNTS = r"""
counts AS (
  SELECT p.period, et.topic_id, CAST(count(*) AS INTEGER) AS edit_count
  FROM et, clock, periods p
  WHERE et.eff >= clock.as_of - to_hours(p.hours)
  GROUP BY p.period, et.topic_id
)
"""

BASELINES = r"""
daily AS (
  SELECT topic_id, CAST(ts AS DATE) AS day, count(*) AS daily_count
  FROM et, clock WHERE eff >= as_of - to_days({days}) GROUP BY 1, 2
),
bl AS (SELECT topic_id, CAST(avg(daily_count) AS FLOAT) AS baseline_daily FROM daily GROUP BY 1)
"""

# name/path filters of the topic-info query.
NAME_OK = r"name <> '' AND NOT regexp_matches(lower(name), '^topic\s*\d+$') AND NOT regexp_matches(lower(name), '^topic\d+$')"
PATH_OK = r"path <> '' AND NOT regexp_matches(lower(path), '^topic-\d+$')"

INFO = r"""
info AS (
  SELECT topic_id,
    coalesce((max({{'e': eff, 'v': name}}) FILTER (WHERE """ + NAME_OK + r""")).v, '') AS name,
    coalesce((max({{'e': eff, 'v': path}}) FILTER (WHERE """ + PATH_OK + r""")).v, '') AS path
  FROM et WHERE topic_id IN (SELECT topic_id FROM {ids}) GROUP BY topic_id
)
"""

# per (period, topic, article) counts on ts alone; one count per (edit, topic).
ARTICLE_COUNTS = r"""
et_distinct AS (SELECT DISTINCT event_id, article_id, title, ts, topic_id FROM et),
ac AS (
  SELECT p.period, x.topic_id, x.article_id, min(x.title) AS title, CAST(count(*) AS INTEGER) AS edits
  FROM et_distinct x, clock, periods p
  WHERE x.ts >= clock.as_of - to_hours(p.hours)
  GROUP BY 1, 2, 3
)
"""


def anomaly_sql(src: str) -> str:
    """A-04 in SQL over a relation with period, edit_count, baseline_daily."""
    return rf"""
  SELECT s.*,
    CAST(CASE WHEN expected < 0.0001 AND actual < 0.0001 THEN 0.0 WHEN expected < 0.0001 THEN actual
              ELSE (actual - expected) / sqrt(expected) END AS FLOAT) AS anomaly_score,
    CAST(CASE WHEN expected < 0.0001 AND actual < 0.0001 THEN 0.0 WHEN expected < 0.0001 THEN 1.0
              ELSE (actual - expected) / expected END AS FLOAT) AS change_percent
  FROM (SELECT {src}.*,
          CASE period WHEN 'LastHour' THEN CAST(baseline_daily AS DOUBLE) / 24.0
                      WHEN 'Last7Days' THEN CAST(baseline_daily AS DOUBLE) * 7.0
                      ELSE CAST(baseline_daily AS DOUBLE) END AS expected,
          CAST(edit_count AS DOUBLE) AS actual
        FROM {src}) s
"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)

# recent changes (FIXTURES 3.2) and the raw edits F-01 + F-02 keep.
RECENT = r"""
ev_raw AS (SELECT event_id AS n, user_id, event_type, value, ts FROM events),
clock AS (SELECT max(date_trunc('second', ts)) AS as_of FROM events),
rc AS (
  SELECT n AS src_n, CASE WHEN n % 40 = 0 THEN NULL ELSE n END AS id,
    CASE WHEN n % 10 <= 6 THEN 'edit' WHEN n % 10 = 7 THEN 'EDIT' WHEN n % 10 = 8 THEN 'new' ELSE NULL END AS type,
    CASE WHEN n % 6 = 0 THEN 1 ELSE 0 END AS namespace,
    'Article ' || CAST(n % 97 + 1 AS VARCHAR) AS title, 'user-' || CAST(user_id AS VARCHAR) AS "user",
    user_id % 10 = 0 AS bot, n % 3 = 0 AS minor,
    CAST(n % 5000 AS INTEGER) AS len_old, CAST(n % 5000 AS INTEGER) + CAST(floor(value) AS INTEGER) AS len_new,
    CASE WHEN n % 33 = 0 THEN '' ELSE CASE user_id % 3 WHEN 0 THEN 'enwiki' WHEN 1 THEN 'ruwiki' ELSE 'dewiki' END END AS wiki,
    CASE WHEN n % 2 = 0 THEN epoch_us(ts) // 1000000 ELSE epoch_us(ts) // 1000 END AS "timestamp",
    CASE WHEN n % 9 = 0 THEN NULL ELSE n % 97 + 1 END AS page_id
  FROM ev_raw
),
rcr AS (
  SELECT rc.*, CASE
    WHEN id IS NULL OR title IS NULL OR "user" IS NULL THEN 'missing_field'
    WHEN wiki IS NULL OR trim(wiki) = '' OR lower(wiki) NOT IN ('enwiki', 'ruwiki') THEN 'wiki_not_allowed'
    WHEN type IS NOT NULL AND lower(type) NOT IN ('edit') THEN 'type_not_allowed'
    WHEN coalesce(namespace, 0) NOT IN (0) THEN 'namespace_not_allowed' END AS reason
  FROM rc
),
mapped AS (
  SELECT sha256(concat_ws(':', wiki, CAST(id AS VARCHAR))) AS event_id, id AS wiki_edit_id,
    coalesce(page_id, 0) AS page_id, title, wiki, "user",
    coalesce(bot, false) AS is_bot, coalesce(minor, false) AS is_minor, coalesce(type = 'new', false) AS is_new,
    coalesce(len_old, 0) AS old_length, coalesce(len_new, 0) AS new_length,
    CASE WHEN "timestamp" > 10000000000 THEN TIMESTAMP '1970-01-01' + to_milliseconds("timestamp")
         ELSE TIMESTAMP '1970-01-01' + to_seconds("timestamp") END AS "timestamp",
    reason
  FROM rcr
),
raw AS (SELECT * EXCLUDE (reason) FROM mapped WHERE reason IS NULL)
"""

CLEAN_CAT = r"trim(regexp_replace({c}, '^(Category|Категория|Kategorie|Catégorie):', '', 'i'))"
PREFIX = "CASE lang WHEN 'de' THEN 'Kategorie:' WHEN 'fr' THEN 'Catégorie:' ELSE 'Category:' END"

DIMS = r"""
art AS (
  SELECT doc_id AS article_id, lang || 'wiki' AS wiki, doc_id AS page_id, 'Doc ' || CAST(doc_id AS VARCHAR) AS title,
    substring(text, 1, 4000) AS extract, clock.as_of - to_hours(CAST(doc_id % 9 AS BIGINT)) AS last_enriched_at
  FROM documents, clock
),
stored_cats AS (
  SELECT doc_id AS article_id, """ + CLEAN_CAT.format(c="raw") + r""" AS name FROM (
    SELECT doc_id, unnest(CASE WHEN doc_id % 4 = 0 THEN [""" + PREFIX + r""" || source, 'Legacy'] ELSE [""" + PREFIX + r""" || source] END) AS raw
    FROM documents)
),
links AS (SELECT page_id, regexp_extract_all(html, 'href="/([^"]*)"', 1) AS links FROM pages),
resp AS (
  SELECT d.lang || 'wiki' AS wiki, 'Article ' || CAST(d.doc_id AS VARCHAR) AS title, d.doc_id AS r_page_id,
    trim(d.text) AS r_extract,
    list_transform(list_filter([""" + PREFIX.replace("lang", "d.lang") + r""" || d.source, """ + PREFIX.replace("lang", "d.lang") + r""" || ' Lang ' || upper(d.lang)],
                   lambda c: c IS NOT NULL AND c <> ''), lambda c: """ + CLEAN_CAT.format(c="c") + r""") AS r_categories,
    list_filter(coalesce(l.links, []::VARCHAR[]), lambda x: x IS NOT NULL AND x <> '') AS r_links
  FROM documents d LEFT JOIN links l ON d.doc_id = l.page_id
)
"""

REFRESH = r"""
j AS (
  SELECT raw.*, art.article_id AS a_article_id, art.title AS a_title, art.extract AS a_extract, art.last_enriched_at AS a_last
  FROM raw LEFT JOIN art ON raw.wiki = art.wiki AND raw.page_id = art.page_id AND raw.page_id > 0
),
j2 AS (SELECT j.*, (a_article_id IS NULL OR a_last < clock.as_of - to_hours(4)) AS stale FROM j, clock),
firsts AS (SELECT wiki, page_id, min({'t': "timestamp", 'e': event_id}) AS f FROM j2 WHERE stale AND page_id > 0 GROUP BY 1, 2),
j3 AS (
  SELECT j2.*, stale AND (j2.page_id <= 0 OR firsts.f IS NULL OR {'t': j2."timestamp", 'e': j2.event_id} = firsts.f) AS calls
  FROM j2 LEFT JOIN firsts ON j2.wiki = firsts.wiki AND j2.page_id = firsts.page_id
),
r0 AS (SELECT j3.*, resp.r_page_id, resp.r_extract, resp.r_categories, resp.r_links
       FROM j3 LEFT JOIN resp ON j3.wiki = resp.wiki AND j3.title = resp.title),
r AS (
  SELECT r0.*,
    CASE WHEN page_id > 0 THEN page_id ELSE coalesce(r_page_id, 0) END AS resolved_page_id,
    CASE WHEN stale AND r_page_id IS NULL THEN 'Page not found: ' || title
         WHEN stale AND (CASE WHEN page_id > 0 THEN page_id ELSE coalesce(r_page_id, 0) END) <= 0 THEN 'Wikipedia API did not return valid PageId' END AS error,
    CASE WHEN stale THEN title ELSE a_title END AS article_title,
    CASE WHEN stale THEN (CASE WHEN r_extract IS NULL OR r_extract = '' THEN r_extract ELSE substring(r_extract, 1, 4000) END) ELSE a_extract END AS article_extract,
    CASE WHEN calls THEN r_links ELSE []::VARCHAR[] END AS linked_articles
  FROM r0
),
newa AS (
  SELECT wiki, resolved_page_id AS page_id,
    arg_max({'title': article_title, 'extract': article_extract}, {'t': "timestamp", 'e': event_id}) AS v
  FROM r WHERE stale AND error IS NULL GROUP BY 1, 2
),
m AS (SELECT art.article_id AS o_id, art.wiki AS o_wiki, art.page_id AS o_page_id, art.title AS o_title, art.extract AS o_extract,
             art.last_enriched_at AS o_last, newa.wiki, newa.page_id, newa.v.title AS title, newa.v.extract AS extract
      FROM art FULL OUTER JOIN newa ON art.wiki = newa.wiki AND art.page_id = newa.page_id),
ups AS (
  SELECT o_id AS article_id, o_wiki AS wiki, o_page_id AS page_id, coalesce(title, o_title) AS title,
    CASE WHEN wiki IS NOT NULL THEN extract ELSE o_extract END AS extract,
    CASE WHEN wiki IS NOT NULL THEN (SELECT as_of FROM clock) ELSE o_last END AS last_enriched_at
  FROM m WHERE o_id IS NOT NULL
  UNION ALL
  SELECT (SELECT max(article_id) FROM art) + row_number() OVER (ORDER BY wiki, page_id) AS article_id, wiki, page_id, title, extract,
    (SELECT as_of FROM clock) AS last_enriched_at
  FROM m WHERE o_id IS NULL
),
incoming AS (
  SELECT ups.article_id, unnest(r.r_categories) AS name
  FROM r JOIN ups ON r.wiki = ups.wiki AND r.resolved_page_id = ups.page_id WHERE r.calls AND r.error IS NULL
),
inc AS (SELECT DISTINCT article_id, name FROM incoming WHERE trim(name) <> ''),
new_cats AS (
  SELECT article_id, name FROM stored_cats WHERE article_id NOT IN (SELECT article_id FROM inc)
  UNION ALL SELECT article_id, name FROM inc
)
"""

GRAPH = r"""
cust AS (SELECT c_custkey AS k, c_nationkey AS nk, c_name FROM customer),
edges AS (
  SELECT 'C' || CAST(k AS VARCHAR) AS child, 'P31' AS prop, 'Q5' AS parent, 1 AS pos FROM cust WHERE k % 7 = 0
  UNION ALL SELECT 'C' || CAST(k AS VARCHAR), 'P106', 'N' || CAST(nk AS VARCHAR), 1 FROM cust WHERE k % 7 = 0 AND k % 14 <> 0
  UNION ALL SELECT 'C' || CAST(k AS VARCHAR), 'P31', 'N' || CAST(nk AS VARCHAR), 1 FROM cust WHERE k % 7 <> 0
  UNION ALL SELECT 'C' || CAST(k AS VARCHAR), 'P31', 'n' || CAST(nk AS VARCHAR), 2 FROM cust WHERE k % 11 = 0
  UNION ALL SELECT 'C' || CAST(k AS VARCHAR), 'P31', 'Q' || CAST(k % 4 + 100 AS VARCHAR), CASE WHEN k % 22 = 0 THEN 0 ELSE 3 END FROM cust WHERE k % 11 = 0
  UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR), 'P279', 'R' || CAST(n_regionkey AS VARCHAR), 1 FROM nation
  UNION ALL SELECT 'R' || CAST(r_regionkey AS VARCHAR), 'P279', 'ROOT', 1 FROM region
  UNION ALL SELECT 'ROOT', 'P279', 'R0', 1
),
nat AS (SELECT n.n_nationkey, n.n_name, n.n_regionkey, coalesce(c.k, 0) AS k
        FROM nation n LEFT JOIN (SELECT nk, count(*) AS k FROM cust GROUP BY nk) c ON n.n_nationkey = c.nk),
nodes AS (
  SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS qid, n_name AS label, CAST(k AS INTEGER) AS sitelinks FROM nat
  UNION ALL SELECT 'R' || CAST(r.r_regionkey AS VARCHAR), r.r_name, CAST(coalesce(s.k, 0) AS INTEGER)
    FROM region r LEFT JOIN (SELECT n_regionkey, sum(k) AS k FROM nat GROUP BY 1) s ON r.r_regionkey = s.n_regionkey
  UNION ALL SELECT 'ROOT', 'World', CAST(count(*) AS INTEGER) FROM cust
  UNION ALL SELECT 'Q5', 'human', CAST(count(*) FILTER (WHERE k % 7 = 0) AS INTEGER) FROM cust
),
labels AS (SELECT qid AS id, 'en' AS lang, label FROM nodes
  UNION ALL SELECT qid, 'de', '(de) ' || label FROM nodes WHERE regexp_matches(qid, '^[NR][0-9]')),
sub AS (SELECT DISTINCT child, parent FROM edges WHERE prop = 'P279'),
classes AS (SELECT child AS c FROM sub UNION SELECT parent FROM sub UNION SELECT parent FROM edges WHERE prop IN ('P31', 'P106')),
closure(cls, anc) AS (SELECT c, c FROM classes UNION SELECT closure.cls, sub.parent FROM closure JOIN sub ON closure.anc = sub.child),
clock AS (SELECT max(date_trunc('second', ts)) AS as_of FROM events),
pages_of AS (SELECT k, c_name, CASE WHEN k % 9 = 0 THEN 'de' ELSE 'en' END AS lang FROM cust),
mapping AS (SELECT lang || 'wiki' AS wiki, c_name AS title, CASE WHEN k % 10 = 0 THEN NULL ELSE 'C' || CAST(k AS VARCHAR) END AS qid,
                   clock.as_of - to_minutes(CAST(k % 120 AS BIGINT)) AS cached_at FROM pages_of, clock WHERE k % 19 <> 0),
arts AS (SELECT k AS article_id, c_name AS title, lang FROM pages_of),
answers AS (SELECT lang || 'wiki' AS wiki, c_name AS title, CASE WHEN k % 3 = 0 THEN 'C' || CAST(k AS VARCHAR) END AS qid,
  CASE k % 3 WHEN 1 THEN 'none' WHEN 2 THEN 'broken' END AS error FROM pages_of),
entities AS (SELECT lang || 'wiki' AS wiki, c_name AS title, 'C' || CAST(k AS VARCHAR) AS qid FROM pages_of WHERE k % 5 <> 0),
q AS (
  SELECT arts.*, m.qid, m.cached_at, CASE WHEN m.wiki IS NULL THEN 'missing' WHEN m.qid IS NOT NULL THEN 'hit'
    WHEN m.cached_at >= (SELECT as_of FROM clock) - to_hours(1) THEN 'negative' ELSE 'expired' END AS qid_state
  FROM arts LEFT JOIN mapping m ON lower(trim(arts.lang)) || 'wiki' = m.wiki AND trim(arts.title) = m.title
),
checked AS (
  SELECT q.article_id, q.title, q.lang, q.lang || 'wiki' AS wiki, coalesce(q.qid, a.qid) AS qid, q.qid_state, a.qid AS found_qid, a.error
  FROM q LEFT JOIN answers a ON q.qid_state IN ('missing', 'expired') AND q.lang || 'wiki' = a.wiki AND trim(q.title) = a.title
),
items AS (SELECT DISTINCT qid, lang FROM {source} WHERE qid IS NOT NULL AND qid_state <> 'negative'),
humans AS (SELECT DISTINCT child AS qid FROM edges WHERE prop = 'P31' AND parent = 'Q5' AND child IN (SELECT qid FROM items)),
starts AS (
  SELECT DISTINCT h.qid, coalesce(p.parent, 'Q5') AS start FROM humans h LEFT JOIN edges p ON p.child = h.qid AND p.prop = 'P106'
  UNION SELECT DISTINCT e.child, e.parent FROM edges e
    WHERE e.prop = 'P31' AND e.child IN (SELECT qid FROM items) AND e.child NOT IN (SELECT qid FROM humans)
),
reach AS (SELECT s.qid, s.start, c.anc AS class FROM starts s JOIN closure c ON s.start = c.cls),
hier AS (
  SELECT * FROM (SELECT r.qid, r.start, r.class, coalesce(l.label, r.class) AS label, n.sitelinks,
    row_number() OVER (PARTITION BY r.qid ORDER BY n.sitelinks, r.class, r.start) AS pos
    FROM reach r JOIN nodes n ON r.class = n.qid JOIN items i ON i.qid = r.qid
    LEFT JOIN labels l ON l.id = r.class AND l.lang = i.lang WHERE n.sitelinks >= {min_sitelinks}) WHERE pos <= 250
),
hl AS (SELECT qid, list({{'pos': pos, 'label': label, 'sitelinks': sitelinks}} ORDER BY pos) AS xs
       FROM hier WHERE label IS NOT NULL AND trim(label) <> '' GROUP BY qid),
hr AS (SELECT qid, xs, coalesce(nullif(list_position(list_transform(xs, lambda x: x.sitelinks >= 50), true), 0), len(xs)) AS root FROM hl),
roots AS (SELECT qid, xs[root].label AS name,
                 array_to_string(list_reverse(list_transform(xs[1:root], lambda x: x.label)), ' > ') AS path FROM hr)
"""

TOPIC_FIX = r"""
topics AS (SELECT * FROM (VALUES (1, 'Science', 'Root/Science'), (2, 'Technology', 'Root/Technology'),
  (3, 'Politics', 'Root/Politics'), (4, 'Business', 'Root/Business'), (5, 'Sports', 'Root/Sports')) t(topic_id, name, path)),
atl AS (
  SELECT k AS article_id, CAST(k % 7 + 1 AS INTEGER) AS topic_id, CAST(0.9 AS FLOAT) AS confidence FROM cust WHERE k % 3 <> 0 AND k % 2 = 0
  UNION ALL SELECT k, CAST(k % 5 + 1 AS INTEGER), CAST(0.4 AS FLOAT) FROM cust WHERE k % 3 <> 0 AND k % 2 = 0
  UNION ALL SELECT k, 99, CAST(0.95 AS FLOAT) FROM cust WHERE k % 3 <> 0 AND k % 2 <> 0
),
stored AS (
  SELECT article_id, topic_id, name, path, confidence FROM (
    SELECT atl.article_id, atl.topic_id, t.name, t.path, atl.confidence,
      row_number() OVER (PARTITION BY atl.article_id ORDER BY atl.confidence DESC, atl.topic_id) AS rk
    FROM atl JOIN topics t ON atl.topic_id = t.topic_id) WHERE rk = 1
),
looked AS (SELECT c.*, e.qid AS entity FROM checked c LEFT JOIN entities e ON c.wiki = e.wiki AND trim(c.title) = e.title),
api AS (
  SELECT q2.qid, q2.lang, min({{'pos': e.pos, 'class': e.parent, 'label': l.label}}).label AS name
  FROM (SELECT DISTINCT entity AS qid, lang FROM looked WHERE qid_state <> 'negative' AND entity IS NOT NULL) q2
  JOIN edges e ON e.child = q2.qid AND e.prop = 'P31'
  JOIN labels l ON l.id = e.parent AND l.lang = q2.lang
  WHERE l.label IS NOT NULL AND trim(l.label) <> '' GROUP BY 1, 2
),
resolved AS (
  SELECT q.article_id,
    CASE WHEN s.article_id IS NOT NULL THEN s.name WHEN q.qid_state = 'negative' THEN 'Uncategorized'
         WHEN roots.qid IS NOT NULL THEN roots.name WHEN api.name IS NOT NULL THEN api.name ELSE 'Uncategorized' END AS name,
    CASE WHEN s.article_id IS NOT NULL THEN s.path WHEN q.qid_state = 'negative' THEN 'Uncategorized'
         WHEN roots.qid IS NOT NULL THEN roots.path WHEN api.name IS NOT NULL THEN api.name ELSE 'Uncategorized' END AS path,
    CASE WHEN s.article_id IS NOT NULL THEN CAST(s.confidence AS DOUBLE) WHEN q.qid_state = 'negative' THEN 0.1
         WHEN roots.qid IS NOT NULL THEN 1.0 WHEN api.name IS NOT NULL THEN 0.5 ELSE 0.1 END AS confidence,
    CASE WHEN s.article_id IS NOT NULL THEN 'stored' WHEN q.qid_state = 'negative' THEN 'fallback'
         WHEN roots.qid IS NOT NULL THEN 'hierarchy' WHEN api.name IS NOT NULL THEN 'label' ELSE 'fallback' END AS resolution_source
  FROM looked q LEFT JOIN stored s ON q.article_id = s.article_id
  LEFT JOIN roots ON q.qid = roots.qid
  LEFT JOIN api ON q.entity = api.qid AND q.lang = api.lang
)
"""


def with_recursive(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(p.strip() for p in parts)


# GRAPH without its own clock, for plans that already define one.
GRAPH_NO_CLOCK = GRAPH.replace("clock AS (SELECT max(date_trunc('second', ts)) AS as_of FROM events),\n", "")

# enriched edits (enr) and the resolved topics with their upserted ids (rt).
CLASSIFIED = """
inc2 AS (SELECT path, max(name) AS new_name FROM resolved GROUP BY path),
mt AS (SELECT t.topic_id, t.name, coalesce(t.path, inc2.path) AS path, inc2.new_name FROM topics t FULL OUTER JOIN inc2 ON t.path = inc2.path),
upt AS (SELECT topic_id, coalesce(new_name, name) AS name, path FROM mt WHERE topic_id IS NOT NULL
  UNION ALL SELECT (SELECT max(topic_id) FROM topics) + row_number() OVER (ORDER BY path), new_name, path FROM mt WHERE topic_id IS NULL),
rt AS (SELECT resolved.article_id, upt.topic_id, resolved.name, resolved.path, resolved.confidence FROM resolved JOIN upt ON resolved.path = upt.path),
enr AS (SELECT r.event_id, ups.article_id, ups.title, ups.wiki, r."timestamp" FROM r JOIN ups ON r.wiki = ups.wiki AND r.resolved_page_id = ups.page_id
        WHERE r.error IS NULL)
"""
