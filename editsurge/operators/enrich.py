"""Enrichment: article lookup, staleness, refresh from page responses,
article and category upserts, EnrichedEdit projection.

The reference enriches one message at a time with a database lookup and an
HTTP call per edit; here a batch of edits is joined with the article table
and with captured page responses, so the work is two equi-joins per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editsurge.functions.scalar import clean_category, diff_size, truncate_extract
from editsurge.operators.joins import skew_safe_lookup
from editsurge.session import ensure_checkpoint_dir
from editsurge.sources.adapters import ts_lit

# Refresh error texts (missing page: prefix + title; no page id).
PAGE_NOT_FOUND = "Page not found: "
NO_PAGE_ID = "Wikipedia API did not return valid PageId"

# Article cache age (hours, allowed 1..168) and extract size.
ARTICLE_CACHE_HOURS = 4
EXTRACT_MAX = 4000


def join_articles(edits: DataFrame, articles: DataFrame) -> DataFrame:
    """J-02: left lookup of the article by (wiki, page_id), only for
    page_id > 0.  Article columns are prefixed with ``a_``.

    Edits without a page id (the feed sends 0 when it is missing, possibly
    a large share of all edits) bypass the join instead of hashing to one
    shuffle key; they get null article columns and are unioned back."""
    articles = articles.select("article_id", "wiki", "page_id", "title", "extract", "last_enriched_at")
    has_page = F.coalesce(F.col("page_id") > 0, F.lit(False))
    keyed = edits.filter(has_page)
    # Only the articles this batch asks for, salted against hot pages
    # (skew_safe_lookup); the dimension is scanned, never shuffled whole.
    a = articles.select(*[F.col(c).alias(f"a_{c}") for c in articles.columns]) \
                .withColumnRenamed("a_wiki", "wiki").withColumnRenamed("a_page_id", "page_id")
    joined = (skew_safe_lookup(keyed, a, ["wiki", "page_id"])
              .withColumn("a_wiki", F.when(F.col("a_article_id").isNotNull(), F.col("wiki")))
              .withColumn("a_page_id", F.when(F.col("a_article_id").isNotNull(), F.col("page_id"))))
    nulls = [F.lit(None).cast(f.dataType).alias(f.name)
             for f in articles.select(*[F.col(c).alias(f"a_{c}") for c in articles.columns]).schema.fields]
    rest = edits.filter(~has_page).select("*", *nulls)
    return joined.unionByName(rest)


def needs_refresh(as_of: str, hours: int = ARTICLE_CACHE_HOURS):
    """J-04: no article, or last enriched before as_of - hours (1..168)."""
    h = min(168, max(1, int(hours)))
    limit = ts_lit(as_of) - F.expr(f"INTERVAL {h} HOURS")
    return F.col("a_article_id").isNull() | (F.col("a_last_enriched_at") < limit)


def article_state(edits: DataFrame, articles: DataFrame, as_of: str, hours: int = ARTICLE_CACHE_HOURS) -> DataFrame:
    """J-04 as a label per edit: missing / stale / fresh."""
    j = join_articles(edits, articles)
    state = (F.when(F.col("a_article_id").isNull(), "missing")
              .when(needs_refresh(as_of, hours), "stale").otherwise("fresh"))
    return j.withColumn("article_state", state)


def parse_page_responses(responses: DataFrame) -> DataFrame:
    """X-18 tail: trimmed extract, cleaned non-empty category names and
    non-empty link titles of each captured response."""
    return responses.select(
        "wiki", "title", F.col("page_id").alias("r_page_id"),
        F.trim("extract").alias("r_extract"),
        F.transform(F.filter("raw_categories", lambda c: c.isNotNull() & (c != "")), clean_category).alias("r_categories"),
        F.filter("raw_links", lambda x: x.isNotNull() & (x != "")).alias("r_links"))


def refresh(edits: DataFrame, articles: DataFrame, responses: DataFrame, as_of: str,
            hours: int = ARTICLE_CACHE_HOURS) -> DataFrame:
    """J-05: resolve every edit to (article fields, links, error).

    Only the first stale edit of an article (by time, then event id) in a
    batch calls the page source; later edits of it see the refreshed
    article as fresh and get no links, as when messages are handled one at
    a time.  Edits with page_id <= 0 cannot hit the table, so each of them
    refreshes.  Missing response -> 'Page not found: {title}'; page id still
    <= 0 -> 'Wikipedia API did not return valid PageId'.
    The first-edit test uses an aggregate joined back (no window), so a hot
    article is combined map side; only stale edits with a page id take part
    in that join, only stale edits look up responses, and fresh edits pass
    through without any shuffle.
    """
    j = join_articles(edits, articles).withColumn(
        "_stale", F.coalesce(needs_refresh(as_of, hours), F.lit(True)))
    has_page = F.coalesce(F.col("page_id") > 0, F.lit(False))
    keyed = j.filter(F.col("_stale") & has_page)
    first = (keyed.groupBy("wiki", "page_id")
                  .agg(F.min(F.struct("timestamp", "event_id")).alias("_first")))
    keyed = (keyed.join(first, ["wiki", "page_id"], "left")
                  .withColumn("_calls", F.struct("timestamp", "event_id") == F.col("_first")))
    first_type = first.schema["_first"].dataType
    unkeyed = (j.filter(F.col("_stale") & ~has_page)
                .withColumn("_first", F.lit(None).cast(first_type)).withColumn("_calls", F.lit(True)))
    r = parse_page_responses(responses)
    stale = skew_safe_lookup(keyed.unionByName(unkeyed), r, ["wiki", "title"])
    r_nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in r.schema.fields if f.name not in ("wiki", "title")]
    fresh = (j.filter(~F.col("_stale"))
              .withColumn("_first", F.lit(None).cast(first_type)).withColumn("_calls", F.lit(False))
              .select("*", *r_nulls))
    j = stale.unionByName(fresh)
    page_id = F.when(has_page, F.col("page_id")).otherwise(F.coalesce("r_page_id", F.lit(0).cast("long")))
    err = (F.when(F.col("_stale") & F.col("r_page_id").isNull(), F.concat(F.lit(PAGE_NOT_FOUND), F.col("title")))
            .when(F.col("_stale") & (page_id <= 0), F.lit(NO_PAGE_ID)))
    refreshed = F.col("_stale")
    no_links = F.array().cast("array<string>")
    return j.select(
        "*",
        page_id.alias("resolved_page_id"),
        err.alias("error"),
        F.when(refreshed, F.col("title")).otherwise(F.col("a_title")).alias("article_title"),
        F.when(refreshed, truncate_extract("r_extract", EXTRACT_MAX)).otherwise(F.col("a_extract")).alias("article_extract"),
        F.when(F.col("_calls"), F.coalesce(F.col("r_links"), no_links)).otherwise(no_links).alias("linked_articles"),
    )


def max_id(df: DataFrame, col: str) -> int:
    """Largest id of a table (one global aggregate; 0 when empty)."""
    row = df.agg(F.max(col).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


def number_rows(df: DataFrame, order: list[str], start: int, name: str) -> DataFrame:
    """Dense ids start+1, start+2, ... in ``order`` (keys unique).

    A distributed range sort, then ``monotonically_increasing_id`` (partition
    index in the upper bits, position in the lower ones), then per-partition
    offsets from a table of partition sizes.  That table has one row per
    partition, which bounds both its window and its broadcast.  No single
    task sees all rows and no row goes through Python."""
    from pyspark.sql import Window
    ensure_checkpoint_dir(df.sparkSession)
    # written once: both uses below must see one partition layout
    o = (df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()).checkpoint()
           .withColumn("_p", F.shiftright("_m", 33))
           .withColumn("_i", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = o.groupBy("_p").agg(F.count("*").alias("_n"))
    offs = sizes.select("_p", F.coalesce(F.sum("_n").over(
        Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    out = o.join(F.broadcast(offs), "_p")
    ident = (F.lit(int(start)) + F.col("_off") + F.col("_i") + 1).cast("long").alias(name)
    return out.select(ident, *df.columns)


ARTICLE_COLS = ["article_id", "wiki", "page_id", "title", "extract", "last_enriched_at"]


def article_delta(articles: DataFrame, refreshed: DataFrame, as_of: str) -> DataFrame:
    """J-06 delta: the rows a batch changes.  Refreshed keys that exist keep
    their id and take the new title, extract and last_enriched_at; new keys
    get ids max(id) + 1, 2, ... in (wiki, page_id) order (number_rows).
    Only the batch's keys are joined (semi/anti joins against the table),
    so the article table is scanned, never rebuilt."""
    new = (refreshed.filter(F.col("_stale") & F.col("error").isNull())
                    .groupBy("wiki", F.col("resolved_page_id").alias("page_id"))
                    .agg(F.max_by(F.struct(F.col("article_title").alias("title"),
                                           F.col("article_extract").alias("extract")),
                                  F.struct("timestamp", "event_id")).alias("v"))
                    .select("wiki", "page_id", "v.title", "v.extract"))
    keys = ["wiki", "page_id"]
    old_ids = articles.select("article_id", *keys).join(new.select(*keys), keys, "left_semi")
    kept = new.join(old_ids, keys).select(*ARTICLE_COLS[:3], "title", "extract",
                                          ts_lit(as_of).alias("last_enriched_at"))
    fresh = number_rows(new.join(articles.select(*keys), keys, "left_anti"), keys,
                        max_id(articles, "article_id"), "article_id")
    fresh = fresh.select(*ARTICLE_COLS[:5], ts_lit(as_of).alias("last_enriched_at"))
    return kept.select(*ARTICLE_COLS).unionByName(fresh.select(*ARTICLE_COLS))


def upsert_articles(articles: DataFrame, refreshed: DataFrame, as_of: str,
                    delta: DataFrame | None = None) -> DataFrame:
    """J-06: the article table after the batch: rows the batch did not touch
    plus the batch's delta (key anti-join + union, no full outer join)."""
    delta = delta if delta is not None else article_delta(articles, refreshed, as_of)
    rest = articles.select(*ARTICLE_COLS).join(delta.select("wiki", "page_id"), ["wiki", "page_id"], "left_anti")
    return rest.unionByName(delta)


def with_audit(before: DataFrame, after: DataFrame, key: list[str], tracked: list[str], as_of: str) -> DataFrame:
    """X-23: audit columns of an upserted table.  created_at is kept for
    existing keys and set to as_of on insert; updated_at moves to as_of when
    a tracked column changed (null-safe compare), else it is kept.
    ``before`` must carry created_at and updated_at."""
    b = before.select(*key, *[F.col(c).alias(f"b_{c}") for c in tracked], "created_at", "updated_at")
    j = after.join(b, key, "left")
    changed = F.lit(False)
    for c in tracked:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"b_{c}"))
    new = F.col("created_at").isNull()
    return j.select(*after.columns,
                    F.when(new, ts_lit(as_of)).otherwise(F.col("created_at")).alias("created_at"),
                    F.when(new | changed, ts_lit(as_of)).otherwise(F.col("updated_at")).alias("updated_at"))


def category_delta(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """J-09 + U-02: per article, names to remove (stored, not incoming) and
    names to add (incoming, not stored); blank names ignored, names
    distinct.  Only articles present in ``incoming`` are touched.
    Columns: article_id, name, change ('add' / 'remove')."""
    inc = incoming.filter(F.trim("name") != "").select("article_id", "name").distinct()
    touched = inc.select("article_id").distinct()
    old = stored.join(touched, "article_id", "left_semi").select("article_id", "name").distinct()
    removes = old.join(inc, ["article_id", "name"], "left_anti").withColumn("change", F.lit("remove"))
    adds = inc.join(old, ["article_id", "name"], "left_anti").withColumn("change", F.lit("add"))
    return removes.unionByName(adds)


def replace_categories(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """J-09 applied: the stored category table after the delta."""
    touched = incoming.select("article_id").distinct()
    keep = stored.join(touched, "article_id", "left_anti")
    inc = incoming.filter(F.trim("name") != "").select("article_id", "name").distinct()
    return keep.select("article_id", "name").unionByName(inc)


def article_categories(articles: DataFrame, categories: DataFrame) -> DataFrame:
    """J-03: article plus its sorted category names (empty list if none)."""
    c = categories.groupBy("article_id").agg(F.array_sort(F.collect_set("name")).alias("categories"))
    return (articles.join(c, "article_id", "left")
                    .withColumn("categories", F.coalesce("categories", F.array().cast("array<string>"))))


def to_enriched(refreshed: DataFrame, upserted: DataFrame, categories: DataFrame, as_of: str) -> DataFrame:
    """F-16: EnrichedEdit rows for edits without error.  Ids, title, wiki,
    extract and categories come from the (refreshed) article; flags and
    times from the edit."""
    ok = refreshed.filter(F.col("error").isNull() & F.col("resolved_page_id").isNotNull())
    # Articles and categories of this batch only (semi-joins push into the
    # union that forms the upserted table).
    keys = ok.select("wiki", F.col("resolved_page_id").alias("page_id")).distinct()
    batch_arts = upserted.join(keys, ["wiki", "page_id"], "left_semi")
    batch_cats = categories.join(batch_arts.select("article_id"), "article_id", "left_semi")
    a = article_categories(batch_arts, batch_cats).select(
        F.col("article_id"), F.col("wiki").alias("u_wiki"), F.col("page_id").alias("u_page_id"),
        F.col("title").alias("u_title"), F.col("extract").alias("u_extract"), "categories")
    j = ok.join(a, (ok.wiki == a.u_wiki) & (ok.resolved_page_id == a.u_page_id), "inner")
    return j.select(
        "event_id", "wiki_edit_id", "article_id", F.col("u_page_id").alias("page_id"),
        F.col("u_title").alias("title"), F.col("u_wiki").alias("wiki"), F.col("u_extract").alias("extract"),
        "categories", "linked_articles",
        diff_size("new_length", "old_length").alias("diff_size"), "is_bot", "timestamp",
        ts_lit(as_of).alias("enriched_at"))


def enrich(edits: DataFrame, articles: DataFrame, categories: DataFrame, responses: DataFrame,
           as_of: str, hours: int = ARTICLE_CACHE_HOURS) -> dict[str, DataFrame]:
    """The whole enrichment step for a batch of raw edits.

    Returns enriched edits, errors (event_id, error), the article table
    after the upsert, the category table after replacement, the category
    delta, and the two change sets a stream appends to its logs:
    ``article_changes`` (upserted rows of the refreshed articles) and
    ``category_sets`` (article_id, names) for every refreshed article."""
    # The refresh result and the article delta feed every output below.
    # Writing them once as reliable checkpoints (shared checkpoint folder)
    # computes each once per batch and keeps every output's plan short,
    # instead of re-planning and re-running the refresh joins per output.
    ensure_checkpoint_dir(edits.sparkSession)
    r = refresh(edits, articles, responses, as_of, hours).checkpoint()
    changes = article_delta(articles, r, as_of).checkpoint()
    upserted = upsert_articles(articles, r, as_of, changes)
    callers = (r.filter(F.col("_calls") & F.col("error").isNull())
                .join(changes.select("article_id", F.col("wiki").alias("wiki"), F.col("page_id").alias("resolved_page_id")),
                      ["wiki", "resolved_page_id"]))
    incoming = callers.select("article_id", F.explode("r_categories").alias("name"))
    sets = (callers.select("article_id", F.explode_outer("r_categories").alias("name"))
                   .groupBy("article_id")
                   .agg(F.array_sort(F.array_distinct(F.filter(F.collect_list("name"), lambda x: F.trim(x) != ""))).alias("names")))
    cats = replace_categories(categories, incoming)
    return {
        "enriched": to_enriched(r, upserted, cats, as_of),
        "errors": r.filter(F.col("error").isNotNull()).select("event_id", "error"),
        "articles": upserted,
        "categories": cats,
        "category_delta": category_delta(categories, incoming),
        "article_changes": changes,
        "category_sets": sets,
    }


def latest_articles(base: DataFrame, changes: DataFrame | None) -> DataFrame:
    """W-05: the article table as base rows plus appended change rows, the
    newest per (wiki, page_id) by last_enriched_at winning (aggregate, so a
    hot key is combined map side)."""
    if changes is None:
        return base
    cols = base.columns
    allr = base.select(*cols).unionByName(changes.select(*cols))
    return (allr.groupBy("wiki", "page_id")
                .agg(F.max_by(F.struct(*[c for c in cols if c not in ("wiki", "page_id")]),
                              F.struct("last_enriched_at", "article_id")).alias("v"))
                .select("wiki", "page_id", "v.*").select(*cols))


def latest_categories(base: DataFrame, sets: DataFrame | None) -> DataFrame:
    """Category table as base rows plus appended per-article sets
    (article_id, names, version); the highest version per article wins."""
    if sets is None:
        return base
    b = base.groupBy("article_id").agg(F.collect_list("name").alias("names")).withColumn("version", F.lit(0).cast("long"))
    allr = b.unionByName(sets.select("article_id", "names", F.col("version").cast("long")))
    latest = allr.groupBy("article_id").agg(F.max_by("names", "version").alias("names"))
    return latest.select("article_id", F.explode("names").alias("name"))
