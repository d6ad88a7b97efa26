"""Enrichment golden cases (cache hit, refresh, errors, new articles)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from editsurge import schemas as S
from editsurge.operators import enrich as en
from editsurge.operators import ingest as ig

AS_OF = "2024-01-30 12:00:00"
NOW = dt.datetime(2024, 1, 30, 12, 0, 0)


def raw(spark, rows):
    full = [(e, 1, pid, t, w, "u", False, False, False, 1, 2, NOW, NOW) for (e, pid, t, w) in rows]
    return spark.createDataFrame(full, S.RAW_EDIT)


@pytest.fixture(scope="module")
def dims(spark):
    arts = spark.createDataFrame([(100, "enwiki", 42, "Test", "cached", NOW),
                                  (101, "enwiki", 43, "Old", "old", NOW - dt.timedelta(hours=5))],
                                 "article_id long, wiki string, page_id long, title string, extract string, last_enriched_at timestamp_ntz")
    cats = spark.createDataFrame([(100, "Cat"), (101, "Gone")], "article_id long, name string")
    resp = spark.createDataFrame([
        ("enwiki", "T", 42, " from-api ", ["Category:C1", "C2"], ["L1", "L2"]),
        ("enwiki", "New", 77, "fresh", ["C1", "C2"], ["L1", "L2"]),
        ("enwiki", "Zero", 0, "x", [], []),
        ("enwiki", "T43", 43, "refreshed", ["Category:C3", ""], ["L3"]),
    ], "wiki string, title string, page_id long, extract string, raw_categories array<string>, raw_links array<string>")
    return arts, cats, resp


def test_cache_hit_uses_stored_article(spark, dims):
    arts, cats, resp = dims
    out = en.enrich(raw(spark, [("evt-1", 42, "T", "enwiki")]), arts, cats, resp, AS_OF)
    r = out["enriched"].collect()[0]
    assert (r.article_id, r.extract, r.categories, r.linked_articles) == (100, "cached", ["Cat"], [])
    assert r.title == "Test" and r.diff_size == 1


def test_missing_article_refreshes_and_inserts(spark, dims):
    arts, cats, resp = dims
    out = en.enrich(raw(spark, [("evt-2", 0, "New", "enwiki")]), arts, cats, resp, AS_OF)
    r = out["enriched"].collect()[0]
    assert r.extract == "fresh" and sorted(r.categories) == ["C1", "C2"] and r.linked_articles == ["L1", "L2"]
    assert r.article_id == 102 and r.page_id == 77          # max(id) + 1
    assert out["articles"].count() == 3


def test_stale_article_refresh_once_per_batch(spark, dims):
    arts, cats, resp = dims
    edits = raw(spark, [("evt-3", 43, "T43", "enwiki"), ("evt-4", 43, "T43", "enwiki")])
    out = en.enrich(edits, arts, cats, resp, AS_OF)
    rows = {r.event_id: r for r in out["enriched"].collect()}
    assert rows["evt-3"].linked_articles == ["L3"] and rows["evt-4"].linked_articles == []
    assert rows["evt-3"].extract == "refreshed" and rows["evt-3"].categories == ["C3"]
    delta = {(r.name, r.change) for r in out["category_delta"].collect()}
    assert delta == {("Gone", "remove"), ("C3", "add")}


def test_error_reasons(spark, dims):
    arts, cats, resp = dims
    out = en.enrich(raw(spark, [("evt-5", 0, "Zero", "enwiki"), ("evt-6", 0, "Nope", "enwiki")]), arts, cats, resp, AS_OF)
    errs = {r.event_id: r.error for r in out["errors"].collect()}
    assert errs == {"evt-5": "Wikipedia API did not return valid PageId", "evt-6": "Page not found: Nope"}
    df = spark.createDataFrame([(None, "T", "w"), ("e", "", "w"), ("e", "T", "")], "event_id string, title string, wiki string")
    got = [r.e for r in df.select(ig.enrich_input_error().alias("e")).collect()]
    assert got == ["Edit event is null", "Title is required", "Wiki is required"]


def test_category_set_difference(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "z")], "article_id long, name string")
    new = spark.createDataFrame([(1, "b"), (1, "c"), (1, " ")], "article_id long, name string")
    got = {(r.article_id, r.name, r.change) for r in en.category_delta(old, new).collect()}
    assert got == {(1, "a", "remove"), (1, "c", "add")}


def test_number_rows_dense_and_ordered(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("k"))
    out = en.number_rows(df, ["k"], 10, "nid").orderBy("k").collect()
    assert [r.nid for r in out] == list(range(11, 511))


def test_number_rows_repeatable(spark):
    """The same keys get the same ids when the frame is evaluated again
    (as after a lost executor), whatever the input partitioning."""
    df = spark.range(0, 2000).select((F.col("id") * 13 % 2000).alias("k")).repartition(7)
    a = en.number_rows(df, ["k"], 0, "nid")
    first = sorted((r.k, r.nid) for r in a.collect())
    again = sorted((r.k, r.nid) for r in a.collect())
    other = sorted((r.k, r.nid) for r in en.number_rows(df.repartition(3), ["k"], 0, "nid").collect())
    assert first == again == other == [(k, k + 1) for k in range(2000)]
