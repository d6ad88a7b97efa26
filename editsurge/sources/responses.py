"""Parsers for captured service responses (X-18..X-21).

The reference called four HTTP services per edit; here their captured JSON
bodies are rows, parsed with ``from_json`` against explicit schemas, with
the same error texts chosen by a ``when`` chain.  Everything is built-in
functions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editsurge.functions.scalar import blank, clean_category, entity_id_from_uri, safe_int

# Parser error texts, in the order each parser checks.
PAGE_ERRORS = ("No pages in response", "Page not found: ")
QID_ERRORS = ("Wikipedia API response missing pages.", "Wikipedia API returned no pages.",
              "Wikipedia page not found.", "Wikipedia pageprops not found.",
              "Wikipedia page does not have wikibase_item.", "Wikipedia returned empty wikibase_item.")
BINDINGS_ERROR = "SPARQL response missing bindings."
ENTITY_ERRORS = ("No entities returned from Wikidata.", "Entity not found for title '{title}' on '{wiki}'.")

_TITLES = T.ArrayType(T.StructType([T.StructField("title", T.StringType())]))
PAGE_RESPONSE = T.StructType([T.StructField("query", T.StructType([T.StructField("pages", T.MapType(
    T.StringType(), T.StructType([
        T.StructField("pageid", T.LongType()), T.StructField("title", T.StringType()),
        T.StructField("extract", T.StringType()), T.StructField("categories", _TITLES),
        T.StructField("links", _TITLES), T.StructField("missing", T.StringType())])))]))])

QID_RESPONSE = T.StructType([T.StructField("query", T.StructType([T.StructField("pages", T.MapType(
    T.StringType(), T.StructType([
        T.StructField("missing", T.StringType()),
        T.StructField("pageprops", T.StructType([T.StructField("wikibase_item", T.StringType())]))])))]))])

_VALUE = T.StructType([T.StructField("value", T.StringType())])
CLASS_BINDINGS = T.StructType([T.StructField("results", T.StructType([T.StructField("bindings", T.ArrayType(
    T.StructType([T.StructField("class", _VALUE), T.StructField("classLabel", _VALUE),
                  T.StructField("sitelinks", _VALUE)])))]))])

_CLAIM = T.StructType([T.StructField("mainsnak", T.StructType([T.StructField("datavalue", T.StructType([
    T.StructField("value", T.StructType([T.StructField("id", T.StringType())]))]))]))])
ENTITY_RESPONSE = T.StructType([T.StructField("entities", T.MapType(T.StringType(), T.StructType([
    T.StructField("missing", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), _VALUE)),
    T.StructField("claims", T.MapType(T.StringType(), T.ArrayType(_CLAIM)))])))])


def _first_value(m: Column) -> Column:
    return F.get(F.map_values(m), 0)


def parse_page_response(df: DataFrame, body: str = "body", title: str = "title") -> DataFrame:
    """X-18: first page of the pages map -> page_id, trimmed extract,
    cleaned non-empty categories, non-empty links; or an error text."""
    r = F.from_json(F.col(body), PAGE_RESPONSE)
    pages = r["query"]["pages"]
    page = _first_value(pages)
    err = (F.when(pages.isNull() | (F.size(pages) == 0), F.lit(PAGE_ERRORS[0]))
            .when(page["missing"].isNotNull(), F.concat(F.lit(PAGE_ERRORS[1]), F.col(title))))
    cats = F.transform(F.filter(page["categories"], lambda c: c["title"].isNotNull() & (c["title"] != "")),
                       lambda c: clean_category(c["title"]))
    links = F.transform(F.filter(page["links"], lambda c: c["title"].isNotNull() & (c["title"] != "")),
                        lambda c: c["title"])
    ok = err.isNull()
    return df.select(
        "*", err.alias("error"),
        F.when(ok, F.coalesce(page["pageid"], F.lit(0).cast("long"))).alias("page_id"),
        F.when(ok, F.trim(page["extract"])).alias("extract"),
        F.when(ok, F.coalesce(cats, F.array().cast("array<string>"))).alias("categories"),
        F.when(ok, F.coalesce(links, F.array().cast("array<string>"))).alias("linked_articles"))


def parse_qid_response(df: DataFrame, body: str = "body") -> DataFrame:
    """X-19: query.pages.*.pageprops.wikibase_item with one error text per
    missing level."""
    r = F.from_json(F.col(body), QID_RESPONSE)
    pages = r["query"]["pages"]
    page = _first_value(pages)
    item = page["pageprops"]["wikibase_item"]
    conds = [pages.isNull(), F.size(pages) == 0, page["missing"].isNotNull(), page["pageprops"].isNull(),
             item.isNull(), blank(item)]
    err = F.when(conds[0], F.lit(QID_ERRORS[0]))
    for cond, text in zip(conds[1:], QID_ERRORS[1:]):
        err = err.when(cond, F.lit(text))
    return df.select("*", F.when(err.isNull(), item).alias("qid"), err.alias("error"))


def parse_class_bindings(df: DataFrame, body: str = "body") -> DataFrame:
    """X-20: results.bindings[] -> (qid, label, sitelinks) rows; bindings
    with a blank id or label are dropped; no bindings array -> error row."""
    r = F.from_json(F.col(body), CLASS_BINDINGS)
    b = r["results"]["bindings"]
    with_err = df.select("*", b.alias("_b"),
                         F.when(b.isNull(), F.lit(BINDINGS_ERROR)).alias("error"))
    rows = with_err.select(*df.columns, "error", F.posexplode_outer("_b").alias("pos", "x"))
    out = rows.select(*df.columns, "error", "pos",
                      entity_id_from_uri(F.col("x")["class"]["value"]).alias("qid"),
                      F.col("x")["classLabel"]["value"].alias("label"),
                      safe_int(F.col("x")["sitelinks"]["value"]).alias("sitelinks"))
    return out.filter(F.col("error").isNotNull() | (~blank("qid") & ~blank("label")))


def parse_instance_of(df: DataFrame, body: str = "body", title: str = "title", wiki: str = "wiki",
                      lang: str = "lang") -> DataFrame:
    """X-21: first entity -> id, label in the language (else the title),
    P31 ids (claims[].mainsnak.datavalue.value.id, non-blank) and claim
    names; '-1' or a missing entity -> error."""
    r = F.from_json(F.col(body), ENTITY_RESPONSE)
    ents = r["entities"]
    first_key = F.get(F.map_keys(ents), 0)
    ent = _first_value(ents)
    template = ENTITY_ERRORS[1].replace("{title}", "%s").replace("{wiki}", "%s")
    not_found = F.format_string(template, F.col(title), F.col(wiki))
    err = (F.when(ents.isNull() | (F.size(ents) == 0) | blank(first_key), F.lit(ENTITY_ERRORS[0]))
            .when((first_key == "-1") | ent["missing"].isNotNull(), not_found))
    p31 = F.filter(F.transform(ent["claims"]["P31"], lambda c: c["mainsnak"]["datavalue"]["value"]["id"]),
                   lambda x: ~blank(x))
    ok = err.isNull()
    return df.select(
        "*", err.alias("error"), F.when(ok, first_key).alias("entity_id"),
        F.when(ok, F.coalesce(ent["labels"][F.col(lang)]["value"], F.col(title))).alias("label"),
        F.when(ok, F.coalesce(p31, F.array().cast("array<string>"))).alias("instance_of"),
        F.when(ok, F.coalesce(F.map_keys(ent["claims"]), F.array().cast("array<string>"))).alias("claims"))
