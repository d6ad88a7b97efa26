"""Turn the driver's generic tables into the engine's inputs.

Each adapter is a pure column derivation (integer arithmetic and CASE) over a
driver table, so every row of the source takes part and DuckDB can repeat the
rule in the oracle SQL.  The rules are documented in FIXTURES.md section 3.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editsurge import schemas as S
from editsurge.sources.tables import read_table


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


# Fixed values of the fixture: event type -> primary topic id (1..5), and the
# wiki picked by user_id mod 3.
EVENT_TOPIC_TYPES = ["click", "error", "purchase", "signup", "view"]
WIKIS_BY_USER = ["enwiki", "ruwiki", "dewiki"]


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime or 'YYYY-MM-DD HH:MM:SS' text.

    A literal (not a scalar subquery) lets Catalyst fold it and push range
    predicates into the Parquet scan.
    """
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def trunc_second(ts) -> Column:
    """Drop the sub-second part of a TIMESTAMP_NTZ without a time zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    micros = F.timestamp_diff("MICROSECOND", _epoch_ntz(), ts)
    return F.timestamp_add("MICROSECOND", -F.pmod(micros, F.lit(1_000_000)), ts)


def epoch_micros(ts) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), ts)


def max_ts(df: DataFrame, col: str = "ts") -> str:
    """as_of rule: max of a timestamp column truncated to a second.

    One global aggregate (partial max per task, one row to the driver).
    """
    if col == "ts" and "eff_date" in df.columns:
        df = _newest_partitions(df)
    row = df.agg(F.max(col).alias("m")).first()
    m = row["m"] if row else None
    if m is None:
        return "1970-01-01 00:00:00"
    # Truncating the maximum equals the maximum of truncated values.
    return m.strftime("%Y-%m-%d %H:%M:%S")


def _newest_partitions(edits: DataFrame) -> DataFrame:
    """The eff_date partitions that can hold the newest ts of a stored edit
    table, found without scanning it all.  ts <= effective time, so a row
    with ts = T sits in a partition dated on or after day(T).  With m = the
    newest ts of the newest partition, every ts above m lies in partitions
    dated day(m) or later: two pruned scans instead of a full one, and the
    answer is exact."""
    newest = edits.agg(F.max("eff_date").alias("d")).first()["d"]
    if newest is None:
        return edits
    m = edits.filter(F.col("eff_date") == F.lit(newest)).agg(F.max("ts").alias("m")).first()["m"]
    if m is None:
        return edits
    return edits.filter(F.col("eff_date") >= F.lit(m.date()))


# --------------------------------------------------------------------------
# edits (FIXTURES 3.1)
# --------------------------------------------------------------------------

def _type_name(tid: Column) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in EVENT_TOPIC_TYPES]), tid)


def _topic_entry(n: Column, tid: Column) -> Column:
    tname = _type_name(tid)
    name = (F.when(n % 7 == 0, F.concat(F.lit("topic "), tid.cast("string")))
            .when(n % 11 == 0, F.lit(""))
            .otherwise(tname))
    path = (F.when(n % 5 == 0, F.concat(F.lit("topic-"), tid.cast("string")))
            .otherwise(F.concat(F.when(tid % 2 == 1, F.lit("Activity > ")).otherwise(F.lit("Lifecycle > ")), tname)))
    conf = F.when(n % 3 == 0, F.lit(1.0)).when(n % 3 == 1, F.lit(0.5)).otherwise(F.lit(0.1))
    return F.struct(tid.cast("int").alias("topic_id"), name.alias("name"), path.alias("path"),
                    conf.cast("float").alias("confidence"))


def edits_from_events(events: DataFrame) -> DataFrame:
    """Classified edits (edit_events rows) derived from the events table."""
    n = F.col("event_id")
    primary = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(i + 1))
                           for i, t in enumerate(EVENT_TOPIC_TYPES)])
    secondary = (n % 5 + 1).cast("int")
    e1 = _topic_entry(n, primary)
    e2 = _topic_entry(n, secondary)
    empty = F.array().cast(S.TOPICS)
    topics = (F.when(n % 50 == 0, empty)
              .otherwise(F.concat(F.array(e1),
                                  F.when(n % 4 == 0, F.array(e2)).otherwise(empty),
                                  F.when(n % 101 == 0, F.array(e1)).otherwise(empty))))
    ts = trunc_second("ts")
    article = n % 97 + 1
    return events.select(
        F.concat(F.lit("evt-"), n.cast("string")).alias("event_id"),
        n.alias("wiki_edit_id"),
        article.alias("article_id"),
        F.concat(F.lit("Article "), article.cast("string")).alias("title"),
        F.element_at(F.array(*[F.lit(w) for w in WIKIS_BY_USER]), (F.col("user_id") % 3 + 1).cast("int")).alias("wiki"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("user"),
        ts.alias("ts"),
        F.timestamp_add("MINUTE", (n % 11) * 10, ts).alias("classified_at"),
        topics.alias("topics"),
        F.array().cast(S.EMBEDDING).alias("embedding"),
    )


def load_edits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """edits view plus its as_of (max ts truncated to a second)."""
    events = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    return edits_from_events(events), max_ts(events)


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that yields fewer splits than the cluster has
    cores (e.g. one large single-row-group file), so the work after it runs
    in parallel.  A scan with enough splits is returned unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def edits_bench(lineitem: DataFrame, part: DataFrame, orders: DataFrame) -> DataFrame:
    """Bench edits (FIXTURES 3.5): one edit per line item, topic = brand number."""
    li = spread(lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate"))
    p = part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type")
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    j = li.join(p, "l_partkey").join(o, "l_orderkey")
    brand_no = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    topic = F.struct(brand_no.alias("topic_id"), F.col("p_brand").alias("name"),
                     F.concat_ws(" > ", "p_type", "p_brand").alias("path"),
                     F.lit(1.0).cast("float").alias("confidence"))
    return j.select(
        F.concat(F.lit("li-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("event_id"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("wiki_edit_id"),
        F.col("l_partkey").alias("article_id"),
        F.col("p_name").alias("title"),
        F.lit("enwiki").alias("wiki"),
        F.concat(F.lit("user-"), F.col("o_custkey").cast("string")).alias("user"),
        F.col("l_shipdate").alias("ts"),
        F.timestamp_add("DAY", F.col("l_linenumber"), "l_shipdate").alias("classified_at"),
        F.array(topic).alias("topics"),
        F.array().cast(S.EMBEDDING).alias("embedding"),
    )


# --------------------------------------------------------------------------
# recent changes (FIXTURES 3.2)
# --------------------------------------------------------------------------

def recent_changes_from_events(events: DataFrame) -> DataFrame:
    """Change-feed records (typed rows) derived from the events table."""
    n = F.col("event_id")
    micros = epoch_micros("ts")
    epoch = F.when(n % 2 == 0, F.floor(micros / 1_000_000)).otherwise(F.floor(micros / 1_000)).cast("long")
    typ = (F.when(n % 10 <= 6, F.lit("edit")).when(n % 10 == 7, F.lit("EDIT"))
           .when(n % 10 == 8, F.lit("new")).otherwise(F.lit(None).cast("string")))
    wiki = F.when(n % 33 == 0, F.lit("")).otherwise(
        F.element_at(F.array(*[F.lit(w) for w in WIKIS_BY_USER]), (F.col("user_id") % 3 + 1).cast("int")))
    old = (n % 5000).cast("int")
    article = n % 97 + 1
    return events.select(
        F.when(n % 40 == 0, F.lit(None).cast("long")).otherwise(n).alias("id"),
        typ.alias("type"),
        F.when(n % 6 == 0, F.lit(1)).otherwise(F.lit(0)).alias("namespace"),
        F.concat(F.lit("Article "), article.cast("string")).alias("title"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("user"),
        (F.col("user_id") % 10 == 0).alias("bot"),
        (n % 3 == 0).alias("minor"),
        F.struct(old.alias("old"), (old + F.floor("value").cast("int")).alias("new")).alias("length"),
        F.struct(n.alias("old"), (n + 1).alias("new")).alias("revision"),
        wiki.alias("wiki"),
        epoch.alias("timestamp"),
        F.when(n % 9 == 0, F.lit(None).cast("long")).otherwise(article).alias("page_id"),
    )


# --------------------------------------------------------------------------
# dimensions (FIXTURES 3.3)
# --------------------------------------------------------------------------

# Fixed values of the fixture: category prefix per document language.
CATEGORY_PREFIX_BY_LANG = {"de": "Kategorie:", "fr": "Catégorie:"}
DEFAULT_CATEGORY_PREFIX = "Category:"


def articles_from_documents(documents: DataFrame, as_of: str) -> DataFrame:
    """Article rows: one per document, enriched 0..8 hours before as_of."""
    d = F.col("doc_id")
    return documents.select(
        d.alias("article_id"),
        F.concat(F.col("lang"), F.lit("wiki")).alias("wiki"),
        d.alias("page_id"),
        F.concat(F.lit("Doc "), d.cast("string")).alias("title"),
        F.substring("text", 1, 4000).alias("extract"),
        F.timestamp_add("HOUR", -(d % 9), ts_lit(as_of)).alias("last_enriched_at"),
    )


def _category_prefix(lang: Column) -> Column:
    expr = F.lit(DEFAULT_CATEGORY_PREFIX)
    for lg, pre in CATEGORY_PREFIX_BY_LANG.items():
        expr = F.when(lang == lg, F.lit(pre)).otherwise(expr)
    return expr


def links_from_pages(pages: DataFrame) -> DataFrame:
    """Local link targets (href="/...") of every page."""
    return pages.select(
        F.col("page_id"),
        F.regexp_extract_all("html", F.lit(r'href="/([^"]*)"'), 1).alias("links"))


def class_graph(customer: DataFrame, nation: DataFrame, region: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Class graph edges (child, prop, parent, pos) and nodes (qid, label, sitelinks);
    ``pos`` is the position of the claim.

    Customers are items: C{key} -P31-> N{nation}; every 7th customer is a
    human (P31 Q5) with occupation N{nation}, except every 14th, which has
    none.  Every 11th customer also has two extra P31 claims: 'n{nation}'
    (the same class in another case) and Q{100 + key mod 4} (a class with
    no label), which comes first for every 22nd.  Nations are subclasses of regions, regions of ROOT, ROOT of
    R0, which closes a cycle.  sitelinks = customers below the class.
    """
    spark = customer.sparkSession
    c = customer.select("c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    human = k % 7 == 0
    cq = F.concat(F.lit("C"), k.cast("string"))
    nq = F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))

    def e(prop, parent, pos=1):
        at = pos if not isinstance(pos, int) else F.lit(pos)
        return F.struct(F.lit(prop).alias("prop"), parent.alias("parent"), at.cast("int").alias("pos"))

    base = (F.when(human & (k % 14 == 0), F.array(e("P31", F.lit("Q5"))))
             .when(human, F.array(e("P31", F.lit("Q5")), e("P106", nq)))
             .otherwise(F.array(e("P31", nq))))
    extra = F.when(k % 11 == 0, F.array(e("P31", F.concat(F.lit("n"), F.col("c_nationkey").cast("string")), 2),
                                        e("P31", F.concat(F.lit("Q"), (k % 4 + 100).cast("string")),
                                          F.when(k % 22 == 0, 0).otherwise(3)))) \
             .otherwise(F.array().cast("array<struct<prop:string,parent:string,pos:int>>"))
    item_edges = c.select(cq.alias("child"), F.explode(F.concat(base, extra)).alias("e")) \
                  .select("child", "e.prop", "e.parent", "e.pos")
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    nation_edges = n.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("child"),
                            F.lit("P279").alias("prop"),
                            F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("parent"), F.lit(1).alias("pos"))
    r = region.select("r_regionkey", "r_name")
    region_edges = r.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("child"),
                            F.lit("P279").alias("prop"), F.lit("ROOT").alias("parent"), F.lit(1).alias("pos"))
    root_edge = spark.range(1).select(F.lit("ROOT").alias("child"), F.lit("P279").alias("prop"),
                                      F.lit("R0").alias("parent"), F.lit(1).alias("pos"))
    edges = item_edges.unionByName(nation_edges).unionByName(region_edges).unionByName(root_edge)

    per_nation = c.groupBy("c_nationkey").agg(F.count("*").alias("k"))
    nat = n.join(per_nation, n.n_nationkey == per_nation.c_nationkey, "left")
    nation_nodes = nat.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("qid"),
                              F.col("n_name").alias("label"),
                              F.coalesce("k", F.lit(0)).cast("int").alias("sitelinks"))
    per_region = nat.groupBy("n_regionkey").agg(F.sum(F.coalesce("k", F.lit(0))).alias("k"))
    reg = r.join(per_region, r.r_regionkey == per_region.n_regionkey, "left")
    region_nodes = reg.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("qid"),
                              F.col("r_name").alias("label"),
                              F.coalesce("k", F.lit(0)).cast("int").alias("sitelinks"))
    totals = c.agg(F.count("*").alias("k"), F.count_if(human).alias("h"))
    root_nodes = totals.select(F.explode(F.array(
        F.struct(F.lit("ROOT").alias("qid"), F.lit("World").alias("label"), F.col("k").cast("int").alias("sitelinks")),
        F.struct(F.lit("Q5").alias("qid"), F.lit("human").alias("label"), F.col("h").cast("int").alias("sitelinks")),
    )).alias("x")).select("x.*")
    nodes = nation_nodes.unionByName(region_nodes).unionByName(root_nodes)
    return edges, nodes


def labels_from_nodes(nodes: DataFrame) -> DataFrame:
    """Entity labels (id, lang, label): the node labels in English, and in German
    those of nations and regions."""
    en = nodes.select(F.col("qid").alias("id"), F.lit("en").alias("lang"), "label")
    de = nodes.filter(F.col("qid").rlike("^[NR][0-9]")).select(
        F.col("qid").alias("id"), F.lit("de").alias("lang"), F.concat(F.lit("(de) "), "label").alias("label"))
    return en.unionByName(de)


def _customer_lang() -> Column:
    """Every 9th customer is a German article, the others are English."""
    return F.when(F.col("c_custkey") % 9 == 0, "de").otherwise("en")


def items_from_customers(customer: DataFrame) -> DataFrame:
    """Articles to classify: one per customer."""
    return customer.select(F.col("c_custkey").alias("article_id"), F.col("c_name").alias("title"),
                           _customer_lang().alias("lang"))


def topics_fixture(spark: SparkSession) -> DataFrame:
    """Stored topics: the first five default topics with ids 1..5."""
    from editsurge.operators.classify import DEFAULT_TOPICS
    rows = [(i + 1, n, f"Root/{n}") for i, n in enumerate(DEFAULT_TOPICS[:5])]
    return spark.createDataFrame(rows, "topic_id int, name string, path string")


def article_topics_from_customers(customer: DataFrame) -> DataFrame:
    """Stored article-topic links of every customer but each third: two for every
    other one (ids key mod 7 + 1 at 0.9 and key mod 5 + 1 at 0.4; ids 6 and 7 are
    not stored), else one to a missing topic."""
    k = F.col("c_custkey")

    def link(tid, conf):
        return F.struct(tid.cast("int").alias("topic_id"), F.lit(conf).cast("float").alias("confidence"))

    links = (F.when(k % 3 == 0, None)
              .when(k % 2 == 0, F.array(link(k % 7 + 1, 0.9), link(k % 5 + 1, 0.4)))
              .otherwise(F.array(link(F.lit(99), 0.95))))
    return customer.select(k.alias("article_id"), F.explode(links).alias("l")) \
                   .select("article_id", "l.topic_id", "l.confidence")


def qid_mapping_from_customers(customer: DataFrame, as_of: str) -> DataFrame:
    """(wiki, title) -> qid cache rows; every 10th is a negative entry, every 19th has none."""
    k = F.col("c_custkey")
    return customer.filter(k % 19 != 0).select(
        F.concat(_customer_lang(), F.lit("wiki")).alias("wiki"),
        F.col("c_name").alias("title"),
        F.when(k % 10 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("C"), k.cast("string"))).alias("qid"),
        F.timestamp_add("MINUTE", -(k % 120), ts_lit(as_of)).alias("cached_at"),
    )


def qid_responses_from_customers(customer: DataFrame) -> DataFrame:
    """Captured QID responses (wiki, title, body): of the keys modulo 3, 0 names the
    item, 1 has no item and 2 is not JSON."""
    k = F.col("c_custkey")
    item = F.concat(F.lit('{"query":{"pages":{"1":{"title":"t","pageprops":{"wikibase_item":"C'), k.cast("string"), F.lit('"}}}}}'))
    return customer.select(
        F.concat(_customer_lang(), F.lit("wiki")).alias("wiki"), F.col("c_name").alias("title"),
        F.when(k % 3 == 0, item).when(k % 3 == 1, F.lit('{"query":{"pages":{"1":{"title":"t","pageprops":{}}}}}'))
         .otherwise(F.lit("503")).alias("body"))


def entities_from_customers(customer: DataFrame) -> DataFrame:
    """Entities by page (wiki, title, qid): all but every fifth customer have one."""
    k = F.col("c_custkey")
    return customer.filter(k % 5 != 0).select(
        F.concat(_customer_lang(), F.lit("wiki")).alias("wiki"), F.col("c_name").alias("title"),
        F.concat(F.lit("C"), k.cast("string")).alias("qid"))


def processing_log_from_events(events: DataFrame) -> DataFrame:
    """Consumer processing log: one record per event, duration from value."""
    return events.select(
        F.lit("classified-edits").alias("topic"),
        F.concat(F.lit("group-"), F.col("event_type")).alias("group_id"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("processed_at"),
        F.floor(F.col("value") * 10).cast("long").alias("elapsed_ms"),
    )


def commands_from_events(events: DataFrame) -> DataFrame:
    """Command records: an invalidate per 'error' event, a recalc per 'signup'."""
    kind = F.when(F.col("event_type") == "error", F.lit("invalidate")).when(F.col("event_type") == "signup", F.lit("recalculate"))
    period = F.element_at(F.array(F.lit("lasthour"), F.lit("last24hours"), F.lit("last7days")), (F.col("event_id") % 3 + 1).cast("int"))
    return events.filter(kind.isNotNull()).select(
        kind.alias("kind"),
        F.when(F.col("event_id") % 2 == 0, (F.col("event_id") % 5 + 1).cast("int")).alias("topic_id"),
        F.when(kind == "invalidate", F.concat(F.lit("v3:trends:"), period)).alias("cache_key"),
        trunc_second("ts").alias("requested_at"),
    )


def page_responses_from_documents(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Captured page-API responses keyed by (wiki, title).

    One per document: title 'Article {doc_id}', page id = doc_id, extract =
    the whole text, raw category titles (one per source and one per
    language, with the language's prefix), links = local hrefs of the page
    with the same id (none when there is no such page)."""
    pre = _category_prefix(F.col("lang"))
    d = documents.select(
        F.concat(F.col("lang"), F.lit("wiki")).alias("wiki"),
        F.concat(F.lit("Article "), F.col("doc_id").cast("string")).alias("title"),
        F.col("doc_id").alias("page_id"),
        F.col("text").alias("extract"),
        F.array(F.concat(pre, F.col("source")), F.concat(pre, F.lit(" Lang "), F.upper("lang"))).alias("raw_categories"))
    links = links_from_pages(pages)
    return d.join(links, "page_id", "left").select(
        "wiki", "title", "page_id", "extract", "raw_categories",
        F.coalesce(F.col("links"), F.array().cast("array<string>")).alias("raw_links"))


def stored_categories_from_documents(documents: DataFrame) -> DataFrame:
    """Category rows already stored per article: the cleaned source
    category, plus 'Legacy' for every fourth document."""
    from editsurge.functions.scalar import clean_category
    pre = _category_prefix(F.col("lang"))
    names = F.when(F.col("doc_id") % 4 == 0, F.array(F.concat(pre, F.col("source")), F.lit("Legacy"))) \
             .otherwise(F.array(F.concat(pre, F.col("source"))))
    return documents.select(F.col("doc_id").alias("article_id"), F.explode(names).alias("raw")) \
                    .select("article_id", clean_category("raw").alias("name"))
