"""Classification: topic cascade, class-hierarchy closure, topic upserts.

The reference resolves one article at a time (database lookups, an HTTP
graph query, label lookups).  Here a batch of articles is resolved by a
chain of equi-joins, and the graph query becomes a transitive closure of the
subclass relation, started at the batch's distinct start classes (semi-naive
iteration with a checkpoint per round).  Only the classes it keeps, ranked per
start class, are joined with the articles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editsurge.functions.scalar import blank
from editsurge.operators.joins import skew_safe_lookup
from editsurge.session import ensure_checkpoint_dir
from editsurge.sources.adapters import ts_lit

# Fixed values of the topic resolver.
ROOT_SITELINKS = 50
GRAPH_LIMIT = 250
FALLBACK_TOPIC = "Uncategorized"
FALLBACK_CONFIDENCE = 0.1
HIERARCHY_CONFIDENCE = 1.0
LABEL_CONFIDENCE = 0.5
NEGATIVE_TTL_HOURS = 1
MAPPING_CACHE_HOURS = 24
HUMAN = "Q5"
# Instance-of topics start at 0.8, step 0.05 down, floor 0.3;
# their path is this prefix plus the class id.
INSTANCE_BASE, INSTANCE_STEP, INSTANCE_FLOOR = 0.8, 0.05, 0.3
INSTANCE_PATH_PREFIX = "Wikidata/P31/"
# The seven default topics.
DEFAULT_TOPICS = ["Science", "Technology", "Politics", "Business", "Sports", "Culture", "History"]


def seed_topics(spark) -> DataFrame:
    """S-10 input: the default topics with path Root/<Name>."""
    return spark.createDataFrame([(n, f"Root/{n}") for n in DEFAULT_TOPICS], "name string, path string")


def max_confidence_topic(article_topics: DataFrame, topics: DataFrame) -> DataFrame:
    """A-13: per article the stored topic with the highest confidence; links
    to topics that do not exist are ignored (inner join).  Ties go to the
    lower topic id."""
    j = article_topics.join(topics.select("topic_id", "name", "path"), "topic_id")
    best = F.max_by(F.struct("topic_id", "name", "path", "confidence"),
                    F.struct(F.col("confidence"), -F.col("topic_id")))
    return j.groupBy("article_id").agg(best.alias("b")).select("article_id", "b.*")


def lookup_qid(articles: DataFrame, mapping: DataFrame, as_of: str,
               cache_hours: int = MAPPING_CACHE_HOURS) -> DataFrame:
    """J-12: (lang + 'wiki', trimmed title) -> qid with a state:
    hit / negative (null qid younger than min(1, cache hours) h) /
    expired (older null) / missing (no entry)."""
    ttl = min(NEGATIVE_TTL_HOURS, cache_hours)
    m = mapping.select(F.col("wiki").alias("_wiki"), F.col("title").alias("_title"), "qid", "cached_at",
                       F.lit(True).alias("_found"))
    a = articles.withColumn("_wiki", F.concat(F.lower(F.trim("lang")), F.lit("wiki"))) \
                .withColumn("_title", F.trim("title"))
    j = skew_safe_lookup(a, m, ["_wiki", "_title"])
    age_ok = F.col("cached_at") >= ts_lit(as_of) - F.expr(f"INTERVAL {ttl} HOURS")
    state = (F.when(F.col("_found").isNull(), "missing").when(F.col("qid").isNotNull(), "hit")
              .when(age_ok, "negative").otherwise("expired"))
    return j.withColumn("qid_state", state).drop("_found", "_wiki", "_title")


def start_nodes(items: DataFrame, edges: DataFrame) -> DataFrame:
    """U-03: graph start classes per item (column ``qid``).  Humans (P31 Q5)
    start at their occupations (P106) or at Q5 when they have none; other
    items start at their P31 classes."""
    p31 = edges.filter(F.col("prop") == "P31").select(F.col("child").alias("qid"), F.col("parent").alias("start"))
    p106 = edges.filter(F.col("prop") == "P106").select(F.col("child").alias("qid"), F.col("parent").alias("start"))
    q = items.select("qid").distinct()
    humans = p31.filter(F.col("start") == HUMAN).select("qid").distinct().join(q, "qid", "left_semi")
    human_starts = humans.join(p106, "qid", "left").select("qid", F.coalesce("start", F.lit(HUMAN)).alias("start"))
    other = p31.join(q, "qid", "left_semi").join(humans, "qid", "left_anti")
    return human_starts.unionByName(other).distinct()


def class_closure(edges: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """J-13 core: (cls, anc) for every start class (column ``cls``; all
    classes of the graph if none are given) and every ancestor reachable by
    zero or more P279 steps, however many.

    Semi-naive: each round joins only the pairs found in the previous round
    with the edges and keeps pairs not seen before (anti-join against the
    parts so far).  Each round's new pairs are written once as a reliable
    checkpoint in the shared checkpoint folder, and the closure is the union
    of those parts, so lineage stays one level deep and nothing is
    rewritten.  Cycles end because a pair is never added twice; the loop
    stops when a round adds nothing (one small action per round).
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    sub = edges.filter(F.col("prop") == "P279").select("child", "parent").distinct()
    if starts is None:
        starts = (sub.select(F.col("child").alias("cls")).union(sub.select(F.col("parent").alias("cls")))
                     .union(edges.filter(F.col("prop").isin("P31", "P106")).select(F.col("parent").alias("cls"))))
    delta = starts.select("cls", F.col("cls").alias("anc")).distinct().checkpoint()
    parts = [delta]
    while True:
        seen = parts[0]
        for p in parts[1:]:
            seen = seen.unionByName(p)
        step = (delta.join(sub, delta.anc == sub.child)
                     .select("cls", F.col("parent").alias("anc")).distinct())
        new = step.join(seen, ["cls", "anc"], "left_anti").checkpoint()
        if new.isEmpty():
            return seen
        parts.append(new)
        delta = new


def class_hierarchy(items: DataFrame, edges: DataFrame, nodes: DataFrame,
                    min_sitelinks: int = ROOT_SITELINKS, limit: int = GRAPH_LIMIT,
                    closure: DataFrame | None = None, labels: DataFrame | None = None) -> DataFrame:
    """J-13: per item the classes reached from its start nodes with
    sitelinks >= min_sitelinks, ordered by sitelinks ascending (qid breaks
    ties), first ``limit``.  No DISTINCT across start nodes: a class reached
    from two start nodes appears twice.  With ``labels`` (id, lang, label)
    and a ``lang`` column of the items a class is named in the item's
    language, or by its id where it has no label there.  Columns: qid
    (, lang), pos, class, label, sitelinks.

    The closure starts at the batch's distinct start classes; its classes
    are filtered and cut to ``limit`` for each start class before an item
    meets them, one row per start class.  So a class that most items start
    at or reach costs one row there, and the items' side of the join is the
    one that AQE can split."""
    ensure_checkpoint_dir(items.sparkSession)
    items = items.distinct().checkpoint()       # used for the start nodes and their languages
    s = start_nodes(items, edges).checkpoint()
    closure = closure if closure is not None else class_closure(edges, s.select(F.col("start").alias("cls")))
    n = nodes.filter(F.col("sitelinks") >= min_sitelinks).select(F.col("qid").alias("anc"), "label", "sitelinks")
    w = Window.partitionBy("cls").orderBy("sitelinks", "anc")
    ranked = closure.join(n, "anc").withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= limit)
    lists = ranked.groupBy(F.col("cls").alias("start")).agg(      # at most ``limit`` classes
        F.collect_list(F.struct("sitelinks", F.col("anc").alias("class"), "label")).alias("xs"))
    keys = ["qid"]
    if labels is not None:
        s, keys = s.join(items.select("qid", "lang").distinct(), "qid"), ["qid", "lang"]
    reach = s.join(lists, "start").select(*keys, "start", F.explode("xs").alias("x")).select(*keys, "start", "x.*")
    wi = Window.partitionBy(*keys).orderBy("sitelinks", "class", "start")
    out = reach.withColumn("pos", F.row_number().over(wi)).filter(F.col("pos") <= limit)
    if labels is not None:
        named = labels.filter(~blank("label")).select(F.col("id").alias("class"), "lang", F.col("label").alias("_named"))
        out = out.join(named, ["class", "lang"], "left").withColumn("label", F.coalesce("_named", "class"))
    return out.select(*keys, "pos", "class", "label", "sitelinks")


def pick_root_topic(hierarchy: DataFrame, threshold: int = ROOT_SITELINKS) -> DataFrame:
    """J-14: per item, drop blank labels; root = first class with sitelinks
    >= threshold, else the last; name = root label; path = labels up to the
    root, reversed, joined with ' > '.  The per-item list is bounded by the
    graph limit (250)."""
    h = hierarchy.filter(~blank("label"))
    keys = [c for c in ("qid", "lang") if c in hierarchy.columns]
    lists = h.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pos", "label", "sitelinks"))).alias("xs"))
    idx = F.array_position(F.transform("xs", lambda x: x["sitelinks"] >= threshold), F.lit(True))
    root = F.when(idx > 0, idx).otherwise(F.size("xs"))
    upto = F.slice("xs", 1, root)
    return lists.select(
        *keys,
        F.element_at("xs", root.cast("int"))["label"].alias("name"),
        F.array_join(F.reverse(F.transform(upto, lambda x: x["label"])), " > ").alias("path"))


def label_lookup(ids: DataFrame, labels: DataFrame, lang: str | Column) -> DataFrame:
    """J-16: entity ids -> label in one language; ids trimmed, distinct,
    blank labels dropped."""
    lang_c = F.lit(lang) if isinstance(lang, str) else lang
    i = ids.select(F.trim("id").alias("id")).filter(~blank("id")).distinct()
    lb = labels.filter(F.col("lang") == lang_c).select("id", "label")
    return i.join(lb, "id").filter(~blank("label"))


def instance_of_topics(items: DataFrame, edges: DataFrame, labels: DataFrame, lang: str = "en") -> DataFrame:
    """J-15: per item its instance-of ids in claim order, distinct case-insensitively
    (the first claim kept), confidence max(0.3, 0.8 - 0.05 i), name = label or the id,
    path Wikidata/P31/{id}; sorted by confidence desc.  Columns: qid, rank,
    class, name, path, confidence."""
    p31 = (edges.filter(F.col("prop") == "P31")
                .join(items.select("qid").distinct(), edges.child == F.col("qid"), "left_semi")
                .select(F.col("child").alias("qid"), F.col("parent").alias("class"), "pos")
                .filter(~blank("class")))
    first = (p31.groupBy("qid", F.lower("class").alias("k")).agg(F.min(F.struct("pos", "class")).alias("c"))
                .select("qid", "c.pos", "c.class"))
    w = Window.partitionBy("qid").orderBy("pos", "class")
    ranked = first.withColumn("rank", F.row_number().over(w) - 1)
    lb = labels.filter(F.col("lang") == lang).select(F.col("id").alias("class"), "label")
    j = ranked.join(lb, "class", "left")
    conf = F.greatest(F.lit(INSTANCE_FLOOR), F.lit(INSTANCE_BASE) - F.col("rank") * F.lit(INSTANCE_STEP))
    return j.select("qid", "rank", "class",
                    F.when(blank("label"), F.col("class")).otherwise(F.col("label")).alias("name"),
                    F.concat(F.lit(INSTANCE_PATH_PREFIX), F.col("class")).alias("path"),
                    F.round(conf, 4).cast("float").alias("confidence"))


def api_label_topic(items: DataFrame, edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Label path of the resolver: the entity's instance-of ids -> labels in
    the article language -> the first non-blank label (lowest claim
    position) as topic name and path.  Columns: qid, lang, name."""
    p31 = edges.filter(F.col("prop") == "P31").select(F.col("child").alias("qid"), F.col("parent").alias("class"), "pos")
    claims = items.select("qid", "lang").distinct().join(p31, "qid")
    named = labels.filter(~blank("label")).select(F.col("id").alias("class"), "lang", "label")
    return (claims.join(named, ["class", "lang"]).groupBy("qid", "lang")
                  .agg(F.min(F.struct("pos", "class", "label"))["label"].alias("name")))


def checked_qids(articles: DataFrame, mapping: DataFrame, as_of: str, responses: DataFrame | None = None) -> DataFrame:
    """J-12 with the re-check of J-11: articles without a mapping, or with an
    expired negative one, take the qid of their captured response (wiki, title,
    body; X-19).  Adds ``found_qid`` and ``qid_error`` for the checked ones; ``qid`` is
    the mapping's or the found one."""
    q = lookup_qid(articles, mapping, as_of)
    q = q.withColumn("wiki", F.concat(F.lower(F.trim("lang")), F.lit("wiki"))).withColumn("_title", F.trim("title"))
    checked = F.col("qid_state").isin("missing", "expired")
    if responses is None:
        return q.withColumns({"found_qid": F.lit(None).cast("string"),
                              "qid_error": F.when(checked, F.lit("no response"))}).drop("_title")
    from editsurge.sources.responses import parse_qid_response
    r = parse_qid_response(responses.withColumnRenamed("title", "_title")).select(
        "wiki", "_title", F.col("qid").alias("found_qid"), F.col("error").alias("_error"), F.lit(True).alias("_answered"))
    again = q.filter(checked).join(r, ["wiki", "_title"], "left").withColumn(
        "qid_error", F.when(F.col("_answered").isNull(), F.lit("no response")).otherwise(F.col("_error")))
    rest = q.filter(~checked).withColumns({"found_qid": F.lit(None).cast("string"), "qid_error": F.lit(None).cast("string")})
    out = rest.unionByName(again.drop("_error", "_answered"))
    return out.withColumn("qid", F.coalesce("qid", "found_qid")).drop("_title")


def new_mappings(checked: DataFrame, as_of: str) -> DataFrame:
    """J-08 input (wiki, title, qid, cached_at): the found qids, and a null for each
    article whose error says that there is none (X-16).  Other errors write nothing."""
    from editsurge.functions.scalar import is_negative_lookup_error
    wrote = F.col("found_qid").isNotNull() | is_negative_lookup_error("qid_error")
    return (checked.filter(F.col("qid_state").isin("missing", "expired") & wrote)
                   .select("wiki", F.trim("title").alias("title"), F.col("found_qid").alias("qid"),
                           ts_lit(as_of).alias("cached_at")).distinct())


def resolve_topics(articles: DataFrame, article_topics: DataFrame, topics: DataFrame, mapping: DataFrame,
                   edges: DataFrame, nodes: DataFrame, labels: DataFrame, as_of: str,
                   closure: DataFrame | None = None, responses: DataFrame | None = None,
                   entities: DataFrame | None = None, checked: DataFrame | None = None) -> DataFrame:
    """J-11: topic per article by priority:
      stored (max confidence) -> negative cache (young) -> Uncategorized ->
      class hierarchy (1.0) -> instance-of label (0.5) -> Uncategorized (0.1).
    Articles without a live mapping are checked against the captured QID
    ``responses``; the label path takes the entity of the page (``entities``:
    wiki, title, qid), or the article's qid where no entity table is given.
    ``checked`` is the result of ``checked_qids`` where a caller has it already.
    Input articles: article_id, title, lang.  Output: article_id, name,
    path, confidence, resolution_source."""
    stored = max_confidence_topic(article_topics, topics).select(
        "article_id", F.struct("name", "path", "confidence").alias("stored"))
    # The lookup feeds three branches (hierarchy, label path, cascade):
    # computed once per batch and kept as a reliable checkpoint.
    ensure_checkpoint_dir(articles.sparkSession)
    if checked is None:
        checked = checked_qids(articles, mapping, as_of, responses)
    q = checked.withColumn("_lang", F.lower(F.trim("lang")))
    if entities is not None:
        pages = entities.select("wiki", F.col("title").alias("_t"), F.col("qid").alias("_entity"))
        q = q.withColumn("_t", F.trim("title")).join(pages, ["wiki", "_t"], "left").drop("_t")
    else:
        q = q.withColumn("_entity", F.col("qid"))
    q = q.checkpoint()
    live = F.col("qid_state") != "negative"
    items = q.filter(live & F.col("qid").isNotNull()).select("qid", F.col("_lang").alias("lang")).distinct()
    roots = pick_root_topic(class_hierarchy(items, edges, nodes, closure=closure, labels=labels)).select(
        "qid", F.col("lang").alias("_lang"), F.struct("name", "path").alias("root"))
    entity = q.filter(live & F.col("_entity").isNotNull()).select(F.col("_entity").alias("qid"), F.col("_lang").alias("lang"))
    api = api_label_topic(entity, edges, labels).select(
        F.col("qid").alias("_entity"), F.col("lang").alias("_lang"), F.col("name").alias("api_name"))

    # Rows without a key have nothing to look up and do not meet on one task.
    def looked_up(df: DataFrame, side: DataFrame, key: str, value: str) -> DataFrame:
        kind = side.schema[value].dataType
        return (df.filter(F.col(key).isNotNull()).join(side, [key, "_lang"], "left")
                  .unionByName(df.filter(F.col(key).isNull()).withColumn(value, F.lit(None).cast(kind))))

    j = looked_up(looked_up(q, roots, "qid", "root"), api, "_entity", "api_name").join(stored, "article_id", "left")
    fb = F.struct(F.lit(FALLBACK_TOPIC).alias("name"), F.lit(FALLBACK_TOPIC).alias("path"),
                  F.lit(FALLBACK_CONFIDENCE).cast("double").alias("confidence"), F.lit("fallback").alias("source"))
    chosen = (F.when(F.col("stored").isNotNull(),
                     F.struct(F.col("stored.name").alias("name"), F.col("stored.path").alias("path"),
                              F.col("stored.confidence").cast("double").alias("confidence"), F.lit("stored").alias("source")))
               .when(F.col("qid_state") == "negative", fb)
               .when(F.col("root").isNotNull(),
                     F.struct(F.col("root.name").alias("name"), F.col("root.path").alias("path"),
                              F.lit(HIERARCHY_CONFIDENCE).cast("double").alias("confidence"), F.lit("hierarchy").alias("source")))
               .when(F.col("api_name").isNotNull(),
                     F.struct(F.col("api_name").alias("name"), F.col("api_name").alias("path"),
                              F.lit(LABEL_CONFIDENCE).cast("double").alias("confidence"), F.lit("label").alias("source")))
               .otherwise(fb))
    return j.select("article_id", chosen.alias("t")).select(
        "article_id", F.col("t.name").alias("name"), F.col("t.path").alias("path"),
        F.col("t.confidence").cast("float").alias("confidence"), F.col("t.source").alias("resolution_source"))


def upsert_topics(topics: DataFrame, incoming: DataFrame) -> DataFrame:
    """J-07: key = path; an existing topic keeps its id and takes the new
    name; new paths get ids max(id) + 1, 2, ... in path order.  Input
    topics: topic_id, name, path; incoming: name, path (one name per path,
    the largest when several arrive)."""
    from editsurge.operators.enrich import max_id, number_rows
    inc = incoming.groupBy("path").agg(F.max("name").alias("new_name"))
    j = topics.join(inc, "path", "full_outer")
    kept = j.filter(F.col("topic_id").isNotNull()).select(
        "topic_id", F.coalesce("new_name", "name").alias("name"), "path")
    new = j.filter(F.col("topic_id").isNull()).select(F.col("new_name").alias("name"), "path")
    fresh = number_rows(new, ["path"], max_id(topics, "topic_id"), "topic_id").select("topic_id", "name", "path")
    return kept.unionByName(fresh)


def seed_report(topics: DataFrame, seeds: DataFrame) -> DataFrame:
    """S-10: how many default topics would be added and updated (by path)."""
    s = seeds.join(topics.select("path", F.lit(True).alias("exists")), "path", "left")
    return s.agg(F.count_if(F.col("exists").isNull()).alias("added"),
                 F.count_if(F.col("exists").isNotNull()).alias("updated"))


def replace_article_topics(old: DataFrame, new: DataFrame) -> DataFrame:
    """J-10: articles in ``new`` lose all old links and take the new set."""
    keys = new.select("article_id").distinct()
    return old.join(keys, "article_id", "left_anti").unionByName(new.select(*old.columns))


def upsert_mapping(old: DataFrame, new: DataFrame) -> DataFrame:
    """J-08: key (wiki, title): new rows replace qid and cached_at (a null
    qid is a negative entry); other rows stay."""
    keys = new.select("wiki", "title").distinct()
    return old.join(keys, ["wiki", "title"], "left_anti").unionByName(new.select(*old.columns))
