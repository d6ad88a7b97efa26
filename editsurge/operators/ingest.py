"""Ingest: change-feed filtering and mapping, validation, projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editsurge import schemas as S
from editsurge.functions.scalar import blank, language_of_wiki, parse_epoch
from editsurge.sources.adapters import ts_lit

# Default feed filter (wikis, namespaces, change types).
DEFAULT_WIKIS = ("enwiki", "ruwiki")
DEFAULT_NAMESPACES = (0,)
DEFAULT_TYPES = ("edit",)

# Error texts of the enricher's and the classifier's input checks.
ENRICH_INPUT_ERRORS = ("Edit event is null", "Title is required", "Wiki is required")
CLASSIFY_INPUT_ERRORS = ("Edit event is missing required fields", "ArticleId must be positive", "Lang cannot be empty")

# Reject reasons in the order the mapper checks them.
REJECT_REASONS = ("missing_field", "wiki_not_allowed", "type_not_allowed", "namespace_not_allowed")


def reject_reason(wikis=DEFAULT_WIKIS, namespaces=DEFAULT_NAMESPACES, types=DEFAULT_TYPES) -> Column:
    """F-03: first failing check, or null when the change is kept."""
    wl = [w.lower() for w in wikis]
    tl = [t.lower() for t in types]
    missing = F.col("id").isNull() | F.col("title").isNull() | F.col("user").isNull()
    bad_wiki = blank("wiki") | ~F.lower("wiki").isin(wl)
    bad_type = F.col("type").isNotNull() & ~F.lower("type").isin(tl)
    bad_ns = ~F.coalesce(F.col("namespace"), F.lit(0)).isin(list(namespaces))
    return (F.when(missing, REJECT_REASONS[0]).when(bad_wiki, REJECT_REASONS[1])
             .when(bad_type, REJECT_REASONS[2]).when(bad_ns, REJECT_REASONS[3]))


def filter_changes(df: DataFrame, wikis=DEFAULT_WIKIS, namespaces=DEFAULT_NAMESPACES,
                   types=DEFAULT_TYPES) -> DataFrame:
    """F-01: keep a change when id/title/user are present, the wiki is
    allowed (any case), the type is null or allowed (any case) and the
    namespace is allowed."""
    return df.filter(reject_reason(wikis, namespaces, types).isNull())


def rejected_changes_report(df: DataFrame, wikis=DEFAULT_WIKIS, namespaces=DEFAULT_NAMESPACES,
                            types=DEFAULT_TYPES) -> DataFrame:
    """F-03: count of rejected changes per first failing reason."""
    return (df.select(reject_reason(wikis, namespaces, types).alias("reason"))
              .filter(F.col("reason").isNotNull())
              .groupBy("reason").agg(F.count("*").alias("rejected")))


def to_raw_edits(df: DataFrame, collected_at: str) -> DataFrame:
    """F-02: project kept changes to RawEdit rows.

    event_id is a hash of (wiki, id) instead of a random id, so a replayed
    change maps to the same event (idempotent downstream writes)."""
    return df.select(
        F.sha2(F.concat_ws(":", F.col("wiki"), F.col("id").cast("string")), 256).alias("event_id"),
        F.col("id").alias("wiki_edit_id"),
        F.coalesce(F.col("page_id"), F.lit(0).cast("long")).alias("page_id"),
        "title", "wiki", "user",
        F.coalesce(F.col("bot"), F.lit(False)).alias("is_bot"),
        F.coalesce(F.col("minor"), F.lit(False)).alias("is_minor"),
        F.coalesce(F.col("type") == "new", F.lit(False)).alias("is_new"),
        F.coalesce(F.col("length.old"), F.lit(0)).alias("old_length"),
        F.coalesce(F.col("length.new"), F.lit(0)).alias("new_length"),
        parse_epoch("timestamp").alias("timestamp"),
        ts_lit(collected_at).alias("collected_at"),
    )


def raw_edits(changes: DataFrame, collected_at: str, **filters) -> DataFrame:
    """F-01 then F-02."""
    return to_raw_edits(filter_changes(changes, **filters), collected_at)


def enrich_input_error() -> Column:
    """F-05: reason text for an edit the enricher rejects, else null."""
    null_event, no_title, no_wiki = ENRICH_INPUT_ERRORS
    return (F.when(F.col("event_id").isNull(), null_event)
             .when(F.col("title").isNull() | (F.col("title") == ""), no_title)
             .when(F.col("wiki").isNull() | (F.col("wiki") == ""), no_wiki))


def classify_input_error() -> Column:
    """F-06: reason text for an edit the classifier rejects, else null."""
    lang = language_of_wiki("wiki")
    missing, bad_id, no_lang = CLASSIFY_INPUT_ERRORS
    return (F.when(blank("wiki") | blank("title"), missing)
             .when(F.col("article_id") <= 0, bad_id)
             .when(blank(lang), no_lang))


def split_errors(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows and (row, error) rows in one pass definition."""
    tagged = df.withColumn("error", error)
    return tagged.filter(F.col("error").isNull()).drop("error"), tagged.filter(F.col("error").isNotNull())


def field_presence(json_lines: DataFrame, col: str = "value") -> DataFrame:
    """F-12: records missing page_id, title, user, wiki or type, with one
    presence flag per field (a JSON null counts as missing)."""
    fields = ["page_id", "title", "user", "wiki", "type"]
    flags = [F.get_json_object(F.col(col), f"$.{f}").isNotNull().alias(f"has_{f}") for f in fields]
    out = json_lines.select(F.get_json_object(F.col(col), "$.id").cast("long").alias("id"), *flags)
    return out.filter(~F.col("has_page_id") | ~F.col("has_title") | ~F.col("has_user")
                      | ~F.col("has_wiki") | ~F.col("has_type"))


def to_classified(df: DataFrame, classified_at: str) -> DataFrame:
    """F-17: ClassifiedEdit rows: one-element topic list, empty embedding,
    title and wiki from the edit.  Expects topic_id/topic_name/topic_path/
    confidence columns beside the enriched edit."""
    topic = F.struct(F.col("topic_id").cast("int").alias("topic_id"), F.col("topic_name").alias("name"),
                     F.col("topic_path").alias("path"), F.col("confidence").cast("float").alias("confidence"))
    return df.select("event_id", "wiki_edit_id", "article_id", "title", "wiki",
                     F.array(topic).alias("topics"), F.array().cast(S.EMBEDDING).alias("embedding"),
                     F.col("timestamp").alias("ts"), ts_lit(classified_at).alias("classified_at"))
