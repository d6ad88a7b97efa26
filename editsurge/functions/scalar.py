"""Scalar column expressions.

Every function takes and returns ``pyspark.sql.Column`` objects built from
built-in functions only, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "PERIODS", "PERIOD_HOURS", "PERIOD_IDS", "SCORE_EPSILON",
    "parse_epoch", "language_of_wiki", "language_of_wiki_all", "clean_category",
    "truncate_extract", "diff_size", "article_url", "cluster_id", "path_head",
    "is_placeholder_name", "is_placeholder_path", "effective_time", "to_day",
    "entity_id_from_uri", "safe_int", "trends_snapshot_key", "topic_snapshot_key",
    "is_negative_lookup_error", "period_from_value", "period_start",
    "display_name", "display_path", "direction", "blank",
]

# Fixed values that must equal the reference's: trend periods in enum order
# with their trailing window in hours.
PERIODS = ["LastHour", "Last24Hours", "Last7Days"]
PERIOD_HOURS = {"LastHour": 1, "Last24Hours": 24, "Last7Days": 168}
PERIOD_IDS = {"LastHour": 0, "Last24Hours": 1, "Last7Days": 2}
SCORE_EPSILON = 0.0001

# Article link base, cache-key prefixes, placeholder topic name.
ARTICLE_URL_BASE = "https://en.wikipedia.org/wiki/"
TRENDS_KEY_PREFIX = "v3:trends:"
TOPIC_KEY_PREFIX = "v2:topic:"
TOPIC_NAME_PREFIX = "topic-"

# Category prefixes removed from category titles (any case).
CATEGORY_PREFIXES = ["Category:", "Категория:", "Kategorie:", "Catégorie:"]



def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank(c) -> Column:
    """True for null or whitespace-only text."""
    c = _c(c)
    return c.isNull() | (F.trim(c) == "")


def parse_epoch(c) -> Column:
    """X-01: epoch number -> timestamp; above 10^10 it is milliseconds."""
    c = _c(c)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (F.when(c > F.lit(10_000_000_000), F.timestamp_add("MILLISECOND", c, epoch))
            .otherwise(F.timestamp_add("SECOND", c, epoch)))


def language_of_wiki(c) -> Column:
    """X-02: strip one trailing 'wiki' (any case): enwiki -> en."""
    return F.regexp_replace(_c(c), "(?i)wiki$", "")


def language_of_wiki_all(c) -> Column:
    """X-02 variant used by the entity lookup: every 'wiki' is removed."""
    return F.replace(_c(c), F.lit("wiki"), F.lit(""))


def clean_category(c) -> Column:
    """X-03: drop the first matching category prefix (any case), then trim."""
    alt = "|".join(p.rstrip(":") for p in CATEGORY_PREFIXES)
    return F.trim(F.regexp_replace(_c(c), f"(?iu)^({alt}):", ""))


def truncate_extract(c, n: int = 4000) -> Column:
    """X-04: first n characters; null and empty stay as they are."""
    c = _c(c)
    return F.when(c.isNull() | (c == ""), c).otherwise(F.substring(c, 1, n))


def diff_size(new_len, old_len) -> Column:
    """X-05: new length minus old length."""
    return _c(new_len) - _c(old_len)


def article_url(title) -> Column:
    """X-06: article link with RFC 3986 percent-encoding of the title."""
    enc = F.url_encode(_c(title))
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    enc = F.replace(enc, F.lit("*"), F.lit("%2A"))
    enc = F.replace(enc, F.lit("%7E"), F.lit("~"))
    return F.concat(F.lit(ARTICLE_URL_BASE), enc)


def cluster_id(label) -> Column:
    """X-07: lower case, spaces to dashes."""
    return F.replace(F.lower(_c(label)), F.lit(" "), F.lit("-"))


def path_head(p) -> Column:
    """X-08: first non-empty trimmed segment of a '>' path, else the text."""
    p = _c(p)
    segs = F.filter(F.transform(F.split(p, ">"), lambda s: F.trim(s)), lambda s: s != "")
    return F.coalesce(F.get(segs, 0), p)


def is_placeholder_name(name) -> Column:
    """X-09: names like 'topic 5' / 'topic5' (lower-cased)."""
    low = F.lower(_c(name))
    return low.rlike(r"^topic\s*\d+$") | low.rlike(r"^topic\d+$")


def is_placeholder_path(path) -> Column:
    """X-09: paths like 'topic-5' (lower-cased)."""
    return F.lower(_c(path)).rlike(r"^topic-\d+$")


def effective_time(ts="ts", classified_at="classified_at") -> Column:
    """X-10: greatest(Timestamp, ClassifiedAt)."""
    return F.greatest(_c(ts), _c(classified_at))


def to_day(ts="ts") -> Column:
    """X-11: calendar day (UTC)."""
    return F.to_date(_c(ts))


def entity_id_from_uri(u) -> Column:
    """X-12: text after the last '/'; no slash or a trailing slash -> null."""
    u = _c(u)
    tail = F.element_at(F.split(u, "/"), -1)
    return F.when(blank(u) | ~u.contains("/") | (tail == ""), F.lit(None).cast("string")).otherwise(tail)


def safe_int(s) -> Column:
    """X-13: parse an int, else 0."""
    return F.coalesce(_c(s).try_cast("int"), F.lit(0))


def trends_snapshot_key(period) -> Column:
    """X-14: v3:trends:{period} in lower case."""
    return F.lower(F.concat(F.lit(TRENDS_KEY_PREFIX), _c(period)))


def topic_snapshot_key(topic_id, period) -> Column:
    """X-14: v2:topic:{id}:{period} in lower case."""
    return F.lower(F.concat(F.lit(TOPIC_KEY_PREFIX), _c(topic_id).cast("string"), F.lit(":"), _c(period)))


def is_negative_lookup_error(err) -> Column:
    """X-16: error text naming a missing wikibase_item / pageprops / page."""
    e = _c(err)
    return F.coalesce(~blank(e) & e.rlike("(?i)(wikibase_item|pageprops|page not found)"), F.lit(False))


def period_from_value(v) -> Column:
    """X-22: period given as enum number or name -> period name."""
    v = _c(v).cast("string")
    num = v.try_cast("double").cast("int")
    by_num = (F.when(num == 0, "LastHour").when(num == 1, "Last24Hours").when(num == 2, "Last7Days"))
    by_name = F.when(F.lower(v) == "lasthour", "LastHour").when(F.lower(v) == "last24hours", "Last24Hours") \
        .when(F.lower(v) == "last7days", "Last7Days")
    return F.coalesce(by_num, by_name)


def period_start(as_of, period: str) -> Column:
    """F-09: lower bound of the trailing window; unknown periods use 24 h."""
    hours = PERIOD_HOURS.get(period, 24)
    return F.lit(as_of) - F.expr(f"INTERVAL {hours} HOURS")


def display_name(name, topic_id) -> Column:
    """F-15: blank name -> 'topic-{id}'."""
    return F.when(blank(name), F.concat(F.lit(TOPIC_NAME_PREFIX), _c(topic_id).cast("string"))).otherwise(_c(name))


def display_path(path, name) -> Column:
    """F-15: blank path -> the (display) name."""
    return F.when(blank(path), _c(name)).otherwise(_c(path))


def direction(change) -> Column:
    """F-14: Rising above 0.05, Falling below -0.05, else Stable (float compare)."""
    c = _c(change).cast("float")
    return (F.when(c > F.lit(0.05).cast("float"), "Rising")
            .when(c < F.lit(-0.05).cast("float"), "Falling")
            .otherwise("Stable"))
