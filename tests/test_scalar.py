"""Scalar functions (X-*) and small predicates (F-14, F-15) on golden rows."""

from pyspark.sql import functions as F

from editsurge.functions import scalar as X


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_parse_epoch_seconds_and_millis(spark):
    got = one(spark, F.date_format(X.parse_epoch("v"), "yyyy-MM-dd HH:mm:ss.SSS"),
              [(1700000000,), (1700000000123,), (10000000000,)], "v long")
    assert got == ["2023-11-14 22:13:20.000", "2023-11-14 22:13:20.123", "2286-11-20 17:46:40.000"]


def test_path_head(spark):
    got = one(spark, X.path_head("p"), [(" A >  > B ",), ("",), (">",), ("Solo",)], "p string")
    assert got == ["A", "", ">", "Solo"]


def test_clean_category(spark):
    got = one(spark, X.clean_category("c"), [("category: X",), ("Категория:Наука",), ("Y",), ("КАТЕГОРИЯ:Наука",),
                                               ("Catégorie:Art",), ("Kategorie:Kunst",)], "c string")
    assert got == ["X", "Наука", "Y", "Наука", "Art", "Kunst"]


def test_direction_thresholds(spark):
    got = one(spark, X.direction("c"), [(0.05,), (0.0501,), (-0.05,), (-0.0501,)], "c float")
    assert got == ["Stable", "Rising", "Stable", "Falling"]


def test_entity_id_and_safe_int(spark):
    got = one(spark, X.entity_id_from_uri("u"), [("http://www.wikidata.org/entity/Q5",), ("http://x/",), ("Q5",), (None,)],
              "u string")
    assert got == ["Q5", None, None, None]
    assert one(spark, X.safe_int("s"), [("12",), ("x",), (None,), ("1.5",)], "s string") == [12, 0, 0, 0]


def test_snapshot_keys(spark):
    got = one(spark, X.trends_snapshot_key("p"), [("LastHour",), ("Last24Hours",), ("Last7Days",)], "p string")
    assert got == ["v3:trends:lasthour", "v3:trends:last24hours", "v3:trends:last7days"]
    df = spark.createDataFrame([(1, "LastHour"), (42, "Last24Hours")], "i int, p string")
    assert [r[0] for r in df.select(X.topic_snapshot_key("i", "p")).collect()] == ["v2:topic:1:lasthour",
                                                                                  "v2:topic:42:last24hours"]


def test_article_url_rfc3986(spark):
    got = one(spark, X.article_url("t"), [("Article 5",), ("a*b~c+d/(é)",)], "t string")
    assert got == ["https://en.wikipedia.org/wiki/Article%205",
                   "https://en.wikipedia.org/wiki/a%2Ab~c%2Bd%2F%28%C3%A9%29"]


def test_language_and_placeholders(spark):
    assert one(spark, X.language_of_wiki("w"), [("enwiki",), ("ENWIKI",), ("wikidata",)], "w string") == ["en", "EN", "wikidata"]
    assert one(spark, X.is_placeholder_name("n"), [("topic 5",), ("Topic5",), ("topic-5",), ("science",)], "n string") == \
        [True, True, False, False]
    assert one(spark, X.is_placeholder_path("n"), [("topic-5",), ("Topic-12",), ("topic 5",)], "n string") == [True, True, False]


def test_display_fallbacks(spark):
    df = spark.createDataFrame([(1, "", ""), (2, "Sci", " "), (3, "Sci", "A > B")], "id int, name string, path string")
    name = X.display_name("name", "id")
    got = df.select(name.alias("n"), X.display_path(F.col("path"), name).alias("p")).collect()
    assert [(r.n, r.p) for r in got] == [("topic-1", "topic-1"), ("Sci", "Sci"), ("Sci", "A > B")]


def test_period_from_value(spark):
    got = one(spark, X.period_from_value("v"), [("0",), ("2",), ("last24hours",), ("1.0",), ("x",)], "v string")
    assert got == ["LastHour", "Last7Days", "Last24Hours", "Last24Hours", None]


def test_negative_lookup_error(spark):
    got = one(spark, X.is_negative_lookup_error("e"), [("Wikipedia page does not have wikibase_item.",),
                                                      ("PAGE NOT FOUND",), ("timeout",), (None,)], "e string")
    assert got == [True, True, False, False]
