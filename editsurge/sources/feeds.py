"""Change-feed and topic sources (S-01..S-03) and response parsers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editsurge import schemas as S
from editsurge.sources.json_codec import parse_record


def read_recent_changes(spark: SparkSession, path: str, streaming: bool = False,
                        quarantine: bool = False) -> DataFrame:
    """S-01: JSON-lines change feed with an explicit schema.

    Malformed lines never stop the read.  With ``quarantine`` they are kept
    with the raw text in ``_corrupt_record`` (a struct of nulls otherwise),
    so a caller can route them to a bad-records table instead of losing
    them; without it they are dropped."""
    reader = spark.readStream if streaming else spark.read
    if quarantine:
        # Parse text lines with from_json (PERMISSIVE): a bad line keeps its
        # raw text in _corrupt_record, a good line leaves it null.
        schema = T.StructType(S.RECENT_CHANGE.fields + [T.StructField("_corrupt_record", T.StringType())])
        opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
        lines = reader.text(path)
        return lines.select(F.from_json("value", schema, opts).alias("r")).select("r.*")
    return reader.schema(S.RECENT_CHANGE).option("mode", "DROPMALFORMED").json(path)


def read_sse(spark: SparkSession, path: str, line_end: str = "\n") -> DataFrame:
    """S-02 input: a captured event stream, split at blank lines while it is read.
    ``line_end`` is the capture's line end; a capture with the other one is
    still decoded right, but its files are not split among tasks."""
    return spark.read.option("lineSep", line_end * 2).text(path)


def decode_sse(text: DataFrame, col: str = "value") -> DataFrame:
    """S-02: server-sent-event frames -> (event_id, data) rows.

    Input: text with one or more frames a row (``read_sse``).  Frames end at a
    blank line, lines at LF or CRLF.  data: lines of a frame are joined by a
    newline, ``id:`` gives the resume id, ``event:`` and ``:`` comment lines are
    ignored, frames without data are skipped."""
    frames = text.select(F.explode(F.split(F.col(col), "\r?\n\r?\n")).alias("_frame"))
    lines = F.split("_frame", "\r?\n")
    data = F.transform(F.filter(lines, lambda x: x.startswith("data:")),
                       lambda x: F.regexp_replace(x, "^data: ?", ""))
    ids = F.transform(F.filter(lines, lambda x: x.startswith("id:")),
                      lambda x: F.trim(F.regexp_replace(x, "^id:", "")))
    return (frames.select(F.element_at(ids, -1).alias("event_id"),
                          F.array_join(data, "\n").alias("data"), F.size(data).alias("n"))
                  .filter(F.col("n") > 0).drop("n"))


def parse_changes(frames: DataFrame, col: str = "data") -> DataFrame:
    """S-02 tail: JSON text -> typed recent_change rows; bad JSON dropped."""
    parsed = frames.select(F.from_json(F.col(col), S.RECENT_CHANGE).alias("r"), F.col(col).alias("_raw"))
    # from_json gives a struct of nulls for bad JSON; a valid change has an id
    # or a title at least.
    return parsed.filter(F.col("r.id").isNotNull() | F.col("r.title").isNotNull()).select("r.*")


def read_topic(spark: SparkSession, path: str, schema: T.StructType, streaming: bool = False) -> DataFrame:
    """S-03: keyed JSON records of a topic directory (file twin of a Kafka
    topic; with the connector present the same frame comes from
    ``readStream.format('kafka')`` with ``startingOffsets=earliest``).

    The value is parsed with ``schema`` and field names match in any case
    (X-17): the top-level object is read as a map, its keys lower-cased,
    and each field looked up by its lower-cased camelCase name.  A null or
    empty value gives a null record."""
    rec = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
    raw = (spark.readStream if streaming else spark.read).schema(rec).json(path)
    return raw.select("key", parse_record("value", schema).alias("record"))
