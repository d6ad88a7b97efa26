"""S-06 + F-10: a topic-to-file index of the edit table, so that a topic's edits are read from the
files that hold them.

Topic lists are arrays, whose Parquet statistics say nothing about single topics.  The
writer of a batch therefore notes, once the batch is stored, which files hold which topics
and the newest effective time of each; the index of a batch replaces its own folder, as the
batch does.  A reader asks the index (a few rows for a topic) and opens only those files,
leaving out those that end before its window.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editsurge import schemas as S
from editsurge.functions.scalar import effective_time
from editsurge.sources.adapters import ts_lit


def index_batch(spark: SparkSession, table_path: str, index_path: str, batch_id: int) -> None:
    """Note the topics of a stored batch's files (file names relative to the table)."""
    stored = spark.read.schema(S.EDIT_EVENTS).parquet(os.path.join(table_path, f"batch_id={batch_id}"))
    name = F.regexp_extract(F.col("_metadata.file_path"), f"(batch_id={batch_id}/.*)$", 1)
    noted = (stored.select(name.alias("file"), effective_time().alias("eff"), F.explode(F.array_distinct("topics.topic_id")).alias("topic_id"))
                   .groupBy("topic_id", "file").agg(F.count("*").alias("edits"), F.max("eff").alias("newest")))
    noted.write.mode("overwrite").parquet(os.path.join(index_path, f"batch_id={batch_id}"))


def files_of(spark: SparkSession, index_path: str, topic_ids: list[int], since: str | None = None) -> list[str]:
    """Files that hold one of the topics, with an edit at or after ``since``."""
    noted = spark.read.parquet(index_path).filter(F.col("topic_id").isin([int(i) for i in topic_ids]))
    if since is not None:
        noted = noted.filter(F.col("newest") >= ts_lit(since))
    return sorted(r.file for r in noted.select("file").distinct().collect())  # names, as the driver lists them for any scan


def edits_of_topics(spark: SparkSession, table_path: str, index_path: str, topic_ids: list[int], since: str | None = None) -> DataFrame:
    """The stored edits of some topics, from the files that hold them (whole rows, topic lists as stored)."""
    files = files_of(spark, index_path, topic_ids, since)
    wanted = F.arrays_overlap("topics.topic_id", F.array(*[F.lit(int(i)) for i in topic_ids]))
    if not files:
        return spark.createDataFrame([], S.EDIT_EVENTS)
    paths = [os.path.join(table_path, f) for f in files]
    read = spark.read.schema(S.EDIT_EVENTS).parquet(*paths).filter(wanted)
    return read if since is None else read.filter(effective_time() >= ts_lit(since))
