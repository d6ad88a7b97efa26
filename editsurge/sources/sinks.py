"""Sinks: fact table, baselines, trend snapshots and keyed JSON topics.

Batch writers are idempotent per call (overwrite of their own partition or
batch directory), so a retried task or a replayed micro-batch does not
double-count.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editsurge.functions.scalar import effective_time
from editsurge.sources.json_codec import json_names, renamed


def valid_edits(df: DataFrame) -> DataFrame:
    """F-04: drop null events, blank event ids and null embeddings."""
    return df.filter(F.col("event_id").isNotNull() & (F.length(F.trim("event_id")) > 0)
                     & F.col("embedding").isNotNull())


def rejected(record: str = "") -> Column:
    """Whether F-04 rejects a row (``record`` is the prefix of its columns)."""
    event = F.col(record + "event_id")
    ok = event.isNotNull() & (F.length(F.trim(event)) > 0) & F.col(record + "embedding").isNotNull()
    return ~F.coalesce(ok, F.lit(False))


def invalid_edits(df: DataFrame) -> DataFrame:
    """Rows F-04 rejects (quarantine output instead of silent loss, Q6)."""
    return df.filter(rejected())


def flatten_topic_columns(df: DataFrame) -> DataFrame:
    """F-18: topic structs -> four parallel arrays; null lists and
    embeddings become empty arrays (the fact table's Nested layout)."""
    topics = F.coalesce(F.col("topics"), F.array().cast("array<struct<topic_id:int,name:string,path:string,confidence:float>>"))
    return df.select(
        *[c for c in df.columns if c not in ("topics", "embedding")],
        F.transform(topics, lambda t: t["topic_id"]).alias("topic_ids"),
        F.transform(topics, lambda t: t["name"]).alias("topic_names"),
        F.transform(topics, lambda t: t["path"]).alias("topic_paths"),
        F.transform(topics, lambda t: t["confidence"]).alias("topic_confidences"),
        F.coalesce(F.col("embedding"), F.array().cast("array<float>")).alias("embedding"))


def nest_topic_columns(df: DataFrame) -> DataFrame:
    """Rows of a flattened fact table with ``topics`` as structs again."""
    arrays = F.arrays_zip("topic_ids", "topic_names", "topic_paths", "topic_confidences")
    topics = F.transform(arrays, lambda x: F.struct(
        x["topic_ids"].alias("topic_id"), x["topic_names"].alias("name"), x["topic_paths"].alias("path"),
        x["topic_confidences"].alias("confidence")))
    flat = ("topic_ids", "topic_names", "topic_paths", "topic_confidences")
    return df.select(*[c for c in df.columns if c not in flat], topics.alias("topics"))


def with_eff_date(df: DataFrame) -> DataFrame:
    """Partition column: day of greatest(ts, classified_at)."""
    return df.withColumn("eff_date", F.to_date(effective_time()))


def write_edit_events(df: DataFrame, path: str, partition_by_day: bool = False,
                      mode: str = "append", num_files: int | None = None, batch_id: int | None = None,
                      flatten: bool = False) -> None:
    """S-05: validate and write classified edits to Parquet.

    With ``batch_id`` the rows replace the folder ``batch_id=N`` of the table, so a
    replayed batch or a repeated call leaves one copy; without it they are
    appended.  ``flatten`` stores the topics as parallel arrays (F-18);
    ``nest_topic_columns`` reads them back.

    Rows are range-partitioned by effective time (``num_files`` ranges,
    default ``spark.sql.shuffle.partitions``): the write runs in parallel
    even when the input is one file, a large day is split over many
    writers instead of one, and every file covers its own time range, so
    the Parquet min/max statistics let trailing-window scans skip old row
    groups.  With ``partition_by_day`` the table is also partitioned by
    ``eff_date`` (day of the effective time) for directory pruning.
    """
    out = valid_edits(df)
    spark = df.sparkSession
    if batch_id is not None:
        path, mode = os.path.join(path, f"batch_id={batch_id}"), "overwrite"
    n = num_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    eff = effective_time()
    if partition_by_day:
        out = with_eff_date(out).repartitionByRange(n, "eff_date", eff).sortWithinPartitions("eff_date", eff)
        out = flatten_topic_columns(out) if flatten else out
        out.write.mode(mode).partitionBy("eff_date").parquet(path)
    else:
        out = out.repartitionByRange(n, eff).sortWithinPartitions(eff)
        out = flatten_topic_columns(out) if flatten else out
        out.write.mode(mode).parquet(path)


def write_baselines(df: DataFrame, path: str, batch_id: int | None = None) -> None:
    """S-07: add baseline rows (topic_id, baseline_daily, calculated_at);
    the read side keeps the newest per topic (W-02), so a repeated append
    changes no result.  With ``batch_id`` the rows replace that batch's folder."""
    mode = "append"
    if batch_id is not None:
        path, mode = os.path.join(path, f"batch_id={batch_id}"), "overwrite"
    df.select(F.col("topic_id").cast("int"), F.col("baseline_daily").cast("float"),
              F.col("calculated_at").cast("timestamp_ntz")).write.mode(mode).parquet(path)


def write_trend_snapshot(updates: DataFrame, path: str) -> None:
    """S-08: one snapshot record per period, replacing that period only
    (dynamic partition overwrite keyed by period)."""
    (updates.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("period").parquet(path))


def _json_struct(df: DataFrame, cols: list[str]) -> Column:
    kinds = T.StructType([df.schema[c] for c in cols])
    names = json_names(kinds)
    return F.struct(*[renamed(F.col(c), kinds[c].dataType).alias(names[c]) for c in cols])


def to_topic_records(df: DataFrame, key: Column | str, value_cols: list[str] | None = None) -> DataFrame:
    """S-04: (key, value) records, value = JSON without nulls, camelCase at every level."""
    key = F.col(key) if isinstance(key, str) else key
    value_cols = value_cols or df.columns
    return df.select(key.cast("string").alias("key"), F.to_json(_json_struct(df, value_cols)).alias("value"))


def write_topic(df: DataFrame, path: str, key: Column | str, value_cols: list[str] | None = None,
                kafka_bootstrap: str | None = None) -> None:
    """S-04 batch: append keyed JSON records to a topic folder (the file
    twin of a Kafka topic), or with ``kafka_bootstrap`` to the Kafka topic
    named ``path`` (needs the spark-sql-kafka package; the producer runs
    with acks=all and idempotence, as the reference's producer does)."""
    recs = to_topic_records(df, key, value_cols)
    if kafka_bootstrap:
        (recs.write.format("kafka").option("kafka.bootstrap.servers", kafka_bootstrap)
             .option("kafka.acks", "all").option("kafka.enable.idempotence", "true")
             .option("topic", path).save())
    else:
        recs.write.mode("append").json(path)
