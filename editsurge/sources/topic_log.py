"""S-03 and S-02 with offsets: a topic kept as numbered records, and a stream source for it.

``append`` is the writing side of a topic: records go to partitions by their key and get
consecutive offsets there, behind those stored before.  A segment is a folder for a
partition and an append, ``partition=P/range=F-E`` with the offsets F to below E, so
what a topic holds follows from the names of its folders; its Parquet files hold ranges
of these offsets.

``register`` adds the format ``topic_log`` to a session: a stream (or batch) of partition, offset,
key and value.  The progress that Spark keeps in the query's checkpoint is the next offset of each
partition, so a restarted query goes on behind the last committed record, with no gap and
nothing twice.  Segments are read by the executors, as Arrow batches, one task for each file.

A captured event stream is appended the same way with the frame's id as key;
``last_keys`` then gives the id that a reconnecting capture resumes from.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editsurge.session import ensure_checkpoint_dir

SCHEMA = "partition int, offset long, key string, value string"
FORMAT = "topic_log"


def _names(spark: SparkSession, folder: str) -> list[str]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def ends(spark: SparkSession, path: str) -> dict[int, int]:
    """The next offset of every partition that holds records."""
    out: dict[int, int] = {}
    for name in _names(spark, path):
        if name.startswith("partition="):
            ranges = [n for n in _names(spark, os.path.join(path, name)) if n.startswith("range=")]
            out[int(name[len("partition="):])] = max((int(n.split("-")[1]) for n in ranges), default=0)
    return out


def append(records: DataFrame, path: str, partitions: int = 4, partition: Column | None = None, order: list | None = None) -> None:
    """Append (key, value) records.  Without ``partition`` a record's partition is a hash of its key, and
    records without a key are dealt by their value; ``order`` (columns, ascending) numbers the records of an append
    within a partition (by key and value, if None).  One writer at a time."""
    spark = records.sparkSession
    ensure_checkpoint_dir(spark)
    if partition is None:
        partition = F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(partitions))
    by = [c if isinstance(c, Column) else F.col(c) for c in order or ["key", "value"]]
    keys = [f"_by{i}" for i in range(len(by))]
    # Dealt in ranges of the order: a partition is sorted and written by many tasks, each of which numbers its
    # own records behind those of the ranges before.  Stored, so that the ranges are the same for both passes.
    ranged = (records.select("key", "value", partition.cast("int").alias("partition"), *[c.alias(k) for c, k in zip(by, keys)])
                     .repartitionByRange("partition", *keys)
                     .sortWithinPartitions("partition", *keys)
                     .select("partition", "key", "value", F.monotonically_increasing_id().alias("at")).checkpoint())
    piece = F.shiftright("at", 33)      # the task that wrote a record
    sizes = ranged.groupBy("partition", piece.alias("piece")).agg(F.count("*").alias("n"), F.min("at").alias("low")).collect()  # a row a range
    if not sizes:
        return
    if any(r["partition"] is None for r in sizes):
        raise ValueError("a record has no partition")
    before = ends(spark, path)
    starts, segments = {r["partition"]: before.get(r["partition"], 0) for r in sizes}, []
    after = dict(starts)
    for r in sorted(sizes, key=lambda r: (r["partition"], r["piece"])):
        segments.append((r["partition"], r["piece"], after[r["partition"]] - r["low"]))
        after[r["partition"]] += r["n"]
    dealt = spark.createDataFrame([(p, k, shift, f"{starts[p]}-{after[p]}") for p, k, shift in segments],
                                  "partition int, piece long, shift long, range string")
    rows = ranged.withColumn("piece", piece).join(F.broadcast(dealt), ["partition", "piece"]).withColumn("offset", F.col("at") + F.col("shift"))
    rows.select("offset", "key", "value", "partition", "range").write.mode("append").partitionBy("partition", "range").parquet(path)


def last_keys(spark: SparkSession, path: str) -> dict[int, str]:
    """The key of the newest record of every partition (the resume id of a captured stream)."""
    if not ends(spark, path):
        return {}
    stored = spark.read.parquet(path)
    return {r["partition"]: r["key"] for r in stored.groupBy("partition").agg(F.max_by("key", "offset").alias("key")).collect()}


def register(spark: SparkSession) -> None:
    """Make ``spark.readStream.format("topic_log").load(path)`` known to a session.  The classes are
    local so that they travel to the workers by value, whatever is installed there."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
    schema, fmt = SCHEMA, FORMAT

    class Segment(InputPartition):
        def __init__(self, path, partition, low, high):
            self.path, self.partition, self.low, self.high = path, partition, low, high

    def open_fs(path):
        from pyarrow import fs
        if re.match(r"^[a-z][a-z0-9+.-]*:", path):
            return fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", path))
        return fs.LocalFileSystem(), path

    def segments(path):
        """(partition, first offset, end, folder) of every segment."""
        from pyarrow import fs
        store, root = open_fs(path)
        out = []
        for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            m = re.search(r"partition=(\d+)/range=(\d+)-(\d+)$", info.path)
            if m and info.type == fs.FileType.Directory:
                out.append((int(m[1]), int(m[2]), int(m[3]), info.path))
        return sorted(out)

    def read_segment(path, part):
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        if not isinstance(part, Segment):       # a topic without records has no segment to read
            return
        store, _ = open_fs(path)
        with store.open_input_file(part.path) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=4096, columns=["offset", "key", "value"]):
                t = pa.table(batch).filter(pc.and_(pc.greater_equal(batch["offset"], part.low), pc.less(batch["offset"], part.high)))
                t = t.add_column(0, pa.field("partition", pa.int32()), pa.array([part.partition] * t.num_rows, pa.int32()))
                yield from t.cast(pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("key", pa.string()),
                                             ("value", pa.string())])).to_batches()

    def between(path, start, end):
        from pyarrow import fs
        store, _ = open_fs(path)
        out = []
        for p, lo, hi, folder in segments(path):
            low, high = max(lo, start.get(str(p), 0)), min(hi, end.get(str(p), 0))
            if low < high:
                files = (info.path for info in store.get_file_info(fs.FileSelector(folder)))
                out += [Segment(f, p, low, high) for f in sorted(files) if f.endswith(".parquet")]
        return out

    def newest(path):
        out = {}
        for p, _, hi, _ in segments(path):
            out[str(p)] = max(out.get(str(p), 0), hi)
        return out

    class StreamReader(DataSourceStreamReader):
        def __init__(self, path):
            self.path = path

        def initialOffset(self):
            return {}

        def latestOffset(self):
            return newest(self.path)

        def partitions(self, start, end):
            return between(self.path, start, end)

        def read(self, partition):
            return read_segment(self.path, partition)

        def commit(self, end):
            pass

    class BatchReader(DataSourceReader):
        def __init__(self, path):
            self.path = path

        def partitions(self):
            return between(self.path, {}, newest(self.path))

        def read(self, partition):
            return read_segment(self.path, partition)

    class TopicLog(DataSource):
        @classmethod
        def name(cls):
            return fmt

        def schema(self):
            return schema

        def reader(self, schema):
            return BatchReader(self.options["path"])

        def streamReader(self, schema):
            return StreamReader(self.options["path"])

    spark.dataSource.register(TopicLog)


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    """partition, offset, key, value of a topic as a stream."""
    register(spark)
    return spark.readStream.format(FORMAT).load(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """partition, offset, key, value of all records a topic holds."""
    register(spark)
    return spark.read.format(FORMAT).load(path)
