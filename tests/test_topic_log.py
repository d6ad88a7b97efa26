"""Topic log: offsets, restarts without a gap, resume ids, batch reads."""
import os
import uuid

from pyspark.sql import functions as F

from editsurge.sources import topic_log as tl
from editsurge.streaming import jobs as J


def folder(spark):
    return J.state_dir(spark, "test-topic-log", uuid.uuid4().hex)


def records(spark, ids):
    return spark.createDataFrame([(None if i % 10 == 0 else f"k{i % 7}", f"v{i:03d}") for i in ids], "key string, value string")


def test_offsets_follow_and_restart_resumes(spark):
    d = folder(spark)
    topic, ck, out = (os.path.join(d, x) for x in ("topic", "ck", "out"))

    def go():
        q = (tl.read_stream(spark, topic).writeStream.option("checkpointLocation", ck).format("parquet").option("path", out)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None

    for k, ids in enumerate([range(40), range(40, 45), range(45, 100)]):
        tl.append(records(spark, ids), topic, partitions=3)
        if k == 1:
            continue            # two appends are read by one run
        go()
        got = spark.read.parquet(out)
        assert got.count() == ids[-1] + 1 and got.select("value").distinct().count() == got.count()
    rows = spark.read.parquet(out).collect()
    for p in {r.partition for r in rows}:
        assert sorted(r.offset for r in rows if r.partition == p) == list(range(sum(r.partition == p for r in rows)))
    assert all(len({r.partition for r in rows if r.key == key}) == 1 for key in {r.key for r in rows} - {None})
    assert tl.ends(spark, topic) == {p: 1 + max(r.offset for r in rows if r.partition == p) for p in {r.partition for r in rows}}
    go()                        # nothing new
    assert spark.read.parquet(out).count() == 100
    assert sorted(map(repr, tl.read(spark, topic).collect())) == sorted(map(repr, spark.read.parquet(out).select("partition", "offset", "key", "value").collect()))


def test_resume_id_of_a_capture(spark):
    from editsurge.sources import feeds as fd
    d = folder(spark)
    topic = os.path.join(d, "topic")
    assert tl.last_keys(spark, topic) == {}
    frames = "".join(f"event: message\nid: {i}\ndata: {{\"id\": {i}}}\n\n" for i in range(1, 31))
    got = fd.decode_sse(spark.createDataFrame([(frames,)], "value string"))
    recs = got.select(F.col("event_id").alias("key"), F.col("data").alias("value"))
    number = F.col("key").cast("int")
    tl.append(recs.filter(number <= 20), topic, partition=F.lit(0), order=[number])
    assert tl.last_keys(spark, topic) == {0: "20"}
    tl.append(recs.filter(number > int(tl.last_keys(spark, topic)[0])), topic, partition=F.lit(0), order=[number])
    assert [(r.offset, r.key) for r in tl.read(spark, topic).orderBy("offset").collect()] == [(i, str(i + 1)) for i in range(30)]


def test_empty_append(spark):
    topic = os.path.join(folder(spark), "topic")
    tl.append(records(spark, []), topic)
    assert tl.ends(spark, topic) == {} and tl.read(spark, topic).count() == 0


def test_a_partition_is_numbered_by_many_tasks(spark):
    topic = os.path.join(folder(spark), "topic")
    for k in range(2):
        numbers = spark.range(k * 40000, (k + 1) * 40000, 1, 4).select(F.col("id").cast("string").alias("id"))
        part = numbers.select(
            F.col("id").alias("key"), F.concat(F.lpad("id", 9, "0"), *[F.sha2(F.concat("id", F.lit(f"-{j}")), 256) for j in range(8)]).alias("value"))
        tl.append(part, topic, partition=F.lit(0), order=["value"])
    files = [f for _, _, names in os.walk(os.path.join(topic.removeprefix("file:"), "partition=0")) for f in names if f.endswith(".parquet")]
    assert len(files) > 4
    got = tl.read(spark, topic)
    assert got.rdd.getNumPartitions() == len(files)
    assert got.count() == 80000 and got.filter(F.col("offset") != F.col("key").cast("long")).isEmpty()
