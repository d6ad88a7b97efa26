"""Queries meet the shards by exchanges on the executors, in chunks and slots, with the results of brute force."""
import numpy as np

from editsurge.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def made(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=8 if k % 3 else 4).astype(np.float32).tolist()) for k in range(400)]
    rows += [(k + 1000, rows[k][1]) for k in range(0, 40, 2)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(rows, k=5):
    want = []
    for at, (own, q) in enumerate(rows):
        if own % 10 == 0:
            near = sorted((-float(ann.cosine(np.array(x), np.array(q))), i) for j, (i, x) in enumerate(rows) if j != at and len(x) == len(q))
            want += [(own, r, i, round(-s, 9)) for r, (s, i) in enumerate(near[:k], 1)]
    return sorted(want)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_side_passes_the_driver(spark):
    rows, df = made(spark)
    usable = ann.usable(df)
    index, shards = ann.build_index(usable, shard_rows=40)
    found = ann.search(usable, index, shards, usable.filter("vec_id % 10 = 0"))
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in found.collect()]
    assert sorted(got) == brute(rows)
    assert "Broadcast" not in plan_of(found) and "Exchange" in plan_of(found)  # however small the planner takes a side to be


def test_chunks_and_slots_change_no_result(spark, monkeypatch):
    rows, df = made(spark)
    usable = ann.usable(df)
    index, shards = ann.build_index(usable, shard_rows=40)
    for chunk, slot, per_core in ((256, 1, 1), (1 << 20, 24 << 20, 1), (300, 24 << 20, 100)):
        for name, value in (("CHUNK_BYTES", chunk), ("SLOT_BYTES", slot), ("SLOTS_A_CORE", per_core)):
            monkeypatch.setattr(ann, name, value)
        found = ann.search(usable, index, shards, usable.filter("vec_id % 10 = 0"))
        assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in found.collect()) == brute(rows)


def test_index_keeps_floats_short_and_doubles_whole(spark):
    rows = [(k, [1.0, 1e-3 * k + 1e-12]) for k in range(12)]
    for kind, size in (("float", 4), ("double", 8)):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
        index, _ = ann.build_index(ann.usable(df))
        assert [len(r.vectors) // (r.n * r.dim) for r in index.collect()] == [size]
        want = {(q, i): float(ann.cosine(*(np.array(rows[x][1], dtype=f"f{size}").astype(float) for x in (q, i)))) for q in (0,) for i in range(12)}
        got = ann.nearest(df).collect()
        assert len(got) == 5 and all(r.score == want[r.query_id, r.vec_id] for r in got)
