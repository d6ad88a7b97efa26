"""HNSW search against brute force: recall, scores, odd vectors."""
import numpy as np
import pytest

from editsurge.llm import ann, hnsw

SCHEMA = "vec_id long, embedding array<float>"


def brute(x, ids, q, own, k=5):
    s = ann.cosine(x, x[q])
    order = [i for i in np.lexsort((ids, -s)) if i != own][:k]
    return [(int(ids[i]), float(s[i])) for i in order]


def test_recall_on_the_driver_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    t = df.toPandas()
    x, ids = np.stack(t.embedding).astype(float), t.vec_id.to_numpy()
    rows = ann.usable(df)
    index, shards = ann.build_index(rows, shard_rows=700)
    assert len(shards) == 3
    got = {}
    for r in ann.search(rows, index, shards, rows.filter("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for i in np.flatnonzero(ids % 50 == 0):
        want = brute(x, ids, i, i)
        found = sorted(got[ids[i]])
        assert [f[0] for f in found] == [1, 2, 3, 4, 5]
        hits += len({w[0] for w in want} & {f[1] for f in found})
    assert hits / (5 * len(got)) >= 0.9


def test_odd_vectors_copies_and_ties(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (50, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]),
            (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (100, [1.0, 2.0, 4.0]),
            (None, [1.0, 0.5]), (150, [0.0, 0.0])] + [(200 + k, [1.0, 0.0]) for k in range(1, 40)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("vec_id", "embedding", "1 AS score", "2 AS uid")
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    assert sorted(got) == [0, 50, 100]
    assert sorted(got[0]) == sorted([(1, 0, 1.0), (2, 1, 1.0), (3, 201, 1.0), (4, 202, 1.0), (5, 203, 1.0)] * 2)
    assert sorted(got[50])[0] == (1, None, round(1.5 / (2 ** 0.5 * 1.25 ** 0.5), 9))
    assert [x[1] for x in sorted(got[50])[1:]] == [0, 0, 1, 2]
    assert got[100] == [(1, 9, round(17 / (14 ** 0.5 * 21 ** 0.5), 9))]


def test_empty_table(spark):
    assert ann.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 50, 400])
def test_graph_reaches_every_vector(n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 8)).astype(np.float32)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    graph = hnsw.build(x, rng.random(n))
    found = sum(i in graph.search(x[i], 32)[:1] for i in range(n))
    assert found >= 0.98 * n
    assert all((a < n).all() for a in graph.links)
