"""Run tables: any batch count equals a plain fold, few runs, replays, deletions."""
import os
import random
import uuid

import pytest

from editsurge.sources.runs import RunTable
from editsurge.streaming.jobs import state_dir


def folder(spark):
    return state_dir(spark, "test-runs", uuid.uuid4().hex)


def test_cover_is_complete_and_bounded(spark):
    t = RunTable(spark, "/nowhere", ["k"], fan=4, depth=2)
    for n in range(200):
        at, runs = 0, t.cover(n)
        for level, last in runs:
            first = 0 if level == t.depth else last + 1 - t.fan ** level
            assert first == at
            at = last + 1
        assert at == n and len(runs) <= 1 + t.depth * (t.fan - 1)


def test_latest_with_deletions_and_replays(spark):
    rng, t, want, history = random.Random(3), RunTable(spark, folder(spark), ["k"], fan=2, depth=2), {}, []
    for n in range(13):
        rows = [(k, n * 100 + k, rng.random() < 0.3) for k in rng.sample(range(12), rng.randrange(5))]
        df = spark.createDataFrame(rows, "k int, v int, gone boolean") if rows or n % 2 else None
        for _ in range(2):          # each batch is run twice
            before = t.read(n)
            assert ({} if before is None else {r.k: r.v for r in before.collect()}) == want
            t.write(df, n)
        assert len(t.runs(n + 1)) <= 1 + 2
        history.append(dict(want))
        for k, v, gone in rows:
            want.pop(k, None) if gone else want.update({k: v})
    got = t.read()
    assert {r.k: r.v for r in got.collect()} == want
    assert got.columns == ["k", "v"]
    some = spark.createDataFrame([(k,) for k in range(0, 12, 3)], "k int")
    assert {r.k: r.v for r in t.read(only=some).collect()} == {k: v for k, v in want.items() if k % 3 == 0}


def test_sums_and_old_runs_go(spark):
    path = folder(spark)
    t, want = RunTable(spark, path, ["a", "b"], fold="sum", fan=2, depth=2), {}
    for n in range(9):
        rows = [(k % 3, k, 1, k) for k in range(n, n + 4)]
        t.write(spark.createDataFrame(rows, "a int, b int, n long, s long"), n)
        for a, b, c, s in rows:
            x = want.setdefault((a, b), [0, 0])
            x[0], x[1] = x[0] + c, x[1] + s
    assert {(r.a, r.b): [r.n, r.s] for r in t.read().collect()} == want
    local = path[len("file:"):] if path.startswith("file:") else path
    assert sorted(os.listdir(os.path.join(local, "level=0")), key=lambda n: int(n[9:]))[0] == "batch_id=4"
    assert sorted(os.listdir(os.path.join(local, "level=2"))) == ["batch_id=3", "batch_id=7"]


def test_nothing_written_and_bad_rules(spark):
    t = RunTable(spark, folder(spark), ["k"])
    assert t.read() is None and t.next_batch() == 0 and t.read(5) is None
    with pytest.raises(ValueError):
        RunTable(spark, "/x", ["k"], fold="other")
    with pytest.raises(ValueError):
        RunTable(spark, "/x", ["k"], fan=1)
