"""Sharding: permutation, law, reproducibility, SQL expression against integers."""
import zlib

from pyspark.sql import functions as F

from editsurge.llm import sharding


def test_permutation_and_its_inverse(spark):
    for n in (1, 2, 3, 7, 100, 1001):
        places = [sharding.place(i, n) for i in range(n)]
        assert sorted(places) == list(range(n))
        assert [sharding.row_at(p, n) for p in places] == list(range(n))
        column = spark.range(n).select("id", sharding.place_column(F.col("id"), n).alias("p"))
        assert [r.p for r in column.orderBy("id").collect()] == places


def test_law_slots_and_facts(docs_of):
    rows = [(i, f"text é {i}" * (i % 5)) for i in range(101)] + [(7, "x"), (7, "x"), (None, None), (200, None), (201, "long " * 20_000)]
    got = sharding.digest(docs_of(rows, extra=True)).collect()
    assert len(got) == len(rows)
    facts = sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr)
    assert facts == sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    sizes = [sum(r.shard == s for r in got) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    for r in got:
        assert (r.shard, r.slot) == (sharding.place(r.row, len(rows)) % 8, sharding.place(r.row, len(rows)) // 8)


def test_same_result_for_any_layout_and_empty_table(docs_of):
    rows = [(i % 40, f"t{i}") for i in range(120)]
    key = lambda df: sorted((r.doc_id, r.text_crc32, r.shard, r.slot) for r in df.collect())
    assert key(sharding.digest(docs_of(rows))) == key(sharding.digest(docs_of(rows[::-1]).repartition(7)))
    assert sharding.digest(docs_of([])).count() == 0


def test_no_python_in_the_plan(docs_of):
    plan = sharding.digest(docs_of([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
