"""Leaks against all items on all texts (5-word containment)."""
import random

from editsurge.llm import decontaminate as dc
from tests.conftest import SF_CHECK

ITEMS = "item_id long, text string"


def test_finds_what_brute_force_finds(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF_CHECK}/benchmark.parquet")
    grams = lambda w: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    of_item = {r.item_id: grams(dc.words(r.text)) for r in items.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for have in [grams(dc.words(r.text))] for i, s in of_item.items()
            if s and len(s & have) >= dc.CONTAINED * len(s)}
    got = dc.find_leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and want
    assert all(r.score >= dc.THRESHOLD and r.contained >= dc.CONTAINED for r in got)


def planted(rng, n):
    return " ".join(rng.choice([f"w{k}" for k in range(300)]) for _ in range(n))


def test_planted_leaks_in_long_texts_and_near_misses(spark, docs_of):
    rng = random.Random(2)
    items = [(i, planted(rng, rng.choice([12, 20, 40, 90])) + ". " + planted(rng, 6) + ".") for i in range(60)]
    items += [(100, None), (101, ""), (102, "too short"), (3, items[3][1]), (None, planted(rng, 30))]
    rows = [(1, planted(rng, 3000) + " " + items[7][1].upper() + " " + planted(rng, 3000)),
            (2, items[8][1].replace(" ", ",  ")), (3, " ".join(items[9][1].split()[:10])), (4, planted(rng, 500)),
            (5, None), (6, ""), (2, items[8][1]), (None, items[10][1]), (7, " ".join(sorted(items[11][1].split()))), (8, "too short")]
    got = sorted(((r.doc_id, r.item_id) for r in dc.find_leaks(docs_of(rows, extra=True), spark.createDataFrame(items, ITEMS)).collect()), key=repr)
    assert got == sorted([(1, 7), (2, 8), (2, 8), (None, 10)], key=repr)
    kept = dc.keep_clean(docs_of(rows, extra=True), spark.createDataFrame(items, ITEMS))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7, 8] and kept.columns == docs_of([], extra=True).columns


def test_block_maxima_bound_every_score(spark):
    rng = random.Random(4)
    items = spark.createDataFrame([(i, planted(rng, 30)) for i in range(50)], ITEMS)
    index = dc.indexes(items)[0].value
    import numpy as np
    for block, members in enumerate(index.block_items):
        most = {}
        for t in range(len(index.vocabulary)):
            for k in range(index.starts[t], index.starts[t + 1]):
                if index.blocks[k] == block:
                    most[t] = index.maxima[k]
        for i in members:
            item = index.items[i]
            assert np.isclose(sum(item.terms.values()), 1)
            assert sum(u for t, u in item.terms.items() if t not in most) <= dc.COMMON_MASS + 1e-9
            assert all(most[t] >= u - 1e-12 for t, u in item.terms.items() if t in most)


def test_index_parts_and_empty_tables(spark, docs_of):
    rng = random.Random(5)
    items = spark.createDataFrame([(i, planted(rng, 30)) for i in range(20)], ITEMS)
    parts = dc.indexes(items, part_items=6)
    assert len(parts) == 4 and sorted(x.item_id for p in parts for x in p.value.items) == list(range(20))
    assert dc.find_leaks(docs_of([(1, "some words of a text here")]), items.limit(0)).count() == 0
    assert dc.find_leaks(docs_of([]), items).count() == 0
