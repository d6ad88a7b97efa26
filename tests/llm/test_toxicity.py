"""Factorization machine: gradients' effect, pairs, held-out rows, odd inputs."""
import numpy as np
from pyspark.sql import functions as F

from editsurge.llm import toxicity
from tests.conftest import SF_CHECK


def terms(rows):
    t = toxicity.Terms()
    return [np.asarray(t.of(r), dtype=np.int64) for r in rows]


def test_pair_sum_equals_all_pairs():
    rng = np.random.default_rng(0)
    m = toxicity.Machine(0.1, rng.normal(size=toxicity.BUCKETS), rng.normal(size=(toxicity.BUCKETS, toxicity.FACTORS)))
    t = np.array([3, 99, 1234, 77])
    want = 0.1 + m.weight[t].sum() + sum(m.factor[a] @ m.factor[b] for i, a in enumerate(t) for b in t[:i])
    assert np.isclose(m.logits([t, np.zeros(0, np.int64)]), [want, 0.1]).all()


def test_learns_pairs_that_single_terms_do_not_tell():
    rng = np.random.default_rng(1)
    words, texts, labels = [f"word{k}" for k in range(30)], [], []
    for _ in range(1500):
        a, b = rng.random(2) < 0.5
        w = [*rng.choice(words, 6), *(["insult"] if a else []), *(["group"] if b else [])]
        texts.append(" ".join(w))
        labels.append(float(a and b))
    m = toxicity.fit_machine(terms(texts), np.array(labels))
    s = m.scores(terms(["word1 insult group", "word1 insult", "word1 group", "word1"]))
    assert s[0] > 0.7 and (s[1:] < 0.5).all()


def test_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    marked = docs.join(labels, "doc_id").filter(F.length("text") < 3000).select("doc_id", "text")
    got = toxicity.digest(marked, toxicity.fit(marked, labels)).join(labels, "doc_id").filter("held_out").toPandas()
    toxic, clean = got[got.toxic == 1], got[got.toxic == 0]
    # about one in ten of this table's toxic marks are on texts without any telling term
    assert (toxic.predicted == 1).mean() > 0.7 and (clean.predicted == 1).mean() < 0.01
    assert got.score.between(0, 1).all()


def test_odd_inputs(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "x"), (3, "w " * 100_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.digest(df, toxicity.fit(df, none)).collect()} == {0.0}
    labels = spark.createDataFrame([(2, 1), (2, 0), (3, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    got = toxicity.digest(df, toxicity.fit(df, labels)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.digest(df.limit(0), toxicity.fit(df, labels)).count() == 0
