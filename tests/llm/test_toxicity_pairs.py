"""Factorization machine on terms that tell nothing alone; clashing columns; the whole path from tables."""
import numpy as np

from editsurge.llm import toxicity
from tests.llm.test_toxicity import terms


def xor_rows(n, seed=1):
    rng = np.random.default_rng(seed)
    words, texts, labels = [f"word{k}" for k in range(30)], [], []
    for _ in range(n):
        a, b = rng.random(2) < 0.5
        texts.append(" ".join([*rng.choice(words, 6), *(["alpha"] if a else []), *(["beta"] if b else [])]))
        labels.append(int(a != b))
    return texts, labels


def test_terms_that_tell_only_as_a_pair():
    texts, labels = xor_rows(6000)
    t, y = terms(texts), np.array(labels, dtype=float)
    alpha, beta = terms(["alpha"])[0], terms(["beta"])[0]
    assert not toxicity.telling_terms(t, y)[np.concatenate([alpha, beta])].any()
    found = toxicity.telling_pairs(t, y)
    assert found[alpha].all() and found[beta].all() and found.sum() == len({*alpha, *beta})
    s = toxicity.fit_machine(t, y).scores(terms(["word1 alpha", "word2 beta", "word3 alpha beta", "word4"]))
    assert (s[:2] > 0.7).all() and (s[2:] < 0.3).all()


def test_rare_pair_of_neutral_terms():
    """Two common words, each in one text of twenty with the usual share of toxic ones, toxic only together."""
    rng = np.random.default_rng(4)
    words, texts, labels = [f"word{k}" for k in range(40)], [], []
    for i in range(6000):
        a, b = rng.random(2) < 0.1
        toxic = (a and b) or (not a and not b and rng.random() < 0.1)
        texts.append(" ".join([*rng.choice(words, 6), *(["red"] if a else []), *(["fox"] if b else [])]))
        labels.append(float(toxic))
    m = toxicity.fit_machine(terms(texts), np.array(labels))
    s = m.scores(terms(["word1 red fox", "word1 red", "word1 fox", "word1"]))
    assert s[0] > 0.7 and (s[1:] < 0.5).all()


def test_no_pairs_in_noise():
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice([f"word{k}" for k in range(300)], 30)) for _ in range(2000)]
    assert not toxicity.telling_pairs(terms(texts), (rng.random(2000) < 0.1).astype(float)).any()


def test_from_tables_with_clashing_columns(spark):
    texts, labels = xor_rows(3000, 2)
    docs = spark.createDataFrame([(i, t, "x", 9, 0.5) for i, t in enumerate(texts)], "doc_id long, text string, terms string, toxic int, score double")
    marks = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int").selectExpr("*", "'y' AS text", "1 AS predicted")
    got = toxicity.digest(docs, toxicity.fit(docs.select("doc_id", "text"), marks)).toPandas().sort_values("doc_id")
    held = got[got.held_out]
    right = held.predicted.to_numpy() == np.array(labels)[held.doc_id]
    assert len(held) > 800 and right.mean() > 0.95
