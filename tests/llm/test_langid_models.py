"""Kneser-Ney against a plain dictionary version; the sample's size at any count; planted texts in the pipeline's stage."""
import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline as cp
from editsurge.llm import common, langid
from tests.conftest import SF_CHECK

TEXTS = {"aa": ["the cat sat on the mat", "then the rat ran at the cat"], "bb": ["le chat est là", "la chatte et le rat"]}


def plain(texts, alphabet):
    """p(character | 3 before) of one language, straight from the definition."""
    top = Counter()
    for t in texts:
        t = "   " + t + " "
        top.update(t[i:i + 4] for i in range(len(t) - 3))
    counts = {4: top}
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    by = {n: defaultdict(list) for n in counts}
    discount = {}
    for n, c in counts.items():
        one, two = (sum(v == k for v in c.values()) for k in (1, 2))
        discount[n] = min(max(one / max(one + 2 * two, 1), 0.1), 0.9)
        for g, v in c.items():
            by[n][g[:-1]].append(v)

    def p(gram, n):
        ctx, base = gram[4 - n:3], 1 / (alphabet + 1)
        seen = by[n].get(ctx)
        below = base if n == 1 else p(gram, n - 1)
        if not seen:
            return below
        total, d = sum(seen), discount[n]
        return max(counts[n][gram[4 - n:]] - d, 0) / total + d * len(seen) / total * below
    return p


def test_equal_to_a_plain_version():
    rows = [(x, t[i:i + 4]) for x, ts in TEXTS.items() for t in (f"   {t} " for t in ts) for i in range(len(t) - 3)]
    counts = pd.DataFrame(rows, columns=["lang", "gram"]).groupby(["lang", "gram"]).size().rename("n").reset_index()
    model = langid.kneser_ney(counts)
    alphabet = len({g[-1] for _, g in rows})
    grams = sorted({g for _, g in rows} | {"theq", "zzzz", "   t", "xx l", "cat "})
    got = model.bits(langid._pack_text(grams))
    for k, x in enumerate(model.langs):
        p = plain(TEXTS[x], alphabet)
        assert np.allclose(got[:, k], [-math.log2(p(g, 4)) for g in grams], rtol=1e-4, atol=1e-4)


def test_sample_size_at_any_count():
    for n in (600, 10 ** 4, 10 ** 10, 10 ** 15):
        assert abs(common.hash_bound(600, n) / common.HASH_RANGE * n - 600) < 1
    assert common.hash_bound(600, 599) == common.hash_bound(600, 0) == common.HASH_RANGE


def test_hashes_fill_the_range(spark):
    r = spark.range(20_000).select(common.hash_part("id").alias("h")).agg(F.min("h"), F.max("h"), F.avg("h")).first()
    assert 0 <= r[0] < common.HASH_RANGE / 1000 and common.HASH_RANGE * 0.999 < r[1] < common.HASH_RANGE
    assert abs(r[2] / common.HASH_RANGE - 0.5) < 0.02


FOREIGN = ["De snelle bruine vos springt over de luie hond en rent daarna terug naar het bos waar hij woont met zijn jongen",
           "Hyvää huomenta kaikille, tänään meillä on kaunis päivä ja lähdemme yhdessä metsään keräämään sieniä ja marjoja",
           "Η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί και φεύγει μακριά στο δάσος", "qzxjw vkqpz xxqjk wvzqp jjkqx zzvwq " * 5,
           "Szybki brązowy lis przeskakuje nad leniwym psem i biegnie z powrotem do lasu gdzie mieszka"]


def test_pipeline_stage_drops_planted_texts(spark):
    docs = cp.documents(spark, SF_CHECK)
    planted = spark.createDataFrame([(10 ** 9 + 3 * k, t) for k, t in enumerate(FOREIGN)], "doc_id long, text string")
    for f in docs.schema:
        if f.name not in planted.columns:
            planted = planted.withColumn(f.name, F.lit(None).cast(f.dataType))
    kept = cp.identify_language(spark, docs.unionByName(planted.select(*docs.columns)), SF_CHECK)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert not ids & {10 ** 9 + 3 * k for k in range(len(FOREIGN))} and len(ids) == docs.count()
    model = langid.fit(docs)
    got = langid.digest(docs.select("doc_id", "text").unionByName(planted.select("doc_id", "text")), model)
    assert {r.doc_id for r in got.filter("rejected").collect()} == {10 ** 9 + 3 * k for k in range(len(FOREIGN))}
