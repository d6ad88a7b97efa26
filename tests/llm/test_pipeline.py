"""The pipeline's stages against brute force on a small table."""
import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry_mod
import corpus_pipeline as cp
from editsurge.llm import decontaminate as dc
from editsurge.llm import langid
from tests.conftest import SF_CHECK
from tests.llm.test_secret_scan import base


def test_stages_equal_brute_force(spark):
    got = {r.doc_id: r for r in cp.run(spark, SF_CHECK).collect()}
    docs = cp.documents(spark, SF_CHECK)
    model = langid.fit(docs)
    rows = {r.doc_id: r.text for r in docs.collect()}
    rows = {i: t for i, t in rows.items() if not model.predict([t])[0][2]}
    groups = brute_by_sets(rows)
    rows = {i: t for i, t in rows.items() if groups[i]}
    grams = lambda w: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    items = [grams(dc.words(r.text)) for r in spark.read.parquet(f"{SF_CHECK}/benchmark.parquet").collect()]
    rows = {i: t for i, t in rows.items() for have in [grams(dc.words(t))] if not any(len(s & have) >= dc.CONTAINED * len(s) for s in items)}
    assert set(got) == set(rows)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    clean = 0
    for i, text in rows.items():
        if base(text):
            continue
        clean += 1
        assert got[i].n_tokens == len(t.encode(text, add_special_tokens=False).ids)
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert 0 < clean < len(rows) or not any(map(base, rows.values()))


def brute_by_sets(rows):
    """Kept or not, with candidates by shared shingles instead of all pairs."""
    from tests.llm.test_minhash import shingles
    import collections
    sets = {i: shingles(t) for i, t in rows.items()}
    where = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    met = collections.Counter((a, b) for ids in where.values() if 1 < len(ids) < 2000 for k, b in enumerate(sorted(ids)) for a in sorted(ids)[:k])
    linked = {p for p, n in met.items() if 100 * n >= 85 * (len(sets[p[0]]) + len(sets[p[1]]) - n)}
    parent = {i: i for i in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in sorted(linked):
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    return {i: find(i) == i for i in rows}


def test_stage_names_and_columns(spark):
    assert [n for n, _ in cp.STAGES] == ["language_id", "minhash_dedup", "decontamination", "secret_scan", "bpe_codec"]
    docs = cp.documents(spark, SF_CHECK).limit(0)
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF_CHECK)
        assert out.columns == docs.columns and out.count() == 0
    assert cp.STAGES[-1][1](spark, docs, SF_CHECK).count() == 0


def test_registered():
    names = entry_mod.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
