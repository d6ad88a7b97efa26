"""Language models: held-out accuracy on the driver's rows, rejection, odd inputs."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from editsurge.llm import langid
from tests.conftest import SF_CHECK

SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", "lang")


@pytest.fixture(scope="module")
def model(rows):
    return langid.fit(rows, per_lang=150)


def test_held_out_accuracy_and_no_clean_document_rejected(rows, model):
    got = langid.digest(rows, model).join(rows.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert len(got) > 200 and (got.lang_pred == got.lang).mean() > 0.98
    assert got.score.between(0, 1).all()
    assert langid.keep_identified(rows, model).count() == rows.count()


def test_odd_texts(spark, model):
    texts = [None, "", " 123 !? ", "the", "漢字かな" * 30, "qxzj vwkq zzxq pqrt " * 30, "the and of " * 100_000]
    got = model.predict(texts)
    assert [g[0] for g in got[:3]] == ["und"] * 3 and all(g[2] for g in got[:3])
    assert all(g[0] in model.langs for g in got[3:])
    assert [g[2] for g in got[3:]] == [False, True, True, False]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] * 2, "doc_id long, text string, score string")
    kept = langid.keep_identified(df, model)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [3, 3, 6, 6]


def test_slices_do_not_change_the_sums(model, monkeypatch):
    text = "the quick and the of hethe ing " * 50
    whole = model.measure([text, None, text])
    monkeypatch.setattr(langid, "SLICE", 64)
    parts = model.measure([text, None, text])
    for a, b in zip(whole, parts):
        assert np.allclose(a, b, rtol=1e-5)


def test_kneser_ney_rows_are_distributions(model):
    ctx = langid.codes("the")
    p = np.array([langid.packed(np.append(ctx, np.uint64(ord(c))))[0] for c in "abcdefghijklmnopqrstuvwxyzäöüßéèêçàñóíá' "])
    total = np.exp2(-model.bits(p).astype(float)).sum(axis=0)
    assert (total < 1.01).all() and (total > 0.8).all()


def test_empty_training_and_missing_labels(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = langid.fit(empty)
    assert langid.digest(empty, model).count() == 0
    rows = spark.createDataFrame([(1, "some text", None), (None, None, None)], SCHEMA)
    got = langid.digest(rows, langid.fit(rows)).collect()
    assert {r.lang_pred for r in got} == {"und"} and {r.score for r in got} == {0.0}


def test_fold_is_by_crc32(spark):
    import zlib
    df = spark.range(50).select(F.col("id").alias("doc_id"), langid.utf8_crc32_mod3(F.col("id")).alias("m"))
    assert all(r.m == zlib.crc32(str(r.doc_id).encode()) % 3 for r in df.collect())
