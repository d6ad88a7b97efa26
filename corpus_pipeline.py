"""Corpus pipeline: the stages run in order, each over all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.  All but the last return the
columns of ``docs``:

1. ``language_id`` drops the documents that the language models reject;
2. ``minhash_dedup`` keeps one document of each near-duplicate group;
3. ``decontamination`` drops documents that hold a benchmark item;
4. ``secret_scan`` replaces each reported secret in the texts (no document goes);
5. ``bpe_codec`` encodes and decodes every text and returns its digests.

Null texts have no letters, so stage 1 drops them.  An empty table goes through
all stages as an empty table; extra columns are kept up to the last stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from editsurge.llm import bpe, decontaminate, langid, minhash, secret_scan
from editsurge.llm.common import documents
from editsurge.session import ensure_checkpoint_dir
from editsurge.sources.tables import read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digest(docs)


STAGES = [
    ("language_id", identify_language),
    ("minhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("bpe_codec", encode),
]

#: Trained models and connected components are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; intermediate tables go to the shared folder."""
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
