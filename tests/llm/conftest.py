import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents-like table over several partitions, with extra columns that clash with
    names the operators use."""
    def make(rows, extra=False):
        df = spark.createDataFrame([(i, t) for i, t in rows], DOCS).repartition(3)
        if extra:
            for name in ("n", "label", "score", "kept", "span", "key", "node", "base_spans", "_copies", "place", "kind"):
                df = df.withColumn(name, F.lit("x"))
        return df
    return make
