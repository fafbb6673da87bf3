from pathlib import Path

import pytest
from pyspark.sql import types as T

ROOT = str(Path(__file__).resolve().parents[2])


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents from (doc_id, text), with a column of every internal name."""
    extra = ["id", "body", "rest", "node", "key", "n", "word", "version", "host", "score_0", "root"]
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            *[T.StructField(c, T.StringType()) for c in extra],
        ]
    )

    def make(rows, lang="en", source="src0"):
        full = [(i, t, lang, source, *[f"{c} of {i}" for c in extra]) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def texts(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}
