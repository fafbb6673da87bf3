"""The corpus pipeline: whole stages, each on what the one before it kept.

1. The quality classifier drops the documents it rejects.
2. Recurring lines are dropped from the others.
3. Of each class of near duplicates one document stays.
4. Documents that hold a benchmark passage go.
5. The rest is encoded and decoded with byte-level BPE.

The first four stages return the columns of ``documents``; ``n_chars`` follows
the text. A null text counts as empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe.llm import classifier
from wardframe.llm.bpe import encode_documents
from wardframe.llm.common import stored, table
from wardframe.llm.decontaminate import decontaminate
from wardframe.llm.line_dedup import dedup_lines
from wardframe.llm.minhash import one_per_class
from wardframe.llm.queries import token_digests, tokenizer


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits on the labels of documents that are not held out; keeps what is accepted."""
    model = classifier.train(docs, table(spark, sf_dir, "labels"))
    return classifier.accepted(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    return cut.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_digests(encode_documents(docs, tokenizer()))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte-level BPE", encode),
]

# SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
