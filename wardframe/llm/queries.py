"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardframe.llm import ngram_lm
from wardframe.llm.bpe import encode_documents
from wardframe.llm.classifier import HELD_OUT_PARTS, THRESHOLD, score_documents, train
from wardframe.llm.common import crc32_rest, table
from wardframe.llm.decontaminate import benchmark_matches
from wardframe.llm.filter_audit import audit_filters
from wardframe.llm.fim import fill_in_middle, restore
from wardframe.llm.html_text import extract_text
from wardframe.llm.line_dedup import dedup_lines
from wardframe.llm.minhash import near_duplicates
from wardframe.llm.packing import pack_documents
from wardframe.llm.quality_rules import quality_verdicts
from wardframe.llm.token_files import read_token_files, token_files_folder, write_token_files
from wardframe.llm.url_graph import Rule, judge_urls
from wardframe.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# The rules of the URL query.
RULES = (
    Rule("org", "/", True),
    Rule("example.org", "/es/", False),
    Rule("example.org", "/en/1", False),
    Rule("com", "/fr/", True),
    Rule("com", "/de/", False),
)


def tokenizer() -> str:
    """The vocabulary file of the public tokenizers package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(function):
    QUERIES[function.__name__] = function
    return function


def sha256(text):
    return F.sha2(text.cast("binary"), 256)


@query
def op1_quality_rules(spark, folder):
    return quality_verdicts(table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def token_digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.array_join("ids", ",")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


@query
def op2_html_text(spark, folder):
    return extract_text(table(spark, folder, "pages")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )


@query
def op3_minhash(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates(documents).drop("text")


@query
def op4_bpe(spark, folder):
    return token_digests(encode_documents(table(spark, folder, "documents"), tokenizer()))


@query
def op5_line_dedup(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(documents).select(
        "doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256")
    )


def held_out(parts: int):
    return F.coalesce(crc32_rest(F.col("doc_id"), parts) == 0, F.lit(False)).alias("held_out")


@query
def op6_classifier(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = train(documents, table(spark, folder, "labels"))
    return score_documents(documents, model).select(
        "doc_id",
        held_out(HELD_OUT_PARTS),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op7_decontaminate(spark, folder):
    documents, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return benchmark_matches(documents, items).drop("version")


@query
def op8_token_files(spark, folder):
    files = token_files_folder(spark)
    index = write_token_files(table(spark, folder, "documents"), files, tokenizer())
    return read_token_files(files, index).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op9_url_graph(spark, folder):
    return judge_urls(table(spark, folder, "pages"), RULES).drop("trust", "distrust")


@query
def op10_ngram_lm(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = scratch_path(spark, "ngram-model")
    summary = ngram_lm.train(ngram_lm.training_part(documents), model)
    return ngram_lm.score_documents(documents, model, summary).select(
        "doc_id",
        held_out(ngram_lm.HELD_OUT_PARTS),
        "n_tokens",
        "n_known",
        F.lit(summary.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query
def op11_fim(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return restore(fill_in_middle(documents)).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        sha256(F.col("output")).alias("output_sha256"),
        sha256(F.col("restored")).alias("restored_sha256"),
    )


@query
def op12_packing(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return pack_documents(documents, tokenizer()).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


@query
def op13_filter_audit(spark, folder):
    return audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))
