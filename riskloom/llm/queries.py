"""The operators on their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (bradley_terry, decontam, licenses, line_dedup, mixing, ranked_search, simhash, text_cnn, topk,
                          url_reputation, warc, wavelet, whitening)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
REJECT_BELOW = 0.3
TOXIC_FROM = 0.3

RULES = [
    url_reputation.Rule("allow", "com", "/"),
    url_reputation.Rule("block", "example.com", "/en/"),
    url_reputation.Rule("allow", "www.example.com", "/en/"),
    url_reputation.Rule("block", "net", "/es/"),
    url_reputation.Rule("block", "net", "/fr/"),
]
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels of the documents that are not held out."""
    return labels.filter(~bradley_terry.held_out(F.col("doc_id")))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, text, n_runs, longest_run, first_doc, first_line; repeated runs of any
    length, from one word on."""
    return line_dedup.dedup(table(spark, sf_dir, "documents"), min_words=1, runs=True)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, read back from the shards."""
    return wavelet.documents(wavelet.write(table(spark, sf_dir, "documents"), TOKENIZER, end_id=END_ID, added_tokens=True))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, max_bits=2)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents")
    ranking = bradley_terry.train(docs, training_labels(table(spark, sf_dir, "labels")), cut=REJECT_BELOW)
    scored = docs.select("doc_id", bradley_terry.held_out(F.col("doc_id")).alias("held_out"),
                         bradley_terry.score_column(ranking, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= REJECT_BELOW).cast("int"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read back
    from the archive."""
    return warc.read(warc.write(table(spark, sf_dir, "pages")))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict."""
    return url_reputation.judge(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    return licenses.scan(table(spark, sf_dir, "documents"), PHRASES)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, distance, end_word, item_words."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id, score."""
    return ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), k=16)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    classifier = text_cnn.train(docs, labels.filter(~text_cnn.held_out(F.col("doc_id"))), cut=TOXIC_FROM)
    scored = docs.select("doc_id", text_cnn.held_out(F.col("doc_id")).alias("held_out"),
                         text_cnn.score_column(classifier, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_mixing, op3_wavelet_tokens, op4_simhash, op5_quality, op6_warc, op7_topk,
                            op8_url_filter, op9_licenses, op10_decontamination, op11_ranked_search, op12_whitening, op13_toxicity)}
