"""The corpus pipeline: quality, near duplicates, decontamination, mixing, token
ids.  Every stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; stages but the last return the columns of their input.

Defined cases: a null text is an empty one, and empty texts are equal fingerprints, so one of those that the
ranking keeps stays at most; rows that repeat a document are near duplicates of it; rows without an id are
told apart by their texts; texts of any length go through whole; ties are broken by id, then text; an empty
table gives empty results in every stage; further columns of documents pass through all stages but the last."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import bradley_terry, decontam, mixing, simhash, wavelet
from riskloom.llm.queries import END_ID, REJECT_BELOW, TOKENIZER, table, training_labels
from riskloom.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking does not reject."""
    ranking = bradley_terry.train(docs, training_labels(table(spark, sf_dir, "labels")), cut=REJECT_BELOW)
    return docs.filter(bradley_terry.score_column(ranking, F.col("text")) >= REJECT_BELOW)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    return simhash.representatives(docs, simhash.near_duplicates(docs, k=3, max_bits=2))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's budget takes it."""
    return mixing.take(docs, mixing.mix(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the mix, read back
    from its token shards."""
    return wavelet.documents(wavelet.write(docs, TOKENIZER, end_id=END_ID, added_tokens=True))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("source mixing", mix_sources),
    ("token ids", token_ids),
]

# A learned score, Hamming balls and a tokenizer are not SQL; tests hold run()
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
