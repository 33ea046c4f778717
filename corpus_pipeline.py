"""The training-data pipeline: toxic texts out, exact and near copies out, sources mixed, texts encoded.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. Its result is written as
Parquet, and the next stage reads that; tables that a stage has made for itself go when the next stage of the same
thread starts, and those of other callers stay.

All stages take documents of any columns besides doc_id, text and source: nulls, empty and very long texts, repeated
rows and ids, ties, empty tables and columns of any name have the results that each stage's operator states.
"""

from __future__ import annotations

import threading
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siglane.llm import exact, mixing, neardup, pieces, toxicity
from siglane.llm.common import prepare, release, scratch, shared_dir, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5; it is fitted on the labelled rows among them.

    Null and empty texts score by the softmax's bias alone; without labels of both classes nothing goes unless all are
    toxic. Repeated rows score alike.
    """
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, whatever its white space: the longest, then the smallest doc_id, null last.

    Null texts and texts of white space are one text.
    """
    return exact.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8 or more: the smallest doc_id, null last.

    Texts without words are in no group and stay.
    """
    return neardup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, three times at most; null is a source like others, the last in order.

    Texts without words are not taken.
    """
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, agreed of each row; null text counts as empty."""
    return pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


#: Folders that the last stage of this thread has made for itself.
_made = threading.local()


def _stage(work):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        release(getattr(_made, "folders", []))
        with scratch() as _made.folders:
            return work(spark, docs, sf_dir)

    return run


STAGES = [
    ("toxicity", _stage(drop_toxic)),
    ("exact_dedup", _stage(drop_exact_copies)),
    ("near_dedup", _stage(drop_near_copies)),
    ("mixing", _stage(mix_sources)),
    ("sentencepiece", _stage(encode)),
]

#: Toxicity, the forest's order and SentencePiece can't be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``. What a stage has written goes when the next one has read it."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, work in STAGES:
        path = f"{shared_dir(spark)}/siglane/pipeline-{name}-{uuid.uuid4().hex}"
        work(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        release(before)
        before = [(spark, path)]
    release(_made.folders)
    return docs
