"""A training-corpus pipeline over ``documents``: quality, near-duplicates, benchmark leaks, secrets, tokens.

Each stage works on all rows that its predecessor kept; every stage but the
last returns the columns of ``documents``.  Rows without a doc_id are judged by
their texts like all others; in a group of near-duplicates they come last.
"""

from __future__ import annotations

import os
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import siftlane  # noqa: E402
from siftlane.llm import bpe, decontam, quality, secrets, simhash  # noqa: E402
from siftlane.llm.queries import tokenizer_path  # noqa: E402
from siftlane.session import freeze  # noqa: E402
from siftlane.sources.tables import read_table  # noqa: E402

cloudpickle.register_pickle_by_value(siftlane)

#: Parameters of the stages; the near-duplicate ones are those of operator 4's contract.
KEEP_FROM = quality.KEEP_FROM
SHINGLE_WORDS, MAX_BITS = simhash.SHINGLE_WORDS, simhash.MAX_BITS
TOKENIZER = "byte_bpe_50k.json"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; it learns from the labels of the documents given."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep(docs, model, keep_from=KEEP_FROM)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate rows the one with the smallest doc_id; of rows that repeat it, the one with the smallest digest."""
    return simhash.without_near_duplicates(docs, words=SHINGLE_WORDS, max_bits=MAX_BITS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontam.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced, and n_chars to match."""
    out = secrets.redact(docs, secrets.train(docs))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number and digest of each document's tokens, and the digest of what they decode to."""
    return bpe.encode_decode(docs, tokenizer_path(TOKENIZER))


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("BPE encoding and decoding", bpe_stage),
]

#: Trained models and a tokenizer stand between the input and the result, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``; each stage's result is written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir), name.replace(" ", "_").lower())
    return docs
