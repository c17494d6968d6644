"""The corpus pipeline: language, exact and near duplicates, mixing, tokens.

Each stage takes the documents that the one before has kept, as a stored table, and the
last one gives the tokens of what remains. Language identification cannot be said in SQL,
so there is no SQL counterpart; the tests run the stages against plain Python.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierflow.llm import stages
from tierflow.llm.bpe import encode_documents
from tierflow.llm.common import stored, table
from tierflow.session import bound_batches, ship_package

RANKS = "byte_bpe_multi_50k.tiktoken"


def _ready(spark: SparkSession) -> None:
    ship_package(spark)
    bound_batches(spark)  # every stage hands whole texts to Python


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; texts without a letter and gibberish go. Without labels all stay."""
    _ready(spark)
    return stages.keep_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of all documents with equal texts."""
    _ready(spark)
    return stages.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more."""
    _ready(spark)
    return stages.drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the target weights of their sources ask for; null is a source, and an empty text has size 0."""
    _ready(spark)
    return stages.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and digests of ids and decoded bytes of every row."""
    _ready(spark)
    return encode_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("tokens", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
