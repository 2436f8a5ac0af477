"""Corpus pipeline: from raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basinflow.llm import jaccard_join, mixing, packing, quality_rules, secret_scan
from basinflow.llm.queries import MIX_FRACTION, MIX_TARGETS, MIX_TOPICS, PACK_WEIGHTS, byte_bpe_path
from basinflow.llm.store import cut, read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned list rejects go."""
    return quality_rules.keep_good(docs, quality_rules.fit_rules(docs, read_table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies stays."""
    return jaccard_join.keep_first(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Values of live-looking secrets are replaced; every document stays."""
    return secret_scan.mask_live(docs, length_col="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have the target source, language and topic shares."""
    return mixing.sample(docs, MIX_TARGETS, MIX_FRACTION, topics=MIX_TOPICS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document, placed in sequences of 1024 tokens."""
    return packing.pack(packing.token_pieces(docs, byte_bpe_path()), weights=PACK_WEIGHTS)


STAGES = [
    ("quality rules", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# The learned rules and the tokenizer are beyond SQL; tests/llm holds the
# pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
