"""A corpus pipeline: each stage reads what the one before it kept, and all but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riftspan.llm import exact, mixing, pieces, simhash, toxicity
from riftspan.llm.common import stored, table


#: Words of a shingle and differing bits of fingerprints that are candidates; five-word shingles then decide.
#: Two bits, as the query has, would find only the closest copies; with 11 all 48 pairs of sf0.1 are candidates.
NEAR_WORDS, NEAR_BITS = 3, 11


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under one half."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those whose five-word similarity to one that stays is 0.8 or more."""
    return simhash.without_near_copies(docs, words=NEAR_WORDS, distance=NEAR_BITS)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of rare domains more than once, none not at all."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return pieces.encode_pieces(docs, pieces.default_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_domains),
    ("sentencepiece", encode),
]

#: SQL cannot express the learned stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
