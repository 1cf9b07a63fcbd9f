"""The training-data pipeline: from ``documents`` to packed sequences.

Each stage works on all rows that the one before kept. All but the last return the
columns of ``documents``, whatever these are; the last returns a row for each piece of a
sequence.

Defined results: null text counts as empty in every stage; a text without words is not
toxic by itself, equals every other empty text, and is left out of the mix, to which it
would add nothing; of rows that repeat an id each stage decides as its operator says;
null ids are carried, and give way to rows with an id in groups of copies; very long
texts are taken whole; an empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfold.llm import exact_dedup, mixing, packing, simhash_dedup, toxicity
from wayfold.llm.common import write_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models (fitted on ``labels``) don't reject."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id; rows that
    repeat that id and text stay together."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked SimHash fingerprints, the one with the
    least id; rows that repeat that id stay together."""
    return simhash_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, whole ones only; a null
    source is a source of its own."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences and their places; every row is packed on its own."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Scoring, fingerprints and packing are beyond SQL; tests hold the stages against
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each one's rows are written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return docs
