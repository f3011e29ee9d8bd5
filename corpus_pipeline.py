"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; `run`
writes what it returns as Parquet and hands the stored rows to the next one. All but the last
return the columns of `documents`. Null texts, repeated rows and empty tables are handled as the
operators say; a stage without rows hands on none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstream.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from tillstream.llm.common import table, written
from tillstream.llm.tokens import vocabulary_path
from tillstream.session import scratch_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents among `docs` and drops what scores as toxic."""
    return toxicity.keep_clean(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    index = exact_dedup.DigestIndex(spark, scratch_folder(spark, "digest-index"))
    return exact_dedup.keep_rows(docs, index)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar texts the document with the least doc_id stays.

    Documents without id take part; one of them stays where none of the component has an id.
    """
    return jaccard_join.keep_one(docs, null_ids=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows come as often as the mix takes them, ordered by their virtual finish time."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its place in a sequence; a repeated document is packed again."""
    return packing.pack(docs, vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
# Scores of a learned model, near-copy components and tokens are not SQL; tests compare each stage
# with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
