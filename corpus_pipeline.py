"""Corpus pipeline: from raw documents to packed training sequences.

Each stage calls one operator of ``pactline.llm`` on all that the stage
before it kept, is written as Parquet to the shared checkpoint folder and read
again, so a lost executor never costs more than the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.llm import mixing, mph_dedup, packing, quality, simhash
from pactline.llm.common import keep_table
from pactline.llm.queries import site_of
from pactline.sources.tables import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects."""
    evidence = quality.fit_evidence(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, evidence, *site_of(docs))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of equal texts: the one with the largest id."""
    own = mph_dedup.digests(docs)
    return mph_dedup.drop_repeats(docs, own, mph_dedup.build_index(own))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component."""
    return simhash.keep_representatives(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents as often as the mix does; none means it goes."""
    return mixing.apply_mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of the documents' tokens."""
    return packing.pack_documents(docs).withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]

#: Fitted models, XXH64 and tokenizers have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
