"""A training corpus from the documents table, stage by stage.

Each stage works on what the one before it kept; its result is written as
Parquet to the folder that driver and executors share and read again.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vitalgrid.llm import bpe, exact, mixing, quality, simhash
from vitalgrid.llm.common import scratch, shared_folder, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: rejects documents that are less likely than not to reach grade 1."""
    model = quality.fit(docs, quality.ratings(table(spark, sf_dir, "labels")), quality.N_GRADES)
    return quality.selected(docs, model)


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of equal texts the smallest doc_id stays."""
    return exact.without_exact_duplicates(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of fingerprints linked within two bits, over three-word shingles, the document with the smallest doc_id stays."""
    return simhash.without_near_duplicates(docs, shingle=simhash.SHINGLE, most=simhash.DIFFERENCES)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: sources in their target shares; a document taken twice comes twice."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: token counts and digests of the ids and of the text decoded from them."""
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    return bpe.digests(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", no_exact_copies),
    ("SimHash near-dedup", no_near_copies),
    ("mixing sources", mixed),
    ("byte-level BPE", encoded),
]

# The trained model and the merges cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what stages left behind on the way is deleted after each."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/stage_{uuid.uuid4().hex}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
