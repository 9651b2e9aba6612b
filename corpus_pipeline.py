"""From documents to tokens: quality rules, exact and near duplicates, a mix of sources, byte-level BPE.

Every stage takes what its predecessor kept, stored as Parquet, and all but the
last return rows of documents with all their columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thornwall.llm import bpe, exact_dedup, mixing, quality, simhash
from thornwall.llm.common import Scratch, keep_one, row_key
from thornwall.session import configure

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the cascade rejects."""
    return quality.keep_good(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the smallest id."""
    groups = exact_dedup.exact_groups(docs)
    keepers = groups.filter("kept").select(row_key(F.col("id"), F.col("sha")).alias("key"))
    return keep_one(docs, row_key(docs["doc_id"], F.sha2(exact_dedup.normalised("text").cast("binary"), 256)), keepers)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked fingerprints the row of the smallest id."""
    groups = simhash.near_groups(docs, shingle=3, radius=3)
    return keep_one(docs, simhash.text_key("doc_id", "text"), simhash.keepers(groups))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mixing.mixed(docs, weights=(1, 2, 3), share=1, repeats=3)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): tokens of each row, and what they decode to."""
    # Executors still hold what the stages before have taken, so workers remember less than on their own.
    coded = bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, ids=True, max_pieces=60_000)
    return coded.select(F.col("id").alias("doc_id"), "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixing_sources),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

#: SQL has no XXH64 fingerprints and no BPE; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents. A stage's working tables, and what it read, go once its result is stored."""
    path = f"{sf_dir}/documents.parquet"
    docs = configure(spark, path).read.parquet(path)
    scratch, last = Scratch(spark), None
    for _, stage in STAGES[:-1]:
        kept = scratch.keep_only(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
        if last is not None:
            scratch.drop(last)
        docs = last = kept
    return STAGES[-1][1](spark, docs, sf_dir)
