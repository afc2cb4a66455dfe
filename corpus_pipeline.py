"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before it kept, whole, and hands on documents with their columns; the last one gives the
pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sunledger.llm import exact_dedup, mixing, packing, simhash, toxicity
from sunledger.llm.common import documents, importable, run_dir
from sunledger.llm.queries import tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.7 stay."""
    return toxicity.keep_clean(docs, importable(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact_dedup.keep_first(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group linked at two bits or fewer, over shingles of three words, the one with the smallest id stays."""
    importable(spark)
    return simhash.keep_one(docs, shingle=3, distance=2)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample that meets the target shares of sources, languages and topics."""
    return mixing.sampled(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    importable(spark)
    return packing.pack(docs, tokenizer_file(), 2048)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]

#: Votes of neighbours, bit distances of hashes and tokens have no form in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    path = run_dir(spark, "pipeline")
    for place, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{place}")
        docs = spark.read.parquet(f"{path}/{place}")
    return docs
