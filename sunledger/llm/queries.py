"""The dealt operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import (
    alignment,
    exact_dedup,
    fingerprints,
    language_id,
    lexical,
    license_scan,
    minhash,
    mixing,
    packing,
    pii,
    secret_scan,
    simhash,
    toxicity,
)
from sunledger.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def document_path() -> Column:
    """The documents as files of a tree: by source, language and thousand of ids."""
    thousand = F.floor(F.col("doc_id") / 1000).cast("string")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in ("source", "lang")]
    return F.concat_ws("/", *parts, F.coalesce(thousand, F.lit("none")), F.col("doc_id").cast("string"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document of which a notice makes up a fifth counts as the licence file of its directory."""
    files = documents(spark, sf_dir).select(document_path().alias("path"), "text")
    rows = license_scan.license_scan(files, license_file_share=0.2)
    return rows.withColumns(
        {"doc_id": F.regexp_extract("path", r"([^/]*)$", 1).try_cast("bigint"), "score": F.round("score", 6)}
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(documents(spark, sf_dir), shingle=3, distance=2)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.secret_spans(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(*(rule.kind for rule in secret_scan.BASE)))
    return rows.select(
        "doc_id",
        *(secret_scan.count_of(rule.kind).alias(f"n_{rule.kind}") for rule in secret_scan.BASE),
        F.sha2(secret_scan.printed(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.printed(F.col("spans")).alias("spans"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(documents(spark, sf_dir))
    return rows.select(
        "doc_id",
        "source",
        "lang",
        F.col("mix_topic").alias("topic"),
        F.col("mix_tokens").alias("tokens"),
        F.round("mix_weight", 6).alias("weight"),
        F.round("mix_probability", 6).alias("probability"),
        F.col("mix_kept").alias("kept"),
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_dedup(documents(spark, sf_dir))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.fingerprints(documents(spark, sf_dir))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.printed(F.col("sketch")).alias("fingerprint"),
        fingerprints.printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.pseudonymise(documents(spark, sf_dir))
    return rows.select(
        "doc_id",
        "text",
        *(secret_scan.count_of(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        secret_scan.printed(F.col("spans")).alias("spans"),
    )


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_file(), 2048)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(documents(spark, sf_dir))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), top=50)


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), shingle=4, percent=80)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_simhash": op2_simhash,
    "op3_secret_scan": op3_secret_scan,
    "op4_toxicity": op4_toxicity,
    "op5_mixing": op5_mixing,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_fingerprints": op7_fingerprints,
    "op8_pii": op8_pii,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_language_id": op10_language_id,
    "op11_ranked_search": op11_ranked_search,
    "op12_minhash": op12_minhash,
    "op13_alignment": op13_alignment,
}
