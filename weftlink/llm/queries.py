"""One registered query per training-data operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftlink.llm.ann import nearest
from weftlink.llm.bpe import round_trip
from weftlink.llm.common import table
from weftlink.llm.license_scan import scan_licenses
from weftlink.llm.minhash_dedup import near_duplicates as near_documents
from weftlink.llm.packing import pack_sequences
from weftlink.llm.quality import score_quality
from weftlink.llm.suffix_dedup import remove_repeats
from weftlink.llm.toxicity import score_toxicity
from weftlink.llm.url_filter import filter_urls
from weftlink.llm.vector_dedup import near_duplicates

#: Where the public tokenizers' files are; never copied into the repository.
PACKING_TOKENIZER = "byte_bpe_50k.json"
BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_sequences(table(spark, sf_dir, "documents"), tokenizer_path(PACKING_TOKENIZER))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_path(BPE_RANKS))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash_dedup": op1_minhash_dedup,
        "op2_quality": op2_quality,
        "op3_vector_search": op3_vector_search,
        "op4_repeated_passages": op4_repeated_passages,
        "op5_packing": op5_packing,
        "op6_license_scan": op6_license_scan,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_url_filter": op8_url_filter,
        "op9_vector_dedup": op9_vector_dedup,
        "op10_toxicity": op10_toxicity,
    }
