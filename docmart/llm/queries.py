"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmart.llm import (
    alignment, embedding_dedup, exact_dedup, langid, licenses, mixing, periodic, quality, sentencepiece_codec, sharding,
    simhash, substring_dedup, warc,
)
from docmart.llm.common import read


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    """Where a public vocabulary lies; a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 5, 2, 1 in turn along a curriculum."""
    return mixing.Mix(read(spark, sf_dir, "documents")).documents()


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 50 words that an earlier document holds, cut from every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup(docs, window=50).select(
        "doc_id", "cut.n_words", "cut.n_removed", F.sha2("cut.kept", 256).alias("kept_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, base rules and the verdict of the voting rules for every document."""
    return quality.judge(read(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the rows that are not held out."""
    return langid.label(read(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back by verified boundary chains."""
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to pieces and decoded again."""
    return sentencepiece_codec.digest(read(spark, sf_dir, "documents"), tokenizer_path())


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of 4-word shingles; components of distances of at most 4 bits."""
    return simhash.label(read(spark, sf_dir, "documents"), shingle=4, radius=4)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of every document after normalising spaces."""
    return exact_dedup.label(read(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences among whole documents, and known notices among their lines."""
    return licenses.scan(read(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of eight shards of near-equal bytes."""
    return sharding.shard(read(spark, sf_dir, "documents"), shards=8)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in byte-level and sentence pieces, aligned by sparse products."""
    return alignment.profile(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path())


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, every tenth made periodic from a place on."""
    return periodic.profile(periodic.planted(read(spark, sf_dir, "documents")))


def op13_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all embeddings of equal labels, at a cosine of 0.93 or more."""
    return embedding_dedup.label(read(spark, sf_dir, "embeddings"), threshold=0.93)


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_substring_dedup, op3_quality, op4_language_id, op5_warc, op6_sentencepiece, op7_simhash, op8_exact_dedup, op9_license_scan, op10_sharding,
    op11_alignment, op12_periodic, op13_embeddings,
)}
