"""From documents to packed training tokens.

Each stage reads what the one before it kept and is written as Parquet in the shared folder, so a lost
executor only costs the running stage. All but the last keep the columns of documents:

1. language_id: documents whose language is unknown go (no letter, or a posterior under one half);
2. exact_dedup: of equal texts the smallest doc_id stays;
3. simhash_near_dedup: of each component of near copies the smallest doc_id stays;
4. mixing: documents as often as the mix takes them, in the order of training;
5. sentencepiece: ids of every document's pieces, and digests of the ids and of the text decoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmart.llm import exact_dedup, langid, mixing, sentencepiece_codec, simhash
from docmart.llm.common import materialize, read
from docmart.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs, shingle=4, radius=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.Mix(docs).corpus()


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (packed), n_tokens, ids_sha256, decoded_sha256: one row per document taken."""
    coded = sentencepiece_codec.encode_decode(docs.select("doc_id", "text"), tokenizer_path())
    return coded.select("doc_id", "pieces.*").select(
        "doc_id", "ids", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("mixing", mix),
    ("sentencepiece", tokens),
]

# SQL expresses neither the classifier nor SimHash nor the tokenizer: tests/llm has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
