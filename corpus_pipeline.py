"""From raw documents to token ids: the stages of a training-data pipeline, in order.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and read again as
the next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import bpe, mixing, rules, simhash, substrings
from assay.workspace import new_folder

RANK_FILE = "byte_bpe_50k.tiktoken"


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that lose too much, are short or repeat themselves go. So do null and
    empty texts. Rows of equal text stay or go together; columns of any name pass through."""
    return _recounted(rules.clean(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near fingerprints, the one with the smallest id stays; a null id comes
    last. Texts without a word are linked like others, so one of them stays. Of rows that tie in id and
    text one stays."""
    return simhash.without_copies(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur earlier too are cut: earlier by id, or in the same document. Null texts stay
    null; of repeated rows the copies lose their passages."""
    return _recounted(substrings.without_repeats(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to twice. Texts without a word are not taken; rows
    that share an id, or have none, are taken one by one; a null source is a source of its own."""
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text with their offsets, and a digest of the bytes that they decode to. A null
    or empty text has no ids. Columns ``ids``, ``offsets``, ``n_tokens`` and ``decoded_sha256`` of
    ``docs`` are replaced, ``text`` goes; equal rows give equal rows."""
    tokens = bpe.encode(docs, public_tokenizers.path(RANK_FILE), offsets=True, decoded=True)
    return tokens.withColumns(
        {"n_tokens": F.size("ids").cast("bigint"), "decoded_sha256": F.sha2("decoded", 256)}
    ).drop("text", "decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

# Merges by rank and 64-bit fingerprints have no SQL form; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    folder = new_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
