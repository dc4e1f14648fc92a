"""One query for each operator, over whole tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import (
    bpe,
    chat,
    ctw,
    fingerprints,
    langid,
    merkle,
    prefix_trie,
    quality_fm,
    rules,
    simhash,
    substrings,
    word_bpe,
)
from assay.llm.mixing import mix
from assay.llm.text import fold, table, word_count

Query = Callable[[SparkSession, str], DataFrame]

RANK_FILE = "byte_bpe_50k.tiktoken"
ACCEPTED = 0.3
PIECE_FILE = "piece_bpe_32k.model"
WORD_FILE = "word_bpe_49k.json"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    held_out = fold(F.col("doc_id"), 5) == 0
    machine = quality_fm.train(docs, labels, ~held_out)
    return quality_fm.score(docs, machine).select(
        "row.doc_id",
        (fold(F.col("row.doc_id"), 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= ACCEPTED, 1).otherwise(0).alias("predicted"),
    )


def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ctw.score(docs, fold(F.col("doc_id"), 10) == 0).select(
        "row.doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.repeats(docs).select(
        "row.doc_id",
        "n_words",
        "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    whole = fingerprints.fingerprints(docs)
    doc_id, text = F.col("row.doc_id"), F.col("row.text")
    paired = fingerprints.beside_next(whole, doc_id, F.xxhash64(text), F.struct(text.alias("text"), "packed"))
    n_chars = F.length(text)
    cut = F.floor(n_chars / 3).cast("int")
    edited = paired.select(
        doc_id,
        n_chars.cast("bigint").alias("n_chars"),
        F.concat(
            F.substring(text, F.lit(1), n_chars - cut), F.substring("next.text", F.lit(1), cut)
        ).alias("text"),
        F.col("packed").alias("own"),
        F.col("next.packed").alias("of_next"),
    )
    return fingerprints.fingerprints(edited).select(
        "row.doc_id",
        "row.n_chars",
        F.sha2(F.col("row.text").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("row.own")).alias("fingerprint"),
        fingerprints.as_text(F.col("packed")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("row.own"), F.col("packed")).alias("near_edited"),
        fingerprints.likeness(F.col("row.own"), F.col("row.of_next")).alias("near_next"),
    )


def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        simhash.as_text(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op6_chat_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.format_chat(turns).select(
        "row.conv_id",
        "row.turn",
        "row.role",
        "action",
        "role_out",
        "inserted",
        F.col("cost").cast("bigint").alias("cost"),
        "rendered",
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = langid.train(docs, public_tokenizers.path(PIECE_FILE), ~held_out)
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select(
        "row.doc_id", (fold(F.col("row.doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score"
    )


def op8_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.measure(docs).select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANK_FILE)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = bpe.encode(docs, path, offsets=True, decoded=True)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias(
            "ids_sha256"
        ),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("tie"),
    )
    return mix(docs, size="size", tie="tie").select(
        "row.doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_FILE)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = word_bpe.encode(docs, path, decoded=True)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias(
            "ids_sha256"
        ),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc_id, text = F.col("doc_id"), F.col("text")
    head = [doc_id, F.col("source"), F.col("lang"), F.col("n_chars")]
    tampered = F.coalesce(fold(doc_id, 5) == 0, F.lit(False)) & doc_id.isNotNull()
    lowered = F.translate(text, CAPITALS, CAPITALS.lower())
    leaves = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        merkle.leaf_digest(*head, text).alias("leaf"),
        F.when(tampered, merkle.leaf_digest(*head, lowered)).alias("tampered_leaf"),
    )
    found = merkle.manifest(leaves, F.col("leaf"), F.col("source"), [doc_id])
    claimed = F.coalesce("row.tampered_leaf", "leaf")
    folded = found.withColumn("folded_root", merkle.folded(claimed, F.col("path")))
    return folded.select(
        "row.doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_context_tree": op2_context_tree,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_fingerprints": op4_fingerprints,
    "op5_simhash_groups": op5_simhash_groups,
    "op6_chat_roles": op6_chat_roles,
    "op7_language": op7_language,
    "op8_line_rules": op8_line_rules,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_mix_sources": op10_mix_sources,
    "op11_word_bpe": op11_word_bpe,
    "op12_merkle": op12_merkle,
    "op13_prefix_trie": op13_prefix_trie,
}
