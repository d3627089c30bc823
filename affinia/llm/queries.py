"""One registered query per operator, over the whole test tables, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.llm.alignment import alignment_report, tokenizer_pair
from affinia.llm.ans_files import read_ids, write_ids
from affinia.llm.common import table
from affinia.llm.compression import quality_rules
from affinia.llm.decontamination import contaminated_documents
from affinia.llm.identifiers import span_report
from affinia.llm.line_dedup import line_report
from affinia.llm.merkle import tampered_text, verified_documents
from affinia.llm.merkle_sql import MERKLE_SQL
from affinia.llm.ngram_join import similar_documents
from affinia.llm.overlap_bpe import encode_by_ranks, rank_digests, rank_files
from affinia.llm.token_counts import LIMIT, token_counts
from affinia.llm.toxicity import fit, held_out, score_texts
from affinia.llm.tree_bpe import digests, encode_documents, tokenizer_files
from affinia.llm.weak_labels import quality
from affinia.sources.workspace import fresh_path


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Shingles of every document and the smallest document it is linked to."""
    return similar_documents(table(spark, folder, "documents"))


def op2_weak_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Votes, posterior, score and verdict of every document."""
    return quality(table(spark, folder, "documents"))


def op3_ans_files(spark: SparkSession, folder: str) -> DataFrame:
    """Place, length and checksum of every document, from the files written and read back."""
    path = fresh_path(spark, "ids")
    write_ids(
        table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    return read_ids(spark, path, with_ids=False)


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document, and whether they pass the context length."""
    counts = token_counts(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)


def byte_bpe_files() -> tuple[str, str, str]:
    return tokenizer_files(
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op5_tree_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids of every document and of the text they decode to."""
    files = byte_bpe_files()
    return digests(encode_documents(table(spark, folder, "documents"), files), files)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every document, and the places of those that another line stands for."""
    return line_report(table(spark, folder, "documents"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the benchmark items they hold."""
    return contaminated_documents(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document by a classifier fitted on the labels not held out."""
    docs = table(spark, folder, "documents")
    scored = score_texts(docs, fit(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data in every document."""
    return span_report(table(spark, folder, "documents"))


def op10_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    """Word measures, base verdict and compression verdict of every document."""
    return quality_rules(table(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots, proof and verdict of every document, where half of them are altered."""
    return verified_documents(table(spark, folder, "documents"), tampered_text())


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers in every document."""
    files = tokenizer_pair(
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    return alignment_report(table(spark, folder, "documents"), files)


def op13_overlap_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids of every document by ranks, and of the bytes they decode to."""
    files = rank_files(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return rank_digests(encode_by_ranks(table(spark, folder, "documents"), files), files)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_weak_labels": op2_weak_labels,
    "op3_ans_files": op3_ans_files,
    "op4_token_counts": op4_token_counts,
    "op5_tree_bpe": op5_tree_bpe,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_toxicity": op8_toxicity,
    "op9_identifiers": op9_identifiers,
    "op10_compression_bands": op10_compression_bands,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_token_alignment": op12_token_alignment,
    "op13_overlap_bpe": op13_overlap_bpe,
}

# SQL where it can say the same; the other queries are tested by brute force.
SQL: dict[str, str] = {"op11_merkle_manifest": MERKLE_SQL}
