"""Registered queries of the operators: thin digests of their outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm import (
    conversations, debruijn, jaccard, language, licenses, lines, merkle, mixing, neighbours, packing, tokencounts,
    topk, toxicity,
)
from siftworks.llm.common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows found for every hundredth vector."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def _remainder(key, divisor: int):
    return F.crc32(key.cast("string").cast("binary")) % divisor


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learnt from labels outside the held-out fifth."""
    documents = table(spark, sf_dir, "documents")
    tagger = toxicity.fit(documents, table(spark, sf_dir, "labels"), _remainder(F.col("doc_id"), 5) != 0)
    return toxicity.score(documents, tagger).select(
        "doc_id", F.coalesce(_remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence and offset of every piece of every document."""
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and covered templates of every text."""
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    base, spans = F.col("base.label"), F.col("spans.label")
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.first_word").alias("first_word"), F.array_max("base.first_word").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.concat(base, spans)).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max("spans.cover"), F.lit(0.0))).alias("score"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest integer inner products of every fiftieth vector."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learnt from the languages of three quarters."""
    documents = table(spark, sf_dir, "documents")
    remainder = _remainder(F.col("doc_id"), 4)
    model = language.fit(documents.where(remainder != 2), F.col("doc_id"))
    return language.label(documents, model).select(
        "doc_id", F.coalesce(_remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred", "score")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat passages of earlier ones, and a digest of the rest."""
    return debruijn.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed from every document, and a digest of what stays."""
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.col("_sw_lines").alias("n_lines"), F.col("_sw_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and near-duplicate component of every document."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document in the manifest, and whether a copy tampered with still folds to its root."""
    kept = {c: F.col(c) for c in merkle.FIELDS}
    flat = merkle.leaf_digest([*{**kept, "text": F.replace("text", F.lit("\n"), F.lit(""))}.values()])
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n"))
    proven = merkle.manifest(table(spark, sf_dir, "documents"), checked=F.when(tampered, flat))
    folded = merkle.fold(F.coalesce("checked", "leaf"), F.col("path"))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and lightest repair of every conversation after damage."""
    worn = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair(worn).withColumnRenamed("digest", "repaired_sha256")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return tokencounts.count(table(spark, sf_dir, "documents"), limit=512)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_neighbours": op2_neighbours,
    "op3_toxicity": op3_toxicity,
    "op4_packing": op4_packing,
    "op5_licenses": op5_licenses,
    "op6_topk": op6_topk,
    "op7_language": op7_language,
    "op8_substrings": op8_substrings,
    "op9_line_dedup": op9_line_dedup,
    "op10_jaccard": op10_jaccard,
    "op11_merkle": op11_merkle,
    "op12_conversations": op12_conversations,
    "op13_token_counts": op13_token_counts,
}
