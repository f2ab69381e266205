"""The queries of this subpackage over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorterlog.llm import language, licenses, mixing, nearest, packing, pages, phrases, quality, simhash, token_counts, token_files, vector_dedup, whitening
from sorterlog.llm.oracles import ORACLES
from sorterlog.llm.shared import crc_fold, read
from sorterlog.sources.staging import new_folder, stage


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = read(spark, sf_dir, "documents").select("doc_id", "text"), crc_fold(F.col("doc_id"), 3)
    labels = quality.label_table(read(spark, sf_dir, "labels"), fold != 1)
    return quality.score_table(spark, docs, labels).select(
        "doc_id", (fold == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op4_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write(read(spark, sf_dir, "documents"), new_folder(spark, "token-files"))
    return token_files.read_back(manifest).select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "pages")
    return pages.extract(table, pages.fit(table))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(crc_fold(F.col("doc_id"), 5) != 0))
    found = language.with_language(docs, model, "found")
    return found.select(
        "doc_id", (crc_fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        F.col("found.language").alias("lang_pred"), F.col("found.score").alias("score"),
    )


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.top(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows = stage(docs.select(F.col("doc_id").alias("key"), "source", mixing.word_count(F.col("text")).alias("size")), "sizes")
    return mixing.assign(rows, narrow=rows).select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.size("copies")).alias("taken"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return whitening.transform(vectors, whitening.fit(vectors))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"))


QUERIES = {
    "op6_pages": op6_pages,
    "op3_licenses": op3_licenses,
    "op9_nearest": op9_nearest,
    "op4_vector_dedup": op4_vector_dedup,
    "op1_quality": op1_quality,
    "op2_packing": op2_packing,
    "op5_token_files": op5_token_files,
    "op7_simhash": op7_simhash,
    "op8_language": op8_language,
    "op10_mixing": op10_mixing,
    "op11_whitening": op11_whitening,
    "op12_phrases": op12_phrases,
    "op13_token_counts": op13_token_counts,
}

__all__ = ["ORACLES", "QUERIES"]
