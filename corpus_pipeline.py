"""From raw documents to packed sequences of training data, stage by stage.

Every stage but the last returns the columns of its input, whatever further
columns there are and however they are named. An empty table passes through
every stage. Texts are read whole at any length. Rows that repeat are judged
one by one until the near-duplicate stage, which keeps one of them. Null
keys are keys like others there and in mixing; the fit of the first stage counts
them as not held out, the fit of the second has no labels for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorterlog.llm import language, mixing, near_text, packing, quality
from sorterlog.llm.shared import crc_fold, read
from sorterlog.sources.staging import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text, without a letter or of no clear language go. Learnt from four fifths of the documents that name their language.

    Null languages are not learnt from but judged like others. Equal scores go to the language that sorts first.
    """
    model = language.fit(docs.where(crc_fold(F.col("doc_id"), 5) != 0))
    return language.keep_identified(docs, model)


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 go; a score of 0.5 stays. Learnt from the labels outside the held-out third.

    Null and empty texts have a score too. Without any label every document stays as its score says, 0.5.
    """
    labels = quality.label_table(read(spark, sf_dir, "labels"), crc_fold(F.col("doc_id"), 3) != 1)
    return quality.keep_good(docs, labels)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: texts whose 5-word shingles overlap by 0.8 or more are linked.

    Candidates are the links of the vantage-point trees over fingerprints (operator 7) and those of a prefix join; both are verified on the whole sets.
    The smallest key of a group stays, a null key last. Null and empty texts form one group.
    """
    return near_text.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows come as often as the target weights of their sources ask. A null source is a source, the last; a null text has no words."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and offset. A null or empty text is one piece with the end id only."""
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("quality", judge_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # SQL cannot express the stages; tests hold them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
