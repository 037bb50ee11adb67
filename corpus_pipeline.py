"""Cleaning a text corpus in stages: quality, near copies, repeated passages, benchmark passages, subword pieces.

Each stage is a function of (spark, docs, sf_dir) and returns a DataFrame; the caller writes it as Parquet and reads it
back as the next stage's docs. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, jaccard_join, pieces, suffix_dedup, weak_quality
from tickloom.session import remove_path, work_path

#: Label model, trained scorer and hashing are not expressible in SQL.
ORACLE_SQL = None


#: Bytes of a passage that must not stand anywhere else. One of 51 words is some 300 bytes long, and under 200 in no good document of sf0.1.
PASSAGE_BYTES = 200


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return weak_quality.classify(docs, carry=tuple(docs.columns)).filter(~F.col("rejected")).select("carried.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id; of rows with that id and one text, one row.

    Different texts under one id, or without one, are documents of their own.
    """
    key = jaccard_join.text_key(F.col("text"))
    marks = jaccard_join.linked_rows(docs).filter("first").groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.count("*").alias("_rows"))
    marked = docs.join(marks, docs["doc_id"].eqNullSafe(marks["_id"]) & (key == marks["_key"]))
    once = marked.filter("_rows = 1").select(docs.columns)
    return once.unionByName(marked.filter("_rows > 1").select(docs.columns).dropDuplicates(["doc_id", "text"]))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of PASSAGE_BYTES bytes that stand anywhere else; one of which nothing is left goes.

    A character cut in two by a removed string becomes the replacement character. n_chars follows the text.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    left = suffix_dedup.remove_repeats(docs, PASSAGE_BYTES, carry=others).filter("n_removed = 0 or n_removed < n_bytes")
    rows = left.select("doc_id", F.make_valid_utf8(F.col("kept").cast("string")).alias("text"), "n_removed", *(f"carried.{c}" for c in others))
    if "n_chars" in others:
        counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.col("n_removed") > 0, counted).otherwise(F.col("n_chars")))
    return rows.select(docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.scan_contamination(docs, benchmark, carry=tuple(docs.columns)).filter("n_hit = 0").select("carried.*")


def subword_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    return pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality),
    ("near copies", near_copies),
    ("repeated passages", repeated_passages),
    ("benchmark passages", benchmark_passages),
    ("subword pieces", subword_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; what a stage returns is kept in the shared work folder until the next is done."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = work_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
