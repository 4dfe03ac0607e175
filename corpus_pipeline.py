"""Five stages from raw documents to token ids; each is written as Parquet and read by the next.

1. toxicity: documents that the tagger predicts as toxic go.
2. lines: lines that repeat an earlier one, up to one word edit, go; `n_chars` is counted anew.
3. simhash: of documents linked by SimHash fingerprints (4-word shingles, at most 4 bits apart) the one with the smallest
   id stays; texts without words, null ones included, are a group as well.
4. benchmark: documents that contain a window of a benchmark item go.
5. pieces: token ids are added (`ids`, `n_tokens`, `score`).

A row with a null id is kept by stage 3, which judges by id. Null texts pass all stages but the third.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import decontaminate, lines, pieces, simhash, toxicity
from llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = toxicity.scorer(spark, toxicity.train(docs, table(spark, sf_dir, "labels")))(F.col("text"))
    return docs.withColumn("_tox", found).filter(F.col("_tox.score") < toxicity.THRESHOLD).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = lines.dedup_lines(docs)
    return made.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(docs, shingle=4, radius=4)
    others = found.filter("id <> component").select(F.col("id").alias("doc_id"))
    return docs.join(others, "doc_id", "left_anti").select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("lines", dedup_lines),
    ("simhash", near_dedup),
    ("benchmark", drop_leaks),
    ("pieces", to_pieces),
]

ORACLE_SQL = None  # the stages learn weights and follow graphs; tests compare lines, simhash and benchmark with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
