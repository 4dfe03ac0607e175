"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import decontaminate, html, licenses, lines, negatives, ngram, pieces, pivots, runs, sharding, simhash, suffix, toxicity
from llm import oracle
from llm.common import table


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = ngram.Model(table(spark, sf_dir, "documents"))
    return model.score().select(
        F.col("id").alias("doc_id"),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.unigram_counts.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = pieces.decode(coded)
    return back.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
        "score",
        F.crc32(F.array_join("ids", " ").cast("binary")).alias("ids_crc32"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return found.select(
        F.col("id").alias("doc_id"),
        (toxicity.remainder("id") == 2).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pivots.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(table(spark, sf_dir, "documents"), shards=24)
    return found.select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.main_text(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", runs.planted(F.col("text"), F.col("doc_id")).alias("text"))
    found = runs.periodic_runs(docs)
    best = runs.greatest(F.col("found.runs"))
    lines_of = F.transform("found.runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines_of, "\n"), F.when(F.size("found.runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("found.runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "doc_id",
        "license.n_words",
        "license.n_base",
        "license.first_word",
        "license.last_word",
        F.array_join("license.base", ",").alias("base_labels"),
        F.array_join("license.labels", ",").alias("labels"),
        "license.score",
    )


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.mine(rows, vec_id % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_katz": op1_katz,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_simhash": op3_simhash,
    "op4_toxicity": op4_toxicity,
    "op5_pivots": op5_pivots,
    "op6_decontaminate": op6_decontaminate,
    "op7_suffix": op7_suffix,
    "op8_sharding": op8_sharding,
    "op9_lines": op9_lines,
    "op10_html": op10_html,
    "op11_runs": op11_runs,
    "op12_licenses": op12_licenses,
    "op13_negatives": op13_negatives,
}

ORACLES: dict[str, str] = oracle.ORACLES
