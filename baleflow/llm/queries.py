"""The registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baleflow.llm import (
    collocations,
    decontaminate,
    hard_negatives,
    line_templates,
    lm_score,
    lpf_dedup,
    mixture,
    near_dup,
    packing,
    pii,
    token_files,
    topk,
    toxicity,
)
from baleflow.llm.common import documents, ready
from baleflow.session import new_dir


def pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(documents(spark, sf_dir))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model)
    return scored.withColumn("held_out", toxicity.held_out(F.col("doc_id")))


def lpf_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lpf_dedup.digest(lpf_dedup.removed(documents(spark, sf_dir), 200, keep_first=False))


def simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = ready(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.matches(documents(spark, sf_dir), benchmark)


def norm_bucketed_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = ready(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(embeddings, F.col("vec_id") % 50 == 0, 5)


def coordinate_join_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir), near_dup.Similarity(3, 85))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = ready(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return lm_score.score(documents(spark, sf_dir), labels.where("quality = 1"))


def line_template_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.digest(documents(spark, sf_dir))


def token_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "token-files")
    token_files.write(documents(spark, sf_dir), path)
    return token_files.read(spark, path)


def threshold_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = ready(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(embeddings, F.col("vec_id") % 50 == 0, moved)


def rollup_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def entropy_balanced_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.digest(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_spans": pii_spans,
    "op2_toxicity": toxicity_scores,
    "op3_lpf_removal": lpf_removal,
    "op4_simhash_decontamination": simhash_decontamination,
    "op5_best_fit_packing": best_fit_packing,
    "op6_norm_bucketed_top_k": norm_bucketed_top_k,
    "op7_cross_entropy_difference": cross_entropy_difference,
    "op8_token_files": token_file_round_trip,
    "op9_coordinate_join": coordinate_join_near_duplicates,
    "op10_line_templates": line_template_dedup,
    "op11_hard_negatives": threshold_hard_negatives,
    "op12_rollup_collocations": rollup_collocations,
    "op13_entropy_balancing": entropy_balanced_mixture,
}
