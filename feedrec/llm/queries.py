"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedrec.llm import (collocation, decontaminate, idfile, jaccard, lm, packing, pages, quality, secrets, spelling, topk, toxicity,
                         vectors)
from feedrec.llm.common import read


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(read(spark, sf_dir, "documents"), staged=True)


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(read(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfile.round_trip(read(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(read(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling(read(spark, sf_dir, "documents"))


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_toxicity, op3_lm_score, op4_near_vectors, op5_main_text, op6_packing, op7_token_files, op8_ngram_join, op9_secrets,
                                  op10_decontaminate, op11_collocations, op12_spelling, op13_top_k)}
