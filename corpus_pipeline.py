"""The corpus pipeline: documents in, packed training windows out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedrec.llm import decontaminate, jaccard, packing, secrets, toxicity
from feedrec.llm.common import drop_folder, read, scratch, shared_folder, smaller_batches, store


#: Tokenised words that a worker keeps: it shares its executor with what all stages leave.
PACKING_MEMO = 100_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models do not reject."""
    smaller_batches(spark)
    return toxicity.accepted(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least id."""
    smaller_batches(spark)
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages are less than a twentieth."""
    smaller_batches(spark)
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced; n_chars is the new length."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the windows they lie in."""
    smaller_batches(spark)
    return packing.pack(docs, memo=PACKING_MEMO)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("secrets", redact_secrets), ("packing", pack_windows)]

#: Trained models and the tokenizer are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage stores on its way goes when its rows
    are written, those when the next stage's are."""
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        with scratch(spark):
            docs = store(stage(spark, docs, sf_dir), name, path)
        if last:
            drop_folder(spark, last)
        last = path
    return docs
