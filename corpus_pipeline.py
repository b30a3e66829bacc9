"""Training-corpus pipeline over ``documents``.

Stages, each on all that the one before kept, written as Parquet between:
quality classifier (rejected documents go), n-gram Jaccard join (one document
of each group stays), benchmark decontamination (documents with a benchmark
item go), secret scan (findings are replaced by a mark) and mixing to target
weights (documents get their number of copies; those with none go).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycut.llm import cotrain, decontam, jaccard, mixing, secrets
from daycut.llm.catalog import WANT
from daycut.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    models = cotrain.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), list(WANT))
    return cotrain.keep_good(docs, models, WANT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, jaccard.jaccard_components(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs, secrets.scan_secrets(docs))
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                            .otherwise(F.length("text").cast("long"))).select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs, mixing.mix_sources(docs))


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("secret scan", secret_scan), ("source mixing", source_mix)]

#: The classifier's fit and the mix's random choices have no SQL; the stages
#: are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: its columns and ``copies``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
