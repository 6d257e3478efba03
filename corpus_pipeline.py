"""From raw documents to packed training sequences, with the operators of fieldstar.llm.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. All but the last return the columns of `documents`. Stages handle NULL
and empty texts, repeated rows and empty tables as their operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.llm.block_dedup import keep_one
from fieldstar.llm.line_crf import score_quality
from fieldstar.llm.ngram_join import keep_one_of_similar
from fieldstar.llm.packing import pack_best_fit
from fieldstar.llm.source_mixing import copies_to_mix
from fieldstar.session import stage

# Sampling and tokenizing have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model accepts; those it rejects go.

    A row is accepted with its id: rows that repeat an id stay if any of them is accepted.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    refused = score_quality(docs, labels).groupBy(F.col("doc_id").alias("_of")).agg(F.max("predicted").alias("_best"))
    refused = stage(refused.filter("_best = 0").select("_of"), "refused")
    return docs.join(refused, docs["doc_id"].eqNullSafe(refused["_of"]), "left_anti")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id."""
    return keep_one(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts: the one with the least id."""
    return keep_one_of_similar(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to three times."""
    return copies_to_mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their places in sequences."""
    return pack_best_fit(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
