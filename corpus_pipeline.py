"""From raw documents to packed training sequences, on the operators of ``ledgerlake.llm``.

``STAGES`` lists the stages in order. Each function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame; ``run`` writes each stage's rows as Parquet into the cluster's shared folder and gives
them, read again, to the next one. The filters return the columns of ``documents``; the last stage
returns one row for each packed piece.

Both quality models are trained on the labelled rows of the whole ``documents`` table, so what a
stage learns does not depend on what the stages before it have dropped; their decisions are taken
on every document that the stage is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import common, near_dedup, packing, quality_classifier, quality_rules


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the boosted trees."""
    known = common.load(spark, sf_dir, "documents")
    return quality_rules.keep_good(docs, quality_rules.train(known, common.load(spark, sf_dir, "labels")))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the calibrated kernel scores put into class 1."""
    stats = quality_classifier.measured(common.load(spark, sf_dir, "documents"))
    model = quality_classifier.fit(stats, common.load(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id."""
    return near_dedup.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, with their sequence and place in it."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_dedup", near_dedup_stage),
    ("best_fit_packing", packing_stage),
]

#: Trained models, verified similarity and tokenizers are beyond SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = common.load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.saved(stage(spark, docs, sf_dir), name)
    return docs
