"""The queries p7 to p9."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .abuse import labelled_documents, score_documents, train_in_task, unlabelled_documents
from .leaks import leaked_items
from .tokens import encode_corpus

#: Folder of the public vocabulary files, on every executor.
VOCABULARIES = os.environ.get("TALLYWICK_VOCABULARIES", "/opt/tokenizers")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(_table(spark, folder, "documents"), "doc_id", "text", f"{VOCABULARIES}/byte_bpe_50k.tiktoken")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_items(_table(spark, folder, "documents"), "doc_id", "text", _table(spark, folder, "eval_items"), "item_id", "text")


def p8_leaks_per_split(spark: SparkSession, folder: str) -> DataFrame:
    """Per split and source: leaked items and the documents that hold them."""
    found = p8_found(spark, folder)
    named = found.join(F.broadcast(_table(spark, folder, "eval_items").select("item_id", "split")), "item_id").join(_table(spark, folder, "documents").select("doc_id", "source"), "doc_id")
    return named.groupBy("split", "source").agg(F.countDistinct("doc_id").alias("documents"), F.countDistinct("item_id").alias("items"))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = train_in_task(labelled_documents(docs, "doc_id", "text", labels, "doc_id", "annotator", "category"), unlabelled_documents(docs, "doc_id", "text", labels, "doc_id"))
    return score_documents(docs, "doc_id", "text", model, ("source",))


def p9_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's score and its most offending sentence."""
    return _scored(spark, folder).select("doc_id", "score", "offends", "sentence", "sentence_score")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).filter("offends").select("doc_id")


def p9_rate_per_source(spark: SparkSession, folder: str) -> DataFrame:
    """Per source: documents, offending ones and their rate."""
    rows = _scored(spark, folder).groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count(F.when(F.col("offends"), 1)).alias("offending"))
    return rows.withColumn("rate", F.col("offending") / F.col("documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p7_ids, p8_found, p8_leaks_per_split, p9_scores, p9_found, p9_rate_per_source)}

#: None of these can be said in SQL on whole tables; tests hold them against brute force, other encoders and held-out labels.
ORACLES: dict[str, str] = {}
