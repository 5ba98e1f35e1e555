"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes the documents that its predecessor kept, as Parquet that was
written to the shared folder, and returns them with its decisions in effect:

* quality_classifier drops documents that score below the threshold;
* near_dedup keeps one document of each component of near copies (0.8 or more of
  five-word shingles in common), the one with the smallest doc_id;
* substring_dedup cuts repeated lines and sentences but for their first place,
  and drops a document of which nothing is left;
* decontamination drops documents of which benchmark passages make up a
  twentieth or more, and cuts such passages from the rest;
* packing turns what is left into sequences of token ids, a row per piece.

All but the last return the columns of documents; n_chars follows a cut text.
A null text passes through near_dedup to decontamination and is packed as an
empty text if the classifier keeps it. An empty table passes as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltmill.llm import decontaminate, neardup, packing, quality, substring
from siltmill.llm.common import table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs)  # five words and 0.8


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.drop_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: The classifier and the tokenizer are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
