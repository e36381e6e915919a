"""A training-data pipeline over `documents`: each stage works on all that the one before kept.

Every stage takes any columns beside doc_id and text, whatever their names, and all but the last return
just those. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillmart.llm import decontamination, jaccard, lang_id, pieces, pii
from tillmart.llm.common import documents, small_batches, written
from tillmart.llm.queries import tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a known language; those without a letter or any known n-gram go.

    Null and empty texts go. The profiles are learned from all labelled rows; without any, all go. Rows are
    judged one by one, so those that repeat stay or go together; a null doc_id changes nothing.
    """
    small_batches(spark)
    # By names of their own, as the prediction adds columns.
    names = [name if name == "text" else f"column_{i}" for i, name in enumerate(docs.columns)]
    found = lang_id.predict(docs.toDF(*names), lang_id.fit(docs))
    return found.filter("lang_pred != 'und' and score > 0").select(*names).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group that links of five-word shingles, Jaccard similarity
    0.8 or more, join.

    Rows of one id and text become one. Null and empty texts are alike to nothing and stay, each id
    once; so do rows without an id.
    """
    small_batches(spark)
    return jaccard.one_of_each(docs, size=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents into which a benchmark passage leaked.

    Null and empty texts stay, and so does everything if there are no passages. Rows that repeat stay or go
    together, those without an id included; null and empty passages leak into nothing.
    """
    small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_leaks(docs, benchmark)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and secrets by their kind in brackets; n_chars follows the text.

    All rows stay. Null and empty texts stay as they are, equal texts stay equal.
    """
    small_batches(spark)
    clean = pii.redact(docs, model=pii.fit(docs), secrets=True)
    return clean.selectExpr(
        *[
            "cast(char_length(text) as bigint) as n_chars" if name == "n_chars" else f"`{name}`"
            for name in clean.columns
        ]
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as piece ids: doc_id, lang, source, ids. All rows stay; a null text has null ids, an
    empty one none. Decoding gives back every text exactly."""
    small_batches(spark)
    ids = pieces.encode(docs, tokenizer("piece_bpe_32k.model"))
    return ids.select("doc_id", "lang", "source", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("encode", encode),
]

# Profiles, latent vectors and Viterbi paths have no SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
