"""Corpus pipeline: the stages that turn ``documents`` into packed training sequences.

Each stage takes (spark, docs, sf_dir) and judges all rows that the stage before
kept. The first four return rows of ``docs`` with its columns unchanged, the
last one the packed pieces.

Defined cases, in every stage: null text counts as empty (and has no language,
so the first stage rejects it), null and repeated ids are kept as rows of their
own unless their texts are copies, extra columns pass through, and an empty
table gives an empty result. Without any row of known language nothing can be
identified, and the first stage rejects all.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import contentsort, decontam, langid, queries, simhash
from tessera.llm.common import shared_path

#: A document stays if one language holds at least this share of it.
MAIN_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language; those without letters or of no main language go."""
    model = langid.fit(docs.where(~langid.held_out("doc_id")))
    found = langid.predict(docs, model, out=("__lang", "__share", "__mix"))
    return found.where((F.col("__lang") != langid.UNKNOWN) & (F.col("__share") >= MAIN_SHARE)).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest id."""
    return contentsort.keep_one(docs, keep="largest")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, that with the smallest id."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontam.clean(docs, spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet")), width=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, placed in sequences."""
    return queries.packed_documents(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pack", pack)]

#: The stages need a trained model and a tokenizer, which SQL has no form for.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared
    folder as Parquet and read again as the next stage's input."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
