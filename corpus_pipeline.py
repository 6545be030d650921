"""The corpus pipeline: language id, line dedup, near dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm import decontam, langid, linededup, minhash, packing
from dimweave.llm.common import scratch, table
from dimweave.llm.queries import vocabulary

#: A document goes if no language is recognised, or none with this probability.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled documents of the input teach."""
    found = langid.predict(docs, langid.train(docs), docs.columns, ("found__", "score__"))
    return found.where((F.col("found__") != langid.UNKNOWN) & (F.col("score__") >= LEAST_SCORE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier; emptied documents go."""
    return linededup.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies
    (similarity 0.8 or more over shingles of five words)."""
    return minhash.keep_one(docs, minhash.NEAR_80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark questions, copied or reworded."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences (the last stage)."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language id", language_id),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: The fitted language model and the tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; returns the last one's rows."""
    docs, base = table(spark, sf_dir, "documents"), f"{scratch(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
