"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns rows in the columns of its
input, except for the last, which returns the packed pieces. Further columns,
whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nasij.llm import langid, mixing, neardup, packing, quality
from nasij.llm.common import Written, fresh, ready, release, table, text_bytes


def _where(docs: DataFrame, value, test) -> DataFrame:
    """Rows whose value passes, without a column more."""
    name = fresh(docs, "value")
    return docs.withColumn(name, value).where(test(F.col(name))).drop(name)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without a letter or far from
    every language go.

    A null or empty text has no letter and goes. A null id is judged like any
    other but teaches nothing. Without a training text all documents go. Equal
    texts are judged alike. An empty table stays empty.
    """
    model = langid.fit(docs)
    return _where(docs, langid.judged(docs, model)["rejected"], lambda x: ~x)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold.

    A null text scores as an empty one. A null id is scored like any other but
    teaches nothing. Without labels of both classes all scores are the share of
    good labels. Equal texts are judged alike. An empty table stays empty.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return _where(docs, quality.scorer(model)(text_bytes(F.col("text"))), lambda x: x >= quality.THRESHOLD)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id.

    Rows without an id, or with a repeated one, are compared as well; texts
    without words all stay. An empty table stays empty.
    """
    return neardup.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    A null source is a source; texts without words fill nothing and go. Equal
    rows are drawn one by one. An empty table stays empty.
    """
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [("language", language), ("quality", good), ("neardup", distinct), ("mixing", mix), ("packing", pack)]

#: No stage is expressible in SQL as a whole; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = ready(spark).read.parquet(f"{sf_dir}/documents.parquet"), len(Written.held)
    for name, stage in STAGES[:-1]:
        written = Written(stage(spark, docs, sf_dir), f"stage-{name}")
        # what the stage wrote besides is read no more, nor is its input
        release(written, since=before)
        docs = written.df
    return STAGES[-1][1](spark, docs, sf_dir)
