"""Leakage between partitions of a data set, by ids, pairs and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nasij.operators.dedup import fingerprint, near_pairs

CHUNK_ID = r"^(.+)_c(\d{4,})$"


def with_parent(df: DataFrame, chunk: str) -> DataFrame:
    """The document of a chunk id; null if the id cannot be read."""
    return df.withColumn("parent", F.when(F.col(chunk).rlike(CHUNK_ID), F.regexp_extract(chunk, CHUNK_ID, 1)))


def bad_ids(df: DataFrame, chunk: str, manifest: DataFrame | None, doc: str = "doc_id") -> DataFrame:
    """UNPARSEABLE_ID, and UNKNOWN_DOC_ID if there is a manifest."""
    rows = with_parent(df, chunk)
    out = rows.where("parent is null").select(F.lit("UNPARSEABLE_ID").alias("code"), F.col(chunk).alias("what"))
    if manifest is None:
        return out
    known = manifest.select(F.trim(doc).alias("parent")).where("parent <> ''").distinct()
    lost = rows.where("parent is not null").join(known, "parent", "left_anti")
    return out.unionByName(lost.select(F.lit("UNKNOWN_DOC_ID").alias("code"), F.col("parent").alias("what")).distinct())


def crossing(df: DataFrame, key, part: str) -> DataFrame:
    """Values that occur in more than one partition: value, parts, first, last."""
    seen = df.select(key.alias("value"), F.col(part).alias("p")).distinct()
    return seen.groupBy("value").agg(F.count(F.lit(1)).alias("parts"), F.min("p").alias("first_part"), F.max("p").alias("last_part")).where("parts > 1")


def documents_disjoint(df: DataFrame, doc: str, part: str) -> DataFrame:
    return crossing(df, F.col(doc), part)


def text_crossing(df: DataFrame, text: str, part: str) -> DataFrame:
    """Equal texts in several partitions; empty texts are no leak."""
    return crossing(df.where(F.length(F.trim(text)) > 0), fingerprint(F.col(text)), part)


def near_crossing(df: DataFrame, key: str, text: str, part: str, size: int = 5, threshold: float = 0.8, strict: bool = False) -> DataFrame:
    """Near pairs whose partitions differ; pairs of equal sets count as exact
    unless ``strict``."""
    pairs = near_pairs(df, key, text, size, threshold, equal=strict)
    p = df.select(F.col(key).alias("k"), F.col(part).alias("p"))
    met = pairs.join(p.select(F.col("k").alias("doc_a"), F.col("p").alias("part_a")), "doc_a").join(p.select(F.col("k").alias("doc_b"), F.col("p").alias("part_b")), "doc_b")
    met = met.where("part_a <> part_b")
    return met if strict else met.where("jaccard < 1")


def pairs_intact(df: DataFrame, chunk: str, chosen: str, rejected: str, part: str, order: list[str]) -> DataFrame:
    """The rows that break a pair, with ``why`` and ``also_in``.

    A row that has one of its two texts only is half a pair. A whole one whose
    chunk was first seen in another partition is apart from it; first is by
    ``order``, the order in which partitions and their rows are read. Rows
    without either text are no pairs.
    """
    there = lambda c: F.length(F.coalesce(F.col(c), F.lit(""))) > 0
    rows = df.where(F.col(chosen).isNotNull() | F.col(rejected).isNotNull())
    whole = rows.where(there(chosen) & there(rejected))
    half = rows.where(~(there(chosen) & there(rejected))).withColumn("also_in", F.lit(None).cast("string")).withColumn("why", F.lit("half_pair"))
    first = whole.groupBy(chunk).agg(F.min_by(part, F.struct(*order)).alias("also_in"))
    apart = whole.join(first, chunk).where(F.col("also_in") != F.col(part)).select(*rows.columns, "also_in").withColumn("why", F.lit("chunk_in_two_parts"))
    return half.unionByName(apart)


def counts_by_code(df: DataFrame) -> DataFrame:
    return df.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def sampled(df: DataFrame, by: str, order: list, limit: int = 50) -> DataFrame:
    """The first findings of each kind, with the kind's total."""
    from pyspark.sql import Window

    w = Window.partitionBy(by)
    return df.withColumn("total", F.count(F.lit(1)).over(w)).withColumn("place", F.row_number().over(w.orderBy(*order))).where(F.col("place") <= limit)


def verify(df: DataFrame, key: str, chunk: str, text: str, part: str, manifest: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """All findings of a split: code, what. An empty result is a clean split."""
    rows = with_parent(df, chunk)
    found = bad_ids(df, chunk, manifest)
    for code, seen in (("DOCUMENT_IN_TWO_PARTS", crossing(rows.where("parent is not null"), F.col("parent"), part)), ("TEXT_IN_TWO_PARTS", text_crossing(df, text, part))):
        found = found.unionByName(seen.select(F.lit(code).alias("code"), F.col("value").cast("string").alias("what")))
    near = near_crossing(df, key, text, part, strict=strict)
    return found.unionByName(near.select(F.lit("NEAR_TEXT_IN_TWO_PARTS").alias("code"), F.concat_ws(" ", "doc_a", "doc_b").alias("what")))
