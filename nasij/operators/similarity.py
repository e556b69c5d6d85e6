"""Similarity: hashed n-gram vectors, window scores, percentiles, sequences."""

from __future__ import annotations

import difflib
import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nasij.functions import text as T
from nasij.lineage import cut

DIMENSIONS, GRAM = 512, 4
#: Rarest tokens by which a record's first partners are found, two by each.
FIRST_TOKENS = 8


def grams(c: Column, n: int = GRAM) -> Column:
    cut = lambda s: F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - n + 1, F.lit(1))), lambda i: F.substring(s, i, F.lit(n)))
    return T.let(T.canonical(F.coalesce(c, F.lit(""))), cut)


def hashed(df: DataFrame, key: str, text: str, dims: int = DIMENSIONS) -> DataFrame:
    """key, dim, w: unit vectors of hashed character 4-grams, sparse."""
    bucket = lambda g: F.conv(F.substring(F.md5(g), 1, 8), 16, 10).cast("long") % dims
    counts = df.select(key, F.explode(F.transform(grams(F.col(text)), bucket)).alias("dim")).groupBy(key, "dim").agg(F.count(F.lit(1)).cast("double").alias("n"))
    norm = counts.groupBy(key).agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    return counts.join(norm, key).select(key, "dim", (F.col("n") / F.col("norm")).alias("w"))


def cosine_to_set(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Cosines of sparse vectors with a bounded set of others (a baseline)."""
    return df.join(other.select(F.col(other_key).alias("other"), "dim", F.col("w").alias("v")), "dim").groupBy(key, "other").agg(F.sum(F.col("w") * F.col("v")).alias("cosine"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def window_scores(df: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """max, mean, min and place of the best window (the first of equals)."""
    return df.groupBy(key).agg(F.max(value).alias("high"), F.avg(value).alias("mean"), F.min(value).alias("low"), F.min_by(pos, F.struct((-F.col(value)).alias("a"), F.col(pos).alias("b"))).alias("best"))


def percentile_in(df: DataFrame, key: str, own: str, baseline: DataFrame, base_key: str, value: str) -> DataFrame:
    """100 * share of the baseline's values below one's own (strictly), the
    row itself left out. The baseline is a bounded sample."""
    met = df.crossJoin(F.broadcast(baseline.select(F.col(base_key).alias("_b"), F.col(value).alias("_v")))).where(F.col(key) != F.col("_b"))
    return met.groupBy(key).agg((100.0 * F.count_if(F.col("_v") < F.col(own)) / F.count(F.lit(1))).alias("percentile"))


def baseline_ids(ids: list, n: int = 120, seed: int = 0) -> list:
    return random.Random(seed).sample(sorted(ids), min(n, len(ids)))


def mean_cosine(df: DataFrame, vector: str) -> DataFrame:
    """Mean cosine of all pairs in one pass: from the sum of the unit vectors,
    mean = (|sum|^2 - n) / (n (n - 1)); no pair is formed."""
    norm = F.sqrt(dot(F.col(vector), F.col(vector)))
    rows = df.where(F.col(vector).isNotNull() & (norm > 0)).select(norm.alias("norm"), F.posexplode(vector).alias("i", "x"))
    sums = rows.groupBy("i").agg(F.sum(F.col("x").cast("double") / F.col("norm")).alias("s"), F.count(F.lit(1)).alias("n"))
    n = F.max("n")
    return sums.agg(n.alias("n"), F.when(n > 1, (F.sum(F.col("s") * F.col("s")) - n) / (n * (n - 1))).alias("mean_cosine"))


def embedded(df: DataFrame, key: str, text: str, encode) -> DataFrame:
    """key, vector by an encoder that the caller gives: a function from a list
    of texts to vectors. Without one there is no score, never a made-up one."""

    def run(batches):
        for rows in batches:
            yield pd.DataFrame({key: rows[key], "vector": [list(map(float, v)) for v in encode(rows[text].tolist())]})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInPandas(run, f"`{key}` {kind}, vector array<double>")


def token_windows(text: Column, tokenizer_file: str, most: int) -> Column:
    """Windows by a tokenizer's own ids, half overlapping, two ids spared (an
    Arrow UDF; the file is a public tokenizer's, its path a parameter)."""
    budget = max(16, most - 2)

    def run(s: pd.Series) -> pd.Series:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer_file)

        def one(x: str | None) -> list[str]:
            ids = t.encode(x or "", add_special_tokens=False).ids
            if len(ids) <= budget:
                return [x or ""]
            starts = range(0, len(ids) - budget + budget // 2, budget // 2)
            return [t.decode(ids[i : i + budget], skip_special_tokens=True) for i in starts]

        return s.map(one)

    return F.pandas_udf(run, "array<string>")(text)


def sequence_ratio(a: Column, b: Column) -> Column:
    """Token-sequence ratio, argument order kept (an Arrow UDF)."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([difflib.SequenceMatcher(None, p.split(), q.split()).ratio() if p is not None and q is not None else None for p, q in zip(x, y, strict=True)], dtype="float64")

    return F.pandas_udf(run, "double")(a, b)


def nearest_ratio(df: DataFrame, key: str, text: str) -> DataFrame:
    """The largest ratio of each record with another; 0 without a shared token.

    A ratio is twice the matched tokens over both counts. A first look at
    partners by a record's rarest tokens gives a ratio r that a better partner
    has to reach, so it shares at least r n / (2 - r) of the record's n tokens,
    and one of them is among the record's rarest n - r n / (2 - r) + 1: only
    these are joined, and partners of an unfit length are left out.
    """
    base = cut(df.select(F.col(key).alias("k"), F.col(text).alias("t"), T.words(F.col(text)).alias("w")))
    held = base.select("k", F.size("w").alias("n"), F.explode("w").alias("x"))
    often = held.groupBy("x").agg(F.count(F.lit(1)).alias("c"), F.min("k").alias("lo"), F.max("k").alias("hi")).where("lo <> hi")
    # one row for a record again: no more than its text holds
    ordered = cut(held.join(often, "x").groupBy("k", "n").agg(F.sort_array(F.collect_list(F.struct("c", "x", "lo", "hi"))).alias("s")))

    def best(pairs: DataFrame) -> DataFrame:
        both = pairs.join(base.select("k", "t"), "k").join(base.select(F.col("k").alias("o"), F.col("t").alias("u")), "o")
        return both.select("k", sequence_ratio(F.col("t"), F.col("u")).alias("r")).groupBy("k").agg(F.max("r").alias("r"))

    near = ordered.select("k", F.explode(F.slice(F.array_distinct("s"), 1, FIRST_TOKENS)).alias("e")).select("k", F.explode(F.array("e.lo", "e.hi")).alias("o"))
    floor = cut(best(near.where("k <> o").distinct()))
    least = F.greatest(F.lit(1), F.ceil(F.col("r") * F.col("n") / (2 - F.col("r")) - 1e-9).cast("int"))
    heads = ordered.join(floor, "k", "left").withColumn("r", F.coalesce("r", F.lit(0.0))).withColumn("length", F.size("s") - least + 1).where("length > 0")
    heads = heads.select("k", "n", "r", F.explode(F.array_distinct(F.transform(F.slice("s", F.lit(1), F.col("length")), lambda e: e["x"]))).alias("x"))
    token = base.select(F.col("k").alias("o"), F.size("w").alias("m"), F.explode(F.array_distinct("w")).alias("x"))
    fits = (F.col("k") != F.col("o")) & (2 * F.least("n", "m") >= F.col("r") * (F.col("n") + F.col("m")) - 1e-9)
    more = best(heads.join(token, "x").where(fits).select("k", "o").distinct())
    every = floor.unionByName(more).groupBy("k").agg(F.max("r").alias("r"))
    return base.join(every, "k", "left").select(F.col("k").alias(key), F.coalesce("r", F.lit(0.0)).alias("ratio"))
