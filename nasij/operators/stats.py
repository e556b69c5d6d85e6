"""Corpus profile: percentiles, histograms, rollups, diversity, ledgers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nasij.functions import text as T

IN_BAND = (200, 800)


def percentiles(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """n, mean and linearly interpolated p25, p50, p75, p90 (0 if empty)."""
    p = [F.coalesce(F.percentile(value, q), F.lit(0.0)).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75, 0.9)]
    return df.groupBy(*(by or [])).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), *p)


def upper_median(c: str) -> Column:
    """The upper of the two middle values: the lower one of the descending order."""
    return F.expr(f"-percentile_disc(0.5) WITHIN GROUP (ORDER BY -`{c}`)")


def histogram(df: DataFrame, value: str, bins: int = 12) -> DataFrame:
    """bin, lo, hi, n of equal bins, empty ones included; the last is closed."""
    ends = df.agg(F.min(value).cast("double").alias("a"), F.max(value).cast("double").alias("b"))
    step = (F.col("b") - F.col("a")) / bins
    place = F.when(step > 0, F.least(F.floor((F.col(value) - F.col("a")) / step), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    counted = df.select(value).where(F.col(value).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))  # ends: one row
    every = ends.where("a is not null").select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "a", step.alias("s"))
    return every.join(counted, "bin", "left").select("bin", (F.col("a") + F.col("bin") * F.col("s")).alias("lo"), (F.col("a") + (F.col("bin") + 1) * F.col("s")).alias("hi"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def in_band(df: DataFrame, value: str, low: int = IN_BAND[0], high: int = IN_BAND[1], by: list[str] | None = None) -> DataFrame:
    inside = F.count_if(F.col(value).between(low, high))
    return df.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), inside.alias("in_band"), (inside / F.count(F.lit(1))).alias("share"))


def distribution(df: DataFrame, group: str, doc: str, tokens: str) -> DataFrame:
    """Documents, chunks, tokens, share and median of each group and in total."""
    rows = df.rollup(group).agg(F.grouping(group).cast("int").alias("is_total"), F.countDistinct(doc).alias("documents"), F.count(F.lit(1)).alias("chunks"), F.sum(tokens).alias("tokens"), F.percentile(tokens, 0.5).alias("median"))
    total = F.sum(F.when(F.col("is_total") == 1, F.col("chunks"))).over(Window.partitionBy())
    return rows.withColumn("share", F.col("chunks") / total)


def thin_groups(df: DataFrame, group: str, tokens: str, least: int = 3, below: float = 0.5) -> DataFrame:
    """Groups under half the upper median of all groups' tokens, if there are
    at least three: tokens, vs_median, vs_max."""
    sums = df.groupBy(group).agg(F.sum(tokens).alias("tokens"))
    frame = sums.agg(upper_median("tokens").alias("mid"), F.max("tokens").alias("top"), F.count(F.lit(1)).alias("groups"))
    return sums.crossJoin(F.broadcast(frame)).where((F.col("groups") >= least) & (F.col("tokens") < below * F.col("mid"))).select(group, "tokens", (F.col("tokens") / F.col("mid")).alias("vs_median"), (F.col("tokens") / F.col("top")).alias("vs_max"))


def value_counts(df: DataFrame, value: Column) -> DataFrame:
    return df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def top_by(df: DataFrame, order: list, limit: int) -> DataFrame:
    return df.orderBy(*order).limit(limit)


def evenly_spaced(df: DataFrame, group: str, key: str, picks: int = 3) -> DataFrame:
    """Rows at evenly spaced ranks of each group: first, middle, last.

    Ranks are rounded half to even, as the rule is.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(group))
    r = F.row_number().over(Window.partitionBy(group).orderBy(key)) - 1
    at = F.array(*[F.bround(F.lit(i) * (n - 1) / F.lit(max(picks - 1, 1))).cast("int") for i in range(picks)])
    return df.withColumn("rank", r).withColumn("_at", at).where(F.array_contains("_at", F.col("rank"))).drop("_at")


def sole_title(df: DataFrame, title: str, otherwise: str = "Corpus") -> DataFrame:
    return df.agg(F.when(F.countDistinct(title) == 1, F.min(title)).otherwise(otherwise).alias("title"))


def ngrams(c: Column, n: int) -> Column:
    at = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, F.lit(n)), " "))
    return T.let(T.words(c), lambda w: F.when(F.size(w) >= n, at(w)).otherwise(F.array().cast("array<string>")))


def distinct_n(df: DataFrame, text: str, upto: int = 4) -> DataFrame:
    """n, unique, total, ratio of the n-grams for n = 1 to 4."""
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("n"), ngrams(F.col(text), n).alias("g")) for n in range(1, upto + 1)])).alias("x")).select("x.n", F.explode("x.g").alias("g"))
    # one row for each n-gram first: no distinct set in one task
    once = rows.groupBy("n", "g").agg(F.count(F.lit(1)).alias("c"))
    return once.groupBy("n").agg(F.count(F.lit(1)).alias("unique"), F.sum("c").alias("total"), (F.count(F.lit(1)) / F.sum("c")).alias("ratio"))


def template_share(df: DataFrame, text: str, words: int = 3) -> DataFrame:
    """The most common opening (ties: first in order), its count and share."""
    w = T.words(F.col(text))
    once = df.where(F.size(w) > 0).groupBy(F.array_join(F.slice(w, 1, words), " ").alias("opening")).agg(F.count(F.lit(1)).alias("n"))
    return once.agg(F.min_by("opening", F.struct((-F.col("n")).alias("a"), F.col("opening").alias("b"))).alias("opening"), F.max("n").alias("n"), (F.max("n") / F.sum("n")).alias("share"))


def spread(df: DataFrame, value: str, universe: list[str]) -> DataFrame:
    """Entropy over a fixed universe (others count too, so it may pass 1),
    largest share and number of empty buckets."""
    n = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    p = n.withColumn("p", F.col("n") / total)
    bits = (-F.sum(F.col("p") * F.log("p")) / math.log(len(universe))) if len(universe) > 1 else F.lit(0.0)
    return p.agg(F.coalesce(bits, F.lit(0.0)).alias("entropy"), F.coalesce(F.max("p"), F.lit(0.0)).alias("max_share"), (F.lit(len(universe)) - F.count_if(F.col("v").isin(universe))).cast("long").alias("empty_buckets"))


# Bands of the diversity report.
BANDS = {"distinct_2_low": 0.45, "neighbour_high": 0.55, "near_rate_high": 0.25, "template_high": 0.35, "entropy_low": 0.75}


def near_template_rate(df: DataFrame, similarity: str) -> DataFrame:
    """One row: the mean and the largest similarity to the nearest other record,
    and the share of records that have a near twin; 0 without records."""
    c = F.col(similarity)
    return df.agg(*[F.coalesce(x, F.lit(0.0)).alias(n) for x, n in ((F.avg(c), "neighbour_mean"), (F.max(c), "neighbour_max"), (F.avg((c >= BANDS["neighbour_high"]).cast("double")), "near_template_rate"))])


def diversity_flags(distinct2: Column, neighbour: Column, near_rate: Column, template: Column, records: Column, distinct: Column, regions: Column, absent: Column, formats: Column) -> Column:
    """Warnings, in order. ``neighbour`` is the mean similarity to the nearest
    other record, ``near_rate`` the share of records with a near twin,
    ``distinct`` the number of different texts among ``records``, ``regions``
    and ``formats`` the entropies, ``absent`` the number of empty regions."""
    return F.array_compact(F.array(
        F.when(distinct2 < BANDS["distinct_2_low"], "LOW_PHRASING_VARIETY"), F.when(neighbour >= BANDS["neighbour_high"], "TEMPLATED_INSTRUCTIONS"), F.when(near_rate >= BANDS["near_rate_high"], "TEMPLATED_SUBSET"),
        F.when(template >= BANDS["template_high"], "SHARED_OPENING"), F.when(distinct < records, "EXACT_DUPLICATES"), F.when(regions < BANDS["entropy_low"], "REGION_IMBALANCE"), F.when(absent > 0, "REGIONS_ABSENT"),
        F.when(formats < BANDS["entropy_low"], "FORMAT_IMBALANCE"),
    ))


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """The pairs of values that occur."""
    return df.select(a, b).distinct()


def split_feasibility(df: DataFrame, doc: str) -> DataFrame:
    """Parents, records, largest share in percent (one decimal), possible splits."""
    sizes = df.groupBy(doc).agg(F.count(F.lit(1)).alias("n"))
    share = F.round(100.0 * F.max("n") / F.sum("n"), 1)
    return sizes.agg(F.count(F.lit(1)).alias("parents"), F.sum("n").alias("records"), F.max("n").alias("largest"), F.coalesce(share, F.lit(0.0)).alias("largest_share"), (F.count(F.lit(1)) >= 2).alias("two_way"), (F.count(F.lit(1)) >= 3).alias("three_way"))


def metric_summary(df: DataFrame, metrics: list[str]) -> DataFrame:
    """metric, mean, min, max: one pass over all columns."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])).alias("x")).select("x.*")
    return long.groupBy("metric").agg(F.avg("v").alias("mean"), F.min("v").alias("low"), F.max("v").alias("high"))


def by_group_and_all(df: DataFrame, group: str, value: str) -> DataFrame:
    """n, min, p50, max, mean of each group and of ALL."""
    rows = df.rollup(group).agg(F.grouping(group).alias("g"), F.count(value).alias("n"), F.min(value).alias("low"), F.percentile(value, 0.5).alias("p50"), F.max(value).alias("high"), F.avg(value).alias("mean"))
    return rows.select(F.when(F.col("g") == 1, "ALL").otherwise(F.col(group)).alias("grp"), "n", "low", "p50", "high", "mean")


def ledger(df: DataFrame, abstained: Column, tokens_in: Column, tokens_out: Column, latency: Column, price_in: float | None, price_out: float | None, by: list[str]) -> DataFrame:
    """Calls, abstentions, tokens, latency and cost (null without a price)."""
    cost = F.lit(None).cast("double") if price_in is None or price_out is None else (F.sum(tokens_in) * price_in + F.sum(tokens_out) * price_out) / 1e6
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("calls"), F.count_if(abstained).alias("abstentions"), F.sum(tokens_in).alias("tokens_in"), F.sum(tokens_out).alias("tokens_out"), F.avg(latency).alias("latency_mean"), cost.alias("cost"))


def accuracy(df: DataFrame, hit: Column, abstained: Column, by: list[str]) -> DataFrame:
    scored, hits = F.count_if(~abstained), F.count_if(~abstained & hit)
    return df.groupBy(*by).agg(hits.alias("hits"), scored.alias("scored"), F.when(scored > 0, hits / scored).alias("accuracy"))


def overview(chunks: DataFrame, samples: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: counts, samples for each chunk, pairs for each sample."""
    c, s, p = (d.agg(F.count(F.lit(1)).alias(n)) for d, n in ((chunks, "chunks"), (samples, "samples"), (pairs, "pairs")))
    one = c.crossJoin(s).crossJoin(p)  # one row each
    return one.withColumn("expansion", F.when(F.col("chunks") > 0, F.col("samples") / F.col("chunks"))).withColumn("conversion", F.when(F.col("samples") > 0, F.col("pairs") / F.col("samples")))
