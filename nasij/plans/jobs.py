"""Corpus build, record verification and pair triage as lazy plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nasij.functions import text as T
from nasij.operators import chunk, decisions, dedup, facts, formats, guards, similarity, stats


def build_corpus(docs: DataFrame, corpus: str | None = None, limit: int = chunk.TARGET_MAX) -> DataFrame:
    """Chunks of the cleaned documents that are not exact copies.

    ``docs``: doc_id, corpus, title, source_format, raw_text and what else is
    to go along.
    """
    docs = guards.scope(docs, "corpus", corpus)
    form = F.col("source_format")
    cleaned = chunk.clean(docs, "raw_text", form, F.coalesce("title", F.lit("")))
    kept = dedup.keep_first(cleaned.withColumn("_t", F.array_join("paragraphs_original", "\n\n")), "doc_id", "_t").drop("_t")
    return chunk.chunks(kept, "doc_id", F.col("paragraphs_original"), form, F.col("unit_type"), limit, boundary=chunk.POEM_BOUNDARY)


def chunk_profile(docs: DataFrame, key: str, text: str, group: str, limit: int = chunk.TARGET_MAX) -> DataFrame:
    """Chunks, tokens, median and in-band share of each group and in total."""
    kept = dedup.keep_first(docs, key, text)
    made = chunk.chunks(kept.select(key, text, group), key, chunk.line_units(F.col(text)), F.lit("prose"), F.lit("line"), limit)
    rows = made.rollup(group).agg(
        F.grouping(group).cast("int").alias("is_total"), F.countDistinct(key).alias("documents"), F.count(F.lit(1)).alias("chunks"), F.sum("token_count").alias("tokens"),
        F.percentile("token_count", 0.5).alias("median"), (F.count_if(F.col("token_count").between(*stats.IN_BAND)) / F.count(F.lit(1))).alias("in_band"),
    )
    return rows


def adapt_records(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Locked flat records, and problems, from samples."""
    parts = T.split_scaffold(F.col("answer"))
    flat = raw.select(
        "row_idx", F.col("question").alias("instruction"), parts["answer"].alias("response"), F.col("chunk_id").alias("source_chunk_id"), F.col("dialect").alias("source_region"),
        F.lit(None).cast("string").alias("format_type"), F.lit(None).cast("string").alias("model_version"), parts["thinking"].isNotNull().alias("had_scaffold"),
    )
    bad = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(f"missing_{c}")) for c in ("instruction", "response", "source_chunk_id")]))
    return flat, flat.select("row_idx", F.explode(bad).alias("problem"))


def join_parents(pairs: DataFrame, samples: DataFrame) -> DataFrame:
    """Pairs with the chunk and region of their sample; problem where lost."""
    parent = samples.select(F.col("sample_id").alias("source_sample_id"), "chunk_id", F.col("dialect").alias("source_region"), F.lit(True).alias("_p"))
    met = pairs.join(parent, "source_sample_id", "left")
    return met.withColumn("problem", F.when(F.col("_p").isNull(), "unknown_parent")).drop("_p")


# The fields that records and pairs must have.
SFT_FIELDS = ("instruction", "response", "source_chunk_id", "source_region", "format_type", "model_version")
DPO_FIELDS = ("prompt", "chosen", "rejected", "source_chunk_id", "source_region", "rejection_type", "model_version")


def lacking(df: DataFrame, fields: tuple) -> Column:
    """Names of the fields that a row lacks; a column that the table lacks is
    not asked for, as then no row can have it."""
    return F.array_compact(F.array(*[F.when(F.col(f).isNull(), f) for f in fields if f in df.columns])).cast("array<string>")


def verify_sft(records: DataFrame, chunks: DataFrame, corpus: str, percentiles: DataFrame | None = None) -> DataFrame:
    """Verdict, leaning and acceptance of each record (row_idx), with the fields
    it lacks (an invalid record then) and warnings."""
    lost = lacking(records, SFT_FIELDS)
    fact = facts.check_records(records, chunks, corpus)
    rows = records.withColumn("missing", lost).join(fact, "row_idx", "left")
    rows = rows.join(percentiles, "row_idx", "left") if percentiles is not None else rows.withColumn("percentile", F.lit(None).cast("double"))
    whole = F.size("missing") == 0
    got = decisions.combine_sft(F.when(whole, F.col("fact_verdict")).otherwise("UNKNOWN_CHUNK"), decisions.band(F.col("percentile")), F.col("percentile").isNotNull(), F.col("contradicted_types"))
    form = formats.conformance(F.col("response"), F.col("format_type"))
    ok = F.when(whole & (form == "match"), True).when(whole & (form == "mismatch"), False)
    rows = rows.withColumn("_v", got).withColumn("verdict", F.col("_v.verdict")).withColumn("leaning", F.col("_v.leaning")).withColumn("format_conforms", ok).drop("_v")
    return with_region_warning(rows, chunks).withColumn("decision", decisions.acceptance(F.col("verdict"), F.col("format_conforms"), F.col("format_type")))


def with_region_warning(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """Adds ``warnings``: region_mismatch where the declared region is not that
    of the chunk; a chunk that is not there is no mismatch."""
    if "source_region" not in rows.columns:
        return rows.withColumn("warnings", F.array().cast("array<string>"))
    there = chunks.select(F.col("chunk_id").alias("source_chunk_id"), F.col("region").alias("_region"), F.lit(True).alias("_there"))
    apart = F.col("_there") & ~F.col("source_region").eqNullSafe(F.col("_region"))
    return rows.join(there, "source_chunk_id", "left").withColumn("warnings", F.array_compact(F.array(F.when(apart, "region_mismatch")))).drop("_region", "_there")


def triage_dpo(pairs: DataFrame, chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Triage of pairs; ``chosen`` and ``rejected`` hold row_idx, verdict,
    fact_verdict and percentile of the two sides.

    A pair that lacks a field or a verified side is suspicious, and says what it
    lacks; a kind of rejection that is not known is a warning, and nothing is
    held to be seen of it.
    """
    side = lambda d, n: d.select("row_idx", F.lit(True).alias(f"_{n}"), *[F.col(c).alias(f"{c}_{n}") for c in ("verdict", "fact_verdict", "percentile")])
    rows = pairs.withColumn("_lost", lacking(pairs, DPO_FIELDS)).join(side(chosen, "a"), "row_idx", "left").join(side(rejected, "b"), "row_idx", "left")
    rows = rows.withColumn("missing", F.concat("_lost", F.array_compact(F.array(F.when(F.col("_a").isNull(), "verified_chosen"), F.when(F.col("_b").isNull(), "verified_rejected"))))).drop("_a", "_b", "_lost")
    grounded = lambda n: F.col(f"fact_verdict_{n}").isin("SUPPORTED", "PARTIAL")
    kind = F.col("rejection_type")
    detect = F.coalesce(decisions.lookup(decisions.DETECTABLE, F.coalesce(kind, F.lit(""))), F.lit("none"))
    rows = rows.withColumn("length_signal", formats.length_signal(F.col("chosen"), F.col("rejected"))).withColumn("format_relation", formats.compare(F.col("chosen"), F.col("rejected"), F.col("format_type")))
    rows = rows.withColumn("lexical", similarity.sequence_ratio(F.coalesce("chosen", F.lit("")), F.coalesce("rejected", F.lit(""))))
    rows = rows.withColumn("direction", decisions.direction(F.col("verdict_a"), F.col("verdict_b"), F.col("percentile_a"), F.col("percentile_b"), grounded("a"), grounded("b")))
    seen = decisions.corroborates(kind, F.col("fact_verdict_a"), F.col("fact_verdict_b"), F.col("percentile_a"), F.col("percentile_b"), F.col("length_signal"), F.col("format_relation"))
    rows = rows.withColumn("corroborated", F.when(detect != "none", seen)).withColumn("detectability", detect)
    rows = rows.withColumn("warnings", F.array_compact(F.array(F.when(decisions.lookup(decisions.DETECTABLE, F.coalesce(kind, F.lit(""))).isNull(), "unknown_rejection_type"))))
    win = (kind == "wrong_formatting") & (F.col("format_relation") == "chosen_better")
    told = decisions.triage(F.col("direction"), F.col("corroborated"), formats.length_consistency(kind, F.col("length_signal")), detect, F.coalesce(win, F.lit(False)), F.coalesce(decisions.degenerate(F.col("lexical"), kind), F.lit(False)))
    return rows.withColumn("triage", F.when(F.size("missing") > 0, "FLAG_SUSPICIOUS").otherwise(told))


def plan_pairs(samples: DataFrame, target: int, kinds: list[str]) -> DataFrame:
    """Which sample gets which kinds of rejection: as many as the target asks
    for, the kinds in their order, up to the target."""
    from pyspark.sql import Window

    # each sample gives a pair at least, so the first of them reach the target,
    # and the window below has no more rows than the plan
    each = samples.agg(F.least(F.ceil(F.lit(target) / F.greatest(F.count(F.lit(1)), F.lit(1))).cast("int"), F.lit(len(kinds))).alias("_each"))
    first = samples.select("sample_id").orderBy("sample_id").limit(target)
    rows = first.crossJoin(F.broadcast(each)).select("sample_id", F.posexplode(F.slice(F.array(*map(F.lit, kinds)), F.lit(1), F.col("_each"))).alias("kind_no", "rejection_type"))  # each: one row
    rows = rows.orderBy("sample_id", "kind_no").limit(target)
    return rows.withColumn("place", F.row_number().over(Window.orderBy("sample_id", "kind_no"))).withColumn("pair_id", F.format_string("%s_dpo_%02d", "sample_id", F.col("kind_no") + 1))
