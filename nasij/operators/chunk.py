"""Segmentation of documents into units and packing of units into chunks.

A unit (paragraph, entry, stanza, line) is never split. Packing is a fold along
one document's unit sizes; only these numbers go to an Arrow UDF, which is
linear in the number of units.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nasij.functions import text as T

TARGET_MIN, TARGET_MAX = 200, 800
# Patterns that the formats are told by.
HEADWORD = r"^[ \t]*[()][^)\n]{1,45}\)[ \t]*:"
SECTION = r"^[ \t]*(?:لهج(?:ة|ات?)[ \t]*\([^)\n]{1,80}\)|\([ \t]*(?:الباب|لهجات|لهجة|بعض|الصفات|الألفاظ|الالفاظ)[^)\n]{0,80}\))[ \t]*(?:\([ \t]*\)[ \t]*[0-9٠-٩]+)?[ \t]*$"
LIST_MARKER = r"^\s*(?:[-•*]\s|\(?[٠-٩0-9]+\)|[٠-٩0-9]+[.)]\s)"
FOOTNOTE = r"^\s*\^\("
POEM_BOUNDARY = r"^\s*(?:[*\-=~_]{3,}|#+\s|\[[^\]]+\])\s*$"
SENTENCE_ENDS = ".؟!،:؛"
ROLES = {"تأليف": "author_stated", "ترجمة": "translator", "مراجعة": "reviewer", "تحرير": "editor", "إعداد": "compiler", "تقديم": "introduction_by", "جمع": "compiler", "شرح": "annotator"}
PLACEHOLDER = r"(?i)^\s*\[\s*(figure|image|figcaption)?\s*\]\s*$"
HEADING_WORDS, SECTION_WORDS, HEADWORDS = 8, 12, 5
HEADER_PARAGRAPHS, SUBTITLE_CHARS = 12, 120


def _parts(c: Column, by: str) -> Column:
    return F.filter(F.transform(F.split(c, by), T.strip), lambda x: x != "")


def prose_units(c: Column) -> Column:
    return _parts(c, "\n\n")


def line_units(c: Column) -> Column:
    return _parts(c, "\n")


def verse_units(c: Column) -> Column:
    """Stanzas if blank lines part any, else lines."""
    return F.when(F.size(prose_units(c)) > 1, prose_units(c)).otherwise(line_units(c))


def _marked(c: Column) -> Column:
    """A sign before each line that opens an entry or a section."""
    lines = F.split(c, "\n")
    opens = lambda x: x.rlike(HEADWORD) | (x.rlike(SECTION) & (T.token_count(x) <= SECTION_WORDS))
    return F.array_join(F.transform(lines, lambda x: F.when(opens(x), F.concat(F.lit("\u0001"), x)).otherwise(x)), "\n")


def dictionary_units(c: Column) -> Column:
    """Entries from headword to headword if there are enough, whole; text that
    belongs to no entry by blank lines. Else blocks, else lines."""
    blocks = F.filter(F.split(_marked(c), "\u0001"), lambda x: T.strip(x) != "")
    entries = F.flatten(F.transform(blocks, lambda x: F.when(x.rlike(HEADWORD), F.array(T.strip(x))).otherwise(prose_units(x))))
    many = F.regexp_count(c, F.lit("(?md)" + HEADWORD)) >= HEADWORDS
    return F.when(many, entries).when(F.size(prose_units(c)) > 1, prose_units(c)).otherwise(line_units(c))


def segment(c: Column, form: Column) -> Column:
    return F.when(form == "dictionary", dictionary_units(c)).when(form == "verse", verse_units(c)).otherwise(prose_units(c))


def unit_type(c: Column, form: Column) -> Column:
    many = F.regexp_count(c, F.lit("(?md)" + HEADWORD)) >= HEADWORDS
    blocks = F.size(prose_units(c)) > 1
    return (
        F.when(form == "dictionary", F.when(many, "entry_headword").when(blocks, "entry_block").otherwise("entry_line"))
        .when(form == "verse", F.when(blocks, "stanza").otherwise("verse_line"))
        .otherwise("paragraph")
    )


def drop_placeholders(units: Column) -> Column:
    return F.filter(units, lambda x: ~x.rlike(PLACEHOLDER))


def placeholders(units: Column) -> Column:
    """array<struct<body_index, text>> of the units that are dropped."""
    return F.filter(F.transform(units, lambda x, i: F.struct(i.alias("body_index"), x.alias("text"))), lambda x: x["text"].rlike(PLACEHOLDER))


def header_length(units: Column, title: Column) -> Column:
    """How many leading units are front matter.

    Of the first twelve: role blocks, repeats of the title, and short lines
    before the first role; the first other unit ends it. Without a role only
    leading repeats of the title count.
    """
    first = F.slice(units, 1, HEADER_PARAGRAPHS)
    role = lambda u: T.strip(F.element_at(F.split(u, "\n"), 1)).isin(list(ROLES))
    begin = F.struct(F.lit(0).alias("n"), F.lit(False).alias("role"), F.lit(False).alias("over"))

    def step(s: Column, u: Column) -> Column:
        fits = role(u) | T.title_matches(u, title) | (~s["role"] & (F.length(u) <= SUBTITLE_CHARS))
        goes = ~s["over"] & fits
        return F.struct((s["n"] + goes.cast("int")).alias("n"), (s["role"] | (goes & role(u))).alias("role"), (s["over"] | ~fits).alias("over"))

    whole = F.aggregate(first, begin, step)
    titles = F.aggregate(
        first, F.struct(F.lit(0).alias("n"), F.lit(False).alias("over")),
        lambda s, u: F.struct((s["n"] + (~s["over"] & T.title_matches(u, title)).cast("int")).alias("n"), (s["over"] | ~T.title_matches(u, title)).alias("over")),
    )
    return F.when(whole["role"], whole["n"]).otherwise(titles["n"])


def header_roles(units: Column, n: Column) -> Column:
    """Map from a role's name to the names that follow its marker."""
    found = F.filter(F.slice(units, F.lit(1), n), lambda u: T.strip(F.element_at(F.split(u, "\n"), 1)).isin(list(ROLES)))
    names = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    pairs = F.transform(found, lambda u: F.struct(names[T.strip(F.element_at(F.split(u, "\n"), 1))].alias("k"), F.array_join(F.slice(line_units(u), F.lit(2), F.size(line_units(u))), "، ").alias("v")))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.array_join(F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"]), "؛ "))))


def clean(df: DataFrame, text: str, form: Column, title: Column, raw_chars: Column | None = None) -> DataFrame:
    """paragraphs (folded key), paragraphs_original, header, placeholders, stats
    and flags of each document."""
    ws = T.normalize_whitespace(F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn("_ws", ws).withColumn("_units", segment(F.col("_ws"), form)).withColumn("_h", header_length(F.col("_units"), title))
    df = df.withColumn("header_block", F.array_join(F.slice("_units", F.lit(1), F.col("_h")), "\n\n")).withColumn("header_roles", header_roles(F.col("_units"), F.col("_h")))
    body = F.slice("_units", F.col("_h") + 1, F.size("_units"))
    df = df.withColumn("_body", body).withColumn("removed_placeholders", placeholders(F.col("_body"))).withColumn("paragraphs_original", drop_placeholders(F.col("_body")))
    df = df.withColumn("paragraphs", F.transform("paragraphs_original", lambda u: T.matching_key(u, compose=False)))
    raw = F.length(text) if raw_chars is None else raw_chars
    kept = F.length(F.array_join("paragraphs_original", "\n\n")) + F.length("header_block")
    loss = F.when(raw > 0, 1 - kept / raw).otherwise(0.0)
    flags = F.array_compact(F.array(
        F.when(loss > 0.30, "high_char_loss"), F.when((form == "prose") & (F.col("_h") == 0), "no_header_detected"),
        F.when(F.size("removed_placeholders") > 0, "media_placeholders_removed"), F.when(F.size("paragraphs_original") < 5, "very_few_paragraphs"),
    ))
    return df.withColumn("char_loss_ratio", loss).withColumn("unit_count", F.size("paragraphs_original")).withColumn("unit_type", unit_type(F.col("_ws"), form)).withColumn("review_flags", flags).drop("_ws", "_units", "_h", "_body")


def _numbers(limit: int):
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sizes, breaks in batches:
            out = []
            for row, stops in zip(sizes, breaks, strict=True):
                ids, chunk, held, fresh = [], -1, 0, True
                for n, stop in zip(row, stops, strict=True):
                    alone = n > limit
                    if fresh or alone or stop or held + n > limit:
                        chunk, held = chunk + 1, 0
                    ids.append(chunk)
                    held += n
                    fresh = alone
                out.append(ids)
            yield pd.Series(out)

    return F.pandas_udf(run, "array<int>")


def chunk_numbers(units: Column, limit: int = TARGET_MAX, boundary: str | None = None) -> Column:
    """The chunk of each unit: filled up to the limit, larger units alone."""
    stops = F.transform(units, lambda u: u.rlike(boundary) if boundary else F.lit(False))
    return _numbers(limit)(F.transform(units, T.token_count), stops)


def is_heading(u: Column) -> Column:
    return (T.token_count(u) <= HEADING_WORDS) & ~F.substring(T.strip(u), -1, 1).isin(list(SENTENCE_ENDS))


def classify(units: Column, form: Column) -> Column:
    n = F.size(units)
    share = lambda p: F.size(F.filter(units, lambda u: u.rlike("(?U)" + p))) / n
    return (
        F.when(form == "dictionary", "dictionary_entry").when(form == "verse", "verse").when(n == 0, "empty")
        .when(share(FOOTNOTE) >= 0.5, "footnote_block").when(share(LIST_MARKER) >= 0.5, "list")
        .when(F.size(F.filter(units, lambda u: ~is_heading(u))) <= 1, "prose").otherwise("narrative_paragraph")
    )


def chunks(df: DataFrame, key: str, units: Column, form: Column, unit_kind: Column, limit: int = TARGET_MAX, least: int = TARGET_MIN, boundary: str | None = None) -> DataFrame:
    """One row for each chunk: id, place, tokens, text, format and flags."""
    base = df.withColumn("_u", units).withColumn("_n", chunk_numbers(F.col("_u"), limit, boundary)).withColumn("_form", form).withColumn("_kind", unit_kind)
    # units of a chunk stand together: begin of each chunk, then slices
    def parts(x: Column) -> Column:
        u, n = x["u"], x["n"]
        begin = F.filter(F.sequence(F.lit(1), F.size(n)), lambda i: (i == 1) | (F.element_at(n, i) != F.element_at(n, F.greatest(i - 1, F.lit(1)))))

        def cut(b: Column) -> Column:
            end = lambda k: F.coalesce(F.get(b, k + 1), F.size(u) + 1)
            return F.transform(b, lambda at, k: F.struct(k.alias("chunk_no"), F.slice(u, at, end(k) - at).alias("units"), (at - 1).alias("unit_start")))

        return T.let(begin, cut)

    rows = base.where(F.size("_u") > 0).withColumn("_c", F.explode(T.let(F.struct(F.col("_u").alias("u"), F.col("_n").alias("n")), parts))).select(*df.columns, "_form", "_kind", "_c.*")
    tokens = F.aggregate("units", F.lit(0).cast("long"), lambda a, u: a + T.token_count(u))
    flag = F.when(F.col("token_count") > limit, F.concat(F.lit("oversize_"), F.col("_kind"))).when(F.col("token_count") < least, "below_target_min")
    return (
        rows.withColumn("chunk_id", F.format_string("%s_c%04d", F.col(key).cast("string"), "chunk_no")).withColumn("token_count", tokens)
        .withColumn("unit_count", F.size("units")).withColumn("unit_end", F.col("unit_start") + F.col("unit_count") - 1).withColumn("chunk_text", F.array_join("units", "\n\n"))
        .withColumn("format_type", classify(F.col("units"), F.col("_form"))).withColumn("flag", flag).drop("_form", "_kind", "units")
    )
