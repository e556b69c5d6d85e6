"""Guards of scope and provenance: they raise before a stage begins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fields, formats and blocking flags of the hand-off.
REQUIRED = ("chunk_id", "chunk_text", "format_type", "source", "license")
KNOWN_FORMATS = ("dictionary_entry", "prose", "narrative_paragraph", "verse", "list", "footnote_block")
FATAL_FLAGS = ("damaged_page", "unreadable", "residue_tokens")


def scope(df: DataFrame, column: str = "corpus", wanted: str | None = None) -> DataFrame:
    """Rows of one corpus. Refuses rows without one, and a choice that is
    missing or unknown."""
    name = F.coalesce(F.trim(column), F.lit(""))
    seen = df.agg(F.count_if(name == "").alias("bare"), F.count_if(name == F.lit(wanted)).alias("wanted"), F.min(name).alias("low"), F.max(name).alias("high")).first()
    if seen["bare"]:
        raise ValueError(f"{seen['bare']} rows have no {column}")
    if wanted is None:
        if seen["low"] != seen["high"]:
            raise ValueError(f"several values of {column}, choose one, such as {seen['low']!r} or {seen['high']!r}")
        return df
    if not seen["wanted"]:
        raise ValueError(f"no {column} {wanted!r}; there are {seen['low']!r} to {seen['high']!r}")
    return df.where(F.trim(column) == wanted)


def may_overwrite(spark, path: str, corpus: str) -> None:
    """Refuses to replace a report that another corpus wrote."""
    try:
        held = spark.read.json(path, multiLine=True).select("config.corpus").first()
    except Exception:  # no report, unreadable, or none recorded: it may be written
        return
    if held and held[0] and held[0] != corpus:
        stem = path.removesuffix(".json")
        raise ValueError(f"{path} is of {held[0]!r}; write {stem}_{corpus}.json")


def same_format(df: DataFrame, column: str, form: str) -> None:
    other = df.where(~F.col(column).eqNullSafe(F.lit(form))).limit(1).collect()
    if other:
        raise ValueError(f"{column} is {other[0][column]!r}, not {form!r}")


def handoff_findings(df: DataFrame, key: str, record: str) -> DataFrame:
    """key, code, field: what bars a chunk, a line of JSON, from the next stage.

    Blank lines are no records; null neither.
    """
    json = F.col(record)
    v = F.try_parse_json(json)
    kind = lambda f: F.schema_of_variant(F.try_variant_get(v, f"$.{f}", "variant"))
    text = lambda f: F.try_variant_get(v, f"$.{f}", "string")
    said = lambda f: F.coalesce(kind(f) == "STRING", F.lit(False))
    code = lambda test, name, f: F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(name).alias("code"), F.lit(f).cast("string").alias("field")))
    blank = lambda f: ~text(f).rlike(r"(?U)\S")
    found = []
    for f in REQUIRED:
        found += [code(kind(f).isNull(), "MISSING_FIELD", f), code(kind(f).isNotNull() & (~said(f) | blank(f)), "EMPTY_FIELD", f)]
    found.append(code(said("chunk_id") & text("chunk_id").rlike(r"(?U)\s"), "INVALID_CHUNK_ID", "chunk_id"))
    found.append(code(said("format_type") & ~text("format_type").isin(*KNOWN_FORMATS), "UNKNOWN_FORMAT", "format_type"))
    found.append(code(said("chunk_text") & blank("chunk_text"), "EMPTY_TEXT", "chunk_text"))
    fatal = F.lit(False)
    for f in ("review_flags", "source_doc_flags"):
        listed = F.try_variant_get(v, f"$.{f}", "array<string>")
        none = kind(f).isNull() | (kind(f) == "VOID") | ((kind(f) == "ARRAY<VOID>") & (F.size(listed) == 0))
        good = none | ((kind(f) == "ARRAY<STRING>") & ~F.exists(listed, lambda x: x.isNull()))
        found.append(code(~F.coalesce(good, F.lit(False)), "INVALID_REVIEW_FLAGS", f))
        fatal = fatal | (~none & good & F.arrays_overlap(listed, F.array(*map(F.lit, FATAL_FLAGS))))
    found.append(code(fatal, "FATAL_REVIEW_FLAG", "review_flags"))
    one = lambda name: F.array(F.struct(F.lit(name).alias("code"), F.lit(None).cast("string").alias("field")))
    every = F.when(v.isNull(), one("BAD_JSON")).when(~F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), one("NOT_AN_OBJECT")).otherwise(F.array_compact(F.array(*found)))
    return df.where(json.rlike(r"(?U)\S")).select(key, F.explode(every).alias("x")).select(key, "x.*")
