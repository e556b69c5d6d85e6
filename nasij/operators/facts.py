"""Facts in reference chunks and the checking of responses against them.

Extraction needs the offset of every match, which Spark's expressions do not
give, so one Arrow UDF for each profile returns array<struct<type, value,
position_in_text>>; ``substring(text, position + 1, length(value))`` equals the
value. Verdicts are expressions over exploded assertions.
"""

from __future__ import annotations

import bisect
import difflib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nasij.functions import text as T
from nasij.operators.decisions import NUMERIC, SEVERITY, lookup

# Patterns, word lists and bounds that the facts are told by.
ARW = "[ء-ي]"
HEADWORD = r"(?m)^\(\s*([^()\n]{1,40}?)\s*\)\s*:"
PAGE = r"ص\s*\.?\s*(\d{1,4})(?!\d)"
HIJRI = r"(\d{3,4})\s*(?:هجرية|هجري|هـ|ه\b)"
YEAR = r"(?<!\d)(\d{3,4})(?!\d)\s*(م\b|ميلادي)?"
UNMARKED = (1300, 1500)
ROOT = rf"(?m)^(?!ال)({ARW}{{2,6}})\s*:(?!\s*$)"
FIGURATIVE = r"ومن\s+المجاز"
ENTRY = r"(?m)^[ \t]*([^:\n]{1,40}?)[ \t]*:[ \t]*([^\n]*)"
GLOSS_LEAST = 3
KUNYA = ("ذو", "ذي", "ذا", "أبو", "أبي", "أبا", "ابن", "بن", "أم", "امرؤ", "امرئ")
NASAB = ("بن", "ابن")
VERBS = r"\b(?:وأنشد|أنشد|وقال|قالت|قال|يقول)"
_K = "(?:" + "|".join(KUNYA) + ")"
NAME = rf"({_K}\s+(?:{_K}\s+)?{ARW}{{2,}}|(?:ال)?{ARW}{{3,}}(?:\s+(?:بن|ابن)\s+{ARW}{{2,}}){{0,2}}(?:\s+(?:ال){ARW}{{3,}}){{0,1}})"
CITATION = VERBS + r"\s+" + NAME
STOPWORDS = {
    "له", "لها", "لهم", "لهن", "لك", "لكم", "لي", "لنا", "عنه", "عنها", "فيه", "فيها", "به", "بها", "منه", "منها", "هذا", "هذه", "ذلك", "تلك", "هو", "هي", "هم", "أنا", "أنت", "ما", "إن", "أن", "قد", "كذا", "كما", "إذا", "حين", "عند", "كان", "كانت", "لما", "لقد", "ثم", "بعض", "البعض", "أيضا", "أيضاً", "أي", "لم", "لا", "نعم",
}
CROSS = rf"(?:وفي|في)\s+((?:حاضرة|بادية|لهجة|لهجات|أهل)(?:\s+(?:أهل|بني))?\s+{ARW}{{2,}}|مصر|الشام|العراق|اليمن|الحجاز|نجد|الكويت|البحرين)"
FOOT_MARK, FOOT_LINE = r"\(\s*\.\s*\)\s*\d+", rf"(?m)^\d{{1,2}}(?={ARW})"
QUOTED = r"['‘’\"“”«»]([^'‘’\"“”«»\n]{2,60}?)['‘’\"“”«»]"
MARKED = r"[\(\"«“]([^\)\"»”\n]{1,30})[\)\"»”]"
REGIONS = {
    "نجد": "najdi", "النجديه": "najdi", "نجديه": "najdi", "القصيم": "najdi", "الحجاز": "western", "الحجازيه": "western", "حجازيه": "western", "جده": "western", "المدينه": "western", "ينبع": "western",
    "الشمال": "northern", "الشماليه": "northern", "الجوف": "northern", "الجنوب": "southern", "الجنوبيه": "southern", "عسير": "southern", "الشرقيه": "eastern", "القطيف": "eastern", "الاحساء": "eastern",
}
NEAR_MISS = 0.72
WINDOW_BACK, WINDOW_AHEAD = 40, 200
CONFIDENT = 3

FACT = "array<struct<type:string,value:string,position_in_text:int>>"


def citation_name(raw: str) -> str | None:
    """A name that a saying is ascribed to, or None for narration."""
    name = raw.strip()
    parts = name.split()
    narrated = not parts or parts[0] in STOPWORDS or name in STOPWORDS or name in KUNYA
    repeated = len(parts) > 1 and parts[0] == parts[1]
    lone = len(parts) == 1 and not name.startswith("ال")
    return None if narrated or repeated or lone else name


def year_kind(digits: str, hijri: bool, gregorian: bool) -> str | None:
    n = int(digits)
    if hijri or gregorian:
        return "hijri_year" if hijri else "gregorian_year"
    if n < UNMARKED[0]:
        return None
    return "year_unmarked_era" if n <= UNMARKED[1] else "gregorian_year"


def _found(kind: str, pattern: str, text: str, group: int = 1, value: Callable[[str], str | None] = str.strip) -> Iterator[dict]:
    for m in re.finditer(pattern, text):
        raw = m.group(group)
        kept = value(raw)
        if kept:
            yield {"type": kind, "value": kept, "position_in_text": m.start(group) + len(raw) - len(raw.lstrip())}


def _years(text: str) -> Iterator[dict]:
    pages = [m.span(1) for m in re.finditer(PAGE, text)]
    hijri = {m.start(1) for m in re.finditer(HIJRI, text)}
    for m in re.finditer(YEAR, text):
        at = m.start(1)
        kind = None if any(a <= at < b for a, b in pages) else year_kind(m.group(1), at in hijri, bool(m.group(2)))
        if kind:
            yield {"type": kind, "value": m.group(1), "position_in_text": at}


def dialect_facts(text: str) -> list[dict]:
    return [
        *_found("entry_headword", HEADWORD, text), *_found("citation_authority", CITATION, text, value=citation_name), *_found("page_reference", PAGE, text),
        *_years(text), *_found("cross_dialect_reference", CROSS, text),
    ]


def lexicon_facts(text: str) -> list[dict]:
    roots, figures = [m.start() for m in re.finditer(ROOT, text)], [m.start() for m in re.finditer(FIGURATIVE, text)]
    ends = sorted([*roots, *figures, len(text)])
    senses = [{"type": "figurative_sense", "value": text[a : ends[bisect.bisect_right(ends, a)]].rstrip(), "position_in_text": a} for a in figures]
    return [*_found("entry_root", ROOT, text), *senses, *_found("citation_authority", CITATION, text, value=citation_name)]


def popular_facts(text: str) -> list[dict]:
    arabic = lambda s, least=1: s.strip() if len(s.strip()) >= least and re.search(ARW, s) else None
    out = []
    for m in re.finditer(ENTRY, text):
        if arabic(m.group(1)):
            out.append({"type": "entry_headword", "value": m.group(1).strip(), "position_in_text": m.start(1)})
            if arabic(m.group(2), GLOSS_LEAST):
                out.append({"type": "gloss", "value": m.group(2).strip(), "position_in_text": m.start(2)})
    return [*out, *_found("page_reference", PAGE, text)]


# The corpora's names in the data.
PROFILES: dict[str, Callable[[str], list[dict]]] = {"saudi_dialect": dialect_facts, "classical_lexicon": lexicon_facts, "najdi_popular": popular_facts}


def extracted(text: Column, profile: str) -> Column:
    get = PROFILES[profile]
    return F.pandas_udf(lambda s: s.map(lambda t: get(t) if t else []), FACT)(text)


def apparatus_skipped(text: Column) -> Column:
    return F.regexp_count(text, F.lit("(?U)" + FOOT_MARK)) + F.regexp_count(text, F.lit("(?d)" + FOOT_LINE))


def quoted_items(text: Column) -> Column:
    """Distinct quoted items of at least two Arabic words, in order."""
    found = F.transform(F.regexp_extract_all(text, F.lit(QUOTED), F.lit(1)), T.strip)
    return F.array_distinct(F.filter(found, lambda x: F.size(F.filter(T.words(x), lambda w: w.rlike(ARW))) >= 2))


def fact_rows(df: DataFrame, key: str, facts: str) -> DataFrame:
    return df.select(key, F.explode(facts).alias("f")).select(key, "f.*")


def confident_citations(rows: DataFrame) -> DataFrame:
    """Adds how often a citation occurs and whether it is confident."""
    bare = T.words(T.strip_tashkeel(T.strip_tatweel(F.col("value"))))
    often = F.count(F.lit(1)).over(Window.partitionBy("type", "value"))
    sure = F.element_at(bare, 1).isin(*KUNYA) | F.arrays_overlap(bare, F.array(*map(F.lit, NASAB))) | (F.col("occurrences") >= CONFIDENT)
    return rows.withColumn("occurrences", often).withColumn("confident", F.when(F.col("type") == "citation_authority", sure))


def fact_types(df: DataFrame, region: str, facts: str) -> DataFrame:
    """Facts of each region and type."""
    return df.select(region, F.explode(F.transform(facts, lambda f: f["type"])).alias("type")).groupBy(region, "type").agg(F.count(F.lit(1)).alias("facts"))


def without_facts(df: DataFrame, key: str, region: str, facts: str) -> DataFrame:
    """Chunks that hold no fact."""
    return df.where(F.size(facts) == 0).select(region, key)


def fact_report(df: DataFrame, key: str, region: str, facts: str) -> DataFrame:
    """Chunks, those with facts, coverage in percent and facts of each region;
    ``fact_types`` and ``without_facts`` give the report's other two tables."""
    some = F.count_if(F.size(facts) > 0)
    return df.groupBy(region).agg(F.count(F.lit(1)).alias("chunks"), some.alias("with_facts"), (100.0 * some / F.count(F.lit(1))).alias("coverage"), F.sum(F.size(facts)).alias("facts"))


def _assert(corpus: str):
    lexical = "entry_root" if corpus == "classical_lexicon" else "entry_headword"
    places = r"(?:في|لهجة|لهجات|عند|أهل|من)\s+(?:أهل\s+)?(" + "|".join(sorted(map(re.escape, REGIONS), key=len, reverse=True)) + ")"

    def get(text: str) -> list[dict]:
        word = lambda s: None if re.fullmatch(r"[\d\s.,-]+", s.strip()) or (lexical == "entry_root" and len(s.split()) > 1) else s.strip()
        out = [*_found("page_reference", PAGE, text), *_years(text), *_found("citation_authority", CITATION, text, value=citation_name), *_found(lexical, MARKED, text, value=word)]
        return out + (list(_found("region_claim", places, text)) if corpus == "saudi_dialect" else [])

    return get


def assertions(response: Column, instruction: Column, corpus: str) -> Column:
    """array<struct<type, value, position_in_text>> of checkable specifics."""
    get = _assert(corpus)
    own = F.pandas_udf(lambda s: s.map(lambda t: get(t) if t else []), FACT)(response)
    quoted = F.concat(quoted_items(F.coalesce(response, F.lit(""))), quoted_items(F.coalesce(instruction, F.lit(""))))
    return F.concat(own, F.transform(quoted, lambda q: F.struct(F.lit("quoted_lexical_item").alias("type"), q.alias("value"), F.lit(-1).alias("position_in_text"))))


def _padded(c: Column) -> Column:
    return F.concat(F.lit(" "), c, F.lit(" "))


def relation(key: Column, known: Column) -> Column:
    """How a stated value relates to a known one: equal, whole-token extension
    or abbreviation, or corruption (one begins with the other inside a token)."""
    return (
        F.when(key == known, "equal").when(_padded(key).contains(_padded(known)), "extension").when(_padded(known).contains(_padded(key)), "abbreviation")
        .when((key != "") & (known != "") & (key.startswith(known) | known.startswith(key)), "corruption")
    )


def content_words(c: Column) -> Column:
    return F.filter(T.words(T.fact_key(F.regexp_replace(c, r"(?U)[^\w\s]", " "))), lambda w: F.length(w) >= 4)


def root_hit(root: Column, token: Column) -> Column:
    """A root of two to four letters that occurs in order within a token."""
    pattern = F.array_join(F.filter(F.split(root, ""), lambda x: x != ""), ".*")
    return F.length(root).between(2, 4) & F.regexp_like(token, pattern)


def near_ratio(value: Column, known: Column) -> Column:
    """The best character ratio of a value with known ones (an Arrow UDF)."""

    def run(v: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([max((difflib.SequenceMatcher(None, a, b).ratio() for b in bs), default=0.0) for a, bs in zip(v, k, strict=True)], dtype="float64")

    return F.pandas_udf(run, "double")(value, known)


def checked(rows: DataFrame, facts: str = "extracted_facts", region: str = "region", chunk: str = "chunk_text", response: str = "response") -> DataFrame:
    """A verdict for each assertion (columns type, value) against the facts of
    its chunk. The order of the tests is the order of precedence."""
    kind, key = F.col("type"), T.fact_key(F.col("value"))
    same = F.filter(facts, lambda f: f["type"] == F.col("type"))
    rows = rows.withColumn("_key", key).withColumn("_known", F.transform(same, lambda f: T.fact_key(f["value"]))).withColumn("_chunk", T.fact_key(F.coalesce(F.col(chunk), F.lit(""))))
    rows = rows.withColumn("_rel", F.transform("_known", lambda k: relation(F.col("_key"), k)))
    cross = F.exists(F.filter(facts, lambda f: f["type"] == "cross_dialect_reference"), lambda f: T.fact_key(f["value"]).contains(F.col("_key")))
    place = F.when((lookup(REGIONS, F.col("_key")) == F.col(region)) | cross, "SUPPORTED").otherwise("CONTRADICTED")
    at = F.expr("locate(_key, _chunk)")
    around = F.substring(F.col("_chunk"), F.greatest(at - WINDOW_BACK, F.lit(1)), WINDOW_BACK + F.length("_key") + WINDOW_AHEAD)
    quoted = F.when(F.col("_chunk") == "", "PARTIAL").when(at == 0, "UNSUPPORTED").when(F.col(response).isNull() | F.arrays_overlap(content_words(F.col(response)), content_words(around)), "PARTIAL").otherwise("UNSUPPORTED")
    has = lambda r: F.array_contains("_rel", r)
    added = F.exists("_known", lambda k: _padded(F.col("_key")).contains(_padded(k)) & (F.size(F.array_except(F.array_except(F.split("_key", " "), F.split(k, " ")), F.split("_chunk", " "))) > 0))
    rooted = (kind == "entry_root") & F.exists("_known", lambda k: root_hit(k, F.col("_key")))
    verdict = (
        F.when(kind == "region_claim", place).when(has("equal"), "SUPPORTED").when(kind == "quoted_lexical_item", quoted).when(rooted, "PARTIAL").when(has("corruption"), "CONTRADICTED")
        .when(has("extension"), F.when(added, "CONTRADICTED").otherwise("PARTIAL")).when(has("abbreviation"), "PARTIAL")
        .when(kind.isin(*NUMERIC), F.when(F.size("_known") > 0, "CONTRADICTED").otherwise("UNSUPPORTED")).when(F.col("_near") >= NEAR_MISS, "CONTRADICTED").otherwise("UNSUPPORTED")
    )
    return rows.withColumn("_near", near_ratio(F.col("_key"), F.col("_known"))).withColumn("verdict", verdict).drop("_key", "_known", "_chunk", "_rel", "_near")


def worst(rows: DataFrame, key: str) -> DataFrame:
    """The worst verdict of each record and the contradicted types."""
    rank = lookup(SEVERITY, F.col("verdict"))
    return rows.groupBy(key).agg(F.max_by("verdict", rank).alias("fact_verdict"), F.collect_set(F.when(F.col("verdict") == "CONTRADICTED", F.col("type"))).alias("contradicted_types"))


def check_records(records: DataFrame, chunks: DataFrame, corpus: str, key: str = "row_idx") -> DataFrame:
    """fact_verdict of each record: records hold response, instruction and
    source_chunk_id, chunks hold chunk_id, region, chunk_text, extracted_facts."""
    met = records.join(chunks.withColumnRenamed("chunk_id", "source_chunk_id").withColumn("_there", F.lit(True)), "source_chunk_id", "left")
    said = met.withColumn("_a", assertions(F.col("response"), F.col("instruction"), corpus))
    rows = said.where("_there").select(key, "response", "region", "chunk_text", "extracted_facts", F.explode("_a").alias("a")).select("*", "a.type", "a.value")
    found = worst(checked(rows), key)
    out = met.select(key, "_there").join(found, key, "left")
    return out.select(key, F.when(F.col("_there").isNull(), "UNKNOWN_CHUNK").otherwise(F.coalesce("fact_verdict", F.lit("NO_CHECKABLE_CLAIMS"))).alias("fact_verdict"), F.coalesce("contradicted_types", F.array().cast("array<string>")).alias("contradicted_types"))
