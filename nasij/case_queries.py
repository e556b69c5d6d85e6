"""Queries of rules that a whole table of ordinary text would seldom touch.

Every document is dealt one of a rule's cases by its id. The SQL holds what the
rule gives for each case, worked out by hand, or the rule itself; it does not
repeat an expression of the engine.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nasij.functions import text as T
from nasij.operators import chunk, decisions, facts, formats, generation, guards, judge, leakage, ocr, stats
from nasij.plans import jobs
from nasij.sources import readers

_ALL: dict = {}
_SQL: dict[str, str] = {}


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v) if isinstance(v, int | float) else "'" + v.replace("'", "''") + "'"


def expected(n: int, columns: str, rows: list[tuple]) -> str:
    """SQL: the rows that each document's case gives; a row begins with its case."""
    values = ", ".join("(" + ", ".join(map(_lit, r)) + ")" for r in rows)
    return f"SELECT doc_id, {columns} FROM documents JOIN (VALUES {values}) e(c, {columns}) ON doc_id % {n} = c"


def query(sql: str):
    def keep(f):
        _ALL[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return keep


def dealt(spark, d, cases: list, name: str = "t", kind: str = "string") -> DataFrame:
    """doc_id and the case that the document is dealt."""
    values = F.array(*[F.lit(c) for c in cases]).cast(f"array<{kind}>")
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.element_at(values, (F.pmod("doc_id", F.lit(len(cases))) + 1).cast("int")).alias(name))


def _numbered(spark, d, n: int) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.pmod("doc_id", F.lit(n)).alias("c"))


# --- strings ------------------------------------------------------------------

#: text -> (joins, moves, repaired)
REPAIRS = [
    ("ك ُتب", 1, 0, "كتُب"), ("ُتب", 0, 1, "تُب"), ("ك ُ", 0, 0, "ك ُ"), ("(َب)", 0, 1, "(بَ)"),
    ("ك  َّب", 1, 0, "كبَّ"), ("plain", 0, 0, "plain"), ("ب ُت َث", 1, 0, "بتُ َث"),
]


@query(expected(len(REPAIRS), "joins, moves, repaired", [(i, j, m, t) for i, (_, j, m, t) in enumerate(REPAIRS)]))
def repair_marks(spark, d):
    r = T.repair_marks(F.col("t"))
    return dealt(spark, d, [x[0] for x in REPAIRS]).select("doc_id", r["joins"].alias("joins"), r["moves"].alias("moves"), r["text"].alias("repaired"))


KEYS = [
    # text, matching key without marks, fact key, audit key, root key
    ("أَحـمد", "احمد", "احمد", "أحمد", "أحـمد"),
    ("مكتبة  ١٢", "مكتبة  ١٢", "مكتبه 12", "مكتبة", "مكتبة١٢"),
    ("هدى، آت", "هدي، ات", "هدي، ات", "هدى آت", "هدى،آت"),
    ("abc", "abc", "abc", "", "abc"),
]


@query(expected(len(KEYS), "matching, fact, audit, root", [(i, *k[1:]) for i, k in enumerate(KEYS)]))
def text_keys(spark, d):
    c = F.col("t")
    return dealt(spark, d, [k[0] for k in KEYS]).select("doc_id", T.matching_key(c, strip_diacritics=True).alias("matching"), T.fact_key(c).alias("fact"), T.audit_key(c).alias("audit"), T.root_key(c).alias("root"))


SCAFFOLDS = [
    ("Thinking: why\nAnswer: so", "why", "so", "so"), ("no frame at all", None, "no frame at all", "no frame at all"), ("  Thinking:\n a\n b\n  Answer:\n c \n", "a\n b", "c", "c"),
    ("Answer: only", None, "Answer: only", "only"), ("x Answer: y Answer: z", None, "x Answer: y Answer: z", "y Answer: z"),
]


@query(expected(len(SCAFFOLDS), "thinking, answer, after_mark", [(i, *s[1:]) for i, s in enumerate(SCAFFOLDS)]))
def answer_scaffolds(spark, d):
    s = T.split_scaffold(F.col("t"))
    return dealt(spark, d, [x[0] for x in SCAFFOLDS]).select("doc_id", s["thinking"].alias("thinking"), s["answer"].alias("answer"), T.after_answer(F.col("t")).alias("after_mark"))


LONG = "ب" * 20
DAMAGE = [("كلمة " + LONG, 0.5, "كلمة " + LONG), ("one two", 0.0, "one two"), ("سطر أول\n" + LONG + " آخر", 0.25, LONG + " آخر"), ("ب" * 16 + " ب", 0.0, "ب" * 16 + " ب")]


@query(expected(len(DAMAGE), "ratio, snippet", [(i, *x[1:]) for i, x in enumerate(DAMAGE)]).replace("ratio, snippet FROM", "ratio::DOUBLE AS ratio, snippet FROM"))
def page_damage(spark, d):
    c = F.col("t")
    return dealt(spark, d, [x[0] for x in DAMAGE]).select("doc_id", T.damage_ratio(c).cast("double").alias("ratio"), T.damage_snippet(c).alias("snippet"))


MEANINGS = [("a -- b  --- ", "a   b", ""), ("meaning of it 12", "meaning of it 12", "trailing_number_noise"), ("meaning of it x", "meaning of it x", "trailing_single_char_noise"), ("the 7", "the 7", "trailing_number_noise|trailing_single_char_noise"), ("fine words", "fine words", "")]


@query(expected(len(MEANINGS), "cleaned, flags", [(i, *x[1:]) for i, x in enumerate(MEANINGS)]))
def meaning_cleanup(spark, d):
    c = F.col("t")
    return dealt(spark, d, [x[0] for x in MEANINGS]).select("doc_id", T.clean_meaning(c).alias("cleaned"), F.array_join(T.meaning_flags(c), "|").alias("flags"))


@query(r"SELECT doc_id, substring(trim(regexp_replace(substring(text, greatest(41 - 40, 1), 40 + 5 + 30), '\s+', ' ', 'g')), 1, 400) AS around FROM documents WHERE text IS NOT NULL")
def value_context(spark, d):
    """40 characters before and 30 after a value of 5 at place 40."""
    docs = spark.read.parquet(f"{d}/documents.parquet").where("text is not null")
    return docs.select("doc_id", T.context_window(F.col("text"), F.lit(40), F.lit(5)).alias("around"))


# --- units --------------------------------------------------------------------

_BLANK = r"list_filter(list_transform(string_split(replace(text, '. ', chr(10) || chr(10)), chr(10) || chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')"


@query(f"SELECT doc_id, len({_BLANK})::BIGINT AS units, md5(array_to_string({_BLANK}, '|')) AS joined FROM documents WHERE text IS NOT NULL")
def prose_paragraphs(spark, d):
    """Sentences set apart by blank lines, as paragraphs."""
    docs = spark.read.parquet(f"{d}/documents.parquet").where("text is not null").withColumn("t", F.replace("text", F.lit(". "), F.lit("\n\n")))
    u = chunk.segment(F.col("t"), F.lit("prose"))
    return docs.select("doc_id", F.size(u).cast("long").alias("units"), F.md5(F.array_join(u, "|")).alias("joined"))


_HEAD = "\n".join(f"({w}) : gloss {w}\nmore of {w}" for w in "abcde")
BOOKS = [
    # text, form, units, kind
    ("intro\n\nwords\n" + _HEAD, "dictionary", "intro|words|" + "|".join(f"({w}) : gloss {w}\nmore of {w}" for w in "abcde"), "entry_headword"),
    ("(a) : one\n\n(b) : two", "dictionary", "(a) : one|(b) : two", "entry_block"), ("(a) : one\n(b) : two", "dictionary", "(a) : one|(b) : two", "entry_line"),
    ("v1\nv2\n\nv3", "verse", "v1\nv2|v3", "stanza"), ("v1\n v2 ", "verse", "v1|v2", "verse_line"), ("p1\nx\n\n\n\np2", "prose", "p1\nx|p2", "paragraph"),
]


@query(expected(len(BOOKS), "units, kind", [(i, b[2], b[3]) for i, b in enumerate(BOOKS)]))
def units_by_form(spark, d):
    form = F.element_at(F.array(*[F.lit(b[1]) for b in BOOKS]), (F.pmod("doc_id", F.lit(len(BOOKS))) + 1).cast("int"))
    return dealt(spark, d, [b[0] for b in BOOKS]).select("doc_id", F.array_join(chunk.segment(F.col("t"), form), "|").alias("units"), chunk.unit_type(F.col("t"), form).alias("kind"))


HEADED = [
    # paragraphs, title -> header, body, placeholders
    ("The Book|a subtitle|تأليف\nAli|first [figure] words|[figure]|last", "The Book", 3, "first [figure] words|last", "1:[figure]"),
    ("The Book|first words|last", "The Book", 1, "first words|last", ""), ("first|The Book", "The Book", 0, "first|The Book", ""), ("[ image ]|x|[]", "T", 0, "x", "0:[ image ]|2:[]"),
]


@query(expected(len(HEADED), "header, body, dropped", [(i, *h[2:]) for i, h in enumerate(HEADED)]))
def headers_and_placeholders(spark, d):
    title = F.element_at(F.array(*[F.lit(h[1]) for h in HEADED]), (F.pmod("doc_id", F.lit(len(HEADED))) + 1).cast("int"))
    rows = dealt(spark, d, [h[0] for h in HEADED]).withColumn("u", F.split("t", r"\|")).withColumn("header", chunk.header_length(F.col("u"), title))
    rows = rows.withColumn("b", F.slice("u", F.col("header") + 1, F.size("u")))
    return rows.select("doc_id", "header", F.array_join(chunk.drop_placeholders(F.col("b")), "|").alias("body"), F.array_join(F.transform(chunk.placeholders(F.col("b")), lambda p: F.concat(p["body_index"].cast("string"), F.lit(":"), p["text"])), "|").alias("dropped"))


MARKUP = [
    ("<p>one &amp; two</p><p>three</p>", "\none & two\n\nthree\n"), ("<html><head><title>t</title></head><body>a<script>x()</script>b</body></html>", "ab"),
    ("a<b>c</b>d<br>e", "acd\ne"), ("<ul><li>x<li>y</ul>", "\nx\ny"), ("plain &lt;text&gt;", "plain <text>"), ("<style>p{}</style><h1>H</h1>", "\nH\n"),
]


@query(expected(len(MARKUP), "extracted", [(i, m[1]) for i, m in enumerate(MARKUP)]))
def page_markup(spark, d):
    got = F.pandas_udf(lambda s: s.map(readers.markup_text), "string")(F.col("t"))
    return dealt(spark, d, [m[0] for m in MARKUP]).select("doc_id", got.alias("extracted"))


# --- guards and generation ------------------------------------------------------

_GOOD = {"chunk_id": "c1", "chunk_text": "t", "format_type": "prose", "source": "s", "license": "l"}
HANDOFF = [
    (_GOOD, []), (_GOOD | {"chunk_id": "c 1", "format_type": "odd"}, [("INVALID_CHUNK_ID", "chunk_id"), ("UNKNOWN_FORMAT", "format_type")]), (_GOOD | {"chunk_text": " "}, [("EMPTY_FIELD", "chunk_text"), ("EMPTY_TEXT", "chunk_text")]),
    ({k: v for k, v in _GOOD.items() if k != "license"}, [("MISSING_FIELD", "license")]), (_GOOD | {"source": 5, "license": None}, [("EMPTY_FIELD", "source"), ("EMPTY_FIELD", "license")]),
    (_GOOD | {"review_flags": "x", "source_doc_flags": ["a", 1]}, [("INVALID_REVIEW_FLAGS", "review_flags"), ("INVALID_REVIEW_FLAGS", "source_doc_flags")]), (_GOOD | {"source_doc_flags": ["damaged_page"]}, [("FATAL_REVIEW_FLAG", "review_flags")]),
    (_GOOD | {"review_flags": ["residue_tokens"], "source_doc_flags": None}, [("FATAL_REVIEW_FLAG", "review_flags")]), ([1], [("NOT_AN_OBJECT", None)]),
]


@query(expected(len(HANDOFF) + 1, "code, field", [(i, c, f) for i, (_, found) in enumerate(HANDOFF) for c, f in found] + [(len(HANDOFF), "BAD_JSON", None)]))
def handoff_findings(spark, d):
    return guards.handoff_findings(dealt(spark, d, [*[json.dumps(r) for r, _ in HANDOFF], "{bad"]), "doc_id", "t")


ANSWERED = [
    ([{"question": "", "answer": "x"}, {"question": "q", "answer": "a", "thinking": "I should explain it"}, {"question": "q", "answer": "a"}, {"question": " q2 ", "answer": "b", "thinking": "why", "question_type": "Multi_Step"}],
     [("_sft_001", "q", "Meaning", "Answer:\na"), ("_sft_002", "q2", "Multi-step", "Thinking:\nwhy\n\nAnswer:\nb")]),
    ({"examples": [{"question": "q", "answer": "a", "question_type": "cause / why", "difficulty": "Hard"}]}, [("_sft_001", "q", "Cause/Why", "Answer:\na")]),
    ([{"question": f"q{i}", "answer": "a", "question_type": ""} for i in range(14)], [(f"_sft_{i + 1:03d}", f"q{i}", "Meaning", "Answer:\na") for i in range(12)]), ({"other": 1}, []),
]


@query(expected(len(ANSWERED), "ending, question, question_type, said", [(i, *x) for i, (_, found) in enumerate(ANSWERED) for x in found]).replace("doc_id, ending", "doc_id, doc_id || ending AS sample_id"))
def reply_samples(spark, d):
    rows = dealt(spark, d, [json.dumps(r) for r, _ in ANSWERED]).withColumn("chunk", F.col("doc_id").cast("string"))
    made = generation.samples(rows, "chunk", "t")
    return made.select(F.col("chunk_id").cast("long").alias("doc_id"), "sample_id", "question", "question_type", F.col("messages")[1]["content"].alias("said"))


# --- facts ----------------------------------------------------------------------

DIALECT = [
    ("(مطر) : ماء ينزل", [("entry_headword", "مطر", 1)]), ("انظر ص 12 من الكتاب", [("page_reference", "12", 7)]), ("سنة 1402 هـ", [("hijri_year", "1402", 4)]), ("عام 1998 م", [("gregorian_year", "1998", 4)]),
    ("سنة 1350 كانت", [("year_unmarked_era", "1350", 4)]), ("سنة 1650 كانت", [("gregorian_year", "1650", 4)]), ("سنة 900 كانت", []), ("وقال ذو الرمة في ذلك", [("citation_authority", "ذو الرمة", 5)]), ("وقال له كذا", []),
    ("وفي لهجة نجد", [("cross_dialect_reference", "لهجة نجد", 4)]), ("كلام بلا شيء", []),
]
LEXICON = [("كتب : خط\nومن المجاز كتب الله", [("entry_root", "كتب", 0), ("figurative_sense", "ومن المجاز كتب الله", 9)]), ("الكتاب : شيء", []), ("كتب :", []), ("ومن المجاز أ\nدرس : علم", [("figurative_sense", "ومن المجاز أ", 0), ("entry_root", "درس", 13)])]
POPULAR = [("مطر : ماء ينزل", [("entry_headword", "مطر", 0), ("gloss", "ماء ينزل", 6)]), ("مطر : ما", [("entry_headword", "مطر", 0)]), ("word : gloss", []), ("شمس: ضوء\nانظر ص 7", [("entry_headword", "شمس", 0), ("gloss", "ضوء", 5), ("page_reference", "7", 16)])]


def _facts(spark, d, cases, profile):
    rows = dealt(spark, d, [c[0] for c in cases]).withColumn("f", facts.extracted(F.col("t"), profile))
    return facts.fact_rows(rows, "doc_id", "f").select("doc_id", "type", "value", F.col("position_in_text").alias("place"))


def _facts_sql(cases) -> str:
    return expected(len(cases), "type, value, place", [(i, *f) for i, (_, found) in enumerate(cases) for f in found])


@query(_facts_sql(DIALECT))
def facts_dialect(spark, d):
    return _facts(spark, d, DIALECT, "saudi_dialect")


@query(_facts_sql(LEXICON))
def facts_lexicon(spark, d):
    return _facts(spark, d, LEXICON, "classical_lexicon")


@query(_facts_sql(POPULAR))
def dictionary_facts(spark, d):
    return _facts(spark, d, POPULAR, "najdi_popular")


def _with_facts(spark, d) -> DataFrame:
    region = F.concat(F.lit("r"), F.pmod("doc_id", F.lit(3)).cast("string"))
    return dealt(spark, d, [c[0] for c in DIALECT]).select("doc_id", region.alias("region"), facts.extracted(F.col("t"), "saudi_dialect").alias("f"))


_HELD = "(SELECT doc_id, 'r' || (doc_id % 3) AS region, n FROM documents JOIN (VALUES " + ", ".join(f"({i}, {len(f)})" for i, (_, f) in enumerate(DIALECT)) + f") e(c, n) ON doc_id % {len(DIALECT)} = c)"


@query(f"SELECT region, count(*) AS chunks, count_if(n > 0)::BIGINT AS with_facts, 100.0 * count_if(n > 0) / count(*) AS coverage, sum(n)::BIGINT AS facts FROM {_HELD} GROUP BY region")
def fact_coverage(spark, d):
    return facts.fact_report(_with_facts(spark, d), "doc_id", "region", "f")


@query("SELECT 'r' || (doc_id % 3) AS region, type, count(*) AS facts FROM (" + _facts_sql(DIALECT) + ") GROUP BY 1, 2")
def facts_by_type(spark, d):
    return facts.fact_types(_with_facts(spark, d), "region", "f")


@query(f"SELECT region, doc_id FROM {_HELD} WHERE n = 0")
def chunks_without_facts(spark, d):
    return facts.without_facts(_with_facts(spark, d), "doc_id", "region", "f")


CITED = [("وقال ذو الرمة في ذلك", "ذو الرمة"), ("وقال الأصمعي في ذلك", "الأصمعي"), ("وأنشد الفراء له", "الفراء"), ("قال الشاعر هنا", "الشاعر")]


@query(
    "WITH r AS (" + expected(40, "value", [(i, CITED[i % 3 if i < 39 else 3][1]) for i in range(40)]) + ") SELECT doc_id, value, count(*) OVER (PARTITION BY value) AS occurrences, value = 'ذو الرمة' OR count(*) OVER (PARTITION BY value) >= 3 AS confident FROM r"
)
def citation_confidence(spark, d):
    rows = dealt(spark, d, [CITED[i % 3 if i < 39 else 3][0] for i in range(40)]).withColumn("f", facts.extracted(F.col("t"), "classical_lexicon"))
    found = facts.confident_citations(facts.fact_rows(rows, "doc_id", "f").where("type = 'citation_authority'"))
    return found.select("doc_id", "value", "occurrences", "confident")


QUOTES = [("قال «ماء السماء» ثم", "ماء السماء"), ("'كلمة' و\"كلمة طيبة\" و\"كلمة طيبة\"", "كلمة طيبة"), ("«two words» هنا", ""), ("«سطر أول» «سطر ثان»", "سطر أول|سطر ثان"), ("بلا", "")]


@query(expected(len(QUOTES), "items", [(i, q[1]) for i, q in enumerate(QUOTES)]))
def quoted_items(spark, d):
    return dealt(spark, d, [q[0] for q in QUOTES]).select("doc_id", F.array_join(facts.quoted_items(F.col("t")), "|").alias("items"))


_CHUNK = "(مطر) : ماء ينزل من السماء انظر ص 12 سنة 1402 هـ وقال ذو الرمة في ذلك وفي أهل مصر"
#: response -> worst verdict, contradicted types
CHECKED = [
    ("جاء في ص 12", "SUPPORTED", ""), ("جاء في ص 13", "CONTRADICTED", "page_reference"), ("كلام بلا شيء", "NO_CHECKABLE_CLAIMS", ""), ("معنى «مطر» ماء ينزل", "SUPPORTED", ""), ("في لهجة نجد", "SUPPORTED", ""),
    ("في لهجة الحجاز", "CONTRADICTED", "region_claim"), ("سنة 1402 هـ", "SUPPORTED", ""), ("عام 1998 م", "UNSUPPORTED", ""), ("سنة 1403 هـ", "CONTRADICTED", "hijri_year"), ("'ماء ينزل' من السماء", "PARTIAL", ""),
    ("«ماء يصعد» كذا", "UNSUPPORTED", ""), ("قال ذو الرمة", "SUPPORTED", ""), ("جاء في ص 12 وفي ص 99", "CONTRADICTED", "page_reference"),
    # marked as a headword too, which the chunk does not have
    ("«ماء ينزل» من السماء", "UNSUPPORTED", ""),
]


@query(expected(len(CHECKED) + 1, "fact_verdict, contradicted", [(i, *c[1:]) for i, c in enumerate(CHECKED)] + [(len(CHECKED), "UNKNOWN_CHUNK", "")]))
def facts_checked(spark, d):
    chunks = spark.createDataFrame([("c1", "najdi", _CHUNK)], "chunk_id string, region string, chunk_text string").withColumn("extracted_facts", facts.extracted(F.col("chunk_text"), "saudi_dialect"))
    n = len(CHECKED)
    rows = dealt(spark, d, [*[c[0] for c in CHECKED], "x"], "response").withColumn("instruction", F.lit("")).withColumn("source_chunk_id", F.when(F.pmod("doc_id", F.lit(n + 1)) == n, "nowhere").otherwise("c1"))
    got = facts.check_records(rows, chunks, "saudi_dialect", "doc_id")
    return got.select("doc_id", "fact_verdict", F.array_join(F.array_sort("contradicted_types"), "|").alias("contradicted"))


#: stated, known, relation
RELATIONS = [("ذو الرمة", "ذو الرمة", "equal"), ("ذو الرمة العدوي", "ذو الرمة", "extension"), ("الرمة", "ذو الرمة", "abbreviation"), ("ذو الرمةx", "ذو الرمة", "corruption"), ("عنترة", "ذو الرمة", None)]


@query(expected(len(RELATIONS), "relation", [(i, r[2]) for i, r in enumerate(RELATIONS)]))
def value_relations(spark, d):
    known = F.element_at(F.array(*[F.lit(r[1]) for r in RELATIONS]), (F.pmod("doc_id", F.lit(len(RELATIONS))) + 1).cast("int"))
    return dealt(spark, d, [r[0] for r in RELATIONS]).select("doc_id", facts.relation(F.col("t"), known).alias("relation"))


# --- records and pairs ------------------------------------------------------------


@query(
    """WITH v AS (SELECT doc_id, ['PASS', 'REVIEW', 'FAIL_CONTRADICTED', 'INVALID_RECORD', 'NO_FACT_COVERAGE'][doc_id % 5 + 1] AS a, ['PASS', 'REVIEW', 'FAIL_CONTRADICTED', 'INVALID_RECORD', 'NO_FACT_COVERAGE'][doc_id // 5 % 5 + 1] AS b,
CASE WHEN doc_id % 7 = 0 THEN NULL ELSE (doc_id * 37 % 101)::DOUBLE END AS pa, (doc_id * 53 % 101)::DOUBLE AS pb, doc_id % 3 > 0 AS ga, doc_id % 4 > 0 AS gb FROM documents),
r AS (SELECT *, list_position(['PASS', 'NO_FACT_COVERAGE', 'REVIEW', 'FAIL_CONTRADICTED', 'INVALID_RECORD'], a) AS ra, list_position(['PASS', 'NO_FACT_COVERAGE', 'REVIEW', 'FAIL_CONTRADICTED', 'INVALID_RECORD'], b) AS rb FROM v)
SELECT doc_id, CASE WHEN ra < rb THEN 'chosen_better_verdict' WHEN ra > rb THEN 'rejected_better_verdict' WHEN NOT ga AND NOT gb THEN 'tie' WHEN pa - pb > 5 THEN 'chosen_better_similarity' WHEN pb - pa > 5 THEN 'rejected_better_similarity' ELSE 'tie' END AS way FROM r"""
)
def pair_direction(spark, d):
    i = F.col("doc_id")
    names = F.array(*map(F.lit, ("PASS", "REVIEW", "FAIL_CONTRADICTED", "INVALID_RECORD", "NO_FACT_COVERAGE")))
    at = lambda n: F.element_at(names, (n % 5 + 1).cast("int"))
    way = decisions.direction(at(i), at(F.floor(i / 5)), F.when(i % 7 != 0, (i * 37 % 101).cast("double")), (i * 53 % 101).cast("double"), i % 3 > 0, i % 4 > 0)
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", way.alias("way"))


@query(
    """WITH v AS (SELECT doc_id, ['REJECT', 'ACCEPT', 'HOLD_FOR_REVIEW'][doc_id % 3 + 1] AS a, ['PASS', 'FAIL', 'REVIEW', 'ABSTAIN', NULL][doc_id % 5 + 1] AS j, ['FLAG_SUSPICIOUS', 'AUTO_CONFIRM', 'NEEDS_JUDGE'][doc_id % 3 + 1] AS t,
['rejected_better', 'equivalent', 'chosen_better', NULL][doc_id % 4 + 1] AS s, (doc_id % 11) / 10.0 AS c, ['tie', 'chosen_better_verdict'][doc_id % 2 + 1] AS w, doc_id % 13 = 0 AS biased FROM documents)
SELECT doc_id, CASE WHEN a = 'REJECT' THEN 'REJECT' WHEN a = 'ACCEPT' AND j IS NOT DISTINCT FROM 'PASS' THEN 'ACCEPT' ELSE 'HOLD_FOR_REVIEW' END AS sft, CASE WHEN t = 'FLAG_SUSPICIOUS' THEN 'FLAGGED' WHEN j IS NOT DISTINCT FROM 'PASS' THEN 'CONFIRMED' ELSE 'NEEDS_HUMAN' END AS dpo,
CASE WHEN t = 'NEEDS_JUDGE' AND s IN ('rejected_better', 'equivalent') AND c >= 0.75 AND w <> 'chosen_better_verdict' THEN 'FLAG_SUSPICIOUS' ELSE t END AS adjudicated,
CASE WHEN s IS NULL THEN 'ABSTAIN' WHEN biased THEN 'REVIEW' WHEN s = 'chosen_better' THEN 'PASS' WHEN s = 'rejected_better' THEN 'FAIL' ELSE 'REVIEW' END AS assessed FROM v"""
)
def settlements(spark, d):
    i = F.col("doc_id")
    pick = lambda *x: F.element_at(F.array(*[F.lit(v) for v in x]).cast("array<string>"), (i % len(x) + 1).cast("int"))
    a, j, t, s, w = pick("REJECT", "ACCEPT", "HOLD_FOR_REVIEW"), pick("PASS", "FAIL", "REVIEW", "ABSTAIN", None), pick("FLAG_SUSPICIOUS", "AUTO_CONFIRM", "NEEDS_JUDGE"), pick("rejected_better", "equivalent", "chosen_better", None), pick("tie", "chosen_better_verdict")
    return spark.read.parquet(f"{d}/documents.parquet").select(
        "doc_id", decisions.settle_sft(a, j).alias("sft"), decisions.settle_dpo(t, j).alias("dpo"), decisions.adjudicate(t, s, i % 11 / 10.0, w).alias("adjudicated"), decisions.assessment_verdict(s, i % 13 == 0).alias("assessed")
    )


@query(
    """WITH v AS (SELECT doc_id, ['pass', 'review', 'fail'][doc_id % 3 + 1] AS a, ['pass', 'review', 'fail'][doc_id // 3 % 3 + 1] AS b, ['high', 'low'][doc_id % 2 + 1] AS c, doc_id % 17 = 0 AS failed FROM documents)
SELECT doc_id, CASE WHEN failed THEN 'ABSTAIN' WHEN 'fail' IN (a, b) THEN 'FAIL' WHEN 'review' IN (a, b) OR c = 'low' THEN 'REVIEW' ELSE 'PASS' END AS verdict FROM v"""
)
def judged_dimensions(spark, d):
    i = F.col("doc_id")
    pick = lambda n, *x: F.element_at(F.array(*map(F.lit, x)), (n % len(x) + 1).cast("int"))
    dims = F.create_map(F.lit("grounding"), pick(i, "pass", "review", "fail"), F.lit("style"), pick(F.floor(i / 3), "pass", "review", "fail"))
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", decisions.judge_sft(dims, pick(i, "high", "low"), i % 17 == 0).alias("verdict"))


@query(
    """WITH v AS (SELECT doc_id, 0.88 + (doc_id % 13) / 100.0 AS x, ['partial_factual_errors', 'verbosity', 'unsupported_additions'][doc_id % 3 + 1] AS k FROM documents)
SELECT doc_id, x >= CASE WHEN k = 'verbosity' THEN 0.90 ELSE 0.995 END AS degenerate FROM v"""
)
def degenerate_pairs(spark, d):
    i = F.col("doc_id")
    kind = F.element_at(F.array(*map(F.lit, ("partial_factual_errors", "verbosity", "unsupported_additions"))), (i % 3 + 1).cast("int"))
    lexical = (F.lit("0.88").cast("decimal(10,2)") + (i % 13).cast("decimal(10,2)") / 100).cast("double")
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", decisions.degenerate(lexical, kind).alias("degenerate"))


RECORDS = [
    # response, chunk, region, form, model -> verdict, leaning, decision, missing, warnings
    (("جاء في ص 12.", "c1", "najdi", "prose", "m"), ("REVIEW", "pass", "HOLD_FOR_REVIEW", "", "")), (("جاء في ص 12.", "c1", "western", "prose", "m"), ("REVIEW", "pass", "HOLD_FOR_REVIEW", "", "region_mismatch")),
    (("جاء في ص 13.", "c1", "najdi", "prose", "m"), ("FAIL_CONTRADICTED", "fail", "REJECT", "", "")), (("جاء في ص 12.", "c1", "najdi", "prose", None), ("INVALID_RECORD", None, "REJECT", "model_version", "")),
    (("كلام بلا شيء", "c1", "najdi", "prose", "m"), ("NO_FACT_COVERAGE", None, "HOLD_FOR_REVIEW", "", "")), (("عام 1998 م.", "c1", "najdi", "prose", "m"), ("REVIEW", "fail", "HOLD_FOR_REVIEW", "", "")), (("x", "c9", "najdi", "prose", "m"), ("INVALID_RECORD", None, "REJECT", "", "")),
]


@query(expected(len(RECORDS), "verdict, leaning, decision, missing, warnings", [(i, *r[1]) for i, r in enumerate(RECORDS)]))
def verified_records(spark, d):
    chunks = spark.createDataFrame([("c1", "najdi", _CHUNK)], "chunk_id string, region string, chunk_text string").withColumn("extracted_facts", facts.extracted(F.col("chunk_text"), "saudi_dialect"))
    fields = ("response", "source_chunk_id", "source_region", "format_type", "model_version")
    cases = F.array(*[F.struct(*[F.lit(v).cast("string").alias(f) for f, v in zip(fields, r[0], strict=True)]) for r in RECORDS])
    rows = _numbered(spark, d, len(RECORDS)).select(F.col("doc_id").alias("row_idx"), F.lit("i").alias("instruction"), F.element_at(cases, (F.col("c") + 1).cast("int")).alias("x")).select("row_idx", "instruction", "x.*")
    got = jobs.verify_sft(rows, chunks, "saudi_dialect")
    return got.select(F.col("row_idx").alias("doc_id"), "verdict", "leaning", "decision", F.array_join("missing", "|").alias("missing"), F.array_join("warnings", "|").alias("warnings"))


#: chosen, rejected kind, verdicts of the two sides (None: not verified) -> triage, missing
PAIRS = [
    (("short", "verbosity", "PASS", "REVIEW"), ("AUTO_CONFIRM", "")), (("short", "verbosity", "REVIEW", "PASS"), ("FLAG_SUSPICIOUS", "")), (("short", "verbosity", "PASS", None), ("FLAG_SUSPICIOUS", "verified_rejected")),
    ((None, "verbosity", "PASS", "REVIEW"), ("FLAG_SUSPICIOUS", "chosen")), (("short", "unheard_of", "PASS", "REVIEW"), ("NEEDS_JUDGE", "")), (("short", None, None, None), ("FLAG_SUSPICIOUS", "rejection_type|verified_chosen|verified_rejected")),
    (("short", "wrong_register", "REVIEW", "REVIEW"), ("NEEDS_JUDGE", "")),
]


@query(expected(len(PAIRS), "triage, missing", [(i, *p[1]) for i, p in enumerate(PAIRS)]))
def triaged_pairs(spark, d):
    at = lambda k: F.element_at(F.array(*[F.lit(p[0][k]) for p in PAIRS]).cast("array<string>"), (F.col("c") + 1).cast("int"))
    rows = _numbered(spark, d, len(PAIRS)).select(F.col("doc_id").alias("row_idx"), F.lit("p").alias("prompt"), at(0).alias("chosen"), F.lit("a much longer text that says little").alias("rejected"), at(1).alias("rejection_type"), F.lit("prose").alias("format_type"), at(2).alias("va"), at(3).alias("vb"))
    side = lambda v: rows.where(f"{v} is not null").select("row_idx", F.col(v).alias("verdict"), F.lit("PARTIAL").alias("fact_verdict"), F.lit(60.0).alias("percentile"))
    got = jobs.triage_dpo(rows, side("va"), side("vb"))
    return got.select(F.col("row_idx").alias("doc_id"), "triage", F.array_join("missing", "|").alias("missing"))


@query(
    """WITH r AS (SELECT doc_id, doc_id // 4 AS chunk, ['dev', 'test', 'train'][doc_id % 3 + 1] AS part, CASE WHEN doc_id % 11 <> 0 THEN 'x' ELSE '' END AS chosen, CASE WHEN doc_id % 13 <> 0 THEN 'y' END AS rejected FROM documents),
whole AS (SELECT *, first_value(part) OVER (PARTITION BY chunk ORDER BY part, doc_id) AS first_part FROM r WHERE chosen <> '' AND rejected IS NOT NULL)
SELECT doc_id, 'half_pair' AS why, NULL AS also_in FROM r WHERE chosen = '' OR rejected IS NULL UNION ALL SELECT doc_id, 'chunk_in_two_parts', first_part FROM whole WHERE first_part <> part"""
)
def pairs_intact(spark, d):
    i = F.col("doc_id")
    part = F.element_at(F.array(*map(F.lit, ("dev", "test", "train"))), (i % 3 + 1).cast("int"))
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.floor(i / 4).alias("chunk"), part.alias("part"), F.when(i % 11 != 0, "x").otherwise("").alias("chosen"), F.when(i % 13 != 0, "y").alias("rejected"))
    return leakage.pairs_intact(rows, "chunk", "chosen", "rejected", "part", ["part", "doc_id"]).select("doc_id", "why", "also_in")


@query(
    """WITH v AS (SELECT doc_id, (doc_id % 90) / 100.0 AS d2, (doc_id % 70) / 100.0 AS nn, (doc_id % 50) / 100.0 AS nr, (doc_id % 60) / 100.0 AS ts, doc_id % 5 AS dup, (doc_id % 100) / 100.0 AS re, doc_id % 3 AS absent, (doc_id % 97) / 100.0 AS fe FROM documents)
SELECT doc_id, concat_ws('|', CASE WHEN d2 < 0.45 THEN 'LOW_PHRASING_VARIETY' END, CASE WHEN nn >= 0.55 THEN 'TEMPLATED_INSTRUCTIONS' END, CASE WHEN nr >= 0.25 THEN 'TEMPLATED_SUBSET' END, CASE WHEN ts >= 0.35 THEN 'SHARED_OPENING' END,
CASE WHEN dup > 0 THEN 'EXACT_DUPLICATES' END, CASE WHEN re < 0.75 THEN 'REGION_IMBALANCE' END, CASE WHEN absent > 0 THEN 'REGIONS_ABSENT' END, CASE WHEN fe < 0.75 THEN 'FORMAT_IMBALANCE' END) AS flags FROM v"""
)
def diversity_flags(spark, d):
    i = F.col("doc_id")
    of = lambda n: i % n / 100.0
    flags = stats.diversity_flags(of(90), of(70), of(50), of(60), F.lit(100), 100 - i % 5, of(100), i % 3, of(97))
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.array_join(flags, "|").alias("flags"))


# --- judges -------------------------------------------------------------------------

_GOOD = {
    "schema_version": "judge-1", "judge_model_version": "m", "assessment": "chosen_better", "weakness_present": True, "rejection_type": "weak_organization", "type_scores": {"verbosity": 0.8},
    "confidence": 0.75, "evidence": [{"claim": "pads", "quote_from": "rejected", "quote": "gamma"}], "notes": None,
}


def _reply(**changed) -> str:
    return json.dumps(_GOOD | changed)


def _quote(**changed) -> list:
    return [_GOOD["evidence"][0] | changed]


#: reply -> error type, first code, assessment, corroborated
REPLIES = [
    (_reply(), (None, None, "chosen_better", True)), (None, ("ProviderError", None, None, None)), ("not json", ("InvalidJSON", "INVALID_JSON", None, None)), ("```json\n" + _reply() + "\n```", ("InvalidJSON", "INVALID_JSON", None, None)),
    ("[1]", ("InvalidJudgeOutput", "NOT_AN_OBJECT", None, None)), (_reply(verdict="AUTO_CONFIRM"), ("InvalidJudgeOutput", "RESERVED_FIELD", None, None)),
    (json.dumps({k: v for k, v in _GOOD.items() if k != "confidence"}), ("InvalidJudgeOutput", "MISSING_FIELD", None, None)), (_reply(schema_version="judge-2"), ("InvalidJudgeOutput", "BAD_SCHEMA", None, None)),
    (_reply(assessment="AUTO_CONFIRM"), ("InvalidJudgeOutput", "BAD_ASSESSMENT", None, None)), (_reply(weakness_present="yes"), ("InvalidJudgeOutput", "BAD_WEAKNESS", None, None)),
    (_reply(rejection_type="other"), ("InvalidJudgeOutput", "BAD_REJECTION_TYPE", None, None)), (_reply(rejection_type_agrees_with_record="yes"), ("InvalidJudgeOutput", "BAD_AGREEMENT", None, None)),
    (_reply(type_scores={"verbosity": 1.5}), ("InvalidJudgeOutput", "BAD_TYPE_SCORES", None, None)), (_reply(type_scores={"verbosity": True}), ("InvalidJudgeOutput", "BAD_TYPE_SCORES", None, None)),
    (_reply(type_scores={"odd": 0.5}), ("InvalidJudgeOutput", "BAD_TYPE_SCORES", None, None)), (_reply(type_scores=None), ("InvalidJudgeOutput", "BAD_TYPE_SCORES", None, None)), (_reply(confidence=-0.1), ("InvalidJudgeOutput", "BAD_CONFIDENCE", None, None)),
    (_reply(confidence="0.5"), ("InvalidJudgeOutput", "BAD_CONFIDENCE", None, None)), (_reply(evidence=_quote(quote="delta")), ("InvalidJudgeOutput", "BAD_EVIDENCE", None, None)), (_reply(evidence=_quote(quote_from="prompt")), ("InvalidJudgeOutput", "BAD_EVIDENCE", None, None)),
    (_reply(evidence=_quote(explains_type="odd")), ("InvalidJudgeOutput", "BAD_EVIDENCE", None, None)), (_reply(evidence=_quote(claim="")), ("InvalidJudgeOutput", "BAD_EVIDENCE", None, None)), (_reply(evidence={}), ("InvalidJudgeOutput", "BAD_EVIDENCE", None, None)),
    (_reply(evidence=[]), ("InvalidJudgeOutput", "WEAKNESS_WITHOUT_EVIDENCE", None, None)), (_reply(notes=3), ("InvalidJudgeOutput", "BAD_NOTES", None, None)),
    (_reply(evidence=[], weakness_present=False, rejection_type=None, assessment="undetermined", type_scores={}), (None, None, "undetermined", None)), (_reply(rejection_type="unsupported_additions", confidence=1), (None, None, "chosen_better", False)),
]


@query(expected(len(REPLIES), "error_type, code, assessment, corroborated", [(i, *r[1]) for i, r in enumerate(REPLIES)]))
def judge_replies(spark, d):
    """Replies on a pair whose kind of rejection is of the dimension of style."""
    got = judge.judged(F.col("reply"), F.lit("verbosity"), F.lit("alpha beta"), F.lit("alpha beta gamma"), F.lit("the source text"))
    return dealt(spark, d, [r[0] for r in REPLIES], "reply").withColumn("j", got).select("doc_id", "j.error_type", "j.code", "j.assessment", "j.corroborated")


_BASED = _quote(quote_from="source", quote="source text")


def _says(assessment: str, evidence: list | None = None) -> str:
    return _reply(assessment=assessment, evidence=evidence or _BASED)


#: kind, reply, reply with the sides exchanged, unified verdict -> error type, verdict, called, status in the report, register signals
SWAPS = [
    (("verbosity", _says("chosen_better"), None, "NEEDS_JUDGE"), (None, "PASS", True, "ok", False)), (("verbosity", _says("rejected_better"), None, "AUTO_CONFIRM"), (None, "FAIL", False, "not_called", False)),
    (("wrong_register", _says("chosen_better"), _says("rejected_better"), "NEEDS_JUDGE"), (None, "PASS", True, "ok", True)), (("wrong_register", _says("chosen_better"), _says("chosen_better"), "NEEDS_JUDGE"), ("PositionBias", "REVIEW", True, "unavailable", False)),
    (("wrong_register", _says("chosen_better"), None, "NEEDS_JUDGE"), ("SwapPassUnavailable", "ABSTAIN", True, "unavailable", False)), (("wrong_register", None, _says("chosen_better"), "NEEDS_JUDGE"), ("ProviderError", "ABSTAIN", True, "unavailable", False)),
    (("odd", _says("chosen_better"), None, "FLAG_SUSPICIOUS"), ("InvalidJudgeInput", "ABSTAIN", False, "not_called", False)), (("weak_organization", _says("equivalent"), _says("equivalent"), "NEEDS_JUDGE"), (None, "REVIEW", True, "ok", False)),
    (("wrong_register", _says("chosen_better"), _says("rejected_better", _quote(quote_from="chosen")), "AUTO_CONFIRM"), (None, "PASS", False, "not_called", False)),
]


def _swapped(spark, d) -> DataFrame:
    at = lambda k: F.element_at(F.array(*[F.lit(x[0][k]) for x in SWAPS]).cast("array<string>"), (F.col("c") + 1).cast("int"))
    said = [F.lit(v).alias(n) for n, v in (("prompt", "p"), ("chosen", "alpha beta"), ("rejected", "alpha beta gamma"), ("source_text", "the source text"), ("source_region", "najdi"), ("model_version", "m"))]
    rows = _numbered(spark, d, len(SWAPS)).select("doc_id", F.col("doc_id").cast("string").alias("source_chunk_id"), *said, at(0).alias("rejection_type"), at(1).alias("first"), at(2).alias("second"), at(3).alias("unified"))
    return judge.judged_pairs(rows, "first", "second")


@query(expected(len(SWAPS), "error_type, verdict", [(i, *x[1][:2]) for i, x in enumerate(SWAPS)]))
def judged_pairs(spark, d):
    return _swapped(spark, d).select("doc_id", "judge.error_type", judge.suite_verdict(F.col("judge")).alias("verdict"))


@query(expected(len(SWAPS), "llm_called, judge_status, register", [(i, *x[1][2:]) for i, x in enumerate(SWAPS)]))
def judge_dashboard(spark, d):
    got = judge.dashboard(_swapped(spark, d), "unified", formats.dialect_markers(F.col("rejected")))
    return got.select(F.col("source_chunk_id").cast("long").alias("doc_id"), "llm_called", "judge_status", F.col("register_signals").isNotNull().alias("register"))


def _probe(**changed) -> dict:
    base = {"source_chunk_id": "c1", "instruction": "i", "response": "r", "format_type": "prose", "prompt": "p", "chosen": "a", "rejected": "b", "rejection_type": "verbosity", "fixture": "classical"}
    return base | {"expect_verdict": "PASS", "expect_fail_dimensions": [], "expect_corroborating_dimension": "style"} | changed


#: probe -> code, what (None: sound)
SFT_PROBES = [
    (_probe(expect_verdict="FAIL", expect_fail_dimensions=["grounding"]), None), (_probe(instruction=""), ("MISSING", "instruction")), (_probe(expect_verdict="MAYBE"), ("BAD_VERDICT", "MAYBE")), (_probe(source_chunk_id="c9"), ("UNKNOWN_CHUNK", "c9")),
    (_probe(expect_verdict="FAIL", expect_fail_dimensions=["odd"]), ("UNKNOWN_DIMENSION", "odd")), (_probe(expect_fail_dimensions=["grounding"]), ("PASS_WITH_FAILURES", "grounding")), (_probe(expect_verdict="FAIL"), ("FAIL_WITHOUT_DIMENSION", "")),
    (_probe(source_chunk_id="dialect_dict_c0001"), ("RIGHTS", "dialect_dict_c0001")), (_probe(source_chunk_id="dialect_dict_c0001", fixture="probes_saudi_dialect"), None),
]
DPO_PROBES = [
    (_probe(expect_verdict="REVIEW"), None), (_probe(rejection_type="odd"), ("BAD_TYPE", "odd")), (_probe(expect_corroborating_dimension="format"), ("WRONG_DIMENSION", "format")), (_probe(rejected=""), ("MISSING", "rejected")),
    (_probe(rejection_type="weak_organization"), None),
]


@query(
    "SELECT 'SFT' AS suite, doc_id::VARCHAR AS label, code, what FROM (" + expected(len(SFT_PROBES), "code, what", [(i, *p[1]) for i, p in enumerate(SFT_PROBES) if p[1]])
    + ") UNION ALL SELECT 'DPO', doc_id::VARCHAR, code, what FROM (" + expected(len(DPO_PROBES), "code, what", [(i, *p[1]) for i, p in enumerate(DPO_PROBES) if p[1]]) + ") UNION ALL SELECT 'DPO', NULL, 'TOO_FEW_PROBES', 'wrong_register'"
)
def suite_problems(spark, d):
    """A suite without a probe for one of the kinds that nothing else sees."""
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in _probe().items())

    def rows(probes: list) -> DataFrame:
        return dealt(spark, d, [json.dumps(p[0]) for p in probes]).select(F.col("doc_id").cast("string").alias("label"), F.from_json("t", schema).alias("x")).select("label", "x.*")

    chunks = spark.createDataFrame([("c1",), ("dialect_dict_c0001",)], "chunk_id string")
    return judge.suite_problems(rows(SFT_PROBES), rows(DPO_PROBES), chunks)


# --- recognised pages ---------------------------------------------------------------

ENTRIES = [
    # headword, confidence, meaning, colon -> score, status, final status, tier
    (("مطر", 90.0, "ماء ينزل من السماء", True), (100, "accepted", "accepted", None)), (("مطر", 50.0, "ماء ينزل من السماء", True), (85, "review", "review", "easy_review")), (("مطر", 20.0, "ماء ينزل من السماء", True), (70, "review", "review", "hard_review")),
    (("مطر", 90.0, "ماء كثير", True), (90, "accepted", "review", "easy_review")), (("مطر", 90.0, "ماء", False), (65, "review", "review", "hard_review")), (("مطر", 90.0, "", True), (40, "rejected", "rejected", None)),
    (("مط1", 90.0, "ماء ينزل من السماء", True), (60, "review", "review", "hard_review")), (("مطر", 90.0, "ماء ينزل من السماء 12", True), (90, "review", "review", "hard_review")), (("abc", 90.0, "ماء ينزل من السماء", True), (100, "rejected", "rejected", None)),
]


def _entries(spark, d) -> DataFrame:
    fields = (("headword", "string"), ("headword_conf", "double"), ("meaning", "string"), ("had_colon", "boolean"))
    cases = F.array(*[F.struct(*[F.lit(v).cast(k).alias(f) for (f, k), v in zip(fields, e[0], strict=True)]) for e in ENTRIES])
    return _numbered(spark, d, len(ENTRIES)).select("doc_id", F.element_at(cases, (F.col("c") + 1).cast("int")).alias("x")).select("doc_id", "x.*")


@query(expected(len(ENTRIES), "quality_score, quality_status, final_status, review_tier", [(i, *e[1]) for i, e in enumerate(ENTRIES)]))
def ocr_review(spark, d):
    return ocr.finalize(ocr.score(_entries(spark, d))).select("doc_id", "quality_score", "quality_status", "final_status", "review_tier")


@query(
    "WITH r AS (" + expected(len(ENTRIES), "quality_status, conf", [(i, e[1][1], e[0][1]) for i, e in enumerate(ENTRIES)])
    + ") SELECT count(*) AS entries, count_if(quality_status = 'accepted')::BIGINT AS accepted, count_if(quality_status = 'review')::BIGINT AS review, count_if(quality_status = 'rejected')::BIGINT AS rejected, 100.0 * count_if(quality_status = 'accepted') / count(*) AS accepted_percent, avg(conf)::DOUBLE AS mean_confidence FROM r"
)
def ocr_report(spark, d):
    return ocr.report(ocr.score(_entries(spark, d)))


@query(
    "WITH r AS (" + expected(len(ENTRIES), "headword, via", [(i, e[0][0], {0: "accepted", 1: "auto_approved_easy", 3: "auto_approved_easy"}.get(i)) for i, e in enumerate(ENTRIES)])
    + ") SELECT doc_id // 20 AS page, headword, via AS approval_source, doc_id AS entry FROM r WHERE via IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id // 20, headword ORDER BY via, doc_id) = 1"
)
def ocr_final_subset(spark, d):
    """Twenty entries to a page."""
    rows = _entries(spark, d).withColumn("page", F.floor(F.col("doc_id") / 20)).withColumn("entry", F.col("doc_id")).withColumn("line_top", F.col("doc_id"))
    return ocr.final_subset(ocr.finalize(ocr.score(rows))).select("page", "headword", "approval_source", "entry")


@query(
    "SELECT doc_id // 5 AS page, 'مطر' AS headword, count(*) OVER w AS entry, CASE WHEN doc_id % 5 = 1 THEN 'ماء سطر آخر' ELSE 'ماء' END AS meaning, true AS had_colon FROM documents WHERE doc_id % 5 IN (1, 3) WINDOW w AS (PARTITION BY doc_id // 5 ORDER BY doc_id ROWS UNBOUNDED PRECEDING)"
)
def ocr_entries(spark, d):
    """Five lines to a page: a running head, an entry of two lines, another of
    one, and a blank."""
    i = F.col("doc_id")
    line = F.element_at(F.array(*map(F.lit, ("رأس الصفحة هنا", "مطر: ماء", "سطر آخر", "مطر: ماء", ""))), (i % 5 + 1).cast("int"))
    words = spark.read.parquet(f"{d}/documents.parquet").select(F.floor(i / 5).alias("page"), (i % 5).cast("int").alias("line_num"), F.posexplode(F.filter(F.split(line, " "), lambda x: x != "")).alias("n", "text"))
    head = F.col("line_num").isin(1, 3)
    rows = words.select("page", F.lit(1).alias("block_num"), F.lit(1).alias("par_num"), "line_num", (F.when(head, 1500).otherwise(1200) - F.col("n") * 100).alias("left"), F.col("line_num").alias("top"), F.lit(90.0).alias("conf"), "text")
    return ocr.entries(ocr.lines(rows)).select("page", "headword", "entry", "meaning", "had_colon")


def queries() -> dict:
    return dict(_ALL)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
