"""Structure of responses: features, conformance, length, encoding, secrets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nasij.functions import text as T
from nasij.operators.chunk import FOOTNOTE, LIST_MARKER

# Patterns and bounds of the format rules.
MARKED = r"[\(\"«“][^\)\"»”\n]{1,30}[\)\"»”]"
GLOSS = r"معناه|معناها|تعني|يعني|بمعنى|أي\s|وهي\s|وهو\s|هي\s|هو\s|يقال"
COLON_ENTRY = r"(?U)^\s*[^\s:]{2,20}\s*:\s*\S"
SENTENCE = r"[.؟!؛]"
FORMATS = ("dictionary_entry", "list", "footnote_block", "prose", "narrative_paragraph", "verse")
GLOSS_CHARS, VERSE_WORDS = 60, 12
LONGER, SHORTER = 1.4, 0.7
EXPECTED_LENGTH = {"verbosity": "rejected_longer", "missing_information": "rejected_shorter"}
ORTHOGRAPHY_WORDS = 25
# Shapes of secrets.
SECRETS = {
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "aws_access_key": r"\bAKIA[0-9A-Z]{16}\b",
    "github_token": r"\bgh[pousr]_[A-Za-z0-9]{36,}\b",
    "bearer_token": r"(?i)\bbearer\s+[A-Za-z0-9._-]{20,}",
    "assigned_secret": r"(?i)\b(?:api[_-]?key|secret|token|password)\b\s*[:=]\s*\S{8,}",
}
# Common dialect words, a supporting signal only.
DIALECT_MARKERS = ("هالجذر", "هاللفظ", "هالكلمة", "يعني", "بس", "مش", "إيش", "ليش", "شو", "اللي", "عشان", "كده", "دلوقتي", "إزاي", "وايد", "زين", "شلون", "شنو", "ماكاين", "بزاف", "واش")


def dialect_markers(c: Column, markers: tuple[str, ...] = DIALECT_MARKERS, letters: str = "[\u0621-\u064A\u0660-\u0669]") -> Column:
    """The marker words in a text, whole words in their order, each once."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(letters + "+"), F.lit(0))
    return F.array_intersect(found, F.array(*map(F.lit, markers)))


def lines(c: Column) -> Column:
    return F.filter(F.split(c, "\r\n|[\n\r\u000b\u000c\u0085  ]"), lambda x: x.rlike(r"(?U)\S"))


def features(c: Column) -> Column:
    """struct of line, list, note, lemma, entry, sentence and word figures."""
    c = F.coalesce(c, F.lit(""))
    n = F.size(lines(c))
    some = F.greatest(n, F.lit(1))
    share = lambda p: F.size(F.filter(lines(c), lambda x: x.rlike("(?U)" + p))) / some
    # a marked lemma with a colon right behind it, or a connective soon after
    entry = rf"(?U){MARKED}(?=\s*[:：]|(?s:.{{0,{GLOSS_CHARS - 8}}}?)(?:{GLOSS}))"
    words = T.token_count(c)
    return F.struct(
        n.cast("long").alias("n_lines"), words.alias("n_words"), share(LIST_MARKER).alias("list_ratio"), share(FOOTNOTE).alias("footnote_ratio"), F.regexp_count(c, F.lit(MARKED)).cast("long").alias("marked_lemmas"),
        F.regexp_count(c, F.lit(entry)).cast("long").alias("entry_units"), F.size(F.filter(lines(c), lambda x: x.rlike(COLON_ENTRY))).cast("long").alias("colon_entries"),
        F.regexp_count(c, F.lit(SENTENCE)).cast("long").alias("sentence_marks"), F.when(n > 0, words / some).otherwise(0.0).alias("words_per_line"),
    )


def conformance(c: Column, declared: Column) -> Column:
    """match, mismatch, unknown_format or empty."""
    f = features(c)
    ok = (
        F.when(declared == "dictionary_entry", (f["entry_units"] >= 1) | (f["colon_entries"] >= 1)).when(declared == "list", f["list_ratio"] >= 0.5).when(declared == "footnote_block", f["footnote_ratio"] >= 0.5)
        .when(declared == "verse", (f["n_lines"] >= 2) & (f["words_per_line"] <= VERSE_WORDS) & (f["list_ratio"] < 0.5))
        .otherwise((f["sentence_marks"] >= 1) & (f["list_ratio"] < 0.5) & (f["footnote_ratio"] < 0.5))
    )
    blank = ~F.coalesce(c, F.lit("")).rlike(r"(?U)\S")
    return F.when(blank, "empty").when(~F.coalesce(declared.isin(*FORMATS), F.lit(False)), "unknown_format").when(ok, "match").otherwise("mismatch")


def compare(chosen: Column, rejected: Column, declared: Column) -> Column:
    a, b = conformance(chosen, declared), conformance(rejected, declared)
    return (
        F.when((a == "unknown_format") | (b == "unknown_format"), "undecidable").when((a == "match") & (b != "match"), "chosen_better")
        .when((b == "match") & (a != "match"), "rejected_better").when(a == "match", "both_match").otherwise("both_mismatch")
    )


def length_signal(chosen: Column, rejected: Column) -> Column:
    r = T.token_count(rejected) / F.greatest(T.token_count(chosen), F.lit(1))
    return F.when(r >= LONGER, "rejected_longer").when(r <= SHORTER, "rejected_shorter").otherwise("similar")


def length_consistency(kind: Column, signal: Column) -> Column:
    """consistent, inconsistent, or not_applicable for kinds without a bound."""
    want = F.create_map(*[F.lit(x) for kv in EXPECTED_LENGTH.items() for x in kv])[kind]
    return F.when(want.isNull(), "not_applicable").when(want == signal, "consistent").otherwise("inconsistent")


def encoding_findings(c: Column, composed: Column | None = None, repaired: Column | None = None) -> Column:
    """array<struct<code, severity>>; the two costly tests only if their columns
    (composed and repaired text) are given."""
    code = lambda cond, name, level: F.when(cond, F.struct(F.lit(name).alias("code"), F.lit(level).alias("severity")))
    tests = [code(c.contains("�"), "REPLACEMENT_CHAR", "ERROR"), code(c.rlike(r"[\p{Cc}&&[^\n\t]]"), "CONTROL_CHARS", "ERROR"), code(c.rlike(f"[{T.OCR_CONTROLS}]"), "INVISIBLE_CHARS", "WARN")]
    if composed is not None:
        tests.append(code(c != composed, "NOT_NFC", "WARN"))
    if repaired is not None:
        tests.append(code(c != repaired, "MOJIBAKE", "ERROR"))
    return F.array_compact(F.array(*tests))


def folded_orthography(c: Column) -> Column:
    """Long enough text without any of the letter variants: it was folded."""
    return (T.token_count(c) >= ORTHOGRAPHY_WORDS) & (F.regexp_count(c, F.lit(f"[{T.ALEF_FORMS}{T.YA_FORMS}]")) == 0)


def record_findings(df: DataFrame, line: str, raw: str, required: list[str]) -> DataFrame:
    """line, code, field: BAD_JSON, NOT_AN_OBJECT, MISSING_FIELD, EMPTY_FIELD."""
    v = F.try_parse_json(F.col(raw))
    kind = F.schema_of_variant(v)
    per = [
        F.when(~F.array_contains(F.json_object_keys(F.col(raw)), f), F.struct(F.lit("MISSING_FIELD").alias("code"), F.lit(f).alias("field")))
        .when(F.coalesce(F.trim(F.get_json_object(F.col(raw), f"$.{f}")), F.lit("")) == "", F.struct(F.lit("EMPTY_FIELD").alias("code"), F.lit(f).alias("field")))
        for f in required
    ]
    one = lambda c: F.array(F.struct(F.lit(c).alias("code"), F.lit(None).cast("string").alias("field")))
    found = F.when(v.isNull(), one("BAD_JSON")).when(~kind.startswith("OBJECT"), one("NOT_AN_OBJECT")).otherwise(F.array_compact(F.array(*per)))
    return df.where(F.trim(raw) != "").select(line, F.explode(found).alias("x")).select(line, "x.code", "x.field")


def secret_findings(df: DataFrame, key: str, text: str, entropy_bits: float = 3.5, entropy_chars: int = 20) -> DataFrame:
    """key, rule, n: shapes of secrets, and assigned values of high entropy."""
    hits = F.array(*[F.struct(F.lit(k).alias("rule"), F.regexp_count(F.col(text), F.lit(p)).cast("long").alias("n")) for k, p in SECRETS.items()])
    values = F.regexp_extract_all(F.col(text), F.lit(rf"=\s*[\"']?([A-Za-z0-9+/_=-]{{{entropy_chars},}})"), F.lit(1))
    dense = F.size(F.filter(values, lambda x: T.entropy(x) >= entropy_bits)).cast("long")
    return df.select(key, F.explode(F.array_append(hits, F.struct(F.lit("high_entropy").alias("rule"), dense.alias("n")))).alias("x")).select(key, "x.*").where("n > 0")


def arabic_runs(df: DataFrame, key: str, text: str, least: int = 2) -> DataFrame:
    """key, run, words: runs of at least two Arabic words, as audit keys."""
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[ء-ي{T.MARKS}{T.TATWEEL}]+(?:\\s+[ء-ي{T.MARKS}{T.TATWEEL}]+)*"), F.lit(0))
    keys = F.filter(F.transform(runs, T.audit_key), lambda r: T.token_count(r) >= least)
    return df.select(key, F.explode(F.array_distinct(keys)).alias("run")).withColumn("words", T.token_count(F.col("run")))


def audit(runs: DataFrame, held: DataFrame, public: DataFrame, text: str, allow: list[str]) -> DataFrame:
    """Runs that a held corpus contains: HELD_ONLY or ALSO_IN_PUBLIC.

    Containment is tested by shared two-word shingles first, so that a run is
    compared only with texts that hold its opening.
    """
    def within(corpus: DataFrame) -> DataFrame:
        body = corpus.select(T.audit_key(F.col(text)).alias("t"))
        w = T.words(F.col("t"))
        pairs = body.select("t", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, F.lit(2)), " ")))).alias("p"))
        r = runs.select("run").distinct().withColumn("p", F.array_join(F.slice(T.words(F.col("run")), 1, 2), " "))
        return r.join(pairs, "p").where(F.concat(F.lit(" "), F.col("t"), F.lit(" ")).contains(F.concat(F.lit(" "), F.col("run"), F.lit(" ")))).select("run").distinct()

    found = runs.where(~F.col("run").isin(allow)).join(within(held), "run", "left_semi")
    return found.join(within(public).withColumn("_p", F.lit(True)), "run", "left").withColumn("status", F.when(F.col("_p"), "ALSO_IN_PUBLIC").otherwise("HELD_ONLY")).drop("_p")
