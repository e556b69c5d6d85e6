"""Rubric scores of question, answer, thinking and grounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nasij.functions import text as T

# Markers, bounds and weights of the rubric.
QUESTION_META = ("السؤال", "لازم", "المطلوب", "بناء", "حسب", "the question", "asking about")
INTERROGATIVES = ("ما", "كيف", "متى", "أين", "من", "أي", "هل", "شنو", "إيش", "ليش")
ANSWER_META = ("النص يقول", "حسب النص", "المصدر", "الكتاب", "البيانات", "بناءً على", "the text", "according to")
TEMPLATES = ("ببساطة", "المقصود", "باختصار", "يعني")
THINKING_META = ("السؤال يسأل", "لازم", "المطلوب", "بناءً على", "حسب", "the question", "i need to")
CONSTANTS = {"factual_correctness": 0.8, "saudi_dialect_quality": 0.7, "complexity_score": 0.5, "diversity_score": 0.5, "information_density": 0.7, "redundancy_score": 0.2, "similarity_to_nearest_sample": 0.5}
CONFIDENCE = {"question": 0.2, "answer": 0.3, "grounding": 0.2, "thinking": 0.15, "base": 0.15}
BATCH_PASS, ACCEPT = 0.6, 0.7
AVERAGE = (0.20, 0.15, 0.15, 0.15, 0.10, 0.10, 0.10, 0.05)


def _any(c: Column, marks: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for m in marks:
        out = out | c.contains(m)
    return out


def _minus(*tests: tuple[Column, float]) -> Column:
    lost = F.lit(0.0)
    for cond, points in tests:
        lost = lost + F.when(cond, points).otherwise(0.0)
    return F.greatest(F.lit(0.0), 1.0 - lost)


def _foreign(c: Column) -> Column:
    return ~c.rlike("[؀-ۿ]")


def question_score(q: Column) -> Column:
    n = T.token_count(q)
    return _minus((n < 3, 0.2), (n > 40, 0.1), (_any(F.lower(q), QUESTION_META), 0.3), (~_any(q, INTERROGATIVES), 0.1), (_foreign(q), 0.5))


def answer_score(a: Column, q: Column) -> Column:
    n = T.token_count(a)
    begins = F.lit(False)
    for t in TEMPLATES:
        begins = begins | a.startswith(t)
    return _minus((n < 5, 0.2), (n > 250, 0.1), (_any(F.lower(a), ANSWER_META), 0.3), (begins, 0.1), (_foreign(a), 0.5), (~F.arrays_overlap(T.words(q), T.words(a)), 0.15))


def thinking_score(t: Column, depth: Column) -> Column:
    n = T.token_count(t)
    scored = _minus(((depth == 0) & (n > 50), 0.2), ((depth == 1) & (n > 100), 0.1), ((depth >= 2) & (n > 200), 0.1), (_any(F.lower(t), THINKING_META), 0.3))
    return F.when(n == 0, F.when(depth == 0, 1.0).otherwise(0.7)).otherwise(scored)


def grounding_score(a: Column, facts: Column) -> Column:
    unseen = F.size(F.filter(facts, lambda f: ~F.arrays_overlap(T.words(f), T.words(a))))
    return F.when(F.coalesce(F.size(facts), F.lit(0)) <= 0, 0.5).otherwise(F.greatest(F.lit(0.0), 1.0 - 0.1 * unseen))


def scored(df: DataFrame, question: Column, answer: Column, thinking: Column, depth: Column, facts: Column) -> DataFrame:
    """All rubric columns and teacher_confidence."""
    q, a, t, g = question_score(question), answer_score(answer, question), thinking_score(F.coalesce(thinking, F.lit("")), depth), grounding_score(answer, facts)
    df = df.withColumn("question_naturalness", q).withColumn("answer_naturalness", a).withColumn("thinking_quality", t).withColumn("support_coverage", g)
    c = F.col
    weight = c("question_naturalness") * 0.2 + c("answer_naturalness") * 0.3 + c("support_coverage") * 0.2 + c("thinking_quality") * 0.15 + 0.15
    df = df.withColumn("response_quality", (c("answer_naturalness") + c("thinking_quality")) / 2).withColumn("teacher_confidence", weight)
    for name, value in CONSTANTS.items():
        df = df.withColumn(name, F.lit(value))
    return df


def average(values: list[Column]) -> Column:
    return sum((v * w for v, w in zip(values, AVERAGE, strict=True)), F.lit(0.0))


def contract_findings(df: DataFrame, key: str, required: list[str], roles: str | None = None) -> DataFrame:
    """key, code, field: empty required fields, repeated keys, bad roles."""
    tests = [F.when(T.strip(F.coalesce(F.col(f).cast("string"), F.lit(""))) == "", F.struct(F.lit("MISSING").alias("code"), F.lit(f).alias("field"))) for f in required]
    if roles:
        odd = F.exists(F.coalesce(F.col(roles), F.array().cast("array<string>")), lambda r: ~r.isin("system", "user", "assistant"))
        tests.append(F.when(odd, F.struct(F.lit("BAD_ROLE").alias("code"), F.lit(roles).alias("field"))))
    bad = df.select(key, F.explode(F.array_compact(F.array(*tests))).alias("x")).select(key, "x.*")
    twice = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key, F.lit("DUPLICATE_ID").alias("code"), F.lit(key).alias("field"))
    return bad.unionByName(twice)
