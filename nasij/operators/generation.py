"""Samples from recorded model replies: parsing, normalising, first of equals.

No model is called; a reply is a text column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nasij.functions import text as T
from nasij.operators.dedup import first_n

# Spellings of question types, the default, and the ceiling.
TYPES = {
    "cause / why": "Cause/Why", "cause/why": "Cause/Why", "cause - why": "Cause/Why", "contextual meaning": "Contextual Meaning", "contextual-meaning": "Contextual Meaning", "multi-step": "Multi-step",
    "multi_step": "Multi-step", "definition/meaning": "Definition", "definition / meaning": "Definition", "meaning/definition": "Meaning", "meaning / definition": "Meaning",
}
DEFAULT_TYPE, CEILING = "Meaning", 12
# Words by which thinking speaks of the question.
META = (
    "السؤال يسأل",
    "السؤال هنا",
    "لازم نوضح",
    "لازم أجاوب",
    "الجواب الأفضل",
    "المطلوب هو",
    "بناءً على المعلومات",
    "حسب الحقائق",
    "بناءً على النص",
    "حسب النص",
    "the user is asking",
    "i need to find",
    "the text states",
    "i should explain",
)
EXAMPLE = (
    "array<struct<question: string, answer: string, thinking: string, thinking_arabic: string, thinking_english: string, question_type: string, difficulty: string, reasoning_mode: string, reasoning_depth: int, "
    "support_facts: array<string>, knowledge_units: array<string>, required_facts: array<string>, optional_facts: array<string>>>"
)


def question_type(c: Column) -> Column:
    c = T.strip(F.coalesce(c, F.lit("")))
    known = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])
    return F.when(c == "", DEFAULT_TYPE).otherwise(F.coalesce(known[F.lower(c)], c))


def examples(reply: Column) -> Column:
    """The examples of a reply: a list, or an object that holds one; else none."""
    bare = T.strip(F.regexp_replace(T.strip(reply), r"(?i)^```(?:json)?\s*|\s*```$", ""))
    listed = F.when(bare.startswith("["), F.from_json(bare, EXAMPLE)).otherwise(F.from_json(F.get_json_object(bare, "$.examples"), EXAMPLE))
    return F.coalesce(F.when(F.try_parse_json(bare).isNotNull(), listed), F.array().cast(EXAMPLE))


def clean_thinking(c: Column) -> Column:
    """Trimmed, or empty where it speaks of the question instead of the matter."""
    c = T.strip(F.coalesce(c, F.lit("")))
    meta = F.lit(False)
    for m in META:
        meta = meta | F.contains(F.lower(c), F.lit(m))
    return F.when(meta, "").otherwise(c)


def samples(df: DataFrame, chunk: str, reply: str) -> DataFrame:
    """Samples of each chunk: with question and answer, each pair once, at most
    the ceiling, numbered in the order of the reply among those kept."""
    text = lambda c: T.strip(F.coalesce(F.col(f"e.{c}"), F.lit("")))
    listed = lambda c, other: F.coalesce(F.col(f"e.{c}"), other)
    none = F.array().cast("array<string>")
    facts, thinking, arabic = listed("support_facts", none), clean_thinking(F.col("e.thinking")), clean_thinking(F.col("e.thinking_arabic"))
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    said = F.when(thinking != "", F.concat(F.lit("Thinking:\n"), thinking, F.lit("\n\nAnswer:\n"), text("answer"))).otherwise(F.concat(F.lit("Answer:\n"), text("answer")))
    rows = df.select(F.col(chunk).alias("chunk_id"), F.posexplode(examples(F.col(reply))).alias("place", "e")).select(
        "chunk_id", "place", text("question").alias("question"), text("answer").alias("answer"), thinking.alias("thinking"), F.when(arabic != "", arabic).otherwise(thinking).alias("thinking_arabic"),
        text("thinking_english").alias("thinking_english"), F.array(message("user", text("question")), message("assistant", said)).alias("messages"), question_type(F.col("e.question_type")).alias("question_type"),
        F.coalesce("e.difficulty", F.lit("Medium")).alias("difficulty"), F.coalesce("e.reasoning_mode", F.lit("Direct Recall")).alias("reasoning_mode"), F.coalesce("e.reasoning_depth", F.lit(0)).alias("reasoning_depth"),
        facts.alias("support_facts"), F.struct(facts.alias("support_facts"), listed("knowledge_units", none).alias("knowledge_units"), listed("required_facts", facts).alias("required_facts"), listed("optional_facts", none).alias("optional_facts")).alias("teacher_only"),
    )
    kept = first_n(rows.where("question <> '' and answer <> ''"), ["chunk_id"], ["question", "answer"], ["place"], CEILING)
    # at most CEILING rows of a chunk
    number = F.row_number().over(Window.partitionBy("chunk_id").orderBy("place"))
    return kept.withColumn("sample_id", F.format_string("%s_sft_%03d", "chunk_id", number)).withColumn("validation_status", F.lit("UNVERIFIED"))


def regeneration_targets(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Pairs whose two texts are the same and so must be made again."""
    return pairs.where(F.trim(chosen) == F.trim(rejected))
