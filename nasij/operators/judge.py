"""Adjudication by an injected judge: recorded replies joined on a prompt hash.

No model is called here. Replies are rows (key, reply); a reply is parsed with
tolerance, held to its contract and folded into verdicts.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nasij.functions import text as T
from nasij.operators.decisions import DETECTABLE, DIMENSION, cache_key, lookup

# The reply contract's words and fields, and those of a suite.
SCHEMA = "judge-1"
ASSESSMENTS = ("chosen_better", "rejected_better", "equivalent", "undetermined")
MIRROR = {"chosen_better": "rejected_better", "rejected_better": "chosen_better", "equivalent": "equivalent", "undetermined": "undetermined"}
SOURCES = ("rejected", "chosen", "source")
RESERVED = ("verdict", "judge_verdict", "AUTO_CONFIRM", "auto_confirm", "NEEDS_JUDGE", "needs_judge", "FLAG_SUSPICIOUS", "flag_suspicious")
REQUIRED = ("schema_version", "judge_model_version", "assessment", "weakness_present", "rejection_type", "type_scores", "confidence", "evidence")
ASKED_FIELDS = ("prompt", "chosen", "rejected", "source_chunk_id", "source_region", "model_version")
SFT_PROBE = ("label", "source_chunk_id", "instruction", "response", "format_type", "expect_verdict")
DPO_PROBE = ("label", "prompt", "chosen", "rejected", "source_chunk_id", "rejection_type", "expect_verdict")
DIMENSIONS = ("grounding", "completeness", "format_correctness", "arabic_quality")
EXPECTED = ("PASS", "FAIL", "REVIEW")
HELD_CHUNK, HELD_FILE = "dialect_dict_", "saudi_dialect"


def parsed(reply: Column) -> Column:
    """The reply's JSON text: as it is, from a fence, or from its outer braces."""
    fenced = F.regexp_extract(reply, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    outer = F.regexp_extract(reply, r"(?s)(\{.*\})", 1)
    ok = lambda c: F.when(F.try_parse_json(c).isNotNull() & c.rlike(r"^\s*\{"), c)
    return F.coalesce(ok(reply), ok(fenced), ok(outer))


def parse_state(reply: Column, required: list[str]) -> Column:
    """ok, incomplete or unparseable."""
    body = parsed(reply)
    there = F.size(F.array_except(F.array(*map(F.lit, required)), F.json_object_keys(body))) == 0
    return F.when(body.isNull(), "unparseable").when(there, "ok").otherwise("incomplete")


def replayed(df: DataFrame, model: Column, system: Column, user: Column, recorded: DataFrame) -> DataFrame:
    """Adds prompt_key and the recorded reply, null if there is none."""
    return df.withColumn("prompt_key", cache_key(model, system, user)).join(recorded.select(F.col("key").alias("prompt_key"), "reply"), "prompt_key", "left")


def asked(df: DataFrame, user: str, backend: Callable[[str], str | None]) -> DataFrame:
    """Adds the reply of a live backend, a function given by the caller."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", reply string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rows.assign(reply=[backend(u) for u in rows[user]])

    return df.mapInPandas(run, fields)


def contract_findings(df: DataFrame, key: str, assessment: str, confidence: str, weakness: str, evidence: str) -> DataFrame:
    """key, code: words out of the contract, numbers out of range, quotes that
    are no literal part of their source, a weakness without evidence.

    ``evidence``: array<struct<quote, source_text>>.
    """
    loose = F.exists(F.col(evidence), lambda e: ~F.contains(F.coalesce(e["source_text"], F.lit("")), e["quote"]))
    tests = F.array(
        F.when(~F.coalesce(F.col(assessment).isin(*ASSESSMENTS), F.lit(False)), "BAD_ASSESSMENT"), F.when(~F.coalesce(F.col(confidence).between(0, 1), F.lit(False)), "BAD_CONFIDENCE"),
        F.when(loose, "QUOTE_NOT_IN_SOURCE"), F.when(F.col(weakness) & (F.coalesce(F.size(evidence), F.lit(0)) <= 0), "WEAKNESS_WITHOUT_EVIDENCE"),
    )
    return df.select(key, F.explode(F.array_compact(tests)).alias("code"))


def swap_checked(first: Column, swapped: Column) -> tuple[Column, Column]:
    """The assessment and whether the order decided it: a second pass with the
    sides exchanged must give the mirrored answer."""
    biased = first.isNotNull() & swapped.isNotNull() & (lookup(MIRROR, swapped) != first)
    return F.when(biased, "undetermined").otherwise(first), F.coalesce(biased, F.lit(False))


class JudgeError(Exception):
    """A failure of a live judge; the class's name is the error's type."""


class TimeoutError(JudgeError):  # noqa: A001
    """No answer in time."""


class RateLimited(JudgeError):
    """Too many calls."""


class ProviderError(JudgeError):
    """Any other refusal, or an empty answer."""


def patient(backend: Callable[[str], str | None], retries: int = 2, wait: Callable[[float], None] = time.sleep) -> Callable[[str], str]:
    """A backend that asks again after a lapse or a limit, with growing pauses
    of at most eight seconds; other errors are not tried again."""

    def ask(user: str) -> str:
        for attempt in range(retries + 1):
            try:
                reply = backend(user)
            except (TimeoutError, RateLimited):
                if attempt == retries:
                    raise
                wait(min(2**attempt, 8))
            else:
                if not (reply or "").strip():
                    raise ProviderError("empty reply")
                return reply
        raise ProviderError("not asked")

    return ask


def asked_typed(df: DataFrame, user: str, backend: Callable[[str], str | None], retries: int = 2) -> DataFrame:
    """Adds reply and error_type, one of which is null: no failure ends the job."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", reply string, error_type string"

    def one(ask: Callable[[str], str], prompt: str) -> tuple[str | None, str | None]:
        try:
            return ask(prompt), None
        except JudgeError as e:
            return None, type(e).__name__

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = patient(backend, retries)
        for rows in batches:
            got = [one(ask, u) for u in rows[user]]
            yield rows.assign(reply=[r for r, _ in got], error_type=[e for _, e in got])

    return df.mapInPandas(run, fields)


def corroborated(declared: Column, judged: Column) -> Column:
    """Whether the weakness that the judge names, without knowing the declared
    one, is of the same dimension; null if either is unknown."""
    return lookup(DIMENSION, declared) == lookup(DIMENSION, judged)


def reply_codes(reply: Column, chosen: Column, rejected: Column, source: Column) -> Column:
    """What a reply breaks of its contract, in the order of the tests.

    A reply is JSON as it stands: no fence is taken off. A null reply has no
    codes. Quotes must be literal parts of what they are taken from.
    """
    return T.let(F.try_parse_json(reply), lambda v: _codes(v, reply, chosen, rejected, source))


def _codes(v: Column, reply: Column, chosen: Column, rejected: Column, source: Column) -> Column:
    """Codes of a reply that is parsed as ``v``."""
    kinds = list(DETECTABLE)

    def number(x: Column, kind: Column) -> Column:
        return F.coalesce(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)") & F.try_variant_get(x, "$", "double").between(0, 1), F.lit(False))

    def loose(e: Column) -> Column:
        """A piece of evidence that does not hold."""
        word = lambda f: F.coalesce(F.try_variant_get(e, f"$.{f}", "string"), F.lit(""))
        place = word("quote_from")
        body = F.when(place == "chosen", chosen).when(place == "rejected", rejected).when(place == "source", source)
        held = F.coalesce(F.contains(body, word("quote")), F.lit(False))
        return (word("claim") == "") | (word("quote") == "") | ~place.isin(*SOURCES) | ~held | ~word("explains_type").isin("", *kinds)

    def tests(v: Column) -> Column:
        part = lambda f: F.try_variant_get(v, f"$.{f}", "variant")
        kind = lambda f: F.coalesce(F.schema_of_variant(part(f)), F.lit("VOID"))
        said = lambda f: F.try_variant_get(v, f"$.{f}", "string")
        among = lambda f, words: F.coalesce((kind(f) == "STRING") & said(f).isin(*words), F.lit(False))
        keys = F.json_object_keys(reply)
        words = lambda names: F.array(*map(F.lit, names))
        scores = F.map_entries(F.try_variant_get(v, "$.type_scores", "map<string,variant>"))
        off = F.exists(scores, lambda e: ~e["key"].isin(*kinds) | ~number(e["value"], F.schema_of_variant(e["value"])))
        listed = F.try_variant_get(v, "$.evidence", "array<variant>")
        found = [
            (F.arrays_overlap(keys, words(RESERVED)), "RESERVED_FIELD"), (F.size(F.array_except(words(REQUIRED), keys)) > 0, "MISSING_FIELD"), (~among("schema_version", [SCHEMA]), "BAD_SCHEMA"),
            (~among("assessment", ASSESSMENTS), "BAD_ASSESSMENT"), (kind("weakness_present") != "BOOLEAN", "BAD_WEAKNESS"), ((kind("rejection_type") != "VOID") & ~among("rejection_type", kinds), "BAD_REJECTION_TYPE"),
            (~kind("rejection_type_agrees_with_record").isin("VOID", "BOOLEAN"), "BAD_AGREEMENT"), (~F.startswith(kind("type_scores"), F.lit("OBJECT")) | F.coalesce(off, F.lit(False)), "BAD_TYPE_SCORES"),
            (~number(part("confidence"), kind("confidence")), "BAD_CONFIDENCE"), (~F.startswith(kind("evidence"), F.lit("ARRAY")) | F.coalesce(F.exists(listed, loose), F.lit(False)), "BAD_EVIDENCE"),
            (F.coalesce(F.try_variant_get(v, "$.weakness_present", "boolean"), F.lit(False)) & (F.coalesce(F.size(listed), F.lit(0)) <= 0), "WEAKNESS_WITHOUT_EVIDENCE"), (~kind("notes").isin("VOID", "STRING"), "BAD_NOTES"),
        ]
        return F.array_compact(F.array(*[F.when(t, c) for t, c in found]))

    none = F.array().cast("array<string>")
    object_ = F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))
    return F.when(reply.isNull(), none).when(v.isNull(), F.array(F.lit("INVALID_JSON"))).when(~object_, F.array(F.lit("NOT_AN_OBJECT"))).otherwise(tests(v))


def judged(reply: Column, declared: Column, chosen: Column, rejected: Column, source: Column) -> Column:
    """One pass: struct<status, error_type, code, assessment, confidence,
    judged_type, corroborated>; all but the first three are null unless ok. A
    reply is parsed once, and its codes are told once."""
    first = lambda v: F.get(_codes(v, reply, chosen, rejected, source), F.lit(0))
    both = T.let(F.try_parse_json(reply), lambda v: F.struct(v.alias("v"), first(v).alias("code")))
    return T.let(both, lambda x: _judgement(x["v"], x["code"], reply, declared))


def _judgement(v: Column, code: Column, reply: Column, declared: Column) -> Column:
    error = F.when(reply.isNull(), "ProviderError").when(code == "INVALID_JSON", "InvalidJSON").when(code.isNotNull(), "InvalidJudgeOutput")
    ok = error.isNull()
    kind = F.when(ok, F.try_variant_get(v, "$.rejection_type", "string"))
    return F.struct(
        F.when(ok, "ok").otherwise("unavailable").alias("status"), error.alias("error_type"), code.alias("code"), F.when(ok, F.try_variant_get(v, "$.assessment", "string")).alias("assessment"),
        F.when(ok, F.try_variant_get(v, "$.confidence", "double")).alias("confidence"), kind.alias("judged_type"), corroborated(declared, kind).alias("corroborated"),
    )


def bad_input(df: DataFrame) -> Column:
    """Whether a pair must not be put to a judge: an empty field or source, or a
    kind of rejection that is not known."""
    empty = F.lit(False)
    for f in ASKED_FIELDS:
        empty = empty | (F.coalesce(F.col(f), F.lit("")) == "")
    return empty | ~F.coalesce(F.col("source_text"), F.lit("")).rlike(r"(?U)\S") | ~F.coalesce(F.col("rejection_type").isin(*DETECTABLE), F.lit(False))


def judged_pairs(df: DataFrame, first: str, swapped: str) -> DataFrame:
    """Adds ``judge``, what ``judged`` gives of the reply in ``first``.

    A kind of rejection that nothing else sees needs the reply of a second pass
    with the sides exchanged, and both must agree once that one is mirrored.
    """
    kind, a, b, s = (F.col(c) for c in ("rejection_type", "chosen", "rejected", "source_text"))
    twice = lookup(DETECTABLE, kind) == "none"
    # no other row asks for its second reply
    rows = df.withColumn("_one", judged(F.col(first), kind, a, b, s)).withColumn("_two", F.when(twice, judged(F.col(swapped), kind, b, a, s)))
    apart = lookup(MIRROR, F.col("_two.assessment")) != F.col("_one.assessment")
    error = (
        F.when(bad_input(df), "InvalidJudgeInput").when(F.col("_one.status") != "ok", F.col("_one.error_type"))
        .when(twice & (F.col("_two.status") != "ok"), "SwapPassUnavailable").when(twice & apart, "PositionBias")
    )
    kept = [F.when(error.isNull(), F.col(f"_one.{c}")).alias(c) for c in ("assessment", "confidence", "judged_type", "corroborated")]
    return rows.withColumn("judge", F.struct(F.when(error.isNull(), "ok").otherwise("unavailable").alias("status"), error.alias("error_type"), *kept)).drop("_one", "_two")


def suite_verdict(judge: Column) -> Column:
    """A refusal for position bias is a finding on the judge, not a silence."""
    said = judge["assessment"]
    return F.when(judge["error_type"] == "PositionBias", "REVIEW").when(judge["status"] != "ok", "ABSTAIN").when(said == "chosen_better", "PASS").when(said == "rejected_better", "FAIL").otherwise("REVIEW")


def dashboard(df: DataFrame, unified: str, markers: Column) -> DataFrame:
    """A row of a report for each judged pair. The judge counts only where the
    rules need one; ``markers`` (dialect words of the rejected side) go along as
    a support and decide nothing."""
    called = F.col(unified) == "NEEDS_JUDGE"
    judge = F.col("judge")
    there = called & (judge["status"] == "ok")
    register = F.when(there & (F.col("rejection_type") == "wrong_register"), F.struct(judge["corroborated"].alias("agrees"), markers.alias("markers")))
    return df.select(
        "rejection_type", "source_chunk_id", "source_region", F.col(unified).alias("unified_verdict"), called.alias("llm_called"), F.when(called, judge["status"]).otherwise("not_called").alias("judge_status"),
        *[F.when(called, judge[c]).alias(c) for c in ("error_type", "assessment", "confidence", "judged_type", "corroborated")], there.alias("factual_available"), markers.alias("dialect_markers"), register.alias("register_signals"),
    )


def _problems(rows: DataFrame, suite: str, fields: tuple[str, ...], chunks: DataFrame | None, own: list[Column]) -> DataFrame:
    """Problems of single probes; ``own`` are those of the suite."""
    bad = lambda test, code, what: F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(code).alias("code"), what.cast("string").alias("what")))
    text = lambda f: F.coalesce(F.col(f).cast("string"), F.lit(""))
    chunk = F.col("source_chunk_id")
    found = [bad(text(f) == "", "MISSING", F.lit(f)) for f in fields]
    found.append(bad(~text("expect_verdict").isin(*EXPECTED), "BAD_VERDICT", F.col("expect_verdict")))
    if chunks is not None:
        rows = rows.join(chunks.select(F.col("chunk_id").alias("source_chunk_id"), F.lit(True).alias("_known")).distinct(), "source_chunk_id", "left")
        found.append(bad(F.col("_known").isNull(), "UNKNOWN_CHUNK", chunk))
    found += [bad(test, code, what) for test, code, what in own]
    found.append(bad(F.startswith(chunk, F.lit(HELD_CHUNK)) & ~F.contains(text("fixture"), F.lit(HELD_FILE)), "RIGHTS", chunk))
    return rows.select(F.lit(suite).alias("suite"), F.coalesce("label", F.lit("?")).alias("label"), F.explode(F.array_compact(F.array(*found))).alias("x")).select("suite", "label", "x.*")


def suite_problems(sft: DataFrame, dpo: DataFrame, chunks: DataFrame | None = None) -> DataFrame:
    """suite, label, code, what: why a suite of probes would not measure a judge.

    Probes hold the fields of ``SFT_PROBE`` or ``DPO_PROBE``, ``fixture`` (their
    file), and ``expect_fail_dimensions`` (array) or
    ``expect_corroborating_dimension``. Problems of a whole suite have no label.
    """
    fails = F.coalesce(F.col("expect_fail_dimensions"), F.array().cast("array<string>"))
    odd = F.array_except(fails, F.array(*map(F.lit, DIMENSIONS)))
    want = F.col("expect_verdict")
    one = _problems(sft, "SFT", SFT_PROBE, chunks, [
        (F.size(odd) > 0, "UNKNOWN_DIMENSION", F.array_join(odd, ",")), ((want == "PASS") & (F.size(fails) > 0), "PASS_WITH_FAILURES", F.array_join(fails, ",")), ((want == "FAIL") & (F.size(fails) == 0), "FAIL_WITHOUT_DIMENSION", F.lit("")),
    ])
    kind, dimension = F.col("rejection_type"), F.col("expect_corroborating_dimension")
    two = _problems(dpo, "DPO", DPO_PROBE, chunks, [
        (~F.coalesce(kind.isin(*DETECTABLE), F.lit(False)), "BAD_TYPE", kind), (lookup(DIMENSION, kind).isNotNull() & ~dimension.eqNullSafe(lookup(DIMENSION, kind)), "WRONG_DIMENSION", dimension),
    ])
    unseen = [k for k, how in DETECTABLE.items() if how == "none"]
    whole = lambda test, suite, code, what: F.when(test, F.struct(F.lit(suite).alias("suite"), F.lit(None).cast("string").alias("label"), F.lit(code).alias("code"), F.lit(what).alias("what")))
    split = lambda rows: F.count_if(~rows.eqNullSafe(F.lit("PASS"))) == 0
    few = [whole(F.count_if(kind == k) < 2, "DPO", "TOO_FEW_PROBES", k) for k in unseen]
    of_sft = sft.agg(F.array_compact(F.array(whole(split(want), "SFT", "ALL_PASS", ""))).alias("x"))
    of_dpo = dpo.agg(F.array_compact(F.array(*few, whole(F.count(F.lit(1)) == 0, "DPO", "NO_TYPES", ""), whole(split(want), "DPO", "ALL_PASS", ""))).alias("x"))
    all_ = of_sft.unionByName(of_dpo).select(F.explode("x").alias("x")).select("x.*")
    return one.unionByName(two).unionByName(all_)


def dry_run_cost(df: DataFrame, prompt: Column, calls: Column, reply_tokens: int = 300, by: list[str] | None = None) -> DataFrame:
    """Calls and estimated tokens: a third of the letters, and a fixed reply."""
    return df.groupBy(*(by or [])).agg(F.sum(calls).alias("calls"), F.sum(calls * F.ceil(F.length(prompt) / 3)).alias("tokens_in"), F.sum(calls * reply_tokens).alias("tokens_out"))
