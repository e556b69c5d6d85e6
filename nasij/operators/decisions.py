"""Decision tables as pure column expressions, one function for each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vocabularies and bounds of the tables.
NUMERIC = ("hijri_year", "gregorian_year", "year_unmarked_era", "page_reference")
PRECISE = ("hijri_year", "gregorian_year", "year_unmarked_era", "page_reference", "entry_headword", "entry_root", "citation_authority")
SEVERITY = {"SUPPORTED": 0, "PARTIAL": 1, "UNSUPPORTED": 2, "CONTRADICTED": 3}
VERDICT_RANK = {"PASS": 0, "NO_FACT_COVERAGE": 1, "REVIEW": 2, "FAIL_CONTRADICTED": 3, "INVALID_RECORD": 4}
HIGH, LOW, TIE = 95.0, 50.0, 5.0
DETECTABLE = {
    "partial_factual_errors": "strong", "less_faithful_reconstruction": "strong", "verbosity": "strong", "missing_information": "partial", "unsupported_additions": "partial",
    "poor_instruction_following": "incidental", "wrong_formatting": "strong", "wrong_register": "none", "weak_organization": "none",
}
DIMENSION = {
    "poor_instruction_following": "instruction_following", "wrong_formatting": "format", "missing_information": "completeness", "unsupported_additions": "grounding", "wrong_register": "arabic_quality",
    "verbosity": "style", "weak_organization": "style", "partial_factual_errors": "factual_consistency", "less_faithful_reconstruction": "grounding",
}
MINIMAL_EDITS = ("partial_factual_errors", "unsupported_additions")
IDENTICAL, DEGENERATE = 0.995, 0.90


def lookup(values: dict, c: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[c]


def band(percentile: Column) -> Column:
    return F.when(percentile >= HIGH, "high").when(percentile < LOW, "low").when(percentile.isNotNull(), "middle")


def combine_sft(fact: Column, where: Column, similar: Column, types: Column) -> Column:
    """struct<verdict, leaning> of the fact verdict, the similarity band,
    whether similarity is known, and the contradicted types."""
    v = lambda a, b: F.struct(F.lit(a).alias("verdict"), (F.lit(b) if not isinstance(b, Column) else b).cast("string").alias("leaning"))
    hard = types.isNull() | (F.size(types) == 0) | F.arrays_overlap(types, F.array(*map(F.lit, PRECISE)))
    lean = F.when(~similar, None).when(where == "high", "pass").when(where == "low", "fail")
    weak = fact.isin("PARTIAL", "UNSUPPORTED")
    return (
        F.when(fact == "UNKNOWN_CHUNK", v("INVALID_RECORD", None)).when((fact == "CONTRADICTED") & hard, v("FAIL_CONTRADICTED", "fail")).when(fact == "CONTRADICTED", v("REVIEW", "fail"))
        .when(fact == "NO_CHECKABLE_CLAIMS", v("NO_FACT_COVERAGE", lean)).when(~similar, v("REVIEW", F.when(fact == "SUPPORTED", "pass").otherwise("fail")))
        .when((fact == "SUPPORTED") & (where == "high"), v("PASS", None)).when((fact == "SUPPORTED") & (where == "low"), v("REVIEW", "fail")).when(fact == "SUPPORTED", v("REVIEW", "pass"))
        .when(weak & (where == "low"), v("REVIEW", "fail")).when(weak & (where == "high"), v("REVIEW", "pass")).otherwise(v("REVIEW", None))
    )


def acceptance(verdict: Column, conforms: Column, declared: Column) -> Column:
    """``conforms`` is null where the format was not validated."""
    return (
        F.when(verdict.isin("INVALID_RECORD", "FAIL_CONTRADICTED"), "REJECT").when(conforms.isNull(), "HOLD_FOR_REVIEW")
        .when(~conforms & (declared == "dictionary_entry"), "REJECT").when(~conforms, "HOLD_FOR_REVIEW").when(verdict == "PASS", "ACCEPT").otherwise("HOLD_FOR_REVIEW")
    )


def compare_percentiles(a: Column, b: Column, grounded_a: Column, grounded_b: Column, margin: float = TIE) -> Column:
    none = ~grounded_a & ~grounded_b
    return F.when(none, "incomparable_ungrounded").when(a.isNull() | b.isNull(), "tie").when(a - b > margin, "a_better").when(b - a > margin, "b_better").otherwise("tie")


def direction(va: Column, vb: Column, pa: Column, pb: Column, ga: Column, gb: Column) -> Column:
    """Which of chosen (a) and rejected (b) is better, and on what evidence."""
    ra, rb = F.coalesce(lookup(VERDICT_RANK, va), F.lit(9)), F.coalesce(lookup(VERDICT_RANK, vb), F.lit(9))
    rel = compare_percentiles(pa, pb, ga, gb)
    return (
        F.when(ra < rb, "chosen_better_verdict").when(rb < ra, "rejected_better_verdict").when(rel == "a_better", "chosen_better_similarity").when(rel == "b_better", "rejected_better_similarity").otherwise("tie")
    )


def degenerate(lexical: Column, kind: Column) -> Column:
    return lexical >= F.when(kind.isin(*MINIMAL_EDITS), IDENTICAL).otherwise(DEGENERATE)


def corroborates(kind: Column, fact_a: Column, fact_b: Column, pa: Column, pb: Column, length: Column, form: Column) -> Column:
    """True, false, or null where the weakness cannot be seen."""
    ahead = F.coalesce((pa - pb) > TIE, F.lit(False))
    bad = ("CONTRADICTED", "UNSUPPORTED")
    return (
        F.when(lookup(DETECTABLE, kind).isin("none", "incidental"), F.lit(None).cast("boolean")).when(kind == "partial_factual_errors", (fact_b == "CONTRADICTED") & (fact_a != "CONTRADICTED"))
        .when(kind == "unsupported_additions", fact_b.isin(*bad) & ~fact_a.isin(*bad)).when(kind == "less_faithful_reconstruction", ahead).when(kind == "wrong_formatting", F.coalesce(form == "chosen_better", F.lit(False)))
        .when(kind == "verbosity", length == "rejected_longer").when(kind == "missing_information", (length == "rejected_shorter") & ahead).otherwise(False)
    )


def triage(way: Column, agrees: Column, length: Column, detect: Column, axis_win: Column, same: Column) -> Column:
    sure = F.coalesce(axis_win & agrees & (detect == "strong"), F.lit(False))
    yes = F.coalesce(agrees, F.lit(False))
    blind = F.coalesce(detect.isin("none", "incidental"), F.lit(False))
    auto, ask, flag = "AUTO_CONFIRM", "NEEDS_JUDGE", "FLAG_SUSPICIOUS"
    tie = F.when(sure, auto).when(yes | (length == "consistent") | blind, ask).otherwise(flag)
    return (
        F.when(same | way.startswith("rejected_better"), flag).when(way == "tie", tie).when(way == "chosen_better_similarity", F.when(sure, auto).otherwise(ask))
        .when(blind | ~yes | (length == "inconsistent"), ask).otherwise(auto)
    )


def adjudicate(triaged: Column, assessment: Column, confidence: Column, way: Column) -> Column:
    """Only what needs a judge changes, and never to a confirmation."""
    against = assessment.isin("rejected_better", "equivalent") & (confidence >= 0.75) & (way != "chosen_better_verdict")
    return F.when((triaged == "NEEDS_JUDGE") & F.coalesce(against, F.lit(False)), "FLAG_SUSPICIOUS").otherwise(triaged)


def judge_sft(dimensions: Column, confidence: Column, failed: Column) -> Column:
    """``dimensions``: map from dimension to its verdict."""
    v = F.map_values(dimensions)
    return F.when(failed | dimensions.isNull(), "ABSTAIN").when(F.array_contains(v, "fail"), "FAIL").when(F.array_contains(v, "review") | (confidence == "low"), "REVIEW").otherwise("PASS")


def settle_sft(accepted: Column, judged: Column) -> Column:
    """A judge never lifts what the rules reject or hold, and can only hold."""
    return F.when(accepted == "REJECT", "REJECT").when((accepted == "ACCEPT") & (F.coalesce(judged, F.lit("")) == "PASS"), "ACCEPT").otherwise("HOLD_FOR_REVIEW")


def settle_dpo(triaged: Column, judged: Column) -> Column:
    return F.when(triaged == "FLAG_SUSPICIOUS", "FLAGGED").when(F.coalesce(judged, F.lit("")) == "PASS", "CONFIRMED").otherwise("NEEDS_HUMAN")


def assessment_verdict(assessment: Column, biased: Column) -> Column:
    return F.when(assessment.isNull(), "ABSTAIN").when(biased, "REVIEW").when(assessment == "chosen_better", "PASS").when(assessment == "rejected_better", "FAIL").otherwise("REVIEW")


def slot(record: Column) -> Column:
    """A or B for the chosen text: parity of the first byte of the id's hash."""
    return F.when(F.conv(F.substring(F.sha2(record, 256), 1, 2), 16, 10).cast("int") % 2 == 0, "A").otherwise("B")


def cache_key(model: Column, system: Column, user: Column) -> Column:
    nul = F.lit("\u0000")
    return F.substring(F.sha2(F.concat(model, nul, system, nul, user, nul), 256), 1, 32)
