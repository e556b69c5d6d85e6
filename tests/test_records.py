import difflib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from nasij.operators import decisions, dedup, facts, formats, judge, leakage, ocr, quality, similarity
from nasij.plans import jobs


def one(spark, col, **values):
    kinds = {bool: "boolean", float: "double", int: "int", str: "string", list: "array<string>", dict: "map<string,string>"}
    schema = ", ".join(f"{k} {kinds[type(v)] if v is not None else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(col.alias("r")).first()["r"]


# --- formats


@pytest.mark.parametrize(
    ("text", "form", "want"),
    [
        ("", "prose", "empty"), ("نص", "poem", "unknown_format"), ("نص", None, "unknown_format"), ("جملة تامة.", "prose", "match"), ("بلا علامة", "narrative_paragraph", "mismatch"),
        ("- أ\n- ب", "list", "match"), ("أ\nب", "list", "mismatch"), ("^(1) ح", "footnote_block", "match"), ("شطر أول\nشطر ثان", "verse", "match"), ("سطر واحد", "verse", "mismatch"),
        ("«كلمة» : معنى", "dictionary_entry", "match"), ("(كلمة) وهي كذا", "dictionary_entry", "match"), ("كلمة: شرحها", "dictionary_entry", "match"), ("كلام (كلمة) بلا شرح", "dictionary_entry", "mismatch"),
    ],
)
def test_conformance(spark, text, form, want):
    df = spark.createDataFrame([(text, form)], "t string, f string")
    assert df.select(formats.conformance(F.col("t"), F.col("f"))).first()[0] == want


def test_compare_and_length(spark):
    df = spark.createDataFrame([("- أ\n- ب", "نص", "list"), ("نص", "- أ", "list"), ("- أ", "- ب", "list"), ("x", "y", "list"), ("x", "y", "odd")], "a string, b string, f string")
    assert [r[0] for r in df.select(formats.compare(F.col("a"), F.col("b"), F.col("f"))).collect()] == ["chosen_better", "rejected_better", "both_match", "both_mismatch", "undecidable"]
    df = spark.createDataFrame([("a b c d e", "a b c d e f g"), ("a b c d e f g h i j", "a b c d e f g"), ("a b", "c d")], "a string, b string")
    assert [r[0] for r in df.select(formats.length_signal(F.col("a"), F.col("b"))).collect()] == ["rejected_longer", "rejected_shorter", "similar"]


def test_encoding_records_secrets_and_audit(spark):
    df = spark.createDataFrame([("a�\u0007​",), ("good",)], "t string")
    assert [[x["code"] for x in r[0]] for r in df.select(formats.encoding_findings(F.col("t"))).collect()] == [["REPLACEMENT_CHAR", "CONTROL_CHARS", "INVISIBLE_CHARS"], []]
    folded = spark.createDataFrame([("كلمه " * 30,), ("كلمه " * 29 + "أب",), ("كلمه",)], "t string")
    assert [r[0] for r in folded.select(formats.folded_orthography(F.col("t"))).collect()] == [True, False, False]
    lines = spark.createDataFrame([(1, '{"a": "x", "b": " "}'), (2, "[1]"), (3, "{bad"), (4, "  "), (5, '{"b": "y"}')], "n int, raw string")
    assert {tuple(r) for r in formats.record_findings(lines, "n", "raw", ["a", "b"]).collect()} == {(1, "EMPTY_FIELD", "b"), (2, "NOT_AN_OBJECT", None), (3, "BAD_JSON", None), (5, "MISSING_FIELD", "a")}
    env = spark.createDataFrame([("e", "KEY=q8Zr2Lw9Xv4Tb7Nc1Md5\nAKIA" + "ABCDEFGHIJKLMNOP"), ("f", "A=aaaaaaaaaaaaaaaaaaaaaaaa")], "p string, t string")
    assert {(r["p"], r["rule"]) for r in formats.secret_findings(env, "p", "t").collect()} == {("e", "aws_access_key"), ("e", "high_entropy")}
    runs = formats.arabic_runs(spark.createDataFrame([("f", "x = 'قال الرجل الصالح' + 'كلمة'")], "p string, t string"), "p", "t")
    held, public = spark.createDataFrame([("ثم قَال الرجل الصالح كذا",)], "t string"), spark.createDataFrame([("قال الرجل",)], "t string")
    assert [(r["run"], r["status"]) for r in formats.audit(runs, held, public, "t", []).collect()] == [("قال الرجل الصالح", "HELD_ONLY")]


# --- decisions, against tables written down cell by cell


def combine(fact, band, similar, hard):
    if fact == "UNKNOWN_CHUNK":
        return "INVALID_RECORD", None
    if fact == "CONTRADICTED":
        return ("FAIL_CONTRADICTED" if hard else "REVIEW"), "fail"
    lean = {"high": "pass", "low": "fail"}.get(band) if similar else None
    if fact == "NO_CHECKABLE_CLAIMS":
        return "NO_FACT_COVERAGE", lean
    if not similar:
        return "REVIEW", "pass" if fact == "SUPPORTED" else "fail"
    if fact == "SUPPORTED":
        return {"high": ("PASS", None), "low": ("REVIEW", "fail")}.get(band, ("REVIEW", "pass"))
    return "REVIEW", lean


def test_sft_table(spark):
    kinds = ["SUPPORTED", "PARTIAL", "UNSUPPORTED", "CONTRADICTED", "NO_CHECKABLE_CLAIMS", "UNKNOWN_CHUNK"]
    rows = [(f, p, t) for f in kinds for p in (None, 10.0, 49.9, 50.0, 94.9, 95.0) for t in (None, [], ["entry_root"], ["gloss", "hijri_year"], ["gloss"], ["region_claim", "cross_dialect_reference"])]
    df = spark.createDataFrame(rows, "f string, p double, t array<string>")
    band = decisions.band(F.col("p"))
    got = df.select("*", band.alias("b"), decisions.combine_sft(F.col("f"), band, F.col("p").isNotNull(), F.col("t")).alias("v")).collect()
    for r in got:
        hard = not r["t"] or bool({"hijri_year", "entry_root"} & set(r["t"]))
        assert (r["v"]["verdict"], r["v"]["leaning"]) == combine(r["f"], r["b"], r["p"] is not None, hard), r


def test_acceptance_and_settlement(spark):
    rows = list(itertools.product(["PASS", "REVIEW", "FAIL_CONTRADICTED", "INVALID_RECORD", "NO_FACT_COVERAGE"], [None, True, False], ["dictionary_entry", "prose"], [None, "PASS", "FAIL", "REVIEW", "ABSTAIN"]))
    df = spark.createDataFrame(rows, "v string, c boolean, f string, j string")
    a = decisions.acceptance(F.col("v"), F.col("c"), F.col("f"))
    for r in df.select("*", a.alias("a"), decisions.settle_sft(a, F.col("j")).alias("s")).collect():
        if r["v"] in ("FAIL_CONTRADICTED", "INVALID_RECORD"):
            want = "REJECT"
        elif r["c"] is None:
            want = "HOLD_FOR_REVIEW"
        elif not r["c"]:
            want = "REJECT" if r["f"] == "dictionary_entry" else "HOLD_FOR_REVIEW"
        else:
            want = "ACCEPT" if r["v"] == "PASS" else "HOLD_FOR_REVIEW"
        assert r["a"] == want
        assert r["s"] == (want if want != "ACCEPT" else "ACCEPT" if r["j"] == "PASS" else "HOLD_FOR_REVIEW")
    dpo = spark.createDataFrame(list(itertools.product(["AUTO_CONFIRM", "NEEDS_JUDGE", "FLAG_SUSPICIOUS"], [None, "PASS", "FAIL", "REVIEW", "ABSTAIN"])), "t string, j string")
    for r in dpo.select("*", decisions.settle_dpo(F.col("t"), F.col("j")).alias("s")).collect():
        assert r["s"] == ("FLAGGED" if r["t"] == "FLAG_SUSPICIOUS" else "CONFIRMED" if r["j"] == "PASS" else "NEEDS_HUMAN")


def test_adjudication_never_confirms(spark):
    rows = list(itertools.product(["AUTO_CONFIRM", "NEEDS_JUDGE", "FLAG_SUSPICIOUS"], [None, *judge.ASSESSMENTS], [0.5, 0.75, None], ["tie", "chosen_better_verdict"]))
    df = spark.createDataFrame(rows, "t string, a string, c double, w string")
    for r in df.select("*", decisions.adjudicate(F.col("t"), F.col("a"), F.col("c"), F.col("w")).alias("r")).collect():
        up = r["t"] == "NEEDS_JUDGE" and r["a"] in ("rejected_better", "equivalent") and (r["c"] or 0) >= 0.75 and r["w"] == "tie"
        assert r["r"] == ("FLAG_SUSPICIOUS" if up else r["t"])


def test_corroboration_knows_what_it_cannot_see(spark):
    df = spark.createDataFrame([(k, "SUPPORTED", "CONTRADICTED", 90.0, 50.0, "rejected_shorter", "chosen_better") for k in decisions.DETECTABLE], "k string, a string, b string, p double, q double, l string, f string")
    got = {r["k"]: r["r"] for r in df.select("k", decisions.corroborates(*[F.col(c) for c in "kabpqlf"]).alias("r")).collect()}
    assert got == {
        "partial_factual_errors": True, "less_faithful_reconstruction": True, "verbosity": False, "missing_information": True, "unsupported_additions": True, "poor_instruction_following": None,
        "wrong_formatting": True, "wrong_register": None, "weak_organization": None,
    }


def test_judge_helpers(spark):
    replies = [('{"a": 1, "b": 2}', "ok"), ('text ```json\n{"a": 1, "b": 2}\n``` end', "ok"), ('so {"a": 1} it is', "incomplete"), ("no", "unparseable"), (None, "unparseable")]
    df = spark.createDataFrame([(r,) for r, _ in replies], "r string")
    assert [x[0] for x in df.select(judge.parse_state(F.col("r"), ["a", "b"])).collect()] == [w for _, w in replies]
    cases = spark.createDataFrame([("chosen_better", "rejected_better"), ("chosen_better", "chosen_better"), ("equivalent", None)], "a string, b string")
    kept, biased = judge.swap_checked(F.col("a"), F.col("b"))
    assert [tuple(r) for r in cases.select(kept, biased).collect()] == [("chosen_better", False), ("undetermined", True), ("equivalent", False)]
    rows = spark.createDataFrame([("p", "chosen_better", 0.9, True, [("قال", "قال كذا")]), ("q", "odd", 1.5, True, []), ("r", "equivalent", 0.5, False, [("x", "abc")])], "id string, a string, c double, w boolean, e array<struct<quote:string,source_text:string>>")
    assert {tuple(r) for r in judge.contract_findings(rows, "id", "a", "c", "w", "e").collect()} == {("q", "BAD_ASSESSMENT"), ("q", "BAD_CONFIDENCE"), ("q", "WEAKNESS_WITHOUT_EVIDENCE"), ("r", "QUOTE_NOT_IN_SOURCE")}


def test_judge_is_asked_again_after_lapses_only():
    calls, pauses = [], []

    def flaky(user):
        calls.append(user)
        if len(calls) < 3:
            raise judge.RateLimited
        return "{}"

    assert judge.patient(flaky, wait=pauses.append)("x") == "{}" and pauses == [1, 2]
    for error, tries in ((judge.TimeoutError, 3), (judge.ProviderError, 1)):
        seen = []

        def fails(user, error=error, seen=seen):
            seen.append(user)
            raise error

        with pytest.raises(error):
            judge.patient(fails, wait=lambda s: None)("x")
        assert len(seen) == tries
    with pytest.raises(judge.ProviderError):
        judge.patient(lambda user: " ")("x")


def test_failures_of_a_live_judge_are_rows(spark):
    def backend(user):
        if user == "bad":
            raise judge.ProviderError
        return user

    got = judge.asked_typed(spark.createDataFrame([("ok",), ("bad",)], "u string"), "u", backend)
    assert {tuple(r) for r in got.collect()} == {("ok", "ok", None), ("bad", None, "ProviderError")}


def test_suite_without_probes(spark):
    fields = "label string, " + ", ".join(f"{f} string" for f in {*judge.SFT_PROBE, *judge.DPO_PROBE, "fixture", "expect_corroborating_dimension"} - {"label"}) + ", expect_fail_dimensions array<string>"
    none = spark.createDataFrame([], fields)
    got = {tuple(r) for r in judge.suite_problems(none, none).collect()}
    assert got == {("SFT", None, "ALL_PASS", ""), ("DPO", None, "ALL_PASS", ""), ("DPO", None, "NO_TYPES", ""), ("DPO", None, "TOO_FEW_PROBES", "wrong_register"), ("DPO", None, "TOO_FEW_PROBES", "weak_organization")}


def test_nearest_ratio_loses_no_partner(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("the of a b c d e f g h i j k".split(), [9, 7, 3, *[1] * 10], k=rng.randint(0, 14)))) for i in range(60)]
    got = {r["k"]: r["ratio"] for r in similarity.nearest_ratio(spark.createDataFrame(rows, "k int, t string"), "k", "t").collect()}
    assert got == {i: max(difflib.SequenceMatcher(None, t.split(), u.split()).ratio() if t and u else 0.0 for j, u in rows if j != i) for i, t in rows}


# --- facts


def test_facts_keep_their_offsets(spark):
    text = "(مطر) : ماء ينزل، وقال ذو الرمة كذا، انظر ص 12 وسنة 1350 وسنة 1402 هـ وسنة 1299 وفي أهل نجد\nسطر"
    df = spark.createDataFrame([("c", text)], "k string, t string")
    got = facts.fact_rows(df.withColumn("f", facts.extracted(F.col("t"), "saudi_dialect")), "k", "f").collect()
    assert {(r["type"], r["value"]) for r in got} >= {("entry_headword", "مطر"), ("citation_authority", "ذو الرمة"), ("page_reference", "12"), ("year_unmarked_era", "1350"), ("hijri_year", "1402")}
    assert not any(r["value"] in ("1299",) for r in got) and not any(r["type"].endswith("year") and r["value"] == "12" for r in got)
    assert all(text[r["position_in_text"] :].startswith(r["value"]) for r in got)


def test_lexicon_senses_end_at_the_next_boundary(spark):
    text = "كتب: جمع.\nومن المجاز: كتب عليه.\nومن المجاز: آخر\nدرس: قرأ"
    got = [(f["type"], f["value"]) for f in facts.lexicon_facts(text)]
    assert [v for t, v in got if t == "entry_root"] == ["كتب", "درس"]
    assert [v for t, v in got if t == "figurative_sense"] == ["ومن المجاز: كتب عليه.", "ومن المجاز: آخر"]


@pytest.mark.parametrize(("raw", "want"), [("له", None), ("أبو", None), ("فلان", None), ("الشاعر", "الشاعر"), ("زيد زيد", None), ("زيد الخيل", "زيد الخيل")])
def test_citation_names(raw, want):
    assert facts.citation_name(raw) == want


@pytest.mark.parametrize(("n", "h", "g", "want"), [("1299", False, False, None), ("1300", False, False, "year_unmarked_era"), ("1500", False, False, "year_unmarked_era"), ("1501", False, False, "gregorian_year"), ("1200", True, False, "hijri_year"), ("1200", False, True, "gregorian_year")])
def test_years(n, h, g, want):
    assert facts.year_kind(n, h, g) == want


def test_records_are_checked_against_their_chunk(spark):
    chunk = "(مطر) : ماء ينزل من السماء انظر ص 12 سنة 1402 هـ"
    chunks = spark.createDataFrame([("c1", "najdi", chunk, facts.dialect_facts(chunk))], f"chunk_id string, region string, chunk_text string, extracted_facts {facts.FACT}")
    said = ["جاء في ص 12", "جاء في ص 13", "كلام بلا شيء", "معنى «مطر» ماء ينزل", "في لهجة نجد", "في لهجة الحجاز", "سنة 1402 هـ"]
    rows = [(i, s, "", "c1") for i, s in enumerate(said)] + [(99, "x", "", "nowhere")]
    got = {r["row_idx"]: r["fact_verdict"] for r in facts.check_records(spark.createDataFrame(rows, "row_idx int, response string, instruction string, source_chunk_id string"), chunks, "saudi_dialect").collect()}
    assert got == {0: "SUPPORTED", 1: "CONTRADICTED", 2: "NO_CHECKABLE_CLAIMS", 3: "SUPPORTED", 4: "SUPPORTED", 5: "CONTRADICTED", 6: "SUPPORTED", 99: "UNKNOWN_CHUNK"}


def test_verification_and_triage_run_end_to_end(spark):
    chunk = "(مطر) : ماء ينزل من السماء انظر ص 12."
    chunks = spark.createDataFrame([("c1", "najdi", chunk, facts.dialect_facts(chunk))], f"chunk_id string, region string, chunk_text string, extracted_facts {facts.FACT}")
    rows = spark.createDataFrame([(0, "جاء في ص 12.", "", "c1", "prose"), (1, "جاء في ص 13.", "", "c1", "prose")], "row_idx int, response string, instruction string, source_chunk_id string, format_type string")
    pct = spark.createDataFrame([(0, 99.0), (1, 20.0)], "row_idx int, percentile double")
    got = {r["row_idx"]: (r["verdict"], r["decision"]) for r in jobs.verify_sft(rows, chunks, "saudi_dialect", pct).collect()}
    assert got == {0: ("PASS", "ACCEPT"), 1: ("FAIL_CONTRADICTED", "REJECT")}
    pairs = spark.createDataFrame([(0, "جاء في ص 12 من الكتاب.", "جاء في ص 13 وهو كلام آخر مختلف.", "partial_factual_errors", "prose"), (1, "نص واحد", "نص واحد", "verbosity", "prose")], "row_idx int, chosen string, rejected string, rejection_type string, format_type string")
    side = lambda v, f, p: spark.createDataFrame([(i, v, f, p) for i in (0, 1)], "row_idx int, verdict string, fact_verdict string, percentile double")
    got = {r["row_idx"]: r["triage"] for r in jobs.triage_dpo(pairs, side("PASS", "SUPPORTED", 90.0), side("FAIL_CONTRADICTED", "CONTRADICTED", 30.0)).collect()}
    assert got == {0: "AUTO_CONFIRM", 1: "FLAG_SUSPICIOUS"}


# --- duplicates and leakage


def test_exact_and_near(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near = base.replace("w30 ", "x30 ")
    df = spark.createDataFrame([("a", base), ("b", base.replace(" ", "  ")), ("c", near), ("d", "other words"), ("e", "")], "k string, t string")
    state = {r["k"]: r["status"] for r in dedup.status(df, "k", "t").collect()}
    assert state == {"a": "near_duplicate_flagged", "b": "exact_duplicate", "c": "near_duplicate_flagged", "d": "unique", "e": "unique"}
    pairs = spark.createDataFrame([(i, i + 1) for i in range(1, 20)] + [(40, 41), (41, 42), (42, 40)], "a long, b long")
    assert {r["node"]: r["component"] for r in dedup.components(pairs, "a", "b").collect()} == {i: 1 for i in range(1, 21)} | {40: 40, 41: 40, 42: 40}


def test_equal_sets_with_different_texts_leak_only_if_strict(spark):
    a = "x y x y x y x"
    df = spark.createDataFrame([(1, a, "train"), (2, a + " y", "test")], "k int, t string, p string")
    assert leakage.near_crossing(df, "k", "t", "p", 2).count() == 0
    assert leakage.near_crossing(df, "k", "t", "p", 2, strict=True).count() == 1


def test_sequence_ratio_is_the_librarys(spark):
    rows = [(0, "a b c d e f g h"), (1, "a b c d e f h g"), (2, "z"), (3, "a z")]
    got = {r["k"]: r["ratio"] for r in similarity.nearest_ratio(spark.createDataFrame(rows, "k int, t string"), "k", "t").collect()}
    for i, t in rows:
        assert got[i] == max(difflib.SequenceMatcher(None, t.split(), u.split()).ratio() for j, u in rows if j != i)


# --- OCR entries and rubric


def test_ocr_entries(spark):
    words = [("5", 1, 1, 1, 1500, 10, "90", "مطر:"), ("5", 1, 1, 1, 1300, 10, "80", "ماء"), ("5", 1, 1, 1, 1200, 10, "80", "نازل"), ("5", 1, 1, 2, 1300, 30, "70", "تكملة"), ("5", 1, 1, 3, 1500, 50, "40", "ريح:"), ("5", 1, 1, 3, 1300, 50, "x", "ضاع"), ("4", 1, 1, 3, 1300, 50, "90", "لا"), ("5", 1, 1, 0, 1300, 1, "90", "قبل")]
    df = spark.createDataFrame([(1, int(a), *r) for a, *r in words], "page int, level int, block_num int, par_num int, line_num int, left int, top int, conf string, text string")
    got = ocr.finalize(ocr.score(ocr.entries(ocr.lines(ocr.words(df))))).orderBy("entry").collect()
    assert [(r["headword"], r["meaning"]) for r in got] == [("مطر", "ماء نازل تكملة"), ("ريح", "")]
    assert got[0]["final_status"] == "accepted" or got[0]["review_flags"] == ["short_meaning"]
    assert got[1]["quality_status"] == "rejected" and "empty_meaning" in got[1]["review_flags"]


def test_review_tiers(spark):
    df = spark.createDataFrame([(["short_meaning"],), (["short_meaning", "headword_without_colon"],), (["very_short_headword"],), ([],)], "f array<string>")
    assert [r[0] for r in df.select(ocr.tier(F.col("f"))).collect()] == ["easy_review", "hard_review", "hard_review", "hard_review"]


def test_rubric(spark):
    df = spark.createDataFrame([("ما معنى المطر هنا", "المطر هنا ماء ينزل من السماء", "", 0, ["ماء السماء"]), ("x", "y", "", 1, [])], "q string, a string, t string, d int, f array<string>")
    got = quality.scored(df, *[F.col(c) for c in "qatdf"]).collect()
    assert [round(got[0][c], 4) for c in ("question_naturalness", "answer_naturalness", "thinking_quality", "support_coverage", "teacher_confidence")] == [1.0, 1.0, 1.0, 1.0, 1.0]
    assert [round(got[1][c], 4) for c in ("question_naturalness", "answer_naturalness", "thinking_quality", "support_coverage")] == [0.2, 0.15, 0.7, 0.5]
    dup = spark.createDataFrame([("s1", "a", ["user"]), ("s1", "b", ["robot"]), ("s2", "", ["user"])], "id string, question string, roles array<string>")
    assert {tuple(r) for r in quality.contract_findings(dup, "id", ["question"], "roles").collect()} == {("s1", "BAD_ROLE", "roles"), ("s2", "MISSING", "question"), ("s1", "DUPLICATE_ID", "id")}


def test_pairs_keep_to_the_first_part_of_their_chunk(spark):
    rows = [("train", 0, "c1", "x", "y"), ("train", 1, "c2", "x", ""), ("test", 0, "c1", "x", "z"), ("test", 1, "c3", "x", "y"), ("test", 2, "c1", "p", "q"), ("test", 3, "c2", None, None), ("train", 2, "c2", None, "y"), ("zz", 0, "c3", "x", "y")]
    order = {"train": 0, "test": 1, "zz": 2}
    df = spark.createDataFrame([(order[r[0]], *r) for r in rows], "part_no int, part string, idx int, chunk string, chosen string, rejected string")
    got = {(r["part"], r["idx"], r["why"], r["also_in"]) for r in leakage.pairs_intact(df, "chunk", "chosen", "rejected", "part", ["part_no", "idx"]).collect()}
    assert got == {("train", 1, "half_pair", None), ("train", 2, "half_pair", None), ("test", 0, "chunk_in_two_parts", "train"), ("test", 2, "chunk_in_two_parts", "train"), ("zz", 0, "chunk_in_two_parts", "test")}


def test_incomplete_pairs_and_records_come_out(spark):
    chunks = spark.createDataFrame([("c1", "najdi", "ص 12", facts.dialect_facts("ص 12"))], f"chunk_id string, region string, chunk_text string, extracted_facts {facts.FACT}")
    rows = [(0, "i", "جاء في ص 12.", "c1", "western", "prose", "m"), (1, "i", "جاء في ص 12.", "c1", "najdi", "prose", None), (2, "i", "جاء في ص 12.", "c9", "najdi", "prose", "m")]
    got = {r["row_idx"]: r for r in jobs.verify_sft(spark.createDataFrame(rows, "row_idx int, instruction string, response string, source_chunk_id string, source_region string, format_type string, model_version string"), chunks, "saudi_dialect").collect()}
    assert [(got[i]["verdict"], got[i]["leaning"], got[i]["missing"], got[i]["warnings"]) for i in range(3)] == [("REVIEW", "pass", [], ["region_mismatch"]), ("INVALID_RECORD", None, ["model_version"], []), ("INVALID_RECORD", None, [], [])]
    assert got[1]["decision"] == got[2]["decision"] == "REJECT"
    pairs = spark.createDataFrame([(i, "p", c, "other words here", k, "prose") for i, (c, k) in enumerate([("some words", "verbosity"), ("some words", "odd_kind"), (None, "verbosity"), ("some words", None), ("some words", "verbosity")])], "row_idx int, prompt string, chosen string, rejected string, rejection_type string, format_type string")
    side = spark.createDataFrame([(i, "REVIEW", "PARTIAL", 60.0) for i in range(4)], "row_idx int, verdict string, fact_verdict string, percentile double")
    got = {r["row_idx"]: r for r in jobs.triage_dpo(pairs, side, side).collect()}
    assert len(got) == 5
    assert [got[i]["missing"] for i in range(5)] == [[], [], ["chosen"], ["rejection_type"], ["verified_chosen", "verified_rejected"]]
    assert all(got[i]["triage"] == "FLAG_SUSPICIOUS" for i in (2, 3, 4))
    assert got[1]["warnings"] == ["unknown_rejection_type"] and got[1]["detectability"] == "none" and got[1]["corroborated"] is None and got[1]["triage"] == "NEEDS_JUDGE"


def test_unfinished_components_are_an_error(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a int, b int")
    assert {r["component"] for r in dedup.components(edges, "a", "b").collect()} == {0}
    with pytest.raises(RuntimeError):
        dedup.components(edges, "a", "b", rounds=1)
