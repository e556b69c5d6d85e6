import math
import unicodedata

import pytest
from pyspark.sql import functions as F

from nasij.functions import text as T


def run(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("fn", "given", "want"),
    [
        (T.normalize_whitespace, " a ​ b\t\tc \r\n d\r\r e ", "a b c\nd\n\ne"),
        (T.canonical, "  a \n\t b  ", "a b"),
        (T.token_count, "a b  c\n", 3),
        (T.token_count, None, 0),
        (lambda c: T.matching_key(c, True), "أَهْلـًا إلى آخرِهِ", "اهلا الي اخره"),
        (T.fact_key, "ص ١٢  مَدرسـة  أُولى", "ص 12 مدرسه اولي"),
        (T.audit_key, "سَلامٌ، عليكم! abc", "سلام عليكم"),
        (T.drop_ocr_controls, "ا‏ب⁧ج", "ابج"),
        (T.detached_marks, "ب َ كَ", 1),
        (lambda c: T.repair_marks(c)["text"], "\u0643 \u064f\u062a\u0628", "\u0643\u062a\u064f\u0628"),
        (lambda c: T.repair_marks(c)["text"], "\u0643 \u064f", "\u0643 \u064f"),
        (lambda c: T.repair_marks(c)["text"], "a \u064f\u062a", "a \u064f\u062a"),
        (lambda c: T.repair_marks(c)["text"], "\u064f\u062a\n\u064e\u0628 (\u064f\u062a", "\u062a\u064f\n\u0628\u064e (\u062a\u064f"),
        (lambda c: T.repair_marks(c)["joins"], "\u0643 \u064f\u062a  \u064e\u0628 \u0643  \u064e\u0628", 2),
        (lambda c: T.repair_marks(c)["moves"], "\u064f\u062a \u064e\u0628 .\u064e\u0628", 2),
        (T.damage_ratio, "كلمة " + "ب" * 20, 0.5),
        (T.damage_snippet, "سطر أول\nسطر " + "ط" * 30 + " آخر", "سطر " + "ط" * 30 + " آخر"),
        (T.clean_meaning, "معنى -- آخر  --- ", "معنى   آخر"),
        (T.meaning_flags, "معنى الكلمة 12", ["trailing_number_noise"]),
        (T.meaning_flags, "معنى الكلمة ب", ["trailing_single_char_noise"]),
        (T.after_answer, "Thinking: x\nAnswer: هذا", "هذا"),
        (T.windows, "x" * 1000, ["x" * 900, "x" * 550]),
        (T.windows, "abc", ["abc"]),
        (T.windows, "", []),
        (T.page_lines, "‏سطر\n\n - 12 - \nآخر", ["سطر", "آخر"]),
    ],
)
def test_functions(spark, fn, given, want):
    assert run(spark, given, fn) == want


def test_scaffold(spark):
    got = run(spark, "Thinking: لأن كذا\nAnswer: الجواب\nسطر", T.split_scaffold)
    assert (got["thinking"], got["answer"]) == ("لأن كذا", "الجواب\nسطر")
    assert run(spark, "قال Answer: لا", T.split_scaffold)["thinking"] is None


def test_residue_tokens(spark):
    got = run(spark, "كلمة طويلة بب ثم شيء", lambda c: T.residue_tokens(c, ["ثم"]))
    assert [(x["pos"], x["token"], x["context"]) for x in got] == [(2, "بب", "كلمة طويلة بب ثم شيء")]


def test_unicode_forms_and_mojibake(spark):
    loose = unicodedata.normalize("NFD", "é آ")
    assert run(spark, loose, T.nfc) == "é آ"
    good = "العربية"
    assert run(spark, good.encode().decode("latin-1"), T.repair_encoding) == good
    assert run(spark, "café", T.repair_encoding) == "café"


def test_entropy(spark):
    for s in ("aaaa", "abab", "abcd", "abcdefgh12345678", ""):
        p = [s.count(c) / len(s) for c in set(s)]
        assert run(spark, s, T.entropy) == pytest.approx(-sum(x * math.log2(x) for x in p) if p else 0.0, abs=1e-12)


def test_title_matches(spark):
    rows = spark.createDataFrame([("الأَغَانِي", "الاغاني"), ("كتاب", "كتاب الأغاني : شرح"), ("فصل", "كتاب الأغاني"), ("", "x")], "p string, t string")
    assert [r[0] for r in rows.select(T.title_matches(F.col("p"), F.col("t"))).collect()] == [True, True, False, False]


def test_context_window(spark):
    text = "a" * 50 + " VALUE " + "b" * 50
    got = spark.createDataFrame([(text, 51, 5)], "t string, p int, n int").select(T.context_window(F.col("t"), F.col("p"), F.col("n"))).first()[0]
    assert got == "a" * 39 + " VALUE " + "b" * 29
