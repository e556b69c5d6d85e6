"""String functions for Arabic and other text.

Regular expressions use Unicode classes throughout (``(?U)``), and ``(?d)``
where only a line feed ends a line. All are built-in expressions, except for
``nfc`` and ``repair_encoding``, for which Spark has none.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that the rules name.
TATWEEL = "ـ"
TASHKEEL = "ً-ْ"
SUPERSCRIPT_ALEF = "ٰ"
ALEF_FORMS = "آأإٱٲٳ"
YA_FORMS = "ىی"
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
PERSIAN_DIGITS = "۰۱۲۳۴۵۶۷۸۹"
ZERO_WIDTH = "​-‏‪-‮﻿"
OCR_CONTROLS = "​‌‍‎‏‪‫‬‭‮⁦⁧⁨⁩﻿"
MARKS = "ً-ٰٟ"
LETTERS = "ء-يٱ-ۓ"


def _gsub(c: Column, pattern: str, to: str = "") -> Column:
    return F.regexp_replace(c, pattern, to)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for each row, even where
    the body uses it inside a lambda (which would compute it for each element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    return _gsub(c, r"(?U)^\s+|\s+$")


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"(?U)\S+"), F.lit(0))


def token_count(c: Column) -> Column:
    """White space separated tokens; null has none."""
    return F.coalesce(F.regexp_count(c, F.lit(r"(?U)\S+")), F.lit(0)).cast("long")


def normalize_whitespace(c: Column) -> Column:
    c = _gsub(F.translate(c, " ", " "), f"[{ZERO_WIDTH}]")
    c = _gsub(_gsub(c, r"\r\n?", "\n"), r"[ \t]+", " ")
    return strip(_gsub(c, r" *\n *", "\n"))


def canonical(c: Column) -> Column:
    """White space runs become one space, none at the ends."""
    return strip(_gsub(c, r"(?U)\s+", " "))


def strip_tashkeel(c: Column) -> Column:
    return _gsub(c, f"[{TASHKEEL}]")


def strip_tatweel(c: Column) -> Column:
    return F.translate(c, TATWEEL, "")


def fold_letters(c: Column) -> Column:
    return F.translate(c, ALEF_FORMS + YA_FORMS, "ا" * len(ALEF_FORMS) + "ي" * len(YA_FORMS))


def nfc(c: Column) -> Column:
    """Canonical composition (an Arrow UDF)."""
    return F.pandas_udf(_nfc, "string")(c)


def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def matching_key(c: Column, strip_diacritics: bool = False, compose: bool = True) -> Column:
    """Folded form for matching only; text that ships is never folded."""
    c = fold_letters(strip_tatweel(nfc(c) if compose else c))
    return strip_tashkeel(c) if strip_diacritics else c


def preserve_orthography(c: Column, strip_diacritics: bool = False, drop_tatweel: bool = False, compose: bool = True) -> Column:
    c = nfc(c) if compose else c
    c = strip_tatweel(c) if drop_tatweel else c
    return strip_tashkeel(c) if strip_diacritics else c


def fact_key(c: Column) -> Column:
    """Key for comparing facts: digits, marks, letters and spaces unified."""
    c = F.translate(c, ARABIC_DIGITS + PERSIAN_DIGITS, "0123456789" * 2)
    c = _gsub(c, f"[{TASHKEEL}{SUPERSCRIPT_ALEF}{TATWEEL}]")
    return canonical(F.translate(c, "أإآٱىة", "اااايه"))


def audit_key(c: Column) -> Column:
    """Arabic letters only, as single-spaced words."""
    return canonical(_gsub(_gsub(c, f"[{MARKS}{TATWEEL}]"), "[^ء-ي]+", " "))


def drop_ocr_controls(c: Column) -> Column:
    return F.translate(c, OCR_CONTROLS, "")


def detached_marks(c: Column) -> Column:
    """Marks that no letter, mark or tatweel precedes."""
    return F.regexp_count(c, F.lit(f"(?<![{LETTERS}{MARKS}{TATWEEL}])[{MARKS}]"))


# The letters and marks of the repair, and what a word may follow.
BASES = "\u0621-\u063A\u0641-\u064A"
REPAIRED = "\u064B-\u0655\u0670\u06D6-\u06ED"
OPENERS = "(){}\\[\\]«».,:؛،\"\\-"


def repair_marks(c: Column) -> Column:
    """struct<text, joins, moves>.

    Letter, spaces, marks and letter become letter, letter and marks (a join).
    Marks that lead a line, or a word after punctuation, go behind its first
    letter (a move). A join leaves no further one behind it, as a mark then
    follows its letter: one pass reaches the fixpoint.
    """
    parted = f"([{BASES}]) +([{REPAIRED}]+)([{BASES}])"
    leading = f"(?dm)(^|[{OPENERS}])([{REPAIRED}]+)([{BASES}])"
    joined = _gsub(c, parted, "$1$3$2")
    return F.when(c.isNotNull(), F.struct(_gsub(joined, leading, "$1$3$2").alias("text"), F.regexp_count(c, F.lit(parted)).alias("joins"), F.regexp_count(joined, F.lit(leading)).alias("moves")))


def residue_tokens(c: Column, keep: list[str], around: int = 3, limit: int = 120) -> Column:
    """array<struct<pos, token, context>> of tokens of at most two letters."""
    found = lambda w: F.transform(w, lambda t, i: F.struct(i.alias("pos"), t.alias("token"), F.substring(F.array_join(F.slice(w, F.greatest(i - around + 1, F.lit(1)), F.lit(2 * around + 1)), " "), 1, limit).alias("context")))
    short = let(words(c), found)
    return F.filter(short, lambda x: (F.regexp_count(x["token"], F.lit(f"[{LETTERS}]")) <= 2) & x["token"].rlike(f"[{LETTERS}]") & ~x["token"].isin(keep))


def page_lines(c: Column) -> Column:
    """Lines without direction marks, blanks and folios such as ``- 12 -``."""
    lines = F.transform(F.split(c, "\n"), lambda x: strip(_gsub(x, f"[{ZERO_WIDTH}]")))
    return F.filter(lines, lambda x: (x != "") & ~x.rlike(r"(?U)^-?\s*\d+\s*-?$"))


def damage_ratio(c: Column, longest: int = 16) -> Column:
    """Share of Arabic tokens that are too long to be words."""
    tokens = F.regexp_extract_all(c, F.lit(f"[{LETTERS}{MARKS}{TATWEEL}]+"), F.lit(0))
    return F.when(F.size(tokens) > 0, F.size(F.filter(tokens, lambda t: F.length(t) > longest)) / F.size(tokens)).otherwise(0.0)


def damage_snippet(c: Column, limit: int = 160) -> Column:
    """The line with the longest token, the first of equals."""
    lines = F.split(c, "\n")
    longest = lambda x: F.coalesce(F.array_max(F.transform(words(x), lambda t: F.length(t))), F.lit(0))
    best = F.array_max(F.transform(lines, lambda x, i: F.struct(longest(x).alias("n"), (-i).alias("i"))))
    return F.substring(F.element_at(lines, -best["i"] + 1), 1, limit)


def clean_meaning(c: Column) -> Column:
    return strip(_gsub(_gsub(c, r"[-–—]{2,}", " "), r"(?U)[\s\-–—]+$"))


def meaning_flags(c: Column) -> Column:
    flags = F.array(F.when(c.rlike(r"(?U)\d+\s*$"), "trailing_number_noise"), F.when(c.rlike(r"(?U)\s\S$"), "trailing_single_char_noise"))
    return F.array_compact(flags)


def title_matches(paragraph: Column, title: Column) -> Column:
    """Equal, contained in the title, or the title's continuation."""
    key = lambda x: canonical(_gsub(fold_letters(strip_tashkeel(strip_tatweel(x))), r"(?U)[^\w\s]", " "))
    p, t = key(paragraph), key(title)
    return (p != "") & ((p == t) | F.contains(t, p) | F.startswith(t, p))


def context_window(c: Column, position: Column, length: Column, before: int = 40, after: int = 30) -> Column:
    """Text around a value at a position counted from 0, single-spaced."""
    start = F.greatest(position - before, F.lit(0))
    return canonical(F.substring(c, start + 1, position - start + length + after))


def after_answer(c: Column) -> Column:
    """Text after the first ``Answer:``, else the whole; trimmed."""
    at = F.locate("Answer:", c)
    return strip(F.when(at > 0, F.substring(c, at + 7, F.length(c))).otherwise(c))


def split_scaffold(c: Column) -> Column:
    """struct<thinking, answer> of anchored lines; null thinking if not there."""
    pattern = r"(?s)^\s*Thinking:[ \t]*(.*?)\n\s*Answer:[ \t]*(.*)$"
    return F.when(c.rlike(pattern), F.struct(strip(F.regexp_extract(c, pattern, 1)).alias("thinking"), strip(F.regexp_extract(c, pattern, 2)).alias("answer"))).otherwise(
        F.struct(F.lit(None).cast("string").alias("thinking"), strip(c).alias("answer"))
    )


def windows(c: Column, size: int = 900, stride: int = 450) -> Column:
    """Overlapping windows; the last one reaches the end."""
    n = F.length(c)
    last = F.greatest(F.ceil((n - size) / stride), F.lit(0)).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(c, i * stride + 1, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def _undo(text: str | None) -> str | None:
    """Undoes UTF-8 that was read as a single-byte code page, if it fits."""
    for _ in range(3):
        if text is None or text.isascii():
            return text
        for page in ("cp1252", "latin-1"):
            try:
                better = text.encode(page).decode("utf-8")
            except UnicodeError:
                continue
            if better != text:
                break
        else:
            return text
        text = better
    return text


def extracted_text(c: Column) -> Column:
    """Text from markup: no direction marks or joiners, single spaces."""
    return canonical(F.translate(c, "\u200f\u200e\u200c\u200d", ""))


def root_key(c: Column) -> Column:
    return _gsub(c, "(?U)[\\s\u064B-\u065F\u0670]")


def repair_encoding(c: Column) -> Column:
    """Mojibake of whole texts undone (an Arrow UDF)."""
    return F.pandas_udf(lambda s: s.map(_undo), "string")(c)


def entropy(c: Column) -> Column:
    """Shannon entropy of the characters in bits; 0 for an empty text."""

    def bits(chars: Column) -> Column:
        share = F.transform(F.array_distinct(chars), lambda x: F.size(F.filter(chars, lambda y: y == x)) / F.size(chars))
        return F.aggregate(share, F.lit(0.0), lambda a, p: a - p * F.log2(p))

    return let(F.filter(F.split(c, ""), lambda x: x != ""), bits)
