"""Dictionary entries from OCR words: lines, entries, scores, review tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nasij.functions import text as T
from nasij.operators.dedup import first_by

# Layout, penalties and flag sets of the rules.
HEADWORD_LEFT, HEADWORD_CHARS, HEADWORD_WORDS = 1350, 25, 2
ACCEPT_SCORE, REJECT_SCORE = 85, 40
CRITICAL = ("very_low_headword_confidence", "low_headword_confidence", "headword_without_colon", "unexpected_symbol_in_headword", "unexpected_symbol_in_meaning", "very_short_meaning", "trailing_number_noise", "trailing_single_char_noise")
EASY = ("low_headword_confidence", "short_meaning", "removed_trailing_dash_noise", "removed_repeated_dash_noise", "possible_trailing_number_noise", "possible_trailing_single_char_noise")
HARD = ("very_low_headword_confidence", "headword_without_colon", "unexpected_symbol_in_headword", "unexpected_symbol_in_meaning", "very_short_meaning", "empty_meaning", "digit_in_headword", "suspicious_ocr_symbol", "possible_standalone_number_noise")
APPROVABLE = ("low_headword_confidence", "short_meaning")
SYMBOL = r"[#©@*_=+<>|\\/{}\[\]~^$%&]"
DIGIT = r"[0-9٠-٩]"


def words(df: DataFrame) -> DataFrame:
    """Rows of level 5 with a numeric confidence of at least 0 and some text."""
    conf = F.try_cast if hasattr(F, "try_cast") else None
    value = F.expr("try_cast(conf AS double)") if conf is None else F.expr("try_cast(conf AS double)")
    out = df.where("level = 5").withColumn("conf", value).withColumn("text", T.strip(T.drop_ocr_controls(F.col("text"))))
    return out.where("conf >= 0 and text <> ''")


def lines(df: DataFrame) -> DataFrame:
    """page, line, top, text, first_conf, first_left: right to left words."""
    w = F.sort_array(F.collect_list(F.struct((-F.col("left")).alias("x"), "text", "conf", "left")))
    by = df.groupBy("page", "block_num", "par_num", "line_num").agg(F.min("top").alias("top"), w.alias("w"))
    return by.select("page", "block_num", "par_num", "line_num", "top", F.array_join(F.transform("w", lambda x: x["text"]), " ").alias("text"), F.col("w")[0]["text"].alias("first_text"), F.col("w")[0]["conf"].alias("first_conf"), F.col("w")[0]["left"].alias("first_left"))


def plausible(c: Column) -> Column:
    letters = F.regexp_count(c, F.lit("[ءاأإآبتثجحخدذرزسشصضطظعغفقكلمنهويىةؤئ]"))
    return (letters >= 2) & (T.token_count(c) <= HEADWORD_WORDS) & (F.length(c) <= HEADWORD_CHARS)


def entries(df: DataFrame) -> DataFrame:
    """Islands of lines: a headword line opens an entry, the next lines belong
    to it; lines before a page's first headword are dropped."""
    head = T.strip(F.regexp_replace("first_text", "[:：]", ""))
    df = df.withColumn("headword", head).withColumn("is_head", (F.col("first_left") >= HEADWORD_LEFT) & plausible(F.col("headword")))
    order = Window.partitionBy("page").orderBy("top", "block_num", "par_num", "line_num")
    df = df.withColumn("n", F.row_number().over(order)).withColumn("entry", F.sum(F.col("is_head").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("entry > 0")
    rest = T.strip(F.regexp_replace(F.expr("substring(text, length(first_text) + 1)"), r"^\s*[:：]", ""))
    part = F.when(F.col("is_head"), rest).otherwise(F.col("text"))
    first = lambda c: F.min_by(c, "n")
    got = df.withColumn("part", part).groupBy("page", "entry").agg(
        first("headword").alias("headword"), first("first_conf").alias("headword_conf"), first("first_left").alias("headword_left"), first("top").alias("line_top"), first(F.col("first_text").rlike("[:：]") | F.col("text").rlike(r"^\S+\s*[:：]")).alias("had_colon"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "part"))), lambda x: x["part"]), " ").alias("meaning"),
    )
    return got.withColumn("meaning", T.canonical(F.col("meaning")))


def score(df: DataFrame) -> DataFrame:
    """quality_score 0 to 100, review_flags and quality_status."""
    head, meaning, conf = T.strip(F.col("headword")), T.strip(F.col("meaning")), F.col("headword_conf")
    n = F.length(meaning)
    tests = [
        ((conf < 30), 30, "very_low_headword_confidence"), ((conf >= 30) & (conf < 60), 15, "low_headword_confidence"), (~F.col("had_colon"), 10, "headword_without_colon"),
        (n == 0, 60, "empty_meaning"), ((n > 0) & (n < 8), 25, "very_short_meaning"), ((n >= 8) & (n < 15), 10, "short_meaning"), (F.length(head) <= 2, 20, "very_short_headword"),
        (head.rlike(DIGIT), 40, "digit_in_headword"), (head.rlike(SYMBOL), 30, "unexpected_symbol_in_headword"), (meaning.rlike(SYMBOL), 10, "unexpected_symbol_in_meaning"),
        (meaning.rlike(DIGIT + r"+\s*$"), 10, "trailing_number_noise"), (meaning.rlike(r"(?U)\s\S$"), 10, "trailing_single_char_noise"),
    ]
    lost = sum((F.when(t, F.lit(p)).otherwise(F.lit(0)) for t, p, _ in tests), F.lit(0))
    flags = F.array_compact(F.array(*[F.when(t, f) for t, _, f in tests]))
    df = df.withColumn("quality_score", F.greatest(F.lit(0), F.least(F.lit(100), 100 - lost))).withColumn("review_flags", flags)
    s = F.col("quality_score")
    status = F.when(~plausible(head) | (n == 0) | (s < REJECT_SCORE), "rejected").when((s < ACCEPT_SCORE) | F.arrays_overlap("review_flags", F.array(*map(F.lit, CRITICAL))), "review").otherwise("accepted")
    return df.withColumn("quality_status", status)


def finalize(df: DataFrame) -> DataFrame:
    """Cleaned meaning, later flags, final status and review tier."""
    cleaned = T.clean_meaning(F.col("meaning"))
    more = F.array_compact(F.array(F.when(cleaned.rlike(r"(?U)(?<!\S)[0-9٠-٩]+(?!\S)"), "possible_standalone_number_noise"), F.when(cleaned.rlike("[#©]"), "suspicious_ocr_symbol")))
    flags = F.concat("review_flags", F.array_except(more, "review_flags"))
    df = df.withColumn("meaning_original", F.col("meaning")).withColumn("cleanup_applied", cleaned != F.col("meaning")).withColumn("meaning", cleaned).withColumn("final_review_flags", flags)
    status = F.when(F.col("quality_status") == "rejected", "rejected").when((F.col("quality_status") == "accepted") & (F.size("final_review_flags") == 0), "accepted").otherwise("review")
    return df.withColumn("final_status", status).withColumn("review_tier", F.when(F.col("final_status") == "review", tier(F.col("final_review_flags"))))


def tier(flags: Column) -> Column:
    """Unknown flags are never easy."""
    has = lambda x: F.array(*map(F.lit, x))
    easy = (F.size(flags) > 0) & (F.size(F.array_except(flags, has(EASY))) == 0)
    return F.when(~F.arrays_overlap(flags, has(HARD)) & easy, "easy_review").otherwise("hard_review")


def final_subset(df: DataFrame) -> DataFrame:
    """Accepted entries, and easy ones with approvable flags alone; the first of
    a page's equal headwords, accepted ones before others."""
    ok = F.size(F.array_except("final_review_flags", F.array(*map(F.lit, APPROVABLE)))) == 0
    source = F.when(F.col("final_status") == "accepted", "accepted").when((F.col("review_tier") == "easy_review") & ok, "auto_approved_easy")
    kept = df.withColumn("approval_source", source).where("approval_source is not null").withColumn("_h", T.strip(F.col("headword")))
    return first_by(kept, ["page", "_h"], ["approval_source", "line_top", "entry"]).drop("_h")


def report(df: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    share = lambda s: (F.count_if(F.col("quality_status") == s) / n * 100).alias(f"{s}_percent")
    return df.agg(n.alias("entries"), *[F.count_if(F.col("quality_status") == s).alias(s) for s in ("accepted", "review", "rejected")], share("accepted"), F.avg("headword_conf").alias("mean_confidence"))
