import json
import random

import pytest
from pyspark.sql import functions as F

from nasij.operators import chunk, guards
from nasij.plans import jobs


def units(spark, text, form):
    r = spark.createDataFrame([(text, form)], "t string, f string").select(chunk.segment(F.col("t"), F.col("f")).alias("u"), chunk.unit_type(F.col("t"), F.col("f")).alias("k")).first()
    return r["u"], r["k"]


ENTRIES = "\n".join(f"(كلمة{i}) : شرح أول\nوتكملة الشرح" for i in "أبتثج")


@pytest.mark.parametrize(
    ("text", "form", "want"),
    [
        ("a\n\n b\nc \n\n\n", "prose", (["a", "b\nc"], "paragraph")),
        ("a\nb\n\nc", "verse", (["a\nb", "c"], "stanza")),
        ("a\n b \n", "verse", (["a", "b"], "verse_line")),
        ("x\n\ny", "dictionary", (["x", "y"], "entry_block")),
        ("x\ny", "dictionary", (["x", "y"], "entry_line")),
    ],
)
def test_segments(spark, text, form, want):
    assert units(spark, text, form) == want


def test_dictionary_entries_stay_whole(spark):
    text = "مقدمة\n\nتمهيد\n" + ENTRIES + "\n( الباب الثاني )\nكلام\n\nكلام آخر\n(خاتمة) :شرح"
    got, kind = units(spark, text, "dictionary")
    assert kind == "entry_headword"
    assert got[:2] == ["مقدمة", "تمهيد"]
    assert got[2] == "(كلمةأ) : شرح أول\nوتكملة الشرح"
    assert got[-3:] == ["( الباب الثاني )\nكلام", "كلام آخر", "(خاتمة) :شرح"]


def fold(sizes, limit, stops):
    """Filled up to the limit; larger units alone; a stop opens a chunk."""
    out, no, held = [], -1, None
    for n, stop in zip(sizes, stops, strict=True):
        if n > limit:
            no, held_next = no + 1, None
        elif held is None or stop or held + n > limit:
            no, held_next = no + 1, n
        else:
            held_next = held + n
        out.append(no)
        held = held_next
    return out


def test_packing_follows_the_fold(spark):
    rng = random.Random(0)
    rows = [([300, 300, 300, 900, 100], [False] * 5)] + [([rng.randrange(1, 30) for _ in range(rng.randrange(1, 25))],) for _ in range(40)]
    rows = [(r[0], [False] * len(r[0])) for r in rows]
    texts = [(i, [" ".join(["w"] * n) for n in s]) for i, (s, _) in enumerate(rows)]
    df = spark.createDataFrame(texts, "i int, u array<string>")
    got = {r["i"]: r["c"] for r in df.select("i", chunk.chunk_numbers(F.col("u"), 40).alias("c")).collect()}
    for i, (s, stops) in enumerate(rows):
        assert got[i] == fold(s, 40, stops)
    first = df.where("i = 0").select(chunk.chunk_numbers(F.col("u"), 800).alias("c")).first()["c"]
    assert first == [0, 0, 1, 2, 3]


def test_poem_boundary_opens_a_chunk(spark):
    df = spark.createDataFrame([(["a b", "***", "c", "d"],)], "u array<string>")
    assert df.select(chunk.chunk_numbers(F.col("u"), 50, chunk.POEM_BOUNDARY)).first()[0] == [0, 1, 1, 1]


def test_chunk_rows(spark):
    df = spark.createDataFrame([("d1", ["a b c", "d e", "f " * 60, "g"]), ("d2", [])], "doc_id string, u array<string>")
    rows = chunk.chunks(df, "doc_id", F.col("u"), F.lit("prose"), F.lit("paragraph"), limit=50, least=4).orderBy("chunk_id").collect()
    assert [(r["chunk_id"], r["token_count"], r["unit_start"], r["unit_end"], r["flag"]) for r in rows] == [("d1_c0000", 5, 0, 1, None), ("d1_c0001", 60, 2, 2, "oversize_paragraph"), ("d1_c0002", 1, 3, 3, "below_target_min")]
    assert rows[0]["chunk_text"] == "a b c\n\nd e"


@pytest.mark.parametrize(
    ("units", "form", "want"),
    [([], "prose", "empty"), (["^(1) حاشية", "نص"], "prose", "footnote_block"), (["- أ", "1. ب", "نص"], "prose", "list"), (["عنوان", "جملة طويلة تنتهي هنا."], "prose", "prose"), (["جملة أولى.", "جملة ثانية."], "prose", "narrative_paragraph"), (["x"], "verse", "verse"), (["x"], "dictionary", "dictionary_entry")],
)
def test_formats_of_chunks(spark, units, form, want):
    df = spark.createDataFrame([(units, form)], "u array<string>, f string")
    assert df.select(chunk.classify(F.col("u"), F.col("f"))).first()[0] == want


def test_cleaning_takes_front_matter_and_placeholders(spark):
    raw = "كتاب الأغاني\n\nتأليف\nفلان\n\nجمع\nعلان\n\nالفصل الأول وهو كلام طويل ينتهي بنقطة ويزيد على مئة وعشرين حرفا حتى لا يحسب عنوانا قصيرا في صدر الكتاب كما هو الشرط هنا وهناك.\n\n[figure]\n\nفقرة ثانية.\n\nفقرة ثالثة."
    df = spark.createDataFrame([("d", "c", "كتاب الأغاني", raw)], "doc_id string, corpus string, title string, raw_text string")
    r = chunk.clean(df, "raw_text", F.lit("prose"), F.col("title")).first()
    assert r["header_block"].startswith("كتاب الأغاني") and r["header_roles"] == {"author_stated": "فلان", "compiler": "علان"}
    assert [x["text"] for x in r["removed_placeholders"]] == ["[figure]"]
    assert r["unit_count"] == 3 and set(r["review_flags"]) == {"media_placeholders_removed", "very_few_paragraphs"}
    assert "أ" in r["paragraphs_original"][0] and "أ" not in r["paragraphs"][0]


def test_build_corpus_drops_exact_copies(spark):
    body = "فقرة أولى طويلة.\n\nفقرة ثانية."
    rows = [("a", "x", "t", "prose", body), ("b", "x", "t", "prose", body.replace(" ", "  ")), ("c", "x", "t", "prose", "أخرى.")]
    df = spark.createDataFrame(rows, "doc_id string, corpus string, title string, source_format string, raw_text string")
    assert {r["doc_id"] for r in jobs.build_corpus(df).collect()} == {"a", "c"}


def test_guards(spark, tmp_path):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, corpus string")
    assert guards.scope(df, "corpus", "x").count() == 1
    for frame, wanted in ((df, None), (df, "z"), (spark.createDataFrame([("a", None)], "id string, corpus string"), "x")):
        with pytest.raises(ValueError):
            guards.scope(frame, "corpus", wanted)
    path = tmp_path / "r.json"
    guards.may_overwrite(spark, str(path), "x")
    path.write_text('{"config": {"corpus": "y"}}')
    with pytest.raises(ValueError, match="r_x.json"):
        guards.may_overwrite(spark, str(path), "x")
    guards.may_overwrite(spark, str(path), "y")
    with pytest.raises(ValueError):
        guards.same_format(df, "corpus", "x")
    good = {"chunk_id": "c1", "chunk_text": "t", "format_type": "prose", "source": "s", "license": "l"}
    cases = {
        1: good, 2: good | {"chunk_id": "c 1", "format_type": "odd"}, 3: good | {"chunk_text": " "}, 4: {k: v for k, v in good.items() if k != "license"}, 5: good | {"source": 5, "license": None},
        6: good | {"review_flags": "x", "source_doc_flags": ["a", 1]}, 7: good | {"source_doc_flags": ["damaged_page"]}, 8: good | {"review_flags": ["residue_tokens", "x"], "source_doc_flags": None}, 9: good | {"review_flags": []},
        10: good | {"review_flags": [None]}, 11: [1], 12: good | {"review_flags": ["fine", None]},
    }
    rows = [(i, json.dumps(r)) for i, r in cases.items()] + [(20, "{bad"), (21, "  "), (22, None)]
    found = {tuple(r) for r in guards.handoff_findings(spark.createDataFrame(rows, "line int, record string"), "line", "record").collect()}
    assert found == {
        (2, "INVALID_CHUNK_ID", "chunk_id"), (2, "UNKNOWN_FORMAT", "format_type"), (3, "EMPTY_FIELD", "chunk_text"), (3, "EMPTY_TEXT", "chunk_text"), (4, "MISSING_FIELD", "license"), (5, "EMPTY_FIELD", "source"), (5, "EMPTY_FIELD", "license"),
        (6, "INVALID_REVIEW_FLAGS", "review_flags"), (6, "INVALID_REVIEW_FLAGS", "source_doc_flags"), (7, "FATAL_REVIEW_FLAG", "review_flags"), (8, "FATAL_REVIEW_FLAG", "review_flags"),
        (10, "INVALID_REVIEW_FLAGS", "review_flags"), (11, "NOT_AN_OBJECT", None), (12, "INVALID_REVIEW_FLAGS", "review_flags"), (20, "BAD_JSON", None),
    }
