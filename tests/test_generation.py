import json

import pytest
from pyspark.sql import functions as F

from nasij.operators import dedup, formats, generation, leakage, similarity, stats
from nasij.plans import jobs


def test_samples_from_replies(spark):
    good = [{"question": "س", "answer": "ج", "question_type": "Multi_Step", "support_facts": ["x"]}, {"question": "س", "answer": "ج"}, {"question": " ", "answer": "ج"}]
    many = [{"question": f"q{i}", "answer": "a", "question_type": ""} for i in range(20)]
    replies = [("c1", "```json\n" + json.dumps({"examples": good}) + "\n```"), ("c2", json.dumps(many)), ("c3", "not json"), ("c4", None)]
    rows = generation.samples(spark.createDataFrame(replies, "chunk_id string, reply string"), "chunk_id", "reply").collect()
    one = [r for r in rows if r["chunk_id"] == "c1"]
    assert [(r["sample_id"], r["question_type"], r["support_facts"]) for r in one] == [("c1_sft_001", "Multi-step", ["x"])]
    skipped = [{"question": "", "answer": "x"}, {"question": "q", "answer": "a", "thinking": "السؤال يسأل عن", "thinking_english": " e "}, {"question": "q2", "answer": "a2", "thinking": "why", "difficulty": "Hard", "reasoning_depth": 2, "support_facts": ["f"]}]
    got = generation.samples(spark.createDataFrame([("c9", json.dumps(skipped))], "chunk_id string, reply string"), "chunk_id", "reply").orderBy("sample_id").collect()
    assert [r["sample_id"] for r in got] == ["c9_sft_001", "c9_sft_002"]
    a, b = got
    assert (a["thinking"], a["thinking_english"], a["difficulty"], a["reasoning_mode"], a["reasoning_depth"]) == ("", "e", "Medium", "Direct Recall", 0)
    assert [m["content"] for m in a["messages"]] == ["q", "Answer:\na"] and b["messages"][1]["content"] == "Thinking:\nwhy\n\nAnswer:\na2"
    assert (b["thinking_arabic"], b["difficulty"], b["reasoning_depth"], b["teacher_only"]["required_facts"]) == ("why", "Hard", 2, ["f"])
    two = [r for r in rows if r["chunk_id"] == "c2"]
    assert len(two) == generation.CEILING and {r["question_type"] for r in two} == {"Meaning"}
    assert {r["chunk_id"] for r in rows} == {"c1", "c2"}


def test_dialect_markers(spark):
    df = spark.createDataFrame([("ليش كده؟ المشهورة مش كده",), (None,)], "t string")
    assert [r[0] for r in df.select(formats.dialect_markers(F.col("t"))).collect()] == [["ليش", "كده", "مش"], []]


def test_minhash_estimates_and_bands(spark):
    base = [f"w{i}" for i in range(120)]
    near = base[:60] + ["x"] + base[61:]
    df = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near)), (3, "all other words here at once"), (4, "")], "k int, t string")
    exact = dedup.near_pairs(df, "k", "t").first()["jaccard"]
    got = dedup.lsh_candidates(df, "k", "t").collect()
    assert [(r["doc_a"], r["doc_b"]) for r in got] == [(1, 2)] and abs(got[0]["estimate"] - exact) < 0.15


def test_mean_cosine_is_that_of_all_pairs(spark):
    v = [[1.0, 0.0], [0.0, 2.0], [3.0, 3.0], [0.0, 0.0]]
    df = spark.createDataFrame([(x,) for x in v], "v array<double>")
    r = similarity.mean_cosine(df, "v").first()
    assert r["n"] == 3 and r["mean_cosine"] == pytest.approx((0 + 2 * 2**-0.5) / 3)


def test_split_report(spark):
    rows = [(1, "d_c0001", "a b c d e f", "train"), (2, "d_c0002", "other text", "test"), (3, "x 1", "a b c d e f", "test"), (4, "z_c0001", "lone", "test")]
    df = spark.createDataFrame(rows, "k int, c string, t string, p string")
    got = {(r["code"], r["what"]) for r in leakage.verify(df, "k", "c", "t", "p", spark.createDataFrame([("d",)], "doc_id string")).collect()}
    assert {c for c, _ in got} == {"UNPARSEABLE_ID", "UNKNOWN_DOC_ID", "DOCUMENT_IN_TWO_PARTS", "TEXT_IN_TWO_PARTS"}
    assert ("UNKNOWN_DOC_ID", "z") in got and ("DOCUMENT_IN_TWO_PARTS", "d") in got


def test_even_spacing_and_thin_groups(spark):
    df = spark.createDataFrame([("g", i, 10 * i) for i in range(4)], "g string, k int, n int")
    assert [r["rank"] for r in stats.evenly_spaced(df, "g", "k").orderBy("rank").collect()] == [0, 2, 3]
    groups = spark.createDataFrame([("a", 100), ("b", 90), ("c", 10)], "g string, n int")
    assert [(r["g"], r["vs_median"]) for r in stats.thin_groups(groups, "g", "n").collect()] == [("c", 10 / 90)]
    assert stats.thin_groups(groups.where("g <> 'a'"), "g", "n").count() == 0


def test_adapter_reports_problems(spark):
    raw = spark.createDataFrame([(1, "q", "Thinking: t\nAnswer: a", "c1", "najdi"), (2, "", "a", None, "x")], "row_idx int, question string, answer string, chunk_id string, dialect string")
    flat, bad = jobs.adapt_records(raw)
    assert [(r["response"], r["had_scaffold"]) for r in flat.orderBy("row_idx").collect()] == [("a", True), ("a", False)]
    assert {tuple(r) for r in bad.collect()} == {(2, "missing_instruction"), (2, "missing_source_chunk_id")}
    pairs = spark.createDataFrame([("s1",), ("s9",)], "source_sample_id string")
    samples = spark.createDataFrame([("s1", "c1", "najdi")], "sample_id string, chunk_id string, dialect string")
    assert {r["source_sample_id"]: r["problem"] for r in jobs.join_parents(pairs, samples).collect()} == {"s1": None, "s9": "unknown_parent"}


def test_diversity_flags_at_their_bands(spark):
    ok = (0.45, 0.54, 0.24, 0.34, 10, 10, 0.75, 0, 0.75)
    bad = (0.44, 0.55, 0.25, 0.35, 10, 9, 0.74, 1, 0.74)
    df = spark.createDataFrame([ok, bad], "d double, n double, r double, t double, k int, u int, e double, a int, f double")
    flags = stats.diversity_flags(*map(F.col, ("d", "n", "r", "t", "k", "u", "e", "a", "f")))
    got = [r[0] for r in df.orderBy(F.desc("d")).select(flags).collect()]
    assert got == [[], ["LOW_PHRASING_VARIETY", "TEMPLATED_INSTRUCTIONS", "TEMPLATED_SUBSET", "SHARED_OPENING", "EXACT_DUPLICATES", "REGION_IMBALANCE", "REGIONS_ABSENT", "FORMAT_IMBALANCE"]]
    one = stats.near_template_rate(spark.createDataFrame([(0.55,), (0.5,), (1.0,), (0.0,)], "s double"), "s").first()
    assert (one["near_template_rate"], one["neighbour_max"]) == (0.5, 1.0)
    assert stats.near_template_rate(spark.createDataFrame([], "s double"), "s").first()["near_template_rate"] == 0.0


def test_reply_samples_agree_with_their_sql(spark, tmp_path):
    import duckdb

    from nasij import case_queries

    spark.range(30).selectExpr("id AS doc_id").write.parquet(str(tmp_path / "documents.parquet"))
    columns = ["doc_id", "sample_id", "question", "question_type", "said"]
    got = [tuple(r) for r in case_queries.reply_samples(spark, str(tmp_path)).select(*columns).collect()]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({case_queries._SQL['reply_samples']})").fetchall()
    assert want and sorted(got) == sorted(want)
