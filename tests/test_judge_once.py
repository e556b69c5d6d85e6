"""A reply is parsed once for each pass, whatever is read of its judgement."""

import pytest

from nasij import case_queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("judge"))
    spark.range(20).selectExpr("id AS doc_id").write.parquet(f"{d}/documents.parquet")
    return d


def _parses(spark, df) -> int:
    kept = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        return df._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson")
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", kept)


def test_judged_pairs_parse_a_reply_once(spark, folder):
    """F6"""
    assert _parses(spark, case_queries.judged_pairs(spark, folder)) == 2


def test_dashboard_parses_a_reply_once(spark, folder):
    """F7"""
    df = case_queries.judge_dashboard(spark, folder)
    assert _parses(spark, df) == 2
    assert df.where("judge_status = 'ok'").count() > 0
