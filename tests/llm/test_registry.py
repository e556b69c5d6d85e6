"""The registered SQL against the operators on fixtures with links."""

import duckdb
import pytest
from tests.llm import cases

from nasij.llm import neardup, registry, urls

PAGES = [
    (1, "https://a.example.com/en/1?x#y", None), (2, "http://WWW.Example.com/en/2", ""), (3, "https://other.org/page", '<html><head><link href="https://a.example.com/en/1" rel="canonical"></head>'), (4, "https://x.net/es/5", ""), (5, None, None),
    (6, "no scheme", "<p>"), (7, "https://m.org/one", '<meta http-equiv="refresh" content="0; url=/two">'), (8, "https://m.org/two", "<link rel=canonical href=//other.org/page/>"), (9, "https://free.org/", ""), (10, "https://example.com", ""),
    (11, "https://both.org/a", '<link rel="canonical" href="https://q.example.com/en/7">'), (12, "https://q.example.com/en/7", '<link rel="canonical" href="https://shop.com/x">'), (13, "https://shop.com/x", None), (14, "https://rel.org/d/e", '<meta property="og:url" content="f?utm_source=z&a=1">'),
    (15, "https://rel.org/d/f?a=1#t", '<link rel="canonical" href="https://y.net/fr/1">'), (3, "https://other.org/page", '<html><head><link href="https://a.example.com/en/1" rel="canonical"></head>'),
]


def rows(df, columns):
    return sorted(map(tuple, df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False)), key=str)


def test_url_sql_agrees_with_the_operator(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    columns = ["page_id", "host", "path", "rule", "verdict"]
    got = urls.judge(pages).select(*columns).toPandas()
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    want = con.sql(registry.oracle_sql()["op5_urls"]).df()
    assert {r[0] for r in rows(want, columns) if r[4] == "block" and r[3] is None} == {3, 7, 8, 14, 15}
    assert sorted(set(rows(got, columns)), key=str) == sorted(set(rows(want, columns)), key=str)


def test_neardup_sql_agrees_with_the_operator(spark):
    docs = cases.corpus(spark, 60).unionByName(cases.odd(spark).where("doc_id is null and text is null or doc_id between 1000 and 2000"))
    docs = docs.where("doc_id is not null")
    columns = ["doc_id", "n_shingles", "component_id", "kept"]
    got = neardup.components(docs, size=4).select(*columns).toPandas()
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert rows(got, columns) == rows(con.sql(registry.oracle_sql()["op6_neardup"]).df(), columns)


@pytest.mark.parametrize("name", ["op2_sharding", "op10_mixing"])
def test_queries_run_on_tables(spark, tmp_path, name):
    docs = cases.corpus(spark, 30)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert registry.queries()[name](spark, str(tmp_path)).count() == docs.count()


def test_pipeline_stages_pass_documents_on(spark, tmp_path):
    import corpus_pipeline

    docs = cases.corpus(spark, 90)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    cases.labels(spark, [(i, int(i % 9 != 0), 0, "") for i in range(100)]).write.parquet(str(tmp_path / "labels.parquet"))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, str(tmp_path))
        assert after.columns == docs.columns, name
        after.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        assert 0 < kept.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "neardup", "mixing", "packing"]
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path)).collect()
    assert sum(p["length"] for p in pieces if p["start"] == 0) > 0
    assert {p["doc_id"] for p in pieces} == {r["doc_id"] for r in kept.select("doc_id").collect()}
    empty = cases.none(spark)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name
