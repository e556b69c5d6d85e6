import json
import zipfile

from pyspark.sql import functions as F

from nasij.sources import readers, writers
from nasij.streaming import validate


def test_line_readers(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"x": 1}\n\n{"x": 2}\n', encoding="utf-8")
    assert [(r["row_idx"], r["x"]) for r in readers.jsonl(spark, str(p), "x int").orderBy("row_idx").collect()] == [(1, 1), (3, 2)]
    assert readers.json_report(spark, str(tmp_path / "none.json")) is None


def test_interim_and_manifest(spark, tmp_path):
    (tmp_path / "c").mkdir()
    for name, corpus in (("a.json", "x"), ("b.json", "y"), ("a_cleaned.json", "x")):
        (tmp_path / "c" / name).write_text(json.dumps({"doc_id": name, "corpus": corpus, "raw_text": "t"}))
    assert readers.interim(spark, str(tmp_path)).count() == 2
    assert [r["doc_id"] for r in readers.interim(spark, str(tmp_path), "x").collect()] == ["a.json"]
    (tmp_path / "m.csv").write_text("doc_id,title\n a ,t\n,u\na,v\n")
    assert [r[0] for r in readers.manifest(spark, str(tmp_path / "m.csv")).collect()] == ["a"]


def test_pages_and_markup(spark, tmp_path):
    (tmp_path / "p.txt").write_text("one\ftwo\f", encoding="utf-8")
    assert [(r["page"], r["text"]) for r in readers.paged_text(spark, str(tmp_path / "p.txt"), 5).orderBy("page").collect()] == [(5, "one"), (6, "two")]
    with zipfile.ZipFile(tmp_path / "b.epub", "w") as z:
        z.writestr("b.xhtml", "<html><head><title>no</title></head><body><p>ك ت ب: جمع</p><script>x</script></body></html>")
        z.writestr("a.xhtml", "<p>first</p>")
    rows = readers.epub(spark, str(tmp_path / "b.epub")).orderBy("part").collect()
    assert [r["text"].strip() for r in rows] == ["first", "ك ت ب: جمع"]
    lex = spark.createDataFrame([("ك ت ب : جمع\nسطر\nد ر س: قرأ",)], "t string")
    assert [(r["root"], r["content"]) for r in readers.root_blocks(lex, "t").collect()] == [("كتب", "جمع\nسطر"), ("درس", "قرأ")]


def test_tsv(spark, tmp_path):
    head = "level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n"
    (tmp_path / "page-027.tsv").write_text(head + "5\t1\t1\t1\t1\t1\t10\t20\t5\t5\t91.5\tكلمة\n", encoding="utf-8")
    r = readers.ocr_tsv(spark, str(tmp_path / "page-027.tsv")).first()
    assert (r["page"], r["conf"], r["text"]) == (27, "91.5", "كلمة")


def test_markdown_and_bars():
    assert writers.markdown([{"a": "x|y", "b": 0.5}, {"a": "كلمة", "b": None}], ["a", "b"]).splitlines() == ["| a | b |", "| --- | --- |", "| x\\|y | 0.5 |", '| <span dir="rtl">كلمة</span> |  |']
    assert writers.bars([{"lo": 0, "hi": 1, "n": 2}, {"lo": 1, "hi": 2, "n": 1}], 4).splitlines()[0].endswith("#### 2")


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text('{"a": "x"}\nbad{\n{"b": "y"}\n')
    q = validate.findings(spark.readStream.text(str(src)), ["a"]).writeStream.format("memory").queryName("found").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["code"] for r in spark.sql("select * from found").collect()) == ["BAD_JSON", "MISSING_FIELD"]
    rows = spark.readStream.text(str(src)).withColumn("ts", F.current_timestamp())
    q = validate.first_seen(rows.union(rows), "value", "ts").writeStream.format("memory").queryName("seen").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select * from seen").count() == 3


def test_entry_registers_what_it_claims():
    import __spark_entry__ as e

    names, sql = set(e.queries()), set(e.oracle_sql())
    assert sql <= names and len(names) >= 60
