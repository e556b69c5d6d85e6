"""Readers. Every reader of line files keeps the line number as ``row_idx``."""

from __future__ import annotations

import html.parser
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nasij import schemas
from nasij.functions import text as T


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed rows of a JSON-lines file; blank lines are skipped."""
    return numbered_lines(spark, path).where(F.trim("value") != "").withColumn("r", F.from_json("value", schema)).select("row_idx", "r.*")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, row_idx (from 1 in each file), file.

    Lines are numbered in the order of the splits that Spark reads, which for
    one file is the order in the file.
    """
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_m"))
    return rows.withColumn("row_idx", F.row_number().over(Window.partitionBy("file").orderBy("_b", "_m"))).drop("_b", "_m")


def json_report(spark: SparkSession, path: str) -> DataFrame | None:
    """An optional report; None if there is none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return spark.read.json(path, multiLine=True)


def interim(spark: SparkSession, root: str, corpus: str | None = None) -> DataFrame:
    """Documents in ``root/*/*.json`` that are not cleaned ones yet."""
    rows = spark.read.schema(schemas.INTERIM).json(f"{root}/*/*.json", multiLine=True).where(~F.col("_metadata.file_path").endswith("_cleaned.json"))
    return rows.where(F.col("corpus") == corpus) if corpus else rows


def cleaned(spark: SparkSession, root: str, corpus: str | None = None) -> DataFrame:
    """Cleaned documents as Parquet; the corpus filter is pushed to the scan."""
    rows = spark.read.parquet(root)
    return rows.where(F.col("corpus") == corpus) if corpus else rows


def paged_text(spark: SparkSession, path: str, first_page: int = 1) -> DataFrame:
    """file, page, text of a text with form feeds; no empty page at the end."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", r"\f\s*$", "").alias("value"))
    return whole.select("file", F.posexplode(F.split("value", "\f")).alias("i", "text")).select("file", (F.col("i") + first_page).alias("page"), "text")


def ocr_tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.OCR_WORD).csv(path, sep="\t", header=True, quote="").withColumn("page", F.coalesce(F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1).try_cast("int"), F.col("page_num")))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Known document ids of the licence manifest."""
    return spark.read.csv(path, header=True).select(F.trim("doc_id").alias("doc_id")).where("doc_id <> ''").distinct()


class _Text(html.parser.HTMLParser):
    """Visible text; blocks end lines."""

    BLOCKS = frozenset("p div br li h1 h2 h3 h4 h5 h6 tr section article".split())
    HIDDEN = frozenset("script style head template".split())

    def __init__(self) -> None:
        super().__init__()
        self.out: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in self.HIDDEN
        if tag in self.BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.hidden -= tag in self.HIDDEN and self.hidden > 0
        if tag in self.BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def markup_text(markup: str) -> str:
    p = _Text()
    p.feed(markup)
    return "".join(p.out)


def epub(spark: SparkSession, path: str) -> DataFrame:
    """file, part, text of the markup files in each archive, in name order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for file, content in zip(rows["path"], rows["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    names = sorted(n for n in z.namelist() if n.lower().endswith((".xhtml", ".html", ".htm")))
                    yield pd.DataFrame([(file, i, n, markup_text(z.read(n).decode("utf-8", "replace"))) for i, n in enumerate(names)], columns=["file", "part", "name", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, part int, name string, text string")


def root_blocks(df: DataFrame, text: str) -> DataFrame:
    """root, content of a lexicon whose roots stand as three spaced letters."""
    mark = F.regexp_replace(text, r"(?md)^[ \t]*([ء-ي]) ([ء-ي]) ([ء-ي])[ \t]*(?=\n|:)", "\u0001$1$2$3\u0002")
    blocks = F.filter(F.split(mark, "\u0001"), lambda b: b.contains("\u0002"))
    return df.withColumn("_b", F.explode(blocks)).withColumn("root", F.substring_index("_b", "\u0002", 1)).withColumn("content", T.strip(F.regexp_replace(F.substring_index("_b", "\u0002", -1), "^\\s*:", ""))).drop("_b")


def staged(spark: SparkSession, files: list[tuple[str, str]]) -> DataFrame:
    """Files that a commit would hold, given as (path, text)."""
    return spark.createDataFrame(files, "path string, text string")
