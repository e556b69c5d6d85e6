"""Quality by compression with zstandard dictionaries of good and bad text.

One dictionary is built from good and one from bad labelled documents. A text
is compressed in short blocks with each, so that what a block repeats of the
text before it saves nothing and the dictionaries decide. The normalised
difference of the two sizes says which kind it resembles: of the whole text,
and of the worst tenth of its blocks, as a text may be bad in places. A
logistic curve over labelled documents that are in neither dictionary turns the
two differences into a score.

Bounds: at most ``PER_CLASS`` labelled documents of each class are read for the
fit; of each that goes into a dictionary at most ``PIECES`` pieces of ``PIECE``
bytes, evenly spaced over the text. The curve is fitted on whole texts and
scoring reads whole texts.

Defined cases: a null or empty text has differences of 0 and so the curve's
value there; without labels of both classes every score is the share of good
labels (0.5 if there are none). Equal texts score alike; rows that repeat a
sampled id count once. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nasij.llm.common import Written, held_out, label_counts, label_sample, logistic, ready, text_bytes

PER_CLASS = 3000
PIECE, PIECES = 1024, 8
DICTIONARY = 256 << 10
#: Of so many labelled documents one is kept for the curve.
SHARE = 4
#: Bytes added to the sums of sizes, of texts and of blocks, so that short ones
#: tell less.
DAMP, BLOCK_DAMP = 16, 32
BLOCK, WORST = 256, 0.1
LEVEL = 3
THRESHOLD = 0.7


@dataclass(frozen=True)
class Compression:
    good: bytes
    bad: bytes
    #: of the whole text's difference and of its worst blocks'
    slopes: tuple[float, float]
    bias: float

    def score(self, whole: float, worst: float) -> float:
        z = self.slopes[0] * whole + self.slopes[1] * worst + self.bias
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, z))))


class Sizer:
    """Compressed sizes under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.tools = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            self.tools.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, text: bytes) -> np.ndarray:
        """Two rows: each block's size with the good and the bad dictionary."""
        blocks = [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]
        return np.array([[len(t.compress(b)) for b in blocks] for t in self.tools], np.int64).reshape(2, -1)

    def measure(self, text: bytes) -> tuple[float, float]:
        """The differences, above 0 where the good dictionary saves more."""
        if not text:
            return 0.0, 0.0
        good, bad = self.sizes(text)
        whole = int(bad.sum() - good.sum()) / (int(good.sum() + bad.sum()) + DAMP)
        return whole, float(np.quantile((bad - good) / (good + bad + BLOCK_DAMP), WORST))


def pieces(text: bytes) -> list[bytes]:
    """The text if it is short, else evenly spaced pieces of it."""
    if len(text) <= PIECE * PIECES:
        return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]
    return [text[i : i + PIECE] for i in np.linspace(0, len(text) - PIECE, PIECES).astype(int)]


def _dictionary(samples: list[bytes]) -> bytes:
    samples = [s for s in samples if len(s) >= 8]
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(DICTIONARY, max(1 << 10, total // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        # too few samples to train on: their text is the dictionary
        return b"".join(samples)[-DICTIONARY:] or b"\0" * 16


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", per_class: int = PER_CLASS) -> Compression:
    ready(docs.sparkSession)
    counts = label_counts(labels, column)
    share = counts[1] / (counts[0] + counts[1]) if counts[0] + counts[1] else 0.5
    share = min(max(share, 0.01), 0.99)
    unfitted = Compression(b"\0" * 16, b"\0" * 16, (0.0, 0.0), math.log(share / (1 - share)))
    if not counts[0] or not counts[1]:
        return unfitted
    chosen = label_sample(labels, column, per_class)
    part = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(SHARE))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    sample = Written(rows.select("doc_id", "y", text_bytes(F.col("text")).alias("t"), part.alias("part")), "quality-sample")
    try:
        return _fitted(sample.df, counts, unfitted)
    finally:
        sample.drop()


def _fitted(sample: DataFrame, counts: dict[int, int], unfitted: Compression) -> Compression:
    have = {(r["y"], r["curve"]): r["n"] for r in sample.groupBy("y", (F.col("part") == 0).alias("curve")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len({y for y, _ in have}) < 2:
        return unfitted
    # with a class that one of the two would lack, all rows serve for both
    apart = all((y, c) in have for y in (0, 1) for c in (True, False))
    build, curve = (sample.where("part <> 0"), sample.where("part = 0")) if apart else (sample, sample)
    cut = F.pandas_udf(lambda texts: texts.map(lambda t: pieces(bytes(t))), "array<binary>")
    # at most 2 * per_class rows of PIECES pieces come to the driver
    got = sorted((r["y"], r["doc_id"], list(map(bytes, r["p"]))) for r in build.select("y", "doc_id", cut("t").alias("p")).collect())
    good, bad = (_dictionary([p for y, _, ps in got if y == c for p in ps]) for c in (1, 0))
    # two numbers of each whole text return
    seen = sorted((r["doc_id"], r["y"], r["m"]["whole"], r["m"]["worst"]) for r in curve.select("doc_id", "y", _measured(good, bad)("t").alias("m")).collect())
    y = np.array([r[1] for r in seen])
    x = np.array([r[2:] for r in seen]) * 100
    w = np.array([counts[c] / (y == c).sum() for c in y])
    *slopes, bias = map(float, logistic(x, y, w))
    return Compression(good, bad, (100 * slopes[0], 100 * slopes[1]), bias)


def _measured(good: bytes, bad: bytes):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sizer = Sizer(good, bad)
        for texts in batches:
            yield pd.DataFrame([sizer.measure(bytes(t)) for t in texts], columns=["whole", "worst"], dtype="float64")

    return F.pandas_udf(run, "whole double, worst double")


def scorer(model: Compression):
    """A column function: bytes of a text -> score."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizer = Sizer(model.good, model.bad)
        for texts in batches:
            yield pd.Series([model.score(*sizer.measure(bytes(t))) for t in texts], dtype="float64")

    return F.pandas_udf(run, "double")


def score(docs: DataFrame, model: Compression) -> DataFrame:
    s = scorer(model)(text_bytes(F.col("text")))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), s.alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
