"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text's vector counts its lower-cased byte trigrams (words are set off by
spaces, and all that is neither a letter nor a mark counts as space) in
``DIMS`` hashed places, damped, weighted by inverse document frequency and
normalised. Each language has up to ``CENTROIDS`` centroids, clustered on the
sphere. A text takes the language of the centroid with the largest cosine, and
is rejected if even that is lower than nearly all training text of its length
has. Training text of a length is whole texts, and runs of letters from places
spread over them, so that short texts are judged by short ones.

Bounds: at most ``PER_LANG`` labelled documents of a language are read for the
fit, and ``RUNS`` runs of each of four lengths for the rejection. Centroids are
fitted on whole texts, and scoring reads whole texts. The centroids go to all executors: some 66 KB a
language.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and
rejected; without training documents every text is. Ties go to the language
that comes first. Repeated rows are judged alike. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from nasij.llm.common import Written, fold, held_out, ready

PER_LANG = 300
DIMS = 4096
CENTROIDS = 4
SEED = 7
#: Share of training texts of a length that may lie below its least cosine, and
#: how far below that a text must be to go.
QUANTILE, SLACK = 0.002, 0.8
#: Steps in which cosines are counted, and runs of a length from one text.
STEPS, RUNS = 1000, 5
UNKNOWN = "und"
#: Bytes of a text that are counted at a time.
STEP = 1 << 20


@dataclass(frozen=True)
class Centroids:
    langs: tuple[str, ...]
    owner: np.ndarray
    vectors: np.ndarray
    idf: np.ndarray
    #: by the power of two in the number of trigrams
    least: np.ndarray


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


_SPACE = np.full(256, 32, np.uint32)
_SPACE[97:123] = np.arange(97, 123)
_SPACE[128:] = np.arange(128, 256)


def counts(text: str) -> np.ndarray:
    """Hashed trigram counts of a whole text."""
    out = np.zeros(DIMS, np.int64)
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8)
    for i in range(0, max(len(raw) - 2, 0), STEP):
        b = _SPACE[raw[i : i + STEP + 2]]
        b = b[(b != 32) | np.append(True, b[:-1] != 32)]
        if len(b) > 2:
            h = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D)
            h ^= h >> np.uint32(15)
            out += np.bincount((h * np.uint32(0x27D4EB2F)) >> np.uint32(20), minlength=DIMS)
    return out


def weighted(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(c) * idf
    norm = np.sqrt((v * v).sum(axis=-1, keepdims=True))
    return v / np.where(norm > 0, norm, 1)


def _clusters(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Spherical k-means, started from texts far from one another."""
    at = [int(rng.integers(len(x)))]
    for _ in range(min(k, len(x)) - 1):
        at.append(int((x @ x[at].T).max(axis=1).argmin()))
    c = x[at]
    for _ in range(15):
        near = (x @ c.T).argmax(axis=1)
        c = np.stack([x[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def _bucket(total: int | np.ndarray):
    return np.clip(np.log2(np.maximum(total, 1)).astype(int), 0, 31)


def fit(docs: DataFrame, per_lang: int = PER_LANG) -> Centroids:
    """Learns from text and language of rows outside the held-out fold."""
    ready(docs.sparkSession)
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id")) != 2)).select("doc_id", "lang", "text")
    # the choice needs the ids only; the texts of at most per_lang rows of each
    # language then come as counts
    near = rows.select("doc_id", "lang", F.xxhash64("doc_id", F.lit(SEED)).alias("h"))
    best = near.withColumn("r", F.row_number().over(Window.partitionBy("lang", F.pmod("h", F.lit(16))).orderBy("h", "doc_id"))).where(F.col("r") <= -(-per_lang // 16))
    sample = Written(rows.join(F.broadcast(best.select("doc_id", "lang").distinct()), ["doc_id", "lang"]).dropDuplicates(["doc_id"]), "lang-sample")
    try:
        return _fitted(sample.df)
    finally:
        sample.drop()


def _fitted(sample: DataFrame) -> Centroids:
    got = sample.select("doc_id", "lang", F.pandas_udf(_sample, "binary")("text").alias("c")).where("c is not null").collect()
    got = sorted((r["lang"], r["doc_id"], zlib.decompress(r["c"])) for r in got)
    if not got:
        return Centroids((), np.zeros(0, int), np.zeros((0, DIMS)), np.zeros(DIMS), np.zeros(32))
    full = np.stack([np.frombuffer(c, np.uint32) for _, _, c in got])
    idf = (np.log((1 + len(full)) / (1 + (full > 0).sum(axis=0))) + 1).astype(np.float32)
    langs, x, rng = tuple(sorted({g[0] for g in got})), weighted(full.astype(np.float32), idf), np.random.default_rng(SEED)
    owner, vectors = [], []
    for i, lang in enumerate(langs):
        c = _clusters(x[[g[0] == lang for g in got]], CENTROIDS, rng)
        owner += [i] * len(c)
        vectors.append(c)
    owner, vectors = np.array(owner), np.concatenate(vectors)
    model = Centroids(langs, owner, vectors.astype(np.float32), idf.astype(np.float32), np.zeros(32))
    # how many runs of each length have each cosine: STEPS * 32 rows at most
    seen = sample.select("text", "lang").mapInPandas(_cosines(model), "size int, step int, n long").groupBy("size", "step").agg(F.sum("n").alias("n")).collect()
    table, least = np.zeros((34, STEPS + 1)), np.zeros(32)
    for r in seen:
        table[r["size"] + 1, r["step"]] = r["n"]
    for b in range(32):
        near = np.cumsum(table[b : b + 3].sum(axis=0))
        least[b] = SLACK * np.searchsorted(near, max(QUANTILE * near[-1], 0.5)) / STEPS if near[-1] >= 20 else (least[b - 1] if b else 0.0)
    # a longer text is never asked for less than a shorter one's least
    return replace(model, least=np.maximum.accumulate(least))


def _sample(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: zlib.compress(np.minimum(counts(t), 2**32 - 1).astype(np.uint32).tobytes(), 1) if has_letter(t) else None)


def runs(text: str) -> Iterator[str]:
    """The text, and RUNS runs of 8, 32, 128 and 512 letters spread over it."""
    yield text
    for n in (8, 32, 128, 512):
        if n < len(text):
            yield from (text[i : i + n] for i in np.unique(np.linspace(0, len(text) - n, RUNS).astype(int)))


def _cosines(model: Centroids):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict = {}
        own = {lang: model.vectors[model.owner == i].T for i, lang in enumerate(model.langs)}
        for rows in batches:
            for text, lang in zip(rows["text"], rows["lang"], strict=True):
                if lang not in own:
                    continue
                for part in filter(has_letter, runs(text)):
                    c = counts(part)
                    at = np.flatnonzero(c)
                    v = np.log1p(c[at]) * model.idf[at]
                    cos = float((v @ own[lang][at]).max() / max(float(np.sqrt((v * v).sum())), 1e-12))
                    key = int(_bucket(int(c.sum()))), int(min(max(cos, 0.0), 1.0) * STEPS)
                    seen[key] = seen.get(key, 0) + 1
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["size", "step", "n"])

    return run


def judge(model: Centroids, texts: list) -> list[tuple[str, float, bool]]:
    out: list = [(UNKNOWN, 0.0, True)] * len(texts)
    if not model.langs:
        return out
    at = [i for i, t in enumerate(texts) if t is not None and has_letter(t)]
    for i in at:
        c = counts(texts[i])
        cos = model.vectors @ weighted(c, model.idf).astype(np.float32)
        best = int(cos.argmax())
        value = float(min(max(cos[best], 0.0), 1.0))
        out[i] = (model.langs[model.owner[best]], value, bool(value < model.least[_bucket(int(c.sum()))]))
    return out


def judged(docs: DataFrame, model: Centroids):
    """A column of each text's struct<lang_pred, score, rejected>."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(judge(shared.value, [t if isinstance(t, str) else None for t in texts]), columns=["lang_pred", "score", "rejected"])

    return F.pandas_udf(run, "lang_pred string, score double, rejected boolean")(F.col("text"))


def predict(docs: DataFrame, model: Centroids) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row."""
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), judged(docs, model).alias("m")).select("doc_id", "held_out", "m.lang_pred", "m.score", "m.rejected")
