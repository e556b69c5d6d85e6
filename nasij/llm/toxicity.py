"""Toxic passages by maximum-scoring segments of token log-odds.

Tokens are words without outer punctuation, lower-cased. A token's features are
the word and its first four and five letters; a feature's score is the log-odds
of toxic against clean labelled text with a Dirichlet prior, kept if its z-value
is significant. A token takes its strongest feature's score, any other token a
negative one. A linear-time scan finds every maximal segment of positive sum.
Segment scores follow an extreme-value law in clean text, whose parameters come
from the token scores there; a document's significant segments are joined by
their sum statistic, and a logistic curve turns its exponent into a score.

Bounds: at most ``PER_CLASS`` labelled documents of each class are read for the
fit; every significant feature of them is kept. Scoring reads whole texts.
Labelled near copies, told by two least checksums of word runs, share one
document's weight, so none is lost and none counts again and again.

Defined cases: a null or empty text has no segment and the curve's value at 0;
without labels of both classes every score is the share of toxic labels.
Repeated rows score alike. Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nasij.llm.common import Written, held_out, label_counts, label_sample, logistic, ready, text_bytes

PER_CLASS = 2000
#: A feature must be in this many documents, and its z-value and log-odds above
#: these: words that are only a little commoner in toxic text tell nothing.
LEAST_DOCS, LEAST_Z, LEAST_ODDS = 3, 2.4, 2.0
#: Pseudo-documents of the prior, and what it gives to each feature besides.
PRIOR, FLOOR = 2.0, 0.4
#: The score of a token without a significant feature.
DRIFT = -0.5
#: A segment counts if so few as good are expected in a clean text.
SIGNIFICANT = 0.05
THRESHOLD = 0.3
#: Tokens whose scores a worker remembers.
REMEMBERED = 200_000

STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’‹›…–—¡¿·•"


@dataclass(frozen=True)
class Lexicon:
    scores: dict = field(default_factory=dict)
    lam: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    bias: float = 0.0


def features(token: str) -> list[str]:
    word = token.strip(STRIP)
    if not word:
        return []
    return ["=" + word, *("^" + word[:n] for n in (4, 5) if len(word) >= n)]


class TokenScores(dict):
    """token -> score; forgets everything when it holds too much."""

    def __init__(self, lexicon: dict):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, token: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        found = [self.lexicon[f] for f in features(token) if f in self.lexicon]
        value = self[token] = max(found, key=abs) if found else DRIFT
        return value


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, sum) in one pass.

    Each candidate knows the sums left of it and up to its end, and the last
    candidate before it with a smaller left sum.
    """
    total, found = 0.0, []  # found: [start, end, left, right, before]
    for i, s in enumerate(scores):
        if s <= 0:
            total += s
            continue
        start, left = i, total
        total += s
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append([start, i + 1, left, total, j])
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, right - left) for a, b, left, right, _ in found]


def tail(model: Lexicon, sums: list[float], tokens: int) -> float:
    """-log of the chance of segments as good in a clean text so long."""
    base = math.log(max(model.k * tokens, 1e-300))
    normal = sorted((model.lam * s - base for s in sums), reverse=True)
    best, total = 0.0, 0.0
    for r, x in enumerate(normal, 1):
        total += x
        if x <= 0 or total <= 0:
            break
        # chance of a sum of r normalised scores, by its leading term
        best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + math.lgamma(r + 1))
    return best


def evidence(model: Lexicon, cache: TokenScores, text: str) -> tuple[float, list[tuple[int, int, float, float]]]:
    """The exponent, and the significant segments (start, end, sum, expected)."""
    tokens = text.lower().split()
    scores = [cache[t] for t in tokens]
    if not scores or max(scores) <= 0:
        return 0.0, []
    found = [(a, b, s, model.k * len(tokens) * math.exp(-min(model.lam * s, 700))) for a, b, s in segments(scores)]
    found = [x for x in found if x[3] <= SIGNIFICANT]
    return tail(model, [x[2] for x in found], len(tokens)), found


def calibrated(model: Lexicon, exponent: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, model.slope * math.log1p(exponent) + model.bias))))


def _sketch(texts: pd.Series) -> pd.Series:
    """The two least checksums of four words in a row: near copies mostly share
    both, and texts that share a line seldom do."""

    def least(text: str) -> int:
        w = text.encode("utf-8", "replace").lower().split()
        seen = sorted({zlib.crc32(b" ".join(w[i : i + 4])) for i in range(max(1, len(w) - 3))})[:2]
        return seen[0] << 31 ^ seen[-1]

    return texts.map(least)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Weight of each class's documents that have a feature, in this task's rows."""
    seen: dict = {}
    for rows in batches:
        for text, y, w in zip(rows["text"], rows["y"], rows["w"], strict=True):
            for f in {f for t in set(text.lower().split()) for f in features(t)}:
                seen[f, int(y)] = seen.get((f, int(y)), 0.0) + w
    rows = list(seen.items())
    yield pd.DataFrame({"f": [k[0] for k, _ in rows], "y": [k[1] for k, _ in rows], "n": [n for _, n in rows]})


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", per_class: int = PER_CLASS) -> Lexicon:
    ready(docs.sparkSession)
    counts = label_counts(labels, column)
    if not counts[0] or not counts[1]:
        share = counts[1] / (counts[0] + counts[1]) if counts[0] + counts[1] else 0.0
        share = min(max(share, 0.01), 0.99)
        return Lexicon(bias=math.log(share / (1 - share)))
    chosen = label_sample(labels, column, per_class)
    sample = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    # at most 2 * per_class rows: the window's groups are bounded
    copies = F.count(F.lit(1)).over(Window.partitionBy("y", F.col("_t")))
    sketched = sample.select("doc_id", "text", "y", F.pandas_udf(_sketch, "long")("text").alias("_t"))
    sample = Written(sketched.select("doc_id", "text", "y", (1.0 / copies).alias("w")), "toxic-sample")
    by_class = {0: 0.0, 1: 0.0} | {r["y"]: r["w"] for r in sample.df.groupBy("y").agg(F.sum("w").alias("w")).collect()}
    if not by_class[0] or not by_class[1]:
        sample.drop()
        return Lexicon(bias=math.log(0.05 / 0.95))
    n0, n1 = by_class[0], by_class[1]
    seen = sample.df.select("text", "y", "w").mapInPandas(_counts, "f string, y int, n double").groupBy("f").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b")
    )
    p = (F.col("a") + F.col("b")) / F.lit(float(n0 + n1))
    a, b = F.col("a") + PRIOR * p + FLOOR, F.col("b") + PRIOR * p + FLOOR
    odds = F.log(a / (n1 + PRIOR + 2 * FLOOR - a)) - F.log(b / (n0 + PRIOR + 2 * FLOOR - b))
    z = odds / F.sqrt(1 / a + 1 / b)
    kept = seen.where(F.col("a") + F.col("b") >= LEAST_DOCS).select("f", odds.alias("s"), z.alias("z")).where((F.col("z") >= LEAST_Z) & (F.col("s") >= LEAST_ODDS))
    model = Lexicon({r["f"]: r["s"] for r in kept.collect() if r["s"] > 0})
    # one row for each sampled document: its tokens' scores, then its evidence
    clean = sample.df.where("y = 0").select("text", "w").mapInPandas(_levels(model), "s double, n double").groupBy("s").agg(F.sum("n").alias("n")).collect()
    model = extreme_values(model, {r["s"]: r["n"] for r in clean})
    seen = sorted((r["doc_id"], r["y"], r["w"], r["x"]) for r in sample.df.select("doc_id", "y", "w", _exponents(model)(text_bytes(F.col("text"))).alias("x")).collect())
    sample.drop()
    x, y = np.log1p([r[3] for r in seen]), np.array([r[1] for r in seen])
    w = np.array([counts[r[1]] / by_class[r[1]] * r[2] for r in seen])
    slope, bias = logistic(x[:, None], y, w, ridge=0.02)
    return Lexicon(model.scores, model.lam, model.k, max(float(slope), 0.0), float(bias))


def _levels(model: Lexicon):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, seen = TokenScores(model.scores), {}
        for rows in batches:
            for text, w in zip(rows["text"], rows["w"], strict=True):
                for t in text.lower().split():
                    s = cache[t]
                    seen[s] = seen.get(s, 0.0) + w
        yield pd.DataFrame({"s": list(seen), "n": list(seen.values())}, columns=["s", "n"])

    return run


def extreme_values(model: Lexicon, levels: dict[float, float]) -> Lexicon:
    """The law's lambda and K from how often clean tokens have each score."""
    total = sum(levels.values()) + 1
    positive = {s: n for s, n in levels.items() if s > 0}
    # an unseen hit on the lexicon is given half a count
    best = max(model.scores.values(), default=1.0)
    positive[best] = positive.get(best, 0) + 0.5
    s, p = np.array([*positive, DRIFT]), np.array([*positive.values(), 0.0]) / total
    p[-1] = 1 - p[:-1].sum()
    lo, hi = 1e-6, 50.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(np.minimum(mid * s, 300))).sum() < 1 else (lo, mid)
    lam = lo
    least = min(positive)
    k = sum(positive.values()) / total * math.exp(min(lam * least, 600))
    return Lexicon(model.scores, lam, k)


def _exponents(model: Lexicon):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = TokenScores(model.scores)
        for texts in batches:
            yield pd.Series([evidence(model, cache, bytes(t).decode("utf-8", "replace"))[0] for t in texts], dtype="float64")

    return F.pandas_udf(run, "double")


def passages(docs: DataFrame, model: Lexicon) -> DataFrame:
    """Every significant passage: doc_id, first and last word, score, expected."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = TokenScores(model.scores)
        for rows in batches:
            found = [(d, *x) for d, t in zip(rows["doc_id"], rows["text"], strict=True) for x in evidence(model, cache, t)[1]]
            yield pd.DataFrame(found, columns=["doc_id", "start_word", "end_word", "score", "expected"])

    return docs.where(F.col("text").isNotNull()).select("doc_id", "text").mapInPandas(run, "doc_id long, start_word long, end_word long, score double, expected double")


def score(docs: DataFrame, model: Lexicon) -> DataFrame:
    """doc_id, held_out, score, predicted, passages, exponent of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        cache = TokenScores(model.scores)
        for texts in batches:
            found = [evidence(model, cache, bytes(t).decode("utf-8", "replace")) for t in texts]
            yield pd.DataFrame({"score": [calibrated(model, x) for x, _ in found], "passages": [len(p) for _, p in found], "exponent": [x for x, _ in found]})

    made = F.pandas_udf(run, "score double, passages int, exponent double")(text_bytes(F.col("text")))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), made.alias("m")).select(
        "doc_id", "held_out", "m.score", (F.col("m.score") >= THRESHOLD).cast("int").alias("predicted"), "m.passages", "m.exponent"
    )
