"""Approximate nearest neighbours by additive quantisation.

A unit vector is coded as a sum of ``BOOKS`` full-dimensional codewords, one
from each codebook, found by beam search over the residuals; its code and the
norm of the sum are stored. The first two words of a code name its cell. A query
visits the cells whose mean vectors are nearest, until they hold ``PROBE`` times
the square root of the number of vectors, so that the work of all queries grows
by the power 1.5 of the table. There it scores codes by table lookups: its
products with every codeword are computed once, a code's score is the sum of its
entries over the stored norm. The best are then ranked by the exact cosine of
the original vectors in double precision, with all that tie with the last of
them and all that can still reach the k-th best: a score is off by at most twice
the length of what its code leaves over. Of equal vectors that meet only the
smallest ids can be among the k, so the others are set aside first.

Cells are gathered in ``REGIONS`` by their first word; a region's vectors and
the queries that visit it are dealt to blocks, and every two blocks meet in one
task, so no region, however full, is one task's work.

Bounds: the codebooks are fitted on at most ``SAMPLE`` vectors drawn by a hash
of the id. Every row is indexed and has a cell. The driver and the broadcasts
hold the mean and the count of at most ``WORDS`` squared cells. The allowance
for a code's error stops at ``SLACK``: among coarsely coded vectors the search
is approximate, among near copies, whose codes are fine, it is not.

Defined cases: vectors that are null, empty, zero, of another length than most
of the sample, or hold a null or non-finite component take no part, and null
ids neither. Ties go to the smaller id. Equal rows (id and vector) are one row;
an id with two different vectors is two rows, each with a ranking of its own if
it is asked for, and each a candidate of the other. Empty input gives an empty
result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nasij.llm.common import Written, ready

BOOKS, WORDS, BEAM = 12, 256, 4
SAMPLE, ROUNDS = 8192, 6
#: Vectors visited for the square root of their number, and the least of cells.
PROBE, LEAST_CELLS = 96, 16
#: Groups of cells; vectors and queries of one that meet in a task.
REGIONS, BLOCK, QUERIES = 32, 32_768, 16_384
#: Codes of a block that are ranked exactly, besides all that can be as good.
RERANK = 96
#: Pairs of a query and a code that are scored together.
STEP = 4_000_000
#: Most that a score is held to be off, and what rounding adds to it.
SLACK, ROUNDING = 0.05, 4e-6
SEED = 9


@dataclass(frozen=True)
class Codebooks:
    #: books x words x dimensions
    words: np.ndarray

    @property
    def size(self) -> int:
        return self.words.shape[2]


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = ROUNDS) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = (x @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
        n = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        at = np.concatenate(([0], np.cumsum(n)[:-1]))
        full = n > 0
        sums = np.add.reduceat(x[order], at[full], axis=0)
        c[full] = sums / n[full][:, None]
        c[~full] = x[rng.choice(len(x), int((~full).sum()))]
    return c


def train(x: np.ndarray) -> Codebooks:
    """Codebooks fitted one after the other to what the earlier leave over."""
    rng, left, books = np.random.default_rng(SEED), x.astype(np.float32), []
    for _ in range(BOOKS):
        c = _kmeans(left, WORDS, rng)
        books.append(c)
        near = (left @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
        left = left - c[near]
    return Codebooks(np.stack(books).astype(np.float32))


def encode(books: Codebooks, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (n x books) and norms of the sums, by beam search."""
    code, sums = _coded(books, x)
    return code, np.linalg.norm(sums, axis=1)


def _coded(books: Codebooks, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and sums."""
    n = len(x)
    sums = np.zeros((n, 1, books.size), np.float32)
    codes = np.zeros((n, 1, 0), np.uint8)
    for c in books.words:
        left = x[:, None, :] - sums
        # squared error after each word; taken anew, as sums of it would drift
        cost = (left.reshape(-1, books.size) @ (-2 * c.T)).reshape(n, -1, WORDS) + (c * c).sum(axis=1)
        cost += (left * left).sum(axis=2)[:, :, None]
        cost = cost.reshape(n, -1)
        keep = min(BEAM, cost.shape[1])
        best = np.argpartition(cost, keep - 1, axis=1)[:, :keep]
        row = np.arange(n)[:, None]
        beam, word = best // WORDS, best % WORDS
        sums = sums[row, beam] + c[word]
        codes = np.concatenate([codes[row, beam], word[:, :, None].astype(np.uint8)], axis=2)
    top = ((x[:, None, :] - sums) ** 2).sum(axis=2).argmin(axis=1)
    row = np.arange(n)
    return codes[row, top], sums[row, top]


def _usable(vectors: pd.Series, size: int) -> np.ndarray:
    """Which rows take part; a null component came as NaN."""
    return np.array([v is not None and len(v) == size and bool(np.isfinite(a := np.asarray(v, float)).all()) and bool(np.any(a)) for v in vectors], bool)


def _unit(x: np.ndarray) -> np.ndarray:
    # scaled first, so that the squares of huge or tiny components stay finite
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sampled(vectors: DataFrame, limit: int = SAMPLE) -> np.ndarray:
    rows = vectors.where("vec_id is not null and embedding is not null").orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id").limit(limit).collect()
    lengths = [len(r["embedding"]) for r in rows if len(r["embedding"])]
    if not lengths:
        return np.zeros((0, 1))
    size = max(sorted(set(lengths)), key=lengths.count)
    x = pd.Series([r["embedding"] and [np.nan if v is None else v for v in r["embedding"]] for r in rows], dtype=object)
    good = x[_usable(x, size)]
    return _unit(np.stack([np.asarray(v, float) for v in good])) if len(good) else np.zeros((0, size))


def regions(books: Codebooks) -> np.ndarray:
    """The region of each first word."""
    c = books.words[0]
    centre = _kmeans(c, REGIONS, np.random.default_rng(SEED))
    return (c @ centre.T - 0.5 * (centre * centre).sum(axis=1)).argmax(axis=1).astype(np.int32)


INDEX = "vec_id long, embedding binary, code binary, norm double, error double, cell int, region int"


def index(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, embedding (its numbers' bytes), code, norm, error, cell, region of
    every vector that takes part."""
    kind, own = _kind(vectors), regions(books)
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows = rows[_usable(rows["embedding"], shared.value.size)]
            if len(rows):
                x = np.stack(rows["embedding"].to_list()).astype(kind)
                unit = _unit(x.astype(np.float64))
                code, sums = _coded(shared.value, unit.astype(np.float32))
                norm, error = np.linalg.norm(sums, axis=1), np.linalg.norm(unit - sums, axis=1)
                yield pd.DataFrame({
                    "vec_id": rows["vec_id"], "embedding": [v.tobytes() for v in x], "code": [c.tobytes() for c in code], "norm": norm.astype(float), "error": error.astype(float),
                    "cell": code[:, 0].astype(np.int32) * WORDS + code[:, 1], "region": own[code[:, 0]],
                })

    element = "float" if kind == np.float32 else "double"
    whole = F.transform("embedding", lambda v: F.coalesce(v.cast(element), F.lit(float("nan")).cast(element)))
    return vectors.where("vec_id is not null and embedding is not null").select("vec_id", whole.alias("embedding")).mapInPandas(run, INDEX)


def _kind(vectors: DataFrame):
    """The number type that keeps the vectors' components as they are."""
    return np.float32 if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else np.float64


@dataclass(frozen=True)
class Cells:
    """Sorted cells with their counts and mean directions."""

    cell: np.ndarray
    count: np.ndarray
    mean: np.ndarray
    region: np.ndarray


def cells(indexed: DataFrame, books: Codebooks, kind) -> Cells:
    """Counts are of different codes among rows that were read together, so that
    a group of copies does not fill the visits of its neighbours."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict = {}
        for rows in batches:
            x = _unit(np.frombuffer(b"".join(rows["embedding"]), kind).reshape(len(rows), -1).astype(np.float64)).astype(np.float32)
            of = rows["cell"].to_numpy()
            codes = pd.Series(rows["code"].to_numpy()).groupby(of).nunique()
            at, place = np.unique(of, return_inverse=True)
            sums = np.zeros((len(at), x.shape[1]), np.float32)
            np.add.at(sums, place, x)
            for c, v in zip(at.tolist(), sums, strict=True):
                n, total = seen.get(c, (0, 0.0))
                seen[c] = n + int(codes[c]), total + v
        yield _rows(seen)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict = {}
        for rows in batches:
            for c, m, v in zip(rows["cell"].tolist(), rows["n"].tolist(), rows["total"], strict=True):
                n, total = seen.get(c, (0, 0.0))
                seen[c] = n + m, total + np.frombuffer(v, np.float32)
        yield _rows(seen)

    schema = "cell int, n long, total binary"
    parts = indexed.select("cell", "code", "embedding").mapInPandas(part, schema)
    # at most WORDS * WORDS rows
    rows = sorted((r["cell"], r["n"], bytes(r["total"])) for r in parts.repartition("cell").mapInPandas(merge, schema).collect())
    at = np.array([r[0] for r in rows], np.int64)
    mean = np.frombuffer(b"".join(r[2] for r in rows), np.float32).reshape(len(rows), -1)
    mean = mean / np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-9)
    return Cells(at, np.array([r[1] for r in rows], np.int64), mean, regions(books)[at // WORDS])


def _rows(seen: dict) -> pd.DataFrame:
    return pd.DataFrame({"cell": list(seen), "n": [n for n, _ in seen.values()], "total": [np.asarray(v, np.float32).tobytes() for _, v in seen.values()]})


def _visits(shared, kind):
    """Per query: the least nearness of a cell that it visits, and the regions."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        books, made = shared.value
        goal = PROBE * math.sqrt(max(int(made.count.sum()), 1))
        for x in batches:
            out = []
            unit = _unit(np.frombuffer(b"".join(x), kind).reshape(len(x), -1).astype(np.float64)).astype(np.float32)
            for i in range(0, len(unit), 64):
                near = unit[i : i + 64] @ made.mean.T
                order = np.argsort(-near, axis=1, kind="stable")
                held = np.cumsum(made.count[order], axis=1)
                last = np.minimum(np.maximum((held < goal).sum(axis=1), LEAST_CELLS - 1), len(made.cell) - 1)
                for j, n in enumerate(last.tolist()):
                    visited = order[j, : n + 1]
                    out.append((float(near[j, visited[-1]]), np.unique(made.region[visited]).tolist()))
            yield pd.DataFrame(out, columns=["least", "regions"])

    return F.pandas_udf(run, "least double, regions array<int>")


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact cosines in double precision; equal rows give equal values."""
    x, q = x / np.abs(x).max(axis=1, keepdims=True), q / np.abs(q).max()
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def _search(shared, kind, k: int):
    """The k best of a block of vectors for each query of a block."""

    def run(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": np.zeros(0, np.int64), "query": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(vectors) or not len(asked):
            return none
        books, made = shared.value
        # one more than k, as a query leaves out its own row
        vectors = vectors.drop_duplicates(["vec_id", "embedding"])
        vectors = vectors[vectors.groupby("embedding")["vec_id"].rank("dense") <= k + 1].sort_values(["cell", "vec_id"], kind="stable")
        own, raw = vectors["vec_id"].to_numpy(), vectors["embedding"].to_numpy()
        x = np.frombuffer(b"".join(raw), kind).reshape(len(own), -1).astype(np.float64)
        code = np.frombuffer(b"".join(vectors["code"]), np.uint8).reshape(len(own), -1).astype(np.int64)
        norm = np.maximum(vectors["norm"].to_numpy(), 1e-9).astype(np.float32)
        slack = (np.minimum(2 * vectors["error"].to_numpy(), SLACK) + ROUNDING).astype(np.float32)
        here, place = np.unique(vectors["cell"].to_numpy(), return_inverse=True)
        mean = made.mean[np.searchsorted(made.cell, here)]
        ids, asked_raw, least = asked["vec_id"].to_numpy(), asked["embedding"].to_numpy(), asked["least"].to_numpy()
        q = np.frombuffer(b"".join(asked_raw), kind).reshape(len(ids), -1).astype(np.float64)
        unit = _unit(q).astype(np.float32)
        found = []
        step = max(1, STEP // len(own))
        for a in range(0, len(ids), step):
            part = unit[a : a + step]
            # what rounding may do to the nearness of a cell is allowed for
            visited = (part @ mean.T >= least[a : a + step, None] - 1e-5)[:, place]
            row, col = np.nonzero(visited)
            # lookup tables: every query's products with every codeword
            score = np.zeros(len(row), np.float32)
            for m, words in enumerate(books.words):
                score += (part @ words.T).ravel()[row * WORDS + code[col, m]]
            score /= norm[col]
            ends = np.searchsorted(row, np.arange(len(part) + 1))
            for i in range(len(part)):
                at, near = col[ends[i] : ends[i + 1]], score[ends[i] : ends[i + 1]]
                mine = own[at] == ids[a + i]
                for j in np.flatnonzero(mine):
                    mine[j] = raw[at[j]] == asked_raw[a + i]
                at, near = at[~mine], near[~mine]
                if not len(at):
                    continue
                if len(at) > RERANK:
                    cut = np.partition(near, -RERANK)[-RERANK]
                    first = near >= cut
                    known = cosines(x[at[first]], q[a + i])
                    # what ties with the last of these or can reach the k-th best
                    reach = np.partition(known, -k)[-k]
                    at = at[first | (near + slack[at] >= reach)]
                s = cosines(x[at], q[a + i])
                best = np.lexsort((own[at], -s))[:k]
                found.append((a + i, own[at[best]], s[best]))
        if not found:
            return none
        n = [len(v) for _, v, _ in found]
        of = np.repeat([i for i, _, _ in found], n)
        return pd.DataFrame({"query_id": ids[of], "query": asked["query"].to_numpy()[of], "vec_id": np.concatenate([v for _, v, _ in found]), "score": np.concatenate([s for _, _, s in found])})

    return run


def search(vectors: DataFrame, modulus: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every modulus-th id."""
    spark = ready(vectors.sparkSession)
    vectors = vectors.select("vec_id", "embedding")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    x = sampled(vectors)
    if not len(x):
        return empty
    books, kind = train(x), _kind(vectors)
    indexed = Written(index(vectors, books), "codes").df
    made = cells(indexed, books, kind)
    shared = spark.sparkContext.broadcast((books, made))
    # a query is a row: its id and its vector
    asked = indexed.where(F.pmod("vec_id", F.lit(modulus)) == 0).select("vec_id", "embedding").distinct()
    asked = asked.select("*", F.xxhash64("vec_id", "embedding").alias("query"), _visits(shared, kind)("embedding").alias("v"))
    asked = Written(asked.select("vec_id", "embedding", "query", "v.least", F.explode("v.regions").alias("region")), "queries").df
    # at most REGIONS rows each
    held = {r["region"]: r["n"] for r in indexed.groupBy("region").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = {r["region"]: r["n"] for r in asked.groupBy("region").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = F.element_at(F.array(*[F.lit(max(1, -(-held.get(r, 0) // BLOCK))) for r in range(REGIONS)]), F.col("region") + 1)
    parts = F.element_at(F.array(*[F.lit(max(1, -(-wanted.get(r, 0) // QUERIES))) for r in range(REGIONS)]), F.col("region") + 1)
    key, each = ["region", "block", "part"], lambda n, name: F.explode(F.sequence(F.lit(0), n - 1)).alias(name)
    left = indexed.withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks).cast("int")).select("*", each(parts, "part"))
    right = asked.withColumn("part", F.pmod("query", parts).cast("int")).select("*", each(blocks, "block"))
    # the number of tasks is given, as small rows with much work must not be put together
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left, right = left.repartition(tasks, *key), right.repartition(tasks, *key)
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_search(shared, kind, k), "query_id long, query long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
