import os

import numpy as np
import pytest
from nasij.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, score double, code string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 0.0, "x") for i, v in vectors], SCHEMA)


def brute(vectors, modulus, k):
    good = {i: np.array(v, float) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in (i for i in good if i % modulus == 0):
        s = sorted((-float(good[q] @ v / np.linalg.norm(good[q]) / np.linalg.norm(v)), i) for i, v in good.items() if i != q)
        out[q] = [(i, -c) for c, i in s[:k]]
    return out


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(10, 32))
    x = (centres[rng.integers(0, 10, 1500)] + 0.1 * rng.normal(size=(1500, 32))).astype(np.float32)
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    want = brute(vectors, 50, 5)
    rows = ann.search(table(spark, vectors), 50, 5).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.9
    for q, v in got.items():
        assert all(a[1] > b[1] or (a[1] == b[1] and a[0] < b[0]) for a, b in zip(v, v[1:], strict=False))
        for i, s in v:
            a, b = x[q].astype(float), x[i].astype(float)
            assert abs(s - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def test_odd_vectors_and_ties(spark):
    e = [1.0, 0.0, 0.0, 0.0]
    vectors = [(0, e), (3, e), (1, e), (2, [2.0, 0.0, 0.0, 0.0]), (50, [0.0, 1.0, 0.0, 0.0]), (4, None), (5, []), (6, [0.0] * 4), (7, [float("nan"), 1.0, 1.0, 1.0]), (8, [None, 1.0, 1.0, 1.0]), (9, [1.0, 2.0]), (None, e), (100, [float("inf"), 0.0, 0.0, 1.0]), (10, [1e-30, 0.0, 0.0, 0.0])]
    got = {}
    for r in ann.search(table(spark, vectors), 50, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {0: [1, 2, 3, 10, 50], 50: [0, 1, 2, 3, 10]}
    assert ann.search(table(spark, []), 50, 5).count() == 0
    assert ann.search(table(spark, [(0, e)]), 50, 5).count() == 0


def test_copies_and_near_copies_are_found_by_id(spark):
    rng = np.random.default_rng(4)
    n = 6000
    kind, base = rng.integers(0, 3, n), rng.normal(size=32)
    x = rng.normal(size=(n, 32))
    x[kind == 0] = base
    x[kind == 1] = base + 0.3 * rng.normal(size=32) + 1e-3 * rng.normal(size=(int((kind == 1).sum()), 32))
    vectors = [(int(i), v.tolist()) for i, v in zip(rng.permutation(n), x.astype(np.float32), strict=True)]
    want = {}
    ids, y = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors])
    for i in range(0, n, 50):
        s = ann.cosines(y, y[np.flatnonzero(ids == i)[0]])
        order = np.lexsort((ids, -s))
        want[i] = [int(v) for v in ids[order] if v != i][:5]
    got = {}
    for r in ann.search(table(spark, vectors), 50, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    kinds = {i: int(k) for (i, _), k in zip(vectors, kind, strict=True)}
    assert got.keys() == want.keys()
    for k in (0, 1):
        assert all(got[i] == want[i] for i in want if kinds[i] == k), k
    assert sum(len(set(got[i]) & set(want[i])) for i in want) >= 0.95 * 5 * len(want)


def test_beam_search_beats_one_path():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4300, 16))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    # vectors that the codebooks were not fitted to
    x, books = x[:300], ann.train(x[300:])
    code, norm = ann.encode(books, x)
    sums = sum(books.words[m][code[:, m]] for m in range(len(books.words)))
    assert np.allclose(norm, np.linalg.norm(sums, axis=1), atol=1e-4)
    left = x.copy()
    for c in books.words:
        left -= c[((left @ c.T) - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)]
    assert ((x - sums) ** 2).sum() < (left**2).sum()


def test_an_id_with_two_vectors_is_two_rows(spark):
    a, b, c = [1.0, 0.0], [0.8, 0.6], [0.0, 1.0]
    rows = ann.search(table(spark, [(0, a), (0, b), (0, a), (7, c)]), 50, 5).collect()
    assert len(rows) == 4 and {(r["query_id"], r["rank"]) for r in rows} == {(0, 1), (0, 2)}
    assert sorted((r["vec_id"], round(r["score"], 6)) for r in rows) == [(0, 0.8), (0, 0.8), (7, 0.0), (7, 0.6)]


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    t = table(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    want = {tuple(r)[:3] for r in ann.search(t, 50, 5).collect()}
    monkeypatch.setattr(ann, "BLOCK", 20)
    monkeypatch.setattr(ann, "QUERIES", 3)
    monkeypatch.setattr(ann, "STEP", 40)
    got = {tuple(r)[:3] for r in ann.search(t, 50, 5).collect()}
    exact = brute([(i, v.tolist()) for i, v in enumerate(x)], 50, 5)
    # smaller blocks rank more codes exactly
    assert sum(v in [i for i, _ in exact[q]] for q, _, v in got) >= sum(v in [i for i, _ in exact[q]] for q, _, v in want) >= 0.95 * len(want)


def test_recall_on_the_given_vectors(spark):
    folder = "/root/testdata/sf0.1/embeddings.parquet"
    if not os.path.exists(folder):
        pytest.skip("no vectors here")
    vectors = spark.read.parquet(folder).select("vec_id", "embedding")
    want = brute([(r["vec_id"], r["embedding"]) for r in vectors.collect()], 50, 5)
    got = {}
    for r in ann.search(vectors, 50, 5).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sum(len(got[q] & {i for i, _ in v}) for q, v in want.items()) >= 0.95 * 5 * len(want)
