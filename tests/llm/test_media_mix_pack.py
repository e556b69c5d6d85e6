import hashlib
import itertools
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import cases

from nasij.llm import media, mixing, packing


# --- media


def test_png_round_trip_and_all_filters():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, size=(20, 64), dtype=np.uint8)
    png = media.encode_png(x)
    assert (media.decode_png(png) == x).all()
    smooth = np.repeat(np.arange(64, dtype=np.uint8)[:, None], 64, axis=1)
    assert (media.decode_png(media.encode_png(smooth)) == smooth).all()
    # filter every line by the rules, one byte at a time, and undo it
    h, w = x.shape
    lines = np.zeros((h, w + 1), np.uint8)
    for i in range(h):
        kind = i % 5
        lines[i, 0] = kind
        for j in range(w):
            a = int(x[i, j - 1]) if j else 0
            b = int(x[i - 1, j]) if i else 0
            c = int(x[i - 1, j - 1]) if i and j else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            lines[i, j + 1] = (int(x[i, j]) - (0, a, b, (a + b) // 2, paeth)[kind]) % 256
    assert (media.unfilter(lines) == x).all()


def test_damaged_png_is_refused():
    png = media.encode_png(np.zeros((4, 64), np.uint8))
    for at in (3, 20, len(png) - 20):
        bad = bytearray(png)
        bad[at] ^= 1
        with pytest.raises((ValueError, zlib.error)):
            media.decode_png(bytes(bad))
    with pytest.raises(ValueError):
        media.decode_png(png[:-6])
    deep = media.SIGNATURE + media._chunk(b"IHDR", struct.pack(">IIBBBBB", 64, 4, 16, 0, 0, 0, 0))
    with pytest.raises(ValueError):
        media.decode_png(deep + media._chunk(b"IEND", b""))


def test_hash_tells_pictures_apart():
    y, x = np.mgrid[0:64, 0:64]
    rng = np.random.default_rng(1)
    waves = lambda: sum(rng.normal() * np.cos(np.pi * (u * (2 * x + 1) + v * (2 * y + 1)) / 128) for u in range(8) for v in range(8))
    a, b = (np.clip(127 + 20 * w / w.std(), 0, 255).astype(np.uint8) for w in (waves(), waves()))
    near = np.clip(a.astype(int) + np.random.default_rng(0).integers(-3, 4, a.shape), 0, 255).astype(np.uint8)
    bits = lambda p, q: bin(int.from_bytes(media.cosine_hash(p), "big") ^ int.from_bytes(media.cosine_hash(q), "big")).count("1")
    assert bits(a, near) <= 6 < bits(a, b)


def test_media_digests(spark):
    docs = cases.odd(spark)
    rows = media.digests(docs).collect()
    text = {(r["doc_id"], r["text"]) for r in docs.collect()}
    assert len(rows) == docs.count()
    want = set()
    for i, t in text:
        raw = (t or "").encode()
        p = raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))
        want.add((i, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
    assert {(r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in rows} == want
    one = {r["payload_sha256"]: (r["media_sha256"], r["feature"]) for r in rows}
    assert all(one[r["payload_sha256"]] == (r["media_sha256"], r["feature"]) for r in rows)
    pngs = media.to_media(docs.where("doc_id = 4")).first()
    assert media.decode_png(bytes(pngs["png"])).tobytes().rstrip(b"\0") == b"two words" and len(pngs["hash"]) == 8
    assert media.digests(cases.none(spark)).count() == 0


# --- mixing


def brute_targets(totals):
    order = sorted(totals, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, free = 1.5 * sum(totals.values()), {}, set(order)
    while True:
        share = {s: weight[s] * left / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * totals[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * totals[s]
            left -= target[s]
        free -= over


def test_targets_and_sums(spark):
    docs = cases.corpus(spark, 150).unionByName(cases.odd(spark).where("doc_id <> 6 and doc_id <> 7 or doc_id is null"))
    rows = mixing.plan(docs).collect()
    assert len(rows) == docs.count()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    totals = defaultdict(int)
    source = {}
    for r in docs.collect():
        totals[r["source"]] += size(r["text"])
        source.setdefault((r["doc_id"], size(r["text"])), r["source"])
    target = brute_targets(totals)
    assert {round(r["target"], 6) for r in rows} == {round(v, 6) for v in target.values()}
    taken = defaultdict(int)
    for r in rows:
        s = source[r["doc_id"], r["size"]]
        assert r["source_size"] == totals[s] and r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
    for s in totals:
        if s is not None and s != "s":
            assert abs(taken[s] - target[s]) <= 1, s
    again = {(r["doc_id"], r["size"], r["taken"]) for r in mixing.plan(docs.repartition(3)).collect()}
    assert again == {(r["doc_id"], r["size"], r["taken"]) for r in rows}
    assert mixing.plan(cases.none(spark)).count() == 0
    made = mixing.mixed(docs)
    assert made.columns == docs.columns
    assert sum(size(r["text"]) for r in made.collect()) >= sum(r["taken"] for r in rows)


def test_hot_length_is_drawn_exactly(spark):
    rows = [(i, "a b c d e", "en", "hot", 1, 0.0, "", 1, "") for i in range(900)] + [(1000 + i, cases.prose(i, 3 + i % 7), "en", "cold", 1, 0.0, "", 1, "") for i in range(100)]
    got = mixing.plan(spark.createDataFrame(rows, cases.SCHEMA)).collect()
    # cold sorts first and weighs 5
    for s in ("hot", "cold"):
        mine = [r for r in got if (r["doc_id"] < 1000) == (s == "hot")]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 5


@pytest.mark.parametrize("budget", [0, 1, 57, 400, 999, 5000, 10**6])
def test_chosen_counts_meet_the_budget(budget):
    lengths, counts = np.array([1, 3, 7, 20, 55, 400]), np.array([3, 40, 20, 10, 9, 2])
    got = mixing.choose_counts(lengths, counts, budget)
    total = int((lengths * counts).sum())
    assert (got >= 0).all() and (got <= counts).all()
    assert int((lengths * got).sum()) == min(budget, total)


@pytest.mark.parametrize("longest", [70_000, 16_000, 500_000])
def test_one_very_long_document_leaves_no_gap(longest):
    lengths, counts = np.array([*range(1, 201), longest]), np.array([5] * 200 + [1])
    for budget in (102_300, 85_250, 99_000, 60_000, 100_501, 170_000):
        got = mixing.choose_counts(lengths, counts, budget)
        assert (got >= 0).all() and (got <= counts).all()
        short = 5 * 100 * 201
        assert int((lengths * got).sum()) == (min(budget, short) if budget < longest else min(budget, short + longest)), budget


def test_every_length_may_fill_the_budget():
    """Exact sums over far more lengths than a few, against all sums there are."""
    rng = np.random.default_rng(7)
    for _ in range(30):
        lengths = np.sort(rng.choice(np.arange(2, 90), 12, replace=False))
        counts = rng.integers(1, 3, 12)
        sums = {0}
        for n, k in zip(lengths.tolist(), counts.tolist(), strict=True):
            sums = {s + j * n for s in sums for j in range(k + 1)}
        budget = int(rng.integers(1, (lengths * counts).sum()))
        got = mixing.choose_counts(lengths, counts, budget)
        assert (got >= 0).all() and (got <= counts).all()
        assert int((lengths * got).sum()) == max(s for s in sums if s <= budget)
    # even lengths but for one that is rare: an odd budget needs it
    lengths, counts = np.array([*range(1000, 3000, 2), 1501]), np.array([3] * 1000 + [1])
    assert int((lengths * mixing.choose_counts(lengths, counts, 2_000_001)).sum()) == 2_000_001


def test_mixed_keeps_columns_of_any_name(spark):
    docs = cases.corpus(spark, 20).withColumn("_row", F.lit("mine")).withColumn("_copy", F.lit(3))
    rows = mixing.mixed(docs)
    assert rows.columns == docs.columns and all(r["_row"] == "mine" and r["_copy"] == 3 for r in rows.collect())


def test_digests_are_read_from_a_stored_column(spark, monkeypatch):
    seen = []

    class Spy(media.Written):
        def __init__(self, df, tag):
            super().__init__(df, tag)
            seen.append(self)

    monkeypatch.setattr(media, "Written", Spy)
    rows = {r["doc_id"]: r for r in media.digests(cases.corpus(spark, 6)).collect()}
    assert len(seen) == 1
    stored = seen[0].df.collect()
    assert len(stored) == len(rows)
    for r in stored:
        assert hashlib.sha256(bytes(r["png"])).hexdigest() == rows[r["doc_id"]]["media_sha256"] and bytes(r["hash"]).hex() == rows[r["doc_id"]]["feature"]


def test_small_source_with_one_very_long_document(spark):
    sizes = [n for n in range(1, 201) for _ in range(5)] + [70_000]
    rows = [(i, "w " * n, "en", "only", 1, 0.0, "", 1, "") for i, n in enumerate(sizes)]
    got = mixing.plan(spark.createDataFrame(rows, cases.SCHEMA)).collect()
    assert abs(sum(r["taken"] for r in got) - got[0]["target"]) <= 1


def test_mixed_takes_equal_rows_as_planned(spark):
    same = [(i, "a b c d e", "en", "hot", 1, 0.0, "", 1, "") for i in [7] * 300 + [None] * 300]
    docs = spark.createDataFrame(same + [(1000 + i, cases.prose(i, 3 + i % 7), "en", "cold", 1, 0.0, "", 1, "") for i in range(100)], cases.SCHEMA)
    words, want = defaultdict(int), defaultdict(int)
    for r in mixing.mixed(docs).collect():
        words[r["source"]] += len(r["text"].split())
    for r in mixing.plan(docs).collect():
        want["cold" if (r["doc_id"] or 0) >= 1000 else "hot"] += r["taken"]
    assert words == want


# --- packing


def held_to_tokenizers(texts):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path(packing.VOCABULARY)), texts


def test_ids_equal_those_of_tokenizers():
    texts = ["", "Hello world", "a  b\n\n c\t d ", "I'll can't we've", "é ü ß ñ 你好 🙂 ١٢٣", "x<|endoftext|>y <|endoftext|>", "a b  c", "don't!!! 123,456.78", " leading", "trailing ", "\r\n\r\n", "ǅ²³½ Ⅷ _under_score", cases.prose(3, 3000), "a" * 2000, "\u001c\u001d x\u0085y"]
    t, _ = held_to_tokenizers(texts)
    encode = packing.encoder()
    for x in texts:
        assert encode(x).tolist() == t.encode(x, add_special_tokens=False).ids, x[:40]


def test_slices_do_not_change_ids(monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 300)
    encode = packing.encoder()
    for text in (cases.prose(5, 2000), "word  word\n" * 400, "12 34 " * 500, "nospace" * 300):
        parts = list(packing.slices(text))
        assert "".join(parts) == text
        assert np.concatenate([encode(p) for p in parts]).tolist() == encode(text).tolist()


def test_rest_of_is_the_checksum_of_the_rest():
    raw = np.arange(100, 700, dtype="<u4").tobytes()
    for cut in (4, 400, 2396):
        assert packing.rest_of(zlib.crc32(raw), zlib.crc32(raw[:cut]), (len(raw) - cut) // 4) == zlib.crc32(raw[cut:])


def test_least_squares_against_projected_gradient():
    rng = np.random.default_rng(0)
    have = np.zeros(packing.WINDOW, np.int64)
    for a in (500, 548, 700, 1000, 1024, 1348, 1548, 300):
        have[a] = rng.integers(5, 60)
    rows = packing.patterns(have)
    assert len(rows) and (rows.sum(axis=1) == packing.WINDOW).all()
    a = np.zeros((packing.WINDOW, len(rows)))
    for j, r in enumerate(rows):
        for v in r[r > 0]:
            a[v, j] += 1
    x, y = packing.solve(have, rows, rounds=2000), np.zeros(len(rows))
    for _ in range(20_000):
        y = np.maximum(0, y - a.T @ (a @ y - have) / 20)
    assert (x >= 0).all()
    assert np.linalg.norm(a @ x - have) == pytest.approx(np.linalg.norm(a @ y - have), rel=0.02, abs=0.5)


def test_production_solve_is_optimal_and_patterns_are_all():
    rng = np.random.default_rng(3)
    have = np.zeros(packing.WINDOW, np.int64)
    for a in rng.choice(np.arange(1, packing.WINDOW), 60, replace=False).tolist() + [2000, 48, 1024, 512, 1536, 1000]:
        have[a] = rng.integers(1, 9)
    rows = packing.patterns(have)
    there = [a for a in range(1, packing.WINDOW) if have[a]]
    every = {(a, b, c) for a in there for b in [*there] for c in [0, *there] if a >= b >= c and a + b + c == packing.WINDOW}
    assert set(map(tuple, rows.tolist())) == every
    a = np.zeros((packing.WINDOW, len(rows)))
    for j, r in enumerate(rows):
        for v in r[r > 0]:
            a[v, j] += 1
    x, y = packing.solve(have, rows), np.zeros(len(rows))
    speed = 1 / np.linalg.norm(a, 2) ** 2
    for _ in range(20_000):
        y = np.maximum(0, y - a.T @ (a @ y - have) * speed)
    assert (x >= 0).all()
    assert np.linalg.norm(a @ x - have) == pytest.approx(np.linalg.norm(a @ y - have), rel=0.01, abs=0.1)


def test_few_tails_are_mostly_laid_by_patterns():
    rng = np.random.default_rng(5)
    have = np.bincount(rng.integers(1, packing.WINDOW, 1000), minlength=packing.WINDOW)
    layout = packing.plan(have)
    streamed = sum(int(have[a] - layout.places[a][-1][0]) for a in layout.stream)
    assert streamed < 400
    # every tail has one place, and no place is used twice
    seen = set()
    for a, table in layout.places.items():
        ends = [*table[1:, 0].tolist(), int(have[a])]
        for (lo, sequence, offset), hi in zip(table.tolist(), ends, strict=True):
            if sequence >= 0:
                for k in range(lo, hi):
                    spot = sequence + k - lo, offset
                    assert spot not in seen
                    seen.add(spot)
    assert len(seen) == 1000 - streamed


def test_cuts_fill_windows_and_lose_nothing():
    rng = np.random.default_rng(0)
    at, held = 0, defaultdict(int)
    for n in rng.integers(1, packing.WINDOW, 3000).tolist() + [packing.WINDOW - 1] * 50 + [1, 2, 15, 16, 17] * 200:
        parts = packing.cuts(at, n)
        assert parts[0][0] == 0 and parts[-1][1] == n and all(a[1] == b[0] for a, b in itertools.pairwise(parts))
        assert all(y == n or y % packing.UNIT == 0 for _, y, _ in parts)
        for x, y, w in parts:
            held[w] += y - x
        at += n
    assert max(held.values()) <= packing.WINDOW
    assert sorted(held) == list(range(len(held))) and len(held) <= -(-at // packing.STRIDE)
    assert sum(held.values()) / len(held) > 0.985 * packing.WINDOW


def check_packed(docs, rows):
    t, _ = held_to_tokenizers([])
    want = defaultdict(list)
    for r in docs.collect():
        want[r["doc_id"]].append(np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert any(len(i) == r["doc_tokens"] and zlib.crc32(i[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for i in want[r["doc_id"]])
    for i, ids in want.items():
        assert sum(p["length"] for p in pieces[i]) == sum(map(len, ids))
        for n in {len(x) for x in ids}:
            starts = sorted((p["start"], p["length"]) for p in pieces[i] if p["doc_tokens"] == n)
            times = sum(len(x) == n for x in ids)
            assert sum(x[1] for x in starts) == n * times
            if times == 1:
                assert all(a[0] + a[1] == b[0] for a, b in itertools.pairwise(starts))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    return sequences


def test_packing_is_whole(spark):
    docs = cases.odd(spark)
    check_packed(docs, packing.pack(docs).collect())
    assert packing.pack(cases.none(spark)).count() == 0


def test_packed_sequences_hold_the_ids(spark):
    docs = cases.odd(spark).unionByName(cases.corpus(spark, 60))
    t, _ = held_to_tokenizers([])
    want = defaultdict(list)
    for r in docs.collect():
        want[r["doc_id"]].append(np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4"))
    rows = packing.pack(docs).collect()
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        assert any(len(i) == r["doc_tokens"] and i[r["start"] : r["start"] + r["length"]].tobytes() == bytes(r["ids"]) for i in want[r["doc_id"]])
    assert any(r["length"] < r["doc_tokens"] % packing.WINDOW and r["start"] % packing.WINDOW for r in rows)
    assert sum(r["length"] for r in rows) == sum(len(i) for v in want.values() for i in v)


def test_packing_leaves_little_padding(spark):
    # one length that a third of all have, which pairs only with itself or by cuts
    texts = [cases.prose(1, 150) for _ in range(150)] + [cases.prose(i, 20 + i % 190) for i in range(300)]
    docs = spark.createDataFrame([(i, t, None, None, None, None, None, None, None) for i, t in enumerate(texts)], cases.SCHEMA)
    sequences = check_packed(docs, packing.pack(docs).collect())
    used = sum(n for s in sequences.values() for _, n in s)
    assert used / (len(sequences) * packing.WINDOW) > 0.97


def test_whole_windows_are_not_shuffled(spark):
    """Even where the optimizer takes nothing for small."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = packing.pack(cases.corpus(spark, 20))._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert "BroadcastHashJoin [task#" in plan and "SortMergeJoin [task#" not in plan
