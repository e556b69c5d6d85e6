"""Packing into windows by non-negative least squares over length patterns.

A document's token ids, with the end id, are cut into whole windows and a tail.
Tails are counted by exact length (a histogram of fewer than ``WINDOW`` bins).
All patterns of two or three lengths that fill a window exactly are the columns
of a non-negative least-squares problem whose solution, rounded, says how often
each pattern is laid out. The problem has many solutions; the descent starts
from whole repeats, so that it ends near whole numbers. What is left is packed
greedily: first by patterns that still fit, then in order of length, where tails
follow one another and are cut, at a multiple of ``UNIT`` ids, where a window
ends.

Which tail takes which place follows from its number among the tails of its
length, so that the driver sees no more than the histogram. Each piece carries
its ids, as little-endian 32-bit numbers, and the checksum taken of them.

Defined cases: a null or empty text is the end id alone; equal rows are packed
one by one; very long texts fill whole windows of their own. Empty input gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nasij.llm.common import Written, ready

WINDOW, END, UNIT = 2048, 1, 16
#: Ids of the stream for each window: moving a cut back fills the rest.
STRIDE = WINDOW - UNIT + 1
#: Parts by which the tails of one length are numbered.
SALTS = 64
#: Share of the tails by which the least squares may still move when they stop.
SETTLED = 1e-3
VOCABULARY, MERGES = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
#: Letters of a text that are tokenised at once, cut where a space follows a letter.
SLICE = 1 << 18


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_loaded: dict = {}


def encoder(path: str | None = None):
    """ids of a text as ``tokenizers`` gives them for the vocabulary's file.

    The same vocabulary and merges are read by tiktoken, which is several times
    faster; tests hold the ids of the two against each other.
    """
    path = path or tokenizer_path(MERGES)
    if path not in _loaded:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding("nasij", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    made = _loaded[path]
    return lambda text: made.encode_to_numpy(text, allowed_special="all")


def slices(text: str) -> Iterator[str]:
    """Parts whose ids, one after the other, are the text's: a cut lies before a
    single space between ASCII letters."""
    at = 0
    while len(text) - at > SLICE:
        cut = at + SLICE
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut + 1 >= len(text):
                cut = len(text)
                break
            a, b = text[cut - 1], text[cut + 1]
            if a.isascii() and a.isalpha() and b.isascii() and b.isalpha():
                break
            cut += 1
        yield text[at:cut]
        at = cut
    if at < len(text):
        yield text[at:]


def _measure(path: str | None):
    """Per text: its number of ids, the ids of its whole windows and of its tail,
    and its first whole window's number in the task."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode, before = encoder(path), 0
        for texts in batches:
            rows = []
            for t in texts:
                parts = [encode(x) for x in slices(t)] if t else []
                ids = np.concatenate([*parts, [END]]).astype("<u4")
                full, tail = divmod(len(ids), WINDOW)
                raw = ids.tobytes()
                whole = [raw[i * 4 * WINDOW : (i + 1) * 4 * WINDOW] for i in range(full)]
                rows.append((len(ids), full, whole, tail, raw[full * 4 * WINDOW :], before))
                before += full
            yield pd.DataFrame(rows, columns=["tokens", "windows", "whole", "tail", "rest", "first"])

    return F.pandas_udf(run, "tokens long, windows long, whole array<binary>, tail int, rest binary, first long")


def rest_of(whole: int, begin: int, ids: int) -> int:
    """Checksum of the last ``ids`` ids, from those of the whole and the begin."""
    nil = bytes(4 * ids)
    return whole ^ zlib.crc32(nil, begin) ^ zlib.crc32(nil)


def patterns(have: np.ndarray) -> np.ndarray:
    """All rows of two or three lengths (0: none), in falling order, that occur
    and fill a window: some WINDOW ** 2 / 12 at most."""
    there = np.zeros(WINDOW + 1, bool)
    there[1:WINDOW] = have[1:WINDOW] > 0
    out = [np.zeros((0, 3), np.int64)]
    for a in np.flatnonzero(there).tolist():
        b = np.arange(max(1, -(-(WINDOW - a) // 2)), min(a, WINDOW - a) + 1)
        c = WINDOW - a - b
        fits = there[b] & (there[c] | (c == 0))
        out.append(np.stack([np.full(int(fits.sum()), a), b[fits], c[fits]], axis=1))
    return np.concatenate(out)[::-1].astype(np.int64)


def _most(left: np.ndarray, lengths: list[int]) -> int:
    """How often the pattern can be laid with what is left."""
    return min(int(left[a]) // lengths.count(a) for a in lengths)


def greedy(left: np.ndarray) -> dict[tuple, int]:
    """Whole repeats of patterns, the longest lengths first; takes from ``left``."""
    out: dict[tuple, int] = {}
    for a in range(WINDOW - 1, WINDOW // 3, -1):
        if not left[a]:
            continue
        b = np.arange(max(1, -(-(WINDOW - a) // 2)), min(a, WINDOW - a) + 1)
        c = WINDOW - a - b
        # the pair is the last; a triple that can be laid often comes first
        can = np.minimum(left[b], np.where(c > 0, left[c], left[b]))
        for i in np.lexsort((b, can))[::-1]:
            if not left[a] or not can[i]:
                break
            row = (a, int(b[i]), int(c[i]))
            n = _most(left, [x for x in row if x])
            if n > 0:
                out[row] = out.get(row, 0) + n
                for x in row:
                    left[x] -= n if x else 0
    return out


def solve(have: np.ndarray, rows: np.ndarray, rounds: int = 300) -> np.ndarray:
    """min |A x - have| with x >= 0, by exact steps along one pattern at a time.

    Column j of A counts how often each length is in pattern j. A round goes
    through the patterns along which a step would still pay; it ends when the
    steps of a round are ``SETTLED`` of the counts together.
    """
    start = greedy(rest := have.astype(np.int64).copy())
    left = rest.astype(float)
    left[0] = 0.0
    x = np.array([float(start.get(tuple(r), 0)) for r in rows.tolist()])
    norm = (rows[:, :, None] == rows[:, None, :]).sum(axis=(1, 2)) - (rows[:, 2] == 0)
    for _ in range(rounds):
        gain = left[rows].sum(axis=1) / norm
        open_ = np.flatnonzero((gain > 0.01) | ((gain < -0.01) & (x > 0)))
        moved, r = 0.0, left.tolist()
        for j, (a, b, c), n in zip(open_.tolist(), rows[open_].tolist(), norm[open_].tolist(), strict=True):
            step = max((r[a] + r[b] + r[c]) / n, -x[j])
            if step:
                x[j] += step
                r[a] -= step
                r[b] -= step
                if c:
                    r[c] -= step
                moved += abs(step)
        left = np.array(r)
        if moved <= SETTLED * max(1.0, float(have.sum())):
            break
    return x


@dataclass(frozen=True)
class Layout:
    """Where the tails of each length go, by their number: from ``lo`` on to
    places (sequence, sequence + 1, ...) at ``offset``, or to the stream."""

    #: by length: arrays lo, sequence (-1: stream), offset
    places: dict
    #: ids at which the stream of each length's rest begins
    stream: dict
    sequences: int
    streamed: int


def plan(have: np.ndarray) -> Layout:
    """have[length]: number of tails (length 0 is unused)."""
    left = have.astype(np.int64).copy()
    left[0] = 0
    rows = patterns(left)
    x = solve(left, rows) if len(rows) else np.zeros(0)
    places: dict[int, list] = {}
    used, sequence = np.zeros(WINDOW, np.int64), 0
    order = np.argsort(-x, kind="stable")
    laid = []
    for j in order[x[order] >= 0.5]:
        row = [a for a in rows[j].tolist() if a]
        n = min(int(round(x[j])), _most(left, row))
        if n > 0:
            laid.append((row, n))
            for a in row:
                left[a] -= n
    # the residuals: patterns that still fit
    laid += [([a for a in row if a], n) for row, n in greedy(left).items()]
    for row, n in laid:
        offset = 0
        for a in row:
            places.setdefault(a, []).append((int(used[a]), sequence, offset))
            used[a] += n
            offset += a
        sequence += n
    stream, at = {}, 0
    for a in range(WINDOW - 1, 0, -1):
        if left[a]:
            places.setdefault(a, []).append((int(used[a]), -1, 0))
            stream[a] = at
            at += int(left[a]) * a
    return Layout({a: np.array(v, np.int64) for a, v in places.items()}, stream, sequence, -(-at // STRIDE))


def cuts(begin: int, length: int) -> list[tuple[int, int, int]]:
    """(from, to, window) of the pieces of a tail that begins there in the
    stream. Each cut is moved back to a multiple of UNIT, so a window holds at
    most STRIDE + UNIT - 1 ids."""
    out, at, n = [], 0, begin // STRIDE
    while at < length:
        end = min(length, (n + 1) * STRIDE - begin)
        if end < length:
            end = end // UNIT * UNIT
        if end > at:
            out.append((at, end, n))
        at, n = max(at, end), n + 1
    return out


def _place(layout: Layout):
    """Pieces of each tail: (start in the tail, length, sequence, order)."""
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for tails, ranks in batches:
            out = []
            for a, r in zip(tails.tolist(), ranks.tolist(), strict=True):
                if not a:
                    out.append([])
                    continue
                table = layout.places[a]
                lo, sequence, offset = table[np.searchsorted(table[:, 0], r, "right") - 1].tolist()
                if sequence >= 0:
                    out.append([{"start": 0, "length": a, "sequence": sequence + r - lo, "offset": offset, "streamed": False}])
                    continue
                begin = layout.stream[a] + (r - lo) * a
                out.append([
                    {"start": x, "length": y - x, "sequence": layout.sequences + n, "offset": begin + x, "streamed": True} for x, y, n in cuts(begin, a)
                ])
            yield pd.Series(out)

    return F.pandas_udf(run, "array<struct<start:long,length:long,sequence:long,offset:long,streamed:boolean>>")


def pack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset."""
    ready(docs.sparkSession)
    spark = docs.sparkSession
    # the row's own number and task are stable once written
    made = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).select("doc_id", _measure(path)("t").alias("m"), F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("row"))
    tails = Written(made.select("doc_id", "m.*", "task", "row").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")), "tails").df
    parts = tails.groupBy("tail", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tail").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    # at most WINDOW * SALTS rows
    parts = Written(parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "tail-parts").df
    have = np.zeros(WINDOW, np.int64)
    for r in parts.groupBy("tail").agg(F.sum("n").alias("n")).collect():
        have[r["tail"]] = r["n"]
    layout = plan(have)
    base = layout.sequences + layout.streamed

    numbered = Window.partitionBy("tail", "salt").orderBy("row")
    ranked = tails.where("tail > 0").select("doc_id", "tokens", "tail", "salt", "rest", F.row_number().over(numbered).alias("_r"), "row").join(parts.select("tail", "salt", "before"), ["tail", "salt"])
    place = _place(layout)("tail", F.col("before") + F.col("_r") - 1)
    pieces = ranked.select("doc_id", "tokens", "tail", "rest", F.explode(place).alias("p")).select(
        "doc_id", (F.col("tokens") - F.col("tail") + F.col("p.start")).alias("start"), "p.length", F.expr("substring(rest, int(4 * p.start + 1), int(4 * p.length))").alias("ids"), F.col("tokens").alias("doc_tokens"), F.col("p.sequence").alias("sequence_id"), "p.offset", "p.streamed"
    )
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id"]
    laid = pieces.where("not streamed").select(*names, "offset")
    # the pieces of a streamed window, in the order of the stream, close up
    inside = Window.partitionBy("sequence_id").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    streamed = pieces.where("streamed").withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long")).select(*names, "offset")

    # whole windows, numbered task by task; a row for each task is broadcast, so that
    # the ids of windows are not shuffled
    tasks = tails.groupBy("task").agg(F.sum("windows").alias("n"))
    tasks = tasks.withColumn("_base", F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("task", "_base")
    whole = tails.where("windows > 0").join(F.broadcast(tasks), "task").select("doc_id", "tokens", "first", "_base", F.posexplode("whole").alias("i", "ids")).select(
        "doc_id", (F.col("i") * WINDOW).cast("long").alias("start"), F.lit(WINDOW).cast("long").alias("length"), "ids", F.col("tokens").alias("doc_tokens"),
        (F.lit(base) + F.col("_base") + F.col("first") + F.col("i")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    every = laid.unionByName(streamed).unionByName(whole)
    return every.select("doc_id", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
