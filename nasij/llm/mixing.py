"""Mixing sources to target weights by subset sums over exact lengths.

Documents are counted by source and exact length. A source's target is met by
whole rounds of the source, then by a part of one round: a proportional share
of every length is taken first, and a bounded knapsack over all lengths that are
left fills the small remaining budget. Which documents of a length are
taken is drawn by a seeded hash.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and
share ``BUDGET`` times all sizes; a target stops at ``LIMIT`` times its source's
size, and the excess goes to the others by weight until none is above.

Defined cases: a null or blank text has size 0 and takes 0; a source of size 0
has target 0; null is a source of its own; null ids are drawn by their length
alone; equal rows are drawn one by one. Empty input gives an empty result.
Further columns of the input are kept by ``mixed`` and ignored by ``plan``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nasij.llm.common import Written, fresh

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUDGET, LIMIT = 1.5, 2
SEED = 20
#: Parts by which the documents of one source and length are numbered.
SALTS = 64
#: Words that the knapsack fills at most; its lengths are all that are left.
DP_BUDGET = 1 << 17


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    One row for each source. With the sources sorted by the ratio at which they
    reach their limit, the level of the others follows from running sums.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, map(float, WEIGHTS))), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int"))
    rows = totals.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(LIMIT)))
    every = Window.partitionBy()
    up = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    # the level if just the sources before this one were at their limit
    level = (F.sum("source_size").over(every) * F.lit(BUDGET) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    rows = rows.withColumn("level", level)
    # it holds from the first source that stays below its limit
    free = F.when(F.col("w") * F.col("level") < F.col("cap"), F.struct(F.col("cap") / F.col("w"), F.col("level")))
    rows = rows.withColumn("l", F.min(free).over(every)["level"])
    return rows.select("source", "source_size", F.when(F.col("l").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("w") * F.col("l"))).alias("target"))


def choose_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each length to take, for a sum next to ``budget``.

    A proportional share of each length first, then a bounded knapsack by dynamic
    programming for what is left of the budget. Where that leaves words over, other
    first shares are tried, and the largest sum is kept.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    best = np.zeros(len(counts), np.int64)
    if total <= 0 or budget <= 0:
        return best
    if budget >= total:
        return counts.copy()
    for taken in _shares(lengths, counts, budget, seed):
        got = _filled(lengths, counts, taken, budget)
        if (lengths * got).sum() > (lengths * best).sum():
            best = got
        if (lengths * best).sum() == budget:
            return best
    return best


def _share(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """A proportional share of each length, with a reserve for the knapsack."""
    total = int((lengths * counts).sum())
    if total <= 0:
        return np.zeros(len(counts), np.int64)
    # what the knapsack is to fill: enough to reach sums of any value
    reserve = min(4 * int(lengths[counts > 0].max()), DP_BUDGET // 2)
    taken = np.minimum(counts, np.floor(counts * (max(budget - reserve, 0) / total)).astype(np.int64))
    left = budget - int((lengths * taken).sum())
    # one more of lengths in a seeded order, until the knapsack can take over
    for i in np.random.default_rng(seed).permutation(len(lengths)):
        if left <= reserve:
            break
        if taken[i] < counts[i] and 0 < lengths[i] <= left - reserve:
            taken[i] += 1
            left -= int(lengths[i])
    return taken


def _shares(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> Iterator[np.ndarray]:
    """First shares: of all lengths alike; then with very long documents chosen
    before, as many as the others cannot make up for; then none."""
    yield _share(lengths, counts, budget, seed)
    long = lengths > DP_BUDGET // 8
    short = np.where(long, 0, counts)
    can = int((lengths * short).sum())
    some = np.floor(counts * (budget / int((lengths * counts).sum()))).astype(np.int64)
    for first in (np.where(long, some, 0), np.zeros(len(counts), np.int64)):
        for order in (np.argsort(-lengths, kind="stable"), np.argsort(lengths, kind="stable")):
            taken = first.copy()
            rest = budget - int((lengths * taken).sum())
            for i in order:
                if rest <= can:
                    break
                if long[i]:
                    k = min(int(counts[i] - taken[i]), rest // int(lengths[i]), -(-(rest - can) // int(lengths[i])))
                    taken[i] += k
                    rest -= k * int(lengths[i])
            yield taken + _share(lengths, short, rest, seed)
    yield np.zeros(len(counts), np.int64)


def _filled(lengths: np.ndarray, counts: np.ndarray, taken: np.ndarray, budget: int) -> np.ndarray:
    """``taken``, and documents of the other lengths with the largest sum that
    fits the rest of the budget. A rest above ``DP_BUDGET`` is filled by the
    longest first; if it stays above, no document left fits it."""
    taken = taken.copy()
    left = budget - int((lengths * taken).sum())
    spare = counts - taken
    for i in np.argsort(-lengths, kind="stable"):
        if left <= DP_BUDGET:
            break
        k = min(int(spare[i]), left // int(lengths[i])) if lengths[i] > 0 else 0
        taken[i] += k
        spare[i] -= k
        left -= k * int(lengths[i])
    left = min(left, DP_BUDGET)
    # by[s]: the first bundle with which s is a sum; the rest of s is a sum of
    # earlier ones
    by = np.full(left + 1, -2, np.int64)
    by[0] = -1
    bundles: list[tuple[int, int]] = []
    for i in np.flatnonzero((spare > 0) & (lengths > 0) & (lengths <= left)).tolist():
        n, size = min(int(spare[i]), left // int(lengths[i])), 1
        while n > 0 and by[left] == -2:
            many = min(size, n)
            w = many * int(lengths[i])
            new = np.flatnonzero((by[:-w] != -2) & (by[w:] == -2)) + w if w <= left else []
            by[new] = len(bundles)
            bundles.append((i, many))
            n -= size
            size *= 2
    at = int(np.flatnonzero(by != -2)[-1])
    while at:
        i, many = bundles[by[at]]
        taken[i] += many
        at -= many * int(lengths[i])
    return taken


def _solve(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts of one source's lengths (a row for each length, not document)."""
    pdf = pdf.sort_values("size", kind="stable")
    size, n = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    total, target = int((size * n).sum()), round(float(pdf["target"].iloc[0]))
    rounds, part = divmod(target, total) if total else (0, 0)
    if rounds >= LIMIT:
        rounds, part = LIMIT, 0
    return pdf.assign(rounds=rounds, more=choose_counts(size, n, part))[["source", "size", "rounds", "more"]]


def plan(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    return _planned(docs.select("doc_id", "source", words(F.col("text")).alias("size"))).select("doc_id", "size", "source_size", "target", "taken")


def _planned(sized: DataFrame) -> DataFrame:
    sized = Written(sized.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(SALTS)).cast("int")), "mix").df
    parts = sized.groupBy("source", "size", "salt").agg(F.count(F.lit(1)).alias("n"))
    by_salt = Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = Written(parts.withColumn("before", F.coalesce(F.sum("n").over(by_salt), F.lit(0))), "mix-parts").df
    lengths = parts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    totals = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = Written(targets(totals), "mix-goal").df
    on = F.col("l.source").eqNullSafe(F.col("g.source"))
    counted = lengths.alias("l").join(goal.alias("g"), on).select("l.source", "size", "n", "target")
    solved = counted.groupBy("source").applyInPandas(_solve, "source string, size long, rounds long, more long")
    key = lambda a, b, *cols: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]
    dealt = (
        parts.hint("merge").alias("p").join(solved.alias("s"), key("p", "s", "source", "size")).select("p.source", "p.size", "salt", "before", "rounds", "more").alias("p")
        .join(goal.alias("g"), key("p", "g", "source")).select("p.*", "source_size", "target")
    )
    dealt = Written(dealt, "mix-dealt").df
    rank = F.row_number().over(Window.partitionBy("source", "size", "salt").orderBy(F.xxhash64("doc_id", F.lit(SEED + 1)), "doc_id"))
    return (
        sized.withColumn("_rank", rank).alias("d")
        # its rows grow with sources and lengths, and its file is far smaller than
        # its rows: not a side to broadcast
        .join(dealt.hint("merge").alias("p"), key("d", "p", "source", "size", "salt"))
        .select(
            *[f"d.{c}" for c in sized.columns if c != "salt"], "source_size", "target",
            (F.col("d.size") * (F.col("rounds") + F.when(F.col("before") + F.col("_rank") <= F.col("more"), 1).otherwise(0))).cast("long").alias("taken"),
        )
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of the mix: each document as often as it is taken.

    Documents of size 0 fill no words and stay out. The rows are numbered and
    written, so that each gets its own copies, equal rows and null ids as well.
    """
    # the rows' own numbers are stable once written
    row, copy = fresh(docs, "row"), fresh(docs, "copy")
    rows = Written(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows").df
    drawn = _planned(rows.select("doc_id", "source", row, words(F.col("text")).alias("size")))
    copies = drawn.where("taken > 0").select(row, F.expr("int(taken div size)").alias(copy))
    return rows.join(copies, row).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy)))).select(*docs.columns)
