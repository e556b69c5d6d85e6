"""Near-duplicates by chosen-path set similarity join.

Documents become sets of word shingles. Equal sets form a class at once. The
classes' minhashes stand for their tokens: each of ``TREES`` independent trees
sends a class to the node of one chosen minhash; a node of more than ``NODE``
classes branches again by ``BRANCH`` minhashes chosen for it, as deep as
``DEPTH``; a small node is compared exhaustively on sketches. A node that keeps
more than half of its parent's classes does not get smaller by branching (a
group of near copies shares nearly all minhashes): it is dealt to blocks. At
similarity 0.8 a pair stays together in a tree of d levels with a chance of
0.8 * 0.96 ** (d - 1), so it misses all nine trees with one below 1e-5, and
fails its sketch with one of about 1e-5.

Sketch links only gather classes into clusters, by connected components. Inside
a cluster links are confirmed on full sets: a class looks at all that are not
yet reached, so a cluster of n classes yields fewer than n links and their
components are exact.

A cluster or node too large for a task is dealt to blocks, in which links are
found first. Where the links of all blocks and nodes then leave its classes in
more than one component, what is not in the largest of them meets every block,
and the blocks of the largest need not meet each other: a group of near copies
costs in proportion to its size, and no link is lost.

Defined cases: a text that is null or has no words has an empty set (0 shingles)
and is linked with nothing; repeated rows and equal texts are one class; a null
id is in no class but its own (component null, kept). Ties do not arise: the
component is the smallest id. Empty input gives an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nasij.llm.common import Written, fresh, ready, text_bytes
from nasij.llm.graph import connected_components
from nasij.llm.shingles import Minhash, shingle_set

TREES, BRANCH, DEPTH = 9, 2, 3
#: Minhashes: so many serve as paths, and one byte of each as the sketch.
PATHS, SKETCH = 32, 64
#: Largest node that is compared at once; shingles of a block of a cluster.
NODE, BLOCK = 512, 4_000_000
#: How far below the threshold a sketch may be: over four standard deviations.
MARGIN = 0.22


def grouped(df: DataFrame, key: str, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Applies ``fn`` to each group, many groups to a batch of rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for rows in batches:
            at = 0
            values = rows[key].to_numpy()
            for end in [*(np.flatnonzero(values[1:] != values[:-1]) + 1), len(rows)]:
                part = rows.iloc[at:end]
                if held and held[0][key].iloc[0] != part[key].iloc[0]:
                    yield fn(pd.concat(held) if len(held) > 1 else held[0])
                    held = []
                held.append(part)
                at = end
        if held:
            yield fn(pd.concat(held) if len(held) > 1 else held[0])

    # the number is given, as small rows with much work must not be put together
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, F.col(key)).sortWithinPartitions(key).mapInPandas(run, schema)


def _describe(size: int):
    """Number of shingles, a 128-bit name of the set, paths and sketch."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = Minhash(SKETCH)
        for texts in batches:
            rows = []
            for t in texts:
                s = shingle_set(bytes(t), size)
                if not len(s):
                    rows.append((0, None, None, None, None))
                    continue
                m = hashes(s)
                mixed = s * np.uint64(0xD6E8FEB86659FD93) ^ (s >> np.uint64(31))
                name = s.sum(dtype=np.uint64).astype(np.int64), mixed.sum(dtype=np.uint64).astype(np.int64)
                rows.append((len(s), int(name[0]), int(name[1]), (m[:PATHS] >> np.uint64(32)).astype(np.uint32).tobytes(), m.astype(np.uint8).tobytes()))
            yield pd.DataFrame(rows, columns=["n", "k1", "k2", "paths", "sketch"]).astype({"n": "int64", "k1": "Int64", "k2": "Int64"})

    return F.pandas_udf(run, "n long, k1 long, k2 long, paths binary, sketch binary")


def _reach(n: int, links: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest: each item looks once at all that are not yet reached."""
    left, found, queue = np.arange(n), [], []
    while len(left):
        queue.append(int(left[0]))
        left = left[1:]
        while queue and len(left):
            at = queue.pop()
            hit = links(at, left)
            if hit.any():
                near = left[hit].tolist()
                found += [(at, j) for j in near]
                queue += near
                left = left[~hit]
        queue.clear()
    return found


def _join(part: np.ndarray, links: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links that join the parts, at most one fewer than parts."""
    part, found = part.copy(), []
    for i in range(len(part)):
        left = i + 1 + np.flatnonzero(part[i + 1 :] != part[i])
        hit = left[links(i, left)] if len(left) else left
        if len(hit):
            others, first = np.unique(part[hit], return_index=True)
            found += [(i, j) for j in hit[first].tolist()]
            part[np.isin(part, others)] = part[i]
    return found


def _spanning(rows: pd.DataFrame, links: Callable[[int, np.ndarray], np.ndarray]) -> pd.DataFrame:
    ids = rows["rep"].to_numpy()
    pairs = _join(rows["part"].to_numpy(), links) if "part" in rows else _reach(len(rows), links)
    return pd.DataFrame({"a": [ids[i] for i, _ in pairs], "b": [ids[j] for _, j in pairs]}, dtype="int64")


def _sketch_links(least: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        s = np.frombuffer(b"".join(map(bytes, rows["sketch"])), np.uint8).reshape(len(rows), SKETCH)
        return _spanning(rows, lambda i, left: (s[left] == s[i]).sum(axis=1) >= least * SKETCH)

    return run


def _set_links(num: int, den: int):
    """Confirms links: den * intersection >= num * union, in whole numbers."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(bytes(x), np.uint64) for x in rows["set"]]
        size = np.array([len(x) for x in sets])
        at = np.concatenate(([0], np.cumsum(size)))
        _, number = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(int(number.max()) + 1, bool)

        def links(i: int, left: np.ndarray) -> np.ndarray:
            mine = number[at[i] : at[i + 1]]
            small, large = np.minimum(size[left], size[i]), np.maximum(size[left], size[i])
            hit = den * small >= num * large
            tested = left[hit]
            if len(tested):
                mark[mine] = True
                places = np.concatenate([number[at[j] : at[j + 1]] for j in tested])
                both = np.add.reduceat(mark[places], np.concatenate(([0], np.cumsum(size[tested])[:-1])), dtype=np.int64)
                mark[mine] = False
                hit[hit] = den * both >= num * (size[i] + size[tested] - both)
            return hit

        return _spanning(rows, links)

    return run


def _u32(paths, i):
    """The i-th minhash (counted from 0) in the packed paths, as hex text."""
    return F.hex(F.substring(paths, i * 4 + 1, 4))


def _dealt(key: str, blocks) -> Column:
    """The block of a key that a class is dealt to."""
    return F.xxhash64(key, F.pmod(F.xxhash64("rep", key), blocks))


def _meetings(members: DataFrame, found: DataFrame, key: str, most: int) -> DataFrame | None:
    """(key, rep, part): what must still meet, if the blocks' links left a key's
    classes in more than one component, which is the part of each.

    Blocks of what is not in the largest part meet all blocks. ``w`` of members
    is a class's weight, ``most`` that of a block.
    """
    told = members.join(_clusters(found).withColumnRenamed("cluster", "part"), "rep", "left").withColumn("part", F.coalesce("part", "rep"))
    told = Written(told, "parts").df
    parts = told.groupBy(key, "part").agg(F.sum("w").alias("w")).groupBy(key).agg(F.max(F.struct("w", "part")).alias("main"), F.sum("w").alias("w"))
    number = lambda w: F.ceil(w / most).cast("long")
    open_ = parts.where("w > main.w").select(key, F.col("main.part").alias("main"), number(F.col("main.w")).alias("large"), number(F.col("w") - F.col("main.w")).alias("small"))
    open_ = Written(open_, "open").df
    if open_.isEmpty():
        return None
    inside = F.col("part") == F.col("main")
    mine = F.pmod(F.xxhash64("rep", key), F.when(inside, F.col("large")).otherwise(F.col("small")))
    to = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    with_main = F.when(inside, F.transform(to("small"), lambda j: F.xxhash64(key, F.lit(0), "_mine", j))).otherwise(F.transform(to("large"), lambda i: F.xxhash64(key, F.lit(0), i, "_mine")))
    # a block of the others meets itself where it meets the largest part's
    others = F.transform(F.filter(to("small"), lambda j: j != F.col("_mine")), lambda j: F.xxhash64(key, F.lit(1), F.least("_mine", j), F.greatest("_mine", j)))
    met = told.join(open_, key).withColumn("_mine", mine).withColumn("_met", F.when(inside, with_main).otherwise(F.concat(with_main, others)))
    return met.select(F.explode("_met").alias(key), "rep", "part")


def _joined(links: DataFrame, members: DataFrame | None, values: DataFrame, key: str, most: int, fn: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """(node, component) by the links found in blocks and those between blocks.

    ``members`` are the classes of keys that were dealt to blocks, if any."""
    found = connected_components(links, "a", "b")
    met = None if members is None else _meetings(members, found, key, most)
    if met is None:
        return found
    between = grouped(met.join(values, "rep").select(key, "rep", "part", *[c for c in values.columns if c != "rep"]), key, fn, "a long, b long")
    return connected_components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(between), "a", "b")


def candidate_components(reps: DataFrame, threshold: float) -> DataFrame:
    """(node, component) by the sketch links of whatever meets in some tree's node."""
    links_of, most = _sketch_links(threshold - MARGIN), NODE // 2
    trees = F.explode(F.array(*[F.xxhash64(F.lit(t), _u32(F.col("paths"), t)) for t in range(TREES)]))
    whole = reps.count()
    level, found, dealt = Written(reps.select("rep", trees.alias("node"), F.lit(whole).cast("long").alias("above")), "tree"), [], []
    for depth in range(DEPTH):
        sizes = level.df.groupBy("node").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        met = Written(level.df.join(sizes, "node"), "met")
        level.drop()
        large = F.col("c") > NODE
        dense = large & (F.lit(depth == DEPTH - 1) | (F.col("c") * 2 > F.col("above")))
        node = F.when(dense, _dealt("node", F.ceil(F.col("c") / most).cast("long"))).otherwise(F.col("node"))
        found.append(grouped(met.df.where(dense | ~large).select("rep", node.alias("node")).join(reps.select("rep", "sketch"), "rep").select("node", "rep", "sketch"), "node", links_of, "a long, b long"))
        more = met.df.agg(F.coalesce(F.bool_or(dense), F.lit(False)), F.coalesce(F.bool_or(large & ~dense), F.lit(False))).first()
        if more[0]:
            dealt.append(met.df.where(dense).select("node", "rep", F.lit(1).cast("long").alias("w")))
        if not more[1]:
            break
        # the node's own choice of minhashes that no tree begins with
        step = (PATHS - TREES) // BRANCH
        own = [F.pmod(F.xxhash64("node", F.lit(j)), F.lit(step)) + F.lit(TREES + j * step) for j in range(BRANCH)]
        child = F.explode(F.array(*[F.xxhash64("node", F.lit(j), F.hex(F.substring(F.col("paths"), (c * 4 + 1).cast("int"), F.lit(4)))) for j, c in enumerate(own)]))
        level = Written(met.df.where(large & ~dense).join(reps, "rep").select("rep", child.alias("node"), F.col("c").alias("above")), "tree")
    members = reduce(DataFrame.unionByName, dealt) if dealt else None
    return _joined(reduce(DataFrame.unionByName, found), members, reps.select("rep", "sketch"), "node", most, links_of)


def components(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    ready(docs.sparkSession)
    made = docs.select("doc_id", _describe(size)(text_bytes(F.col("text"))).alias("m")).select("doc_id", "m.*")
    described = Written(made, "sketches").df
    usable = described.where("n > 0 and doc_id is not null")
    reps = usable.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "n", "paths", "sketch")).alias("m"))
    reps = Written(reps.select("k1", "k2", F.col("m.doc_id").alias("rep"), "m.n", "m.paths", "m.sketch"), "classes").df
    clusters = Written(_clusters(candidate_components(reps.select("rep", "paths", "sketch"), num / den)), "clusters").df

    # whole sets of the clustered classes, from the texts
    make = F.pandas_udf(_sets(size), "set binary, k1 long, k2 long")
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("rep"), text_bytes(F.col("text")).alias("t"))
    # a repeated id may name several classes
    needed = Written(reps.select("rep", "n").join(clusters, "rep").groupBy("rep", "cluster").agg(F.sum("n").alias("w")), "needed").df
    sets = texts.join(needed.select("rep", "cluster").hint("shuffle_hash"), "rep").select("rep", "cluster", make("t").alias("m")).select("rep", "cluster", "m.*")
    # tested after the writing: a test before it would be pushed below the join,
    # and make every text's set there
    sets = Written(sets, "sets").df.where("k1 is not null")
    large = Written(needed.groupBy("cluster").agg(F.ceil(F.sum("w") / BLOCK).cast("long").alias("blocks")).where("blocks > 1"), "large").df
    block = _dealt("cluster", F.coalesce("blocks", F.lit(1).cast("long"))).alias("cluster")
    links = grouped(sets.join(large, "cluster", "left").select(block, "rep", "set"), "cluster", _set_links(num, den), "a long, b long")
    members = None if large.isEmpty() else needed.join(large, "cluster").select("cluster", "rep", "w")
    found = _joined(links, members, sets.select("rep", "set"), "cluster", BLOCK, _set_links(num, den)).withColumnRenamed("node", "rep")

    by_class = reps.select("k1", "k2", "rep").join(found, "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("component_id"))
    return described.select("doc_id", "n", "k1", "k2").join(by_class, ["k1", "k2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept")
    )


def _clusters(found: DataFrame) -> DataFrame:
    """(rep, cluster), the smallest member too."""
    return found.select(F.col("node").alias("rep"), F.col("component").alias("cluster")).unionByName(found.select(F.col("component").alias("rep"), F.col("component").alias("cluster"))).distinct()


def _sets(size: int):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                s = shingle_set(bytes(t), size)
                rows.append((s.tobytes(), int(s.sum(dtype=np.uint64).astype(np.int64)), 0) if len(s) else (None, None, None))
            yield pd.DataFrame(rows, columns=["set", "k1", "k2"]).astype({"k1": "Int64", "k2": "Int64"})

    return run


def deduplicated(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each group of near copies, in the input's columns.

    The row of the smallest id stays, before rows without one. Rows are told
    apart by a number of their own, so copies without an id or with a repeated
    one are compared as well; rows without words all stay. A text that is null
    has no words. Empty input gives an empty result.
    """
    row, doc_id = fresh(docs, "row"), fresh(docs, "id")
    # the rows' own numbers are stable once written
    rows = Written(docs.withColumn(row, F.monotonically_increasing_id()), "dedup-rows").df
    found = components(rows.select(F.col(row).alias("doc_id"), "text"), size, num, den)
    found = found.select(F.col("doc_id").alias(row), "component_id").join(rows.select(row, F.col("doc_id").alias(doc_id)), row)
    best = found.groupBy("component_id").agg(F.min(F.struct(F.col(doc_id).isNull().alias("bare"), F.col(doc_id).alias("id"), F.col(row).alias("row"))).alias("best"))
    kept = Written(best.select(F.col("best.row").alias(row)), "kept").df
    return rows.join(kept, row, "left_semi").select(*[rows[c] for c in docs.columns])
