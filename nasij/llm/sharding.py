"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's virtual slot is a hash of its id and text, of ``SLOTS`` slots that
never change. Bytes are summed for each slot; the map deals whole slots to
shards and is edited, never rebuilt, when data or shards change. Each version of
it is a file in the map's folder; the latest is in force.

The law held is ``bytes``: shards have nearly equal sizes, as long as no single
record weighs much of a shard. A group of copies is spread over slots by the
ids, so no group can fill one.

Defined cases: a null text has no bytes (size 16, crc32 0); a null id is hashed
as such; equal rows get the same virtual slot and different places. Empty input
gives an empty result. Further columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nasij.llm.common import Written, text_bytes

SLOTS = 4096
RECORD_BYTES = 16
SIZED = ["doc_id", "size", "text_crc32", "virtual_slot"]


@dataclass(frozen=True)
class SlotMap:
    """slot -> shard, with its version; ``history`` names the moves of each."""

    shards: int
    owner: tuple[int, ...]
    version: int = 1
    history: tuple = field(default_factory=tuple)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "SlotMap":
        d = json.loads(text)
        return cls(d["shards"], tuple(d["owner"]), d["version"], tuple(tuple(map(tuple, h)) for h in d["history"]))

    @classmethod
    def build(cls, weights: list[int], shards: int) -> "SlotMap":
        """Heaviest slot first, each to the lightest shard."""
        owner, heap = [0] * len(weights), [(0, s) for s in range(shards)]
        for slot in sorted(range(len(weights)), key=lambda i: (-weights[i], i)):
            load, shard = heapq.heappop(heap)
            owner[slot] = shard
            heapq.heappush(heap, (load + weights[slot], shard))
        return cls(shards, tuple(owner))

    def edited(self, weights: list[int], shards: int | None = None, slack: float = 0.005) -> "SlotMap":
        """The next version: as few slots moved as bring each shard near the mean.

        Slots of removed shards go first; then the heaviest shard gives slots to
        the lightest, until the two are a slot's weight or ``slack`` apart.
        """
        shards = shards or self.shards
        owner, loads = list(self.owner), [0] * shards
        homeless = [i for i, s in enumerate(owner) if s >= shards]
        for i, s in enumerate(owner):
            if s < shards:
                loads[s] += weights[i]
        moves = []

        def move(slot: int, to: int) -> None:
            if owner[slot] < shards:
                loads[owner[slot]] -= weights[slot]
            moves.append((slot, owner[slot], to))
            owner[slot] = to
            loads[to] += weights[slot]

        for slot in sorted(homeless, key=lambda i: (-weights[i], i)):
            move(slot, min(range(shards), key=lambda s: (loads[s], s)))
        mean = sum(weights) / shards
        by_shard: list[list[int]] = [[] for _ in range(shards)]
        for i in sorted(range(len(owner)), key=lambda i: (weights[i], i)):
            by_shard[owner[i]].append(i)
        for _ in range(len(owner)):
            high, low = max(range(shards), key=lambda s: (loads[s], -s)), min(range(shards), key=lambda s: (loads[s], s))
            gap = loads[high] - loads[low]
            fits = [i for i in by_shard[high] if 0 < weights[i] < gap]
            if gap <= max(2 * slack * mean, max(weights)) or not fits:
                break
            slot = min(fits, key=lambda i: (abs(gap / 2 - weights[i]), i))
            by_shard[high].remove(slot)
            by_shard[low].append(slot)
            move(slot, low)
        return SlotMap(shards, tuple(owner), self.version + 1, (*self.history, tuple(moves)))


def virtual_slot(doc_id: Column, crc: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(doc_id, crc), F.lit(slots))


def measured(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    raw = text_bytes(F.col("text"))
    return docs.select("doc_id", (F.length(raw) + RECORD_BYTES).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")).withColumn(
        "virtual_slot", virtual_slot(F.col("doc_id"), F.col("text_crc32"), slots)
    )


def slot_weights(sized: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of each slot; as many driver rows as there are slots."""
    size, rows = [0] * slots, [0] * slots
    for r in sized.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect():
        size[r["virtual_slot"]], rows[r["virtual_slot"]] = r["b"], r["n"]
    return size, rows


def _filesystem(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Versions of the map in a folder, in order."""
    path, files = _filesystem(spark, folder)
    names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
    return sorted(int(n[4:-5]) for n in names if n.startswith("map-") and n.endswith(".json"))


def save(spark: SparkSession, folder: str, slot_map: SlotMap) -> None:
    """Adds a version; one that is there is never replaced."""
    path, files = _filesystem(spark, f"{folder}/map-{slot_map.version:06d}.json")
    out = files.create(path, False)
    try:
        out.write(bytearray(slot_map.to_json().encode()))
    finally:
        out.close()


def load(spark: SparkSession, folder: str, version: int | None = None) -> SlotMap:
    """The latest version, or the one asked for."""
    version = version if version is not None else versions(spark, folder)[-1]
    return SlotMap.from_json(spark.read.text(f"{folder}/map-{version:06d}.json", wholetext=True).first()[0])


def rebalanced(docs: DataFrame, folder: str, shards: int = 40, slots: int = SLOTS) -> tuple[DataFrame, SlotMap]:
    """Shards by the map in a folder: built and stored as version 1 if there is
    none, else the latest is edited, and stored as the next version if that
    moved a slot."""
    spark = docs.sparkSession
    sized = Written(measured(docs, slots), "sizes").df
    weights = slot_weights(sized, slots)[0]
    if not versions(spark, folder):
        save(spark, folder, SlotMap.build(weights, shards))
    else:
        now = load(spark, folder)
        after = now.edited(weights, shards)
        if after.owner != now.owner or after.shards != now.shards:
            save(spark, folder, after)
    return shard(sized, shards, load(spark, folder), slots)


def shard(docs: DataFrame, shards: int = 40, slot_map: SlotMap | None = None, slots: int = SLOTS) -> tuple[DataFrame, SlotMap]:
    """Every row with its shard and its place there, and the map used.

    ``docs`` may be what ``measured`` gave. Places are gapless in each shard without one task for a shard: rows are
    numbered within their virtual slot, and a slot begins where the slots
    before it in its shard end.
    """
    spark = docs.sparkSession
    sized = docs if docs.columns == SIZED else Written(measured(docs, slots), "sizes").df
    weights, rows = slot_weights(sized, slots)
    slot_map = slot_map or SlotMap.build(weights, shards)
    begins, filled = [0] * slots, [0] * slot_map.shards
    for i, s in enumerate(slot_map.owner):
        begins[i], filled[s] = filled[s], filled[s] + rows[i]
    dealt = spark.createDataFrame([(i, s, begins[i]) for i, s in enumerate(slot_map.owner)], "virtual_slot long, shard int, begins long")
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (
        sized.withColumn("_place", place)
        .join(F.broadcast(dealt), "virtual_slot")  # as many rows as slots
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("begins") + F.col("_place") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(slot_map.version).alias("map_version")
        ),
        slot_map,
    )
