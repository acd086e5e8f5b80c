"""Sharding by fixed virtual slots.

A record's slot is a hash of its id, one of SLOTS whatever the number of shards. A slot map says which shard holds each
slot; it is made from the bytes of every slot, kept in versions, and edited when bytes or shards have changed: then
only the slots that an edit moves are written elsewhere.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexledger.llm.common import written

SLOTS = 4096
SHARDS = 8
#: An edit ends when no shard holds more than this share above the mean.
TOLERANCE = 0.001
SEED = "shard-1"


def slot_of(doc_id: Column, text: Column) -> Column:
    """A document's slot: a hash of its id, or of its text where that is null."""
    key = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    return (F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), key)), 1, 15), 16, 10).cast("bigint") % SLOTS).cast("int")


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def by_slot(values: list[int] | tuple[int, ...], slot: Column) -> Column:
    """The value of a slot, from a list of SLOTS whole numbers."""
    return F.element_at(F.expr(f"array({', '.join(f'{v}L' for v in values)})"), slot + 1)


def slot_bytes(records: DataFrame) -> dict[int, int]:
    """Bytes of each slot of ``records`` (virtual_slot, size): SLOTS numbers at most, summed before the shuffle."""
    return {r[0]: r[1] for r in records.groupBy("virtual_slot").agg(F.sum("size")).collect()}


@dataclass(frozen=True)
class SlotMap:
    """One version of the map: ``shard_of[slot]``."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    def loads(self, sizes: dict[int, int]) -> list[int]:
        out = [0] * self.shards
        for slot, shard in enumerate(self.shard_of):
            out[shard] += sizes.get(slot, 0)
        return out

    def column(self, slot: Column) -> Column:
        return by_slot(self.shard_of, slot).cast("int")

    def moves(self, newer: SlotMap) -> dict[int, tuple[int, int]]:
        """The slots that another version has elsewhere: from which shard, to which."""
        return {k: (a, b) for k, (a, b) in enumerate(zip(self.shard_of, newer.shard_of, strict=True)) if a != b}


def _filled(sizes: dict[int, int], slots: list[int], loads: list[tuple[int, int, int]]) -> dict[int, int]:
    """Slots, the largest first, each to the shard with the fewest bytes (then slots, then the smallest number)."""
    heapq.heapify(loads)
    out = {}
    for slot in sorted(slots, key=lambda s: (-sizes.get(s, 0), s)):
        held, n, shard = loads[0]
        heapq.heapreplace(loads, (held + sizes.get(slot, 0), n + 1, shard))
        out[slot] = shard
    return out


def first_map(sizes: dict[int, int], shards: int = SHARDS) -> SlotMap:
    """Version 1 of a map, from the bytes of the slots."""
    dealt = _filled(sizes, list(range(SLOTS)), [(0, 0, k) for k in range(shards)])
    return SlotMap(1, shards, tuple(dealt[s] for s in range(SLOTS)))


def rebalanced(old: SlotMap, sizes: dict[int, int], shards: int | None = None, tolerance: float = TOLERANCE) -> SlotMap:
    """The next version, for new bytes or another number of shards; the same version if nothing has to move.

    The slots of shards that are gone are dealt to those that stay. Then, while a shard is over the mean by more than
    the tolerance, the fullest gives the emptiest its largest slot that narrows their gap; where none does, it ends. If
    shards are added, only they take slots in this edit.
    """
    shards = old.shards if shards is None else shards
    of = list(old.shard_of)
    members = [set() for _ in range(shards)]
    for slot, shard in enumerate(of):
        if shard < shards:
            members[shard].add(slot)
    orphans = [slot for slot, shard in enumerate(of) if shard >= shards]
    loads = [sum(sizes.get(s, 0) for s in m) for m in members]
    for slot, shard in _filled(sizes, orphans, [(loads[k], len(members[k]), k) for k in range(shards)]).items():
        members[shard].add(slot)
        loads[shard] += sizes.get(slot, 0)
    bar = sum(loads) / shards * (1 + tolerance)
    takers = range(old.shards, shards) or range(shards)
    while max(loads) > bar:
        full, empty = max(range(shards), key=lambda k: (loads[k], -k)), min(takers, key=lambda k: (loads[k], k))
        gap = loads[full] - loads[empty]
        fit = [s for s in members[full] if 0 < sizes.get(s, 0) <= gap // 2]
        if not fit:
            break
        slot = max(fit, key=lambda s: (sizes[s], -s))
        members[full].remove(slot)
        members[empty].add(slot)
        loads[full] -= sizes[slot]
        loads[empty] += sizes[slot]
    for shard, m in enumerate(members):
        for slot in m:
            of[slot] = shard
    return old if shards == old.shards and tuple(of) == old.shard_of else SlotMap(old.version + 1, shards, tuple(of))


def save_map(spark: SparkSession, root: str, m: SlotMap) -> None:
    """Store a version; a version that exists is not replaced."""
    rows = spark.createDataFrame([(k, s, m.shards) for k, s in enumerate(m.shard_of)], "slot int, shard int, shards int")
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{root}/version={m.version}")


def load_map(spark: SparkSession, root: str, version: int | None = None) -> SlotMap:
    """A stored version, by default the last one."""
    rows = spark.read.parquet(root)
    version = rows.agg(F.max("version")).first()[0] if version is None else version
    found = rows.where(F.col("version") == version).orderBy("slot").collect()
    return SlotMap(version, found[0]["shards"], tuple(r["shard"] for r in found))


def placed(docs: DataFrame, m: SlotMap) -> DataFrame:
    """docs plus ``virtual_slot`` and ``shard``, without a shuffle; columns of these names are replaced."""
    slot = slot_of(F.col("doc_id"), F.col("text"))
    return docs.withColumn("virtual_slot", slot).withColumn("shard", m.column(F.col("virtual_slot")))


def write_shards(docs: DataFrame, m: SlotMap, path: str) -> None:
    """Documents by shard and slot: ``path/shard=s``, whose files hold their slots in order, so that the slots of a move
    are read by themselves. Rows are dealt by slot."""
    placed(docs, m).repartition("virtual_slot").sortWithinPartitions("shard", "virtual_slot").write.partitionBy("shard").parquet(path)


def moving(spark: SparkSession, path: str, old: SlotMap, new: SlotMap) -> DataFrame:
    """Stored documents whose slots another version has elsewhere, plus ``to``: what an edit makes to be written anew."""
    moves = old.moves(new)
    stored = spark.read.parquet(path)
    picked = F.col("shard").isin(sorted({a for a, _ in moves.values()})) & F.col("virtual_slot").isin(sorted(moves))
    return stored.where(picked).withColumn("to", new.column(F.col("virtual_slot")))


def assign(docs: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, SlotMap]:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot) of every document, and the map.

    The law is ``bytes``: shards hold about equal sizes, as far as the largest slot allows. slot: the document's place in
    its shard, from 0 without gaps, in the order of virtual slot, doc_id (nulls first), size and checksum, so it depends
    on the documents only. Null text: no bytes, checksum 0. Null doc_id: a slot by its text. Rows that are equal in all
    of this are counted before they are numbered and take places next to each other; copies of a text with ids of their
    own go to slots of their own. Other columns are not used. Empty table: no rows.
    """
    text = F.col("text")
    narrow = docs.select("doc_id", size_of(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), slot_of(F.col("doc_id"), text).alias("virtual_slot"))
    narrow = written(narrow, "sized")
    of_slot = {r[0]: (r[1], r[2]) for r in narrow.groupBy("virtual_slot").agg(F.sum("size"), F.count("*")).collect()}
    m = first_map({s: b for s, (b, _) in of_slot.items()}, shards)
    before, held = [0] * SLOTS, [0] * shards
    for s, shard in enumerate(m.shard_of):
        before[s] = held[shard]
        held[shard] += of_slot.get(s, (0, 0))[1]
    same = ["virtual_slot", "doc_id", "size", "text_crc32"]
    counted = narrow.groupBy(*same).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("virtual_slot").orderBy(*same[1:]).rowsBetween(Window.unboundedPreceding, -1)
    start = by_slot(before, F.col("virtual_slot")) + F.coalesce(F.sum("n").over(upto), F.lit(0))
    each = counted.withColumn("start", start).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    out = each.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), m.column(F.col("virtual_slot")).alias("shard"), (F.col("start") + F.col("k")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
    return out, m
