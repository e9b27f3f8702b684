"""Sharding over fixed virtual slots with a versioned slot-to-shard map.

Records are hashed into ``SLOTS`` virtual slots, a number that never changes, and bytes and
rows are aggregated per slot.  The map from slots to shards is a small table
(version, virtual_slot, shard, bytes, rows), at most ``SLOTS`` rows a version, whatever the
data: that bound is what makes it safe to bring to the driver and into a plan as a literal.
``build_map`` places the slots, largest first, on the least loaded shard; ``rebalance``
edits a map for new sizes or another number of shards by moving few slots;
``save_map`` / ``load_map`` keep the versions.  All row work is DataFrame expressions.

A record's number inside its shard is its number in its virtual slot plus the rows of the
shard's earlier slots (prefix sums over the aggregate), so no shard is sorted as a whole.

Defined results: a null text has no bytes and crc32 0; a null ``doc_id`` hashes like any
value; rows equal in id and text are one slot's neighbours and numbered in any order;
an empty table gives an empty map and no rows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 8192
OVERHEAD = 16           # bytes of a record besides its text
TOLERANCE = 0.01        # load above the mean at which rebalancing moves slots
MAP_SCHEMA = "virtual_slot int, shard int, bytes long, rows long"


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus the fixed overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def virtual_slot(doc_id: Column, text_crc32: Column) -> Column:
    """The slot of a record: a hash of its id and its text's checksum."""
    return F.pmod(F.xxhash64(doc_id, text_crc32), F.lit(SLOTS)).cast("int")


def records(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) per row of ``docs`` (doc_id, text)."""
    text = F.coalesce(docs["text"], F.lit(""))
    sized = docs.select(docs["doc_id"].alias("doc_id"), record_size(docs["text"]).alias("size"),
                        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return sized.withColumn("virtual_slot", virtual_slot(F.col("doc_id"), F.col("text_crc32")))


def slot_totals(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(virtual slot, bytes, rows), at most ``SLOTS`` of them."""
    totals = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    return sorted((r.virtual_slot, r.bytes, r.n) for r in totals)


def build_map(totals: list[tuple[int, int, int]], n_shards: int) -> dict[int, int]:
    """Slot -> shard: the largest slot goes to the least loaded shard."""
    load = [(0, shard) for shard in range(n_shards)]
    placed = {}
    for slot, size, _ in sorted(totals, key=lambda t: (-t[1], t[0])):
        total, shard = heapq.heappop(load)
        placed[slot] = shard
        heapq.heappush(load, (total + size, shard))
    return placed


def rebalance(current: dict[int, int], totals: list[tuple[int, int, int]], n_shards: int,
              tolerance: float = TOLERANCE) -> dict[int, int]:
    """An edited map for new slot sizes or another number of shards.

    Slots of shards that no longer exist, slots without a shard and the least slots that
    bring an overfull shard down to the mean move to the least loaded shards; all others stay.
    """
    size = {slot: b for slot, b, _ in totals}
    mean = sum(size.values()) / n_shards
    held: dict[int, list[int]] = {shard: [] for shard in range(n_shards)}
    moving = []
    for slot in sorted(size):
        shard = current.get(slot, n_shards)
        (held[shard] if shard < n_shards else moving).append(slot)
    load = {shard: sum(size[s] for s in slots) for shard, slots in held.items()}
    for shard, slots in held.items():
        for slot in sorted(slots, key=lambda s: (-size[s], s)):
            over = load[shard] - mean
            if over <= mean * tolerance:
                break
            if size[slot] <= over:
                moving.append(slot)
                load[shard] -= size[slot]
    edited = {slot: shard for slot, shard in current.items() if slot in size and shard < n_shards}
    heap = [(total, shard) for shard, total in load.items()]
    heapq.heapify(heap)
    for slot in sorted(moving, key=lambda s: (-size[s], s)):
        total, shard = heapq.heappop(heap)
        edited[slot] = shard
        heapq.heappush(heap, (total + size[slot], shard))
    return edited


def map_table(spark: SparkSession, placed: dict[int, int], totals: list[tuple[int, int, int]], version: int) -> DataFrame:
    """The map as a table; its rows are bounded by ``SLOTS``."""
    rows = [(slot, placed[slot], size, n) for slot, size, n in totals]
    literal = F.from_json(F.lit("[" + ",".join('{"virtual_slot":%d,"shard":%d,"bytes":%d,"rows":%d}' % r for r in rows) + "]"),
                          "array<struct<virtual_slot:int,shard:int,bytes:bigint,rows:bigint>>")
    return spark.range(1).select(F.inline(literal)).withColumn("version", F.lit(version))


def save_map(table: DataFrame, folder: str) -> None:
    """Add a version to the map's folder (one subfolder each; older versions stay)."""
    table.coalesce(1).write.partitionBy("version").mode("append").parquet(folder)


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A version of the map, the latest by default."""
    table = spark.read.schema(MAP_SCHEMA + ", version int").parquet(folder)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == version)


def place(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, the record's gapless number inside its shard."""
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    based = table.select("virtual_slot", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0).cast("long")).alias("base"))
    order = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("at", F.row_number().over(order) - 1)
    return numbered.join(F.broadcast(based), "virtual_slot", "left").withColumn("slot", F.col("base") + F.col("at")).drop("at", "base")


def shard_documents(docs: DataFrame, n_shards: int, folder: str) -> DataFrame:
    """Shards of near-equal bytes: (doc_id, size, text_crc32, virtual_slot, shard, slot).

    Version 1 of the map is written below ``folder`` and read back.
    """
    rows = records(docs)
    totals = slot_totals(rows)
    save_map(map_table(docs.sparkSession, build_map(totals, n_shards), totals, 1), folder)
    return place(rows, load_map(docs.sparkSession, folder, 1))
