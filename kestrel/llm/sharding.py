"""Sharding by a minimax contiguous partition (DataFrame functions only).

Documents of equal text form an atomic group.  The leading bits of a 64-bit text hash cut
the groups into at most ``BLOCKS`` runs; a run holds whole groups and is the atomic item of
the partition.  Only the runs' sizes (``BLOCKS`` numbers at most, whatever the input) reach
the driver.  There the items are put in order: light ones by hash, the few heavy ones spread
among them so that none lies where a cut will be.  A binary search finds the smallest
capacity for which a greedy pass over that order needs no more shards than given, and the
cuts are placed under it, as near to equal sizes as it allows.
"""

from __future__ import annotations

from bisect import bisect_right
from heapq import heapify, heapreplace
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import stage_table

SHARDS = 40
BLOCK_BITS = 14
BLOCKS = 1 << BLOCK_BITS
ROW_OVERHEAD = 16
HEAVY = 32                   # an item above 1 / HEAVY of an equal share is placed by itself


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """Smallest capacity under which the ordered ``sizes`` fit into ``shards`` runs."""
    ends = list(accumulate(sizes))

    def fits(capacity: int) -> bool:
        at = filled = 0
        for _ in range(shards):
            at = bisect_right(ends, filled + capacity, at)
            if at == len(ends):
                return True
            filled = ends[at - 1] if at else 0
        return False

    low, high = max([-(-sum(sizes) // shards), *sizes]), max(sum(sizes), 1)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def balanced_cuts(sizes: list[int], shards: int) -> list[int]:
    """Start index of shards 1.. of a partition whose largest shard is the smallest possible.

    Between the earliest and latest cut that the capacity allows, each cut takes the place
    nearest to an equal share.  Items above that share count as one share there, so the
    shards around them come out equal too.
    """
    capacity = smallest_capacity(sizes, shards)
    ends = list(accumulate(sizes))
    total = ends[-1] if ends else 0
    # latest start of each shard's successor seen from the right: what follows must fit
    earliest = [0] * (shards + 1)
    earliest[shards] = len(sizes)
    for k in range(shards - 1, 0, -1):
        i, filled = earliest[k + 1], 0
        while i > 0 and filled + sizes[i - 1] <= capacity:
            i -= 1
            filled += sizes[i]
        earliest[k] = i
    share, large = total / shards, 0
    while True:  # a share that the large items are taken out of
        big = [s for s in sizes if s > share]
        if len(big) == large or len(big) >= shards:
            break
        large, share = len(big), (total - sum(big)) / (shards - len(big))
    even = list(accumulate(min(s, share) for s in sizes))
    cuts, at = [], 0
    for k in range(1, shards):
        latest = bisect_right(ends, (ends[at - 1] if at else 0) + capacity)
        place = bisect_right(even, share * k)
        if place < len(even) and even[place] - share * k < share * k - (even[place - 1] if place else 0):
            place += 1
        at = max(at, earliest[k], min(latest, place))
        cuts.append(at)
    return cuts


def item_order(sizes: list[int], shards: int) -> list[int]:
    """Item numbers in the order to partition: the heavy items, largest first, go to the shard that
    has least so far; each shard's place in the order holds them and then its fill of light items."""
    share = sum(sizes) / shards
    heavy = sorted((i for i, s in enumerate(sizes) if s * HEAVY > share), key=lambda i: (-sizes[i], i))
    loads, own = [(0, k) for k in range(shards)], [[] for _ in range(shards)]
    heapify(loads)
    for i in heavy:
        load, k = loads[0]
        own[k].append(i)
        heapreplace(loads, (load + sizes[i], k))
    held = [sum(sizes[i] for i in own[k]) for k in range(shards)]
    # the level to which light items fill the shards
    light, level, rest = [i for i in range(len(sizes)) if i not in set(heavy)], 0.0, sorted(held)
    mass = sum(sizes[i] for i in light)
    for k in range(1, shards + 1):
        level = (mass + sum(rest[:k])) / k
        if k == shards or level <= rest[k]:
            break
    out, at, filled, target = [], 0, 0, 0.0
    for k in range(shards):
        out += own[k]
        target += max(0.0, level - held[k])
        while at < len(light) and (k == shards - 1 or filled + sizes[light[at]] / 2 <= target):
            filled += sizes[light[at]]
            out.append(light[at])
            at += 1
    return out


def shard_of_items(sizes: list[int], shards: int) -> list[int]:
    """Shard of every item: the cuts of the ordered items."""
    order = item_order(sizes, shards)
    cuts = balanced_cuts([sizes[i] for i in order], shards)
    out = [0] * len(sizes)
    for place, i in enumerate(order):
        out[i] = bisect_right(cuts, place)
    return out


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``bytes``: shard sizes near equal, equal texts together.  ``size`` is the
    text's UTF-8 bytes (null: none) plus 16; ``slot`` numbers a shard's rows from 0 without
    gaps, by block, then text hash, id and crc.  A null text's crc is 0, as an empty text's.
    A group above an equal share fills a shard of its own.  Repeated ids are separate rows;
    an empty table gives an empty result; other columns are ignored.
    """
    text = F.col(text_col).cast("string")
    hashed = F.xxhash64(F.coalesce(text, F.lit("")))
    rows = stage_table(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        hashed.alias("h"), F.shiftrightunsigned(hashed, 64 - BLOCK_BITS).cast("int").alias("block")), "sizes")

    blocks = stage_table(rows.groupBy("block").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")), "blocks")
    sized = sorted(blocks.collect())
    placed = shard_of_items([r["size"] for r in sized], shards)
    # light blocks keep their order, so 39 bounds tell their shard; the heavy ones are a short list
    share = sum(r["size"] for r in sized) / shards
    lone = {r["block"]: k for r, k in zip(sized, placed) if r["size"] * HEAVY > share}
    starts = [min((r["block"] for r, k in zip(sized, placed) if k >= j and r["block"] not in lone), default=BLOCKS) for j in range(1, shards)]
    values = ", ".join(f"({block}, {k})" for block, k in lone.items()) or "(-1, 0)"
    heavy = docs.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(block, lone)")

    # A block far above the mean (a text with very many copies) is numbered in several parts.
    most = max(64, -(-4 * sum(r["n"] for r in sized) // BLOCKS))
    rows = (rows.join(F.broadcast(blocks.select("block", F.ceil(F.col("n") / most).alias("parts"))), "block")
            .join(F.broadcast(heavy), "block", "left")
            .withColumns({"part": F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"),
                          "shard": F.coalesce("lone", sum(((F.col("block") >= c).cast("int") for c in starts), F.lit(0)))}))
    units = stage_table(rows.groupBy("shard", "block", "part").agg(F.count(F.lit(1)).alias("n")), "units")  # BLOCKS * 5 / 4 rows at most
    units = units.select("block", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("block", "part")) - F.col("n")).alias("start"))
    unit = Window.partitionBy("block", "part").orderBy("h", "doc_id", "text_crc32", "size")
    return (rows.withColumn("row", F.row_number().over(unit))
            .join(F.broadcast(units), ["block", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("start") + F.col("row") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
