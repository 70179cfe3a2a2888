"""Exact n-gram Jaccard self-join: size-banded tiles, bitmap signatures, sorted-array intersection.

1. Scan: each document's distinct word shingles as sorted 64-bit hashes; their number, a
   128-bit digest, a bitmap of hashed bits and the tiles of step 2 are staged from one pass.
   Documents of one digest form a class, so copies are never paired.
2. Tiles.  Sizes are cut to bands.  Two sets that link differ in at most H shingles, H
   following from the band, so when the hash range is cut to more than H segments at least
   one segment is equal in both.  Each set is dealt to one tile per segment: (band, segment,
   content), in the scheme of its band and of the next one if it can link upwards.  Only
   tiles of several sets are kept; they are gathered in ``TILE_PASSES`` parts by key.  What a batch
   knows to be a shared tile is not gathered on its key, so one tile of very many sets is not one task.
3. First round: every member of a tile meets the tile's centre, the member that shares most
   tiles.  In a group of near copies that is the text they derive from, so the group
   falls together without its pairs being written out.  From here on the tiles of one
   centre are one hub, so two sets that share many tiles are compared once.
4. Second round: all pairs under a hub that the links so far do not connect.  Small hubs are
   joined with themselves.  The members of hubs above ``LARGE_HUB`` are grouped anew under their
   rarest shingles (a prefix filter, which loses no link), so sets that share only what many share
   do not meet: a member is written once for each of its rarest shingles, however many sets
   its hub holds.  Shingles that members of several components hold form hubs as tiles do; those above
   ``SMALL_HUB`` are cut to blocks of ``BLOCK`` sets compared block by block (blocks of a
   hub's main component only with those of other sets).
5. In both rounds bit counts of the bitmaps bound the overlap from above; the pairs left are
   decided by intersecting the sorted arrays of only those documents, read again.
6. Components of the links, joined back through the classes.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import batch_of, having_ids, in_buckets, text_chunks
from kestrel.llm.components import connected_components
from kestrel.llm.decontaminate import WordHashes, hash_words
from kestrel.session import drop_staged, stage_table

SMALL_HUB = 16               # sets of a group whose pairs a join may write out
BLOCK = 256                  # sets of a block of a larger group
LARGE_HUB = 16               # sets of a hub above which its members meet under their rarest shingles only
SHINGLE_BUCKETS = 1 << 20    # hash buckets by whose counts shingles are called rare
COUNT_BLOCK = 1 << 12        # buckets of a row of counts
TILE_PASSES = 4              # parts of the tiles that are gathered one after the other, so that not all of them are on disk twice
KNOWN = 8                    # sets of one batch that make a tile known as shared
BITMAP_BITS = 1 << 16        # widest bitmap of a set
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_hashes(text: bytes, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles (words: runs without ASCII blanks, A-Z lower-cased)."""
    words = text.lower().split()
    w = hash_words(words, hashes)
    n = len(w) - width + 1
    if not len(w):
        return w
    if n < 1:
        width, n = len(w), 1
    acc = np.full(n, width, U)
    for k in range(width):
        acc = mixed(acc + w[k:k + n])
    return np.unique(acc)


class Scheme:
    """Segments of the size bands for a similarity of ``num / den``."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.bands, self.known = num, den, [1], {}

    def band(self, size: int) -> int:
        """Index of the band; bands are wide enough that linked sizes are in one band or neighbours."""
        step = (self.den / self.num) ** (3 if 10 * self.num >= 9 * self.den else 2)
        while self.bands[-1] <= size:
            self.bands.append(max(self.bands[-1] + 1, math.ceil(self.bands[-1] * step)))
        return int(np.searchsorted(self.bands, size, side="right")) - 1

    def segments(self, band: int) -> tuple[int, int, int]:
        """(segments, smallest segment that gives a key, how many may be below that); no segments: only equal sets link."""
        if band in self.known:
            return self.known[band]
        while len(self.bands) <= band + 1:
            self.band(self.bands[-1])
        low, high = self.bands[band], self.bands[band + 1] - 1
        differ = 2 * high * (self.den - self.num) // (self.den + self.num)
        mean = low * self.num / self.den / (differ + 1)
        least = 2 if mean >= 5 else 1
        weak = (differ + 1) * sum(math.exp(-mean) * mean ** k / math.factorial(k) for k in range(least))
        spare = math.ceil(weak + 2 * math.sqrt(weak) + 1)
        self.known[band] = (differ + 1 + spare, least, spare) if differ else (0, 0, 0)
        return self.known[band]

    def keys(self, h: np.ndarray) -> np.ndarray:
        """Segment keys of a sorted hash set.

        Of ``segments`` segments two linked sets differ in all but ``spare`` + 1 at most, so with
        up to ``spare`` weak ones (few shingles, shared by chance) leaving those out still
        leaves an equal one.  A set with more weak segments gives all its keys.
        """
        out, own = [], self.band(len(h))
        for band in (own, own + 1):
            m, least, spare = self.segments(band)
            if not m or band > own and self.num * self.bands[band] > self.den * len(h):
                continue
            segment = ((h >> U(32)) * U(m)) >> U(32)
            counts = np.bincount(segment.astype(np.int64), minlength=m)
            ends = np.cumsum(counts)
            sums = np.r_[U(0), np.cumsum(mixed(h ^ U(0x5851F42D4C957F2D)), dtype=U)]
            content = sums[ends] - sums[ends - counts]
            place = np.arange(m, dtype=U) + U(band << 32)
            keys = mixed(content + mixed(place * U(0x9E3779B97F4A7C15) + counts.astype(U)))
            strong = counts >= least
            out.append(keys[strong] if m - int(strong.sum()) <= spare else keys)
        return np.concatenate(out) if out else h[:0]


def _digest(h: np.ndarray) -> tuple[int, int]:
    d = np.frombuffer(xxhash.xxh3_128_digest(h.tobytes()), np.int64)
    return int(d[0]), int(d[1])


def bitmap(h: np.ndarray) -> bytes:
    """One bit per hash modulo the width, a power of two of two bits a shingle or more (up to ``BITMAP_BITS``)."""
    width = min(BITMAP_BITS, max(64, 1 << (2 * len(h) - 1).bit_length()))
    bits = np.zeros(width, bool)
    bits[(h & U(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bits: bytes, words: int) -> np.ndarray:
    """A bitmap as 64-bit words, folded to a smaller width: a bit is set if any bit equal modulo the width is."""
    return np.bitwise_or.reduce(np.frombuffer(bits, U).reshape(-1, words), axis=0)


def overlap_bound(a: bytes, b: bytes, sizes: int) -> int:
    """Twice the overlap of two sets at most: each differing bit shows a shingle that only one holds."""
    words = min(len(a), len(b)) // 8
    return sizes - int(np.bitwise_count(folded(a, words) ^ folded(b, words)).sum())


def _scan(batches, width: int, num: int, den: int):
    """Size, digest and bitmap of each set and its tiles ``(key, route)``, all from one shingling.

    Of equal sets of a chunk only the first has tiles.  Where ``KNOWN`` sets of a chunk share a
    tile, their rows but the first have a route of their own and need not meet: the tile is
    known to be shared.
    """
    entry = pa.struct([("key", pa.int64()), ("route", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("bits", pa.binary()),
                        ("tiles", pa.list_(entry))])
    hashes, scheme = WordHashes(), Scheme(num, den)
    for part, texts in text_chunks(batches):
        rows, keys, seen = [], [], set()
        for text in texts:
            h = shingle_hashes(text, width, hashes)
            if not len(h):
                rows.append((0, None, None, None))
                keys.append(h)
                continue
            digest = _digest(h)
            rows.append((len(h), *digest, bitmap(h)))
            keys.append(h[:0] if digest in seen else scheme.keys(h))
            seen.add(digest)
        key = np.concatenate(keys).astype(np.int64)
        doc = np.repeat(np.arange(len(texts)), [len(k) for k in keys])
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        start = np.flatnonzero(first)
        count = np.diff(np.r_[start, len(key)])
        node = np.array([d1 or 0 for _, d1, _, _ in rows], np.int64)
        known = (np.repeat(count, count) >= KNOWN) & ~first
        route = np.where(known, 1 + (node[doc] & 0x3FF), 0)
        # the first of a known tile stands for it on the shared route, and is known itself
        again = start[count >= KNOWN]
        key, route, doc = np.r_[key, key[again]], np.r_[route, 1 + (node[doc[again]] & 0x3FF)], np.r_[doc, doc[again]]
        order = np.argsort(doc, kind="stable")
        ends = np.searchsorted(doc[order], np.arange(len(texts) + 1))
        tiles = pa.StructArray.from_arrays([pa.array(key[order]), pa.array(route[order].astype(np.int32))], fields=list(entry))
        yield batch_of(schema, [part.column(0), part.column(2), *map(list, zip(*rows)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tiles)])


def _sets(batches, width: int):
    schema = pa.schema([("rep", pa.int64()), ("hashes", pa.list_(pa.int64()))])
    hashes = WordHashes()
    for _, texts in text_chunks(batches):
        sets = [h for h in (shingle_hashes(t, width, hashes) for t in texts) if len(h)]
        ends = np.cumsum([0, *map(len, sets)])
        yield batch_of(schema, [[_digest(h)[0] for h in sets], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, U), *sets]).astype(np.int64)))])


# Pairs ---------------------------------------------------------------------------------

def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int(np.count_nonzero(b[at] == a))


def _possible(batches, num: int, den: int):
    """Of (a, b, na, nb, bits_a, bits_b) the pairs whose bitmaps leave a link possible."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for part in batches:
        sizes = part.column(2).to_numpy() + part.column(3).to_numpy()
        keep = [(num + den) * overlap_bound(x.as_buffer(), y.as_buffer(), n) >= 2 * num * n
                for x, y, n in zip(part.column(4), part.column(5), sizes.tolist())]
        yield batch_of(schema, [part.column(0).filter(pa.array(keep, pa.bool_())), part.column(1).filter(pa.array(keep, pa.bool_()))])


def _lists(column) -> list[np.ndarray]:
    ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).view(U)
    return [values[x:y] for x, y in zip(ends[:-1], ends[1:])]


def _linked(batches, num: int, den: int):
    """Of (a, b, hashes_a, hashes_b) the pairs that link."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for part in batches:
        keep = []
        for x, y in zip(_lists(part.column(2)), _lists(part.column(3))):
            common = overlap(x, y)
            keep.append(den * common >= num * (len(x) + len(y) - common))
        yield batch_of(schema, [part.column(0).filter(pa.array(keep, pa.bool_())), part.column(1).filter(pa.array(keep, pa.bool_()))])


def _block_pairs(table: pa.Table, num: int, den: int) -> pa.Table:
    """Pairs of two blocks of a hub (side 0 with side 1, or a block with itself: side 2) that are in
    different components and whose sizes and bitmaps leave a link possible."""
    rep, comp, n, side = (table.column(c).to_numpy() for c in ("rep", "comp", "n", "side"))
    bits = [x.as_buffer() for x in table.column("bits")]
    words = min(map(len, bits)) // 8
    signature = np.array([folded(x, words) for x in bits])
    a, b, place = [], [], np.arange(len(rep))
    for i in range(len(rep)):
        other = np.flatnonzero((place > i) & ((side == 2) | (side == 1 - side[i])) & (comp != comp[i])
                               & (den * np.minimum(n, n[i]) >= num * np.maximum(n, n[i])))
        both = n[other] + n[i]
        most = both - np.bitwise_count(signature[other] ^ signature[i]).sum(axis=1, dtype=np.int64)
        other = other[(num + den) * most >= 2 * num * both]
        a.append(np.full(len(other), rep[i]))
        b.append(rep[other])
    a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b))
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).filter("a < b").distinct()


def _with_bitmaps(pairs: DataFrame, members: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that sizes and bitmaps leave possible."""
    one = members.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"))
    two = members.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"))
    fits = F.lit(den) * F.least("na", "nb") >= F.lit(num) * F.greatest("na", "nb")
    return (pairs.join(one, "a").join(two, "b").filter(fits).select("a", "b", "na", "nb", "bits_a", "bits_b")
            .mapInArrow(lambda it: _possible(it, num, den), "a long, b long"))


def _decide(pairs: DataFrame, src: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, those that link), from the sorted shingle arrays of their classes' documents (``rep, doc``), which are read again."""
    pairs = stage_table(pairs, "pairs")
    if pairs.isEmpty():
        return pairs, pairs
    reps = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    ids = stage_table(docs.join(reps, "rep").select(F.col("doc").alias("doc_id")).distinct(), "pair-ids")
    sets = stage_table(having_ids(src, ids, "doc_id").mapInArrow(lambda it: _sets(it, width), "rep long, hashes array<long>")
                       .join(reps, "rep", "left_semi"), "sets")
    both = (pairs.join(sets.toDF("a", "hashes_a"), "a").join(sets.toDF("b", "hashes_b"), "b")
            .select("a", "b", "hashes_a", "hashes_b"))
    links = stage_table(both.mapInArrow(lambda it: _linked(it, num, den), "a long, b long"), "links")
    drop_staged(sets)
    return pairs, links


def _hubs(tiles: DataFrame) -> DataFrame:
    """``(key, rep)``: the tiles of one centre, the member that shares most tiles with others, put together
    under that centre.  Sets that share a tile are under one key, and a pair that shares many meets there once."""
    counts = stage_table(tiles.groupBy("key").agg((F.count(F.lit(1)) - 1).alias("others")), "tile-sizes")
    scores = stage_table(tiles.join(counts, "key").groupBy("rep").agg(F.sum("others").alias("score")), "scores")
    centres = stage_table(tiles.join(scores, "rep").groupBy("key").agg(F.max_by("rep", F.col("score")).alias("centre")), "centres")
    return stage_table(tiles.join(centres, "key").select(F.col("centre").alias("key"), "rep").distinct(), "hubs")


def _open_groups(placed: DataFrame, members: DataFrame) -> DataFrame | None:
    """Members ``key, rep, comp, n`` of the groups whose members are in several components, with how each group is cut to blocks; None: no such group."""
    per = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    groups = stage_table(
        per.groupBy("key").agg(F.count(F.lit(1)).alias("comps"), F.sum("c").alias("total"), F.max("c").alias("most"), F.max_by("comp", "c").alias("main"))
        .filter("comps > 1")
        .select("key", "main", F.ceil((F.col("total") - F.col("most")) / BLOCK).cast("int").alias("s"), F.ceil(F.col("most") / BLOCK).cast("int").alias("s_main"),
                (F.col("total") <= SMALL_HUB).alias("small"), (F.col("total") > LARGE_HUB).alias("large")), "open-groups")
    if groups.isEmpty():
        return None
    return stage_table(placed.join(groups, "key").join(members.select("rep", "n"), "rep"), "open-rows")


def _small_groups(rows: DataFrame, members: DataFrame, num: int, den: int) -> DataFrame:
    """Possible pairs of groups small enough to write their pairs out."""
    x = rows.filter("small").select("key", F.col("rep").alias("x"), F.col("comp").alias("cx"), F.col("n").alias("nx"))
    y = rows.filter("small").select("key", F.col("rep").alias("y"), F.col("comp").alias("cy"), F.col("n").alias("ny"))
    fits = F.lit(den) * F.least("nx", "ny") >= F.lit(num) * F.greatest("nx", "ny")
    return _with_bitmaps(_ordered(x.join(y, "key").filter((F.col("x") < F.col("y")) & (F.col("cx") != F.col("cy")) & fits), "x", "y"), members, num, den)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h % U(SHINGLE_BUCKETS)).astype(np.int64)


def _shingle_counts(batches, width: int):
    """How many sets of the task hold shingles of each hash bucket, in blocks of ``COUNT_BLOCK`` buckets."""
    schema = pa.schema([("block", pa.int32()), ("counts", pa.binary())])
    hashes, held = WordHashes(), np.zeros(SHINGLE_BUCKETS, np.int32)
    for _, texts in text_chunks(batches):
        held += np.bincount(_bucket(np.concatenate([shingle_hashes(t, width, hashes) for t in texts])), minlength=SHINGLE_BUCKETS).astype(np.int32)
    if held.any():
        blocks = held.reshape(-1, COUNT_BLOCK)
        yield batch_of(schema, [np.arange(len(blocks)), [x.tobytes() for x in blocks]])


def _summed_counts(table: pa.Table) -> pa.Table:
    total = sum((np.frombuffer(x.as_buffer(), np.int32) for x in table.column("counts")), np.zeros(COUNT_BLOCK, np.int64))
    return pa.table({"block": table.column("block")[:1], "counts": pa.array([np.minimum(total, 2 ** 31 - 1).astype(np.int32).tobytes()], pa.binary())})


def _rarest(batches, width: int, num: int, den: int, shared):
    """Each set's first n - ceil(n num / den) + 1 shingles, those of the rarest hash buckets first."""
    schema = pa.schema([("rep", pa.int64()), ("keys", pa.list_(pa.int64()))])
    hashes, held = WordHashes(), shared.value
    for _, texts in text_chunks(batches):
        sets = [h for h in (shingle_hashes(t, width, hashes) for t in texts) if len(h)]
        keys = [h[np.argsort(held[_bucket(h)], kind="stable")[:len(h) + (-len(h) * num // den) + 1]].astype(np.int64) for h in sets]
        yield batch_of(schema, [[_digest(h)[0] for h in sets], keys])


def _by_rare_shingles(rows: DataFrame, src: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``key, rep, comp``: the members of large hubs that share one of their rarest shingles with another component, under hubs of these shingles.

    Shingles are ordered by how many sets hold their hash bucket, then by hash; any order that all
    sets share will do.  Linked sets hold so much in common that both have a common shingle
    among their first n - ceil(n num / den) + 1, so no link is lost; sets that share only what
    many share are not brought together.  The texts are scanned twice where they are, and only
    these first shingles are shuffled.  Two sets that share many of them meet once, as in ``_hubs``.
    """
    mine = stage_table(rows.select("rep", "comp").distinct(), "hub-members")
    ids = stage_table(docs.join(mine.select("rep"), "rep", "left_semi").select(F.col("doc").alias("doc_id")).distinct(), "hub-ids")
    texts = in_buckets(src, ids, ["doc_id"])    # and a few others, which the join with ``mine`` leaves out
    counts = (texts.mapInArrow(lambda it: _shingle_counts(it, width), "block int, counts binary")
              .groupBy("block").applyInArrow(_summed_counts, "block int, counts binary").toArrow().sort_by("block"))
    shared = src.sparkSession.sparkContext.broadcast(np.concatenate([np.frombuffer(x.as_buffer(), np.int32) for x in counts.column("counts")]))
    sets = stage_table(texts.mapInArrow(lambda it: _rarest(it, width, num, den, shared), "rep long, keys array<long>")
                       .join(mine, "rep").dropDuplicates(["rep"]), "rarest")
    rare = sets.select(F.explode("keys").alias("key"), "rep", "comp")
    several = stage_table(rare.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key"), "open-shingles")
    shared_keys = stage_table(in_buckets(rare.select("key", "rep"), several, ["key"]).join(several, "key", "left_semi"), "rare-shingles")
    drop_staged(sets)
    return _hubs(shared_keys).join(mine, "rep").select("key", "rep", "comp")


def _open_pairs(hubs: DataFrame, members: DataFrame, links: DataFrame, decided: DataFrame, src: DataFrame, docs: DataFrame,
                width: int, num: int, den: int) -> DataFrame | None:
    """Possible pairs under a hub, not yet decided, whose members the links do not connect; None
    where every hub is connected."""
    components = connected_components(links).toDF("rep", "comp")
    placed = stage_table(hubs.join(components, "rep", "left").select("key", "rep", F.coalesce("comp", "rep").alias("comp")), "placed")
    rows = _open_groups(placed, members)
    if rows is None:
        return None
    pairs = [_small_groups(rows, members, num, den), _block_groups(rows.filter("NOT small AND NOT large"), members, num, den)]
    large = rows.filter("large")
    rare = None if large.isEmpty() else _open_groups(_by_rare_shingles(large, src, docs, width, num, den), members)
    if rare is not None:
        pairs += [_small_groups(rare, members, num, den), _block_groups(rare.filter("NOT small"), members, num, den)]
    return reduce(DataFrame.unionByName, pairs).distinct().join(decided, ["a", "b"], "left_anti")


def _block_groups(rows: DataFrame, members: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of groups, block by block.  A group's main component has blocks of its own, numbered after
    the others' ``s``; they meet the others' blocks only, so a group that is one component but for a few
    sets costs as many rows as it has members for each block of those few."""
    mine = F.when(F.col("comp") == F.col("main"), F.col("s") + F.pmod(F.xxhash64("rep"), F.col("s_main"))).otherwise(F.pmod(F.xxhash64("rep"), F.col("s")))
    meets = F.when(F.col("mine") < F.col("s"), F.col("s") + F.col("s_main")).otherwise(F.col("s")) - 1
    dealt = (rows.withColumn("mine", mine.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), meets)))
             .select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "rep", "comp", "n",
                     F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side")))
    return (dealt.join(members.select("rep", "bits"), "rep").groupBy("key", "i", "j")
            .applyInArrow(lambda t: _block_pairs(t, num, den), "a long, b long"))


def _shared_tiles(sets: DataFrame) -> list[DataFrame]:
    """``key, d1``: the tiles of several sets, part by part of the keys."""
    tile = Window.partitionBy("key", "route")
    tiles = sets.select("d1", F.inline("tiles"))
    return [stage_table(tiles.filter(F.pmod("key", F.lit(TILE_PASSES)) == part)
                        .select("key", "d1", "route", F.min("d1").over(tile).alias("lo"), F.max("d1").over(tile).alias("hi"))
                        .filter("route > 0 OR lo <> hi").select("key", "d1").distinct(), "shared-tiles") for part in range(TILE_PASSES)]


def _sets_and_links(src: DataFrame, width: int, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links): per row its set, per distinct set its smallest id, and the pairs of distinct sets that link.

    A distinct set is named by 64 bits of its digest (``d1``, in pairs ``rep``).
    """
    sets = stage_table(src.mapInArrow(lambda it: _scan(it, width, num, den),
                                      "doc_id long, mark long, n long, d1 long, d2 long, bits binary, tiles array<struct<key:long,route:int>>"), "sets")
    classes = stage_table(sets.filter("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("doc"), F.max("n").alias("n")), "classes")

    parts = _shared_tiles(sets)
    shared = reduce(DataFrame.unionByName, parts)
    known = stage_table(classes.filter("doc IS NOT NULL").join(shared.select("d1").distinct(), "d1", "left_semi")
                        .select("d2", F.col("d1").alias("rep"), "doc", "n"), "known")
    tiles = stage_table(shared.withColumnRenamed("d1", "rep").join(known.select("rep"), "rep", "left_semi").select("key", "rep"), "tiles")
    members = stage_table(known.join(sets.select(F.col("d1").alias("rep"), "d2", F.col("doc_id").alias("doc"), "bits"), ["rep", "d2", "doc"])
                          .dropDuplicates(["rep"]).select("rep", "n", "bits"), "members")
    docs = known.select("rep", "doc")
    rows = stage_table(sets.select("doc_id", "mark", "n", "d1", "d2"), "set-rows")
    for table in (sets, *parts):  # bitmaps and tiles of sets that share none are not needed any more
        drop_staged(table)

    hubs = _hubs(tiles)
    decided, links = _decide(_with_bitmaps(_ordered(hubs, "rep", "key"), members, num, den), src, docs, width, num, den)
    still_open = _open_pairs(hubs, members, links, decided, src, docs, width, num, den)
    if still_open is not None:
        links = links.unionByName(_decide(still_open, src, docs, width, num, den)[1])
    return rows, classes, links


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("mark"))


def linked_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Two documents link when ``den * |A and B| >= num * |A or B|`` for their sets of distinct
    ``width``-word shingles; a text of fewer words is one shingle.  ``component_id`` is the
    smallest id reachable by links.  Null, empty and blank texts have no shingles and link
    with nothing.  Rows that repeat an id are one document that links by any of its texts;
    documents with a null id link with equal sets only, and a component without any other
    id has a null id.  Other columns are ignored; an empty table gives an empty result.
    Shingles and sets are told apart by 64-bit hashes.
    """
    sets, classes, links = _sets_and_links(_source(docs, id_col, text_col), width, num, den)
    # The sets of one id are one document.
    several = sets.filter("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("d1").alias("lo"), F.max("d1").alias("hi")).filter("lo <> hi")
    same_id = sets.select("doc_id", "d1").join(several, "doc_id").filter("d1 <> lo").select(F.col("lo").alias("a"), F.col("d1").alias("b"))
    found = stage_table(connected_components(links.unionByName(same_id)).toDF("d1", "component"), "components")
    linked = classes.join(found, "d1").select("d1", "component", "doc")
    smallest = linked.groupBy("component").agg(F.min("doc").alias("component_id"))
    named = linked.join(smallest, "component").select("d1", "component_id")
    named = stage_table(classes.join(named, "d1", "left").select("d1", "d2", F.coalesce("component_id", "doc").alias("component_id")), "named")
    return sets.join(named, ["d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component, the one of the smallest id (null last); all columns stay.

    Rows are judged by their texts: rows that repeat an id are documents of their own, named
    by id and a hash of the text, so a text stays unless another one that it is linked with
    does.  Rows equal in id and text stay or go together; texts without words all stay.
    """
    sets, classes, links = _sets_and_links(_source(docs, id_col, text_col), width, num, den)
    found = stage_table(connected_components(links).toDF("d1", "component"), "components")
    named = classes.select("d1", "d2").join(found, "d1", "left").select("d1", "d2", F.coalesce("component", "d1").alias("component"))
    rows = stage_table(sets.filter("n > 0").select("doc_id", "mark", "d1", "d2").join(named, ["d1", "d2"])
                       .select("component", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark").alias("row")), "named-rows")
    stays = rows.groupBy("component").agg(F.min("row").alias("kept"))
    lost = rows.join(stays, "component").filter(~F.col("row").eqNullSafe(F.col("kept"))).select("row.doc_id", "row.mark").distinct()
    free = "_" * (1 + max(map(len, docs.columns)))  # longer than any column's name, so it is none of them
    lost = lost.toDF(free + "id", free + "mark")
    same = docs[id_col].cast("long").eqNullSafe(lost[free + "id"]) & (F.xxhash64(docs[text_col]) == lost[free + "mark"])
    return docs.join(lost.hint("merge"), same, "left_anti")


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, CAST(len(w) AS BIGINT) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS sh FROM w),
n AS (SELECT doc_id, sh, CAST(len(sh) AS BIGINT) AS n FROM s),
classes AS (SELECT list_sort(sh) AS sh, min(doc_id) AS rep, any_value(n) AS n FROM n WHERE n > 0 GROUP BY list_sort(sh)),
e AS (SELECT rep, n, unnest(sh) AS x FROM classes),
common AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
           FROM e a JOIN e b ON a.x = b.x AND a.rep < b.rep AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n GROUP BY 1, 2),
link AS (SELECT a, b FROM common WHERE 100 * shared >= 90 * (na + nb - shared)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT DISTINCT a AS node, a AS seen FROM both_ways UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.seen = both_ways.a),
comp AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY 1)
SELECT n.doc_id, n.n AS n_shingles, coalesce(comp.component_id, classes.rep, n.doc_id) AS component_id
FROM n LEFT JOIN classes ON n.n > 0 AND list_sort(n.sh) = classes.sh LEFT JOIN comp ON classes.rep = comp.node
"""
