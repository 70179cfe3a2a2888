"""Prefix trie of conversations and totals over its subtrees by depth-band rollup.

A conversation is a path: after d turns it stands at the node of its first d turns.  Nodes are
named by a 128-bit prefix hash (the exclusive or of one hash per turn and depth, so prefixes of
long conversations are put together from blocks) and then by their smallest member and depth.

Rollup: depths fall into bands of ``HEIGHT``.  A value is exploded only to the ancestors in its
own band (at most ``HEIGHT`` rows), for all bands at once.  The first depths of the bands form a
tree again, ``HEIGHT`` times less deep, whose totals are found the same way; completed totals of
band roots are then exploded to the ancestors in the band above.  A trie of depth D takes
about 2 log(D) / log(HEIGHT) rounds.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.ordering import global_index
from kestrel.session import stage_table

HEIGHT = 16                  # depths in a band
BLOCK = 1024                 # turns of a conversation whose prefixes one window computes
ID_BLOCK = 1024              # conversation ids joined to one string before hashing
SHARED, HEADS = 100, 6       # fixed values: conversations that share a base; a head has fewer turns than HEADS


# Turns ---------------------------------------------------------------------------------

def _turns(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``c, p, h1, h2, n_chars, n``: turn p (from 0) of conversation c, hashes of its role and text, turns of c.

    Numbered from a range-partitioned sort, so a conversation of any size is dealt over many tasks.
    """
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role_col, text_col))
    src = rows.select(F.col(id_col).cast("long").alias("c"), F.col(turn_col).alias("turn"), F.xxhash64(F.lit(1), role, text).alias("h1"),
                      F.xxhash64(F.lit(2), role, text).alias("h2"), F.length(text).cast("long").alias("n_chars")).filter("c IS NOT NULL")
    numbered = global_index(src, [F.asc("c"), F.asc_nulls_first("turn"), F.asc("h1"), F.asc("h2")], "g")
    first = numbered.groupBy("c").agg(F.min("g").alias("g0"), F.count(F.lit(1)).alias("n"))
    return numbered.join(first.hint("merge"), "c").select("c", (F.col("g") - F.col("g0")).alias("p"), "h1", "h2", "n_chars", "n")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(paths, convs)``: the turns ``c, depth (from 1), h1, h2, n_chars`` of every rebuilt conversation, and ``c, depth`` of its end.

    Conversation c starts with the first h turns of its base c - c % 100 (all if it has fewer, none
    if there is none), h = crc32(decimal c) % 6, and goes on with its own turns after the first h.
    """
    c = F.col("c")
    convs = turns.filter("p = 0").select("c", "n", (c - c % SHARED).alias("base"), (F.crc32(c.cast("string").cast("binary")) % HEADS).alias("h"))
    length = turns.filter("p = 0").select(c.alias("base"), F.col("n").alias("base_n"))
    convs = stage_table(convs.join(length.hint("merge"), "base", "left")  # at most 100 conversations of a base
                        .withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0))))
                        .withColumn("depth", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "rebuilt")
    tails = (turns.drop("n").join(convs.select("c", "h", "head").hint("merge"), "c").filter("p >= h")
             .select("c", (F.col("head") + F.col("p") - F.col("h") + 1).alias("depth"), "h1", "h2", "n_chars"))
    bases = turns.filter((F.col("p") < HEADS) & (c % SHARED == 0)).select(c.alias("base"), "p", "h1", "h2", "n_chars")
    heads = (convs.select("c", "base", "h").join(bases.hint("merge"), "base").filter("p < h")
             .select("c", (F.col("p") + 1).alias("depth"), "h1", "h2", "n_chars"))
    return tails.unionByName(heads), convs.select("c", "depth")


def _prefixes(turns: DataFrame, block: int) -> DataFrame:
    """Adds ``x1, x2``, the hash of the turns up to each depth; windows hold one block of a conversation.

    Totals of earlier blocks are added for conversations that have more than one.
    """
    mixed = turns.select("c", "depth", "n_chars", F.xxhash64("depth", "h1", "h2", F.lit(1)).alias("t1"), F.xxhash64("depth", "h2", "h1", F.lit(2)).alias("t2"),
                         F.floor((F.col("depth") - 1) / block).alias("block"))
    upto = Window.partitionBy("c", "block").orderBy("depth")
    local = mixed.select("c", "depth", "n_chars", "block", F.bit_xor("t1").over(upto).alias("y1"), F.bit_xor("t2").over(upto).alias("y2"))
    totals = mixed.groupBy("c", "block").agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"))
    before = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    earlier = totals.select("c", "block", F.bit_xor("s1").over(before).alias("o1"), F.bit_xor("s2").over(before).alias("o2")).filter("block > 0")
    return (local.join(earlier.hint("merge"), ["c", "block"], "left")
            .select("c", "depth", "n_chars", *(F.col(f"y{i}").bitwiseXOR(F.coalesce(f"o{i}", F.lit(0))).alias(f"x{i}") for i in (1, 2))))


# Rollup --------------------------------------------------------------------------------

NODE = ["node", "depth"]     # a node: its smallest member and its depth


def _to_ancestors(values: DataFrame, paths: DataFrame, height: int, of_band: Column) -> DataFrame:
    """Sums of ``values`` (``node, depth``, others) over the ancestors in one band each; the nodes themselves count if they lie in it."""
    sums = [c for c in values.columns if c not in NODE]
    mine = values.select(F.col("node").alias("c"), F.col("depth").alias("at"), of_band.alias("band"), *sums)
    over = paths.select("c", "depth", "node", F.floor(F.col("depth") / height).alias("band"))
    return (mine.join(over.hint("merge"), ["c", "band"]).filter("depth <= at")
            .groupBy(*NODE).agg(*(F.sum(s).alias(s) for s in sums)))


def subtree_totals(paths: DataFrame, values: DataFrame, height: int = HEIGHT) -> DataFrame:
    """For every node with any value below it, the sums of all value columns over its subtree.

    ``paths`` (``c, depth, node``) has each depth from 0 of each path once, with the smallest
    member of the node there; ``values`` has ``node, depth`` and numbers, a row per node at most.
    """
    deepest = paths.agg(F.max("depth")).first()[0]
    own = stage_table(_to_ancestors(values, paths, height, F.floor(F.col("depth") / height)), "band-sums")
    if deepest is None or deepest < height:
        return own
    roots = F.col("depth") % height == 0
    band = (F.col("depth") / height).cast("long").alias("depth")
    upper = subtree_totals(stage_table(paths.filter(roots).select("c", band, "node"), "band-paths"),
                           own.filter(roots).withColumn("depth", band), height)
    below = (upper.filter("depth > 0").withColumn("depth", F.col("depth") * height))
    handed = _to_ancestors(below, paths, height, F.floor(F.col("depth") / height) - 1)
    sums = [c for c in values.columns if c not in NODE]
    return stage_table(own.unionByName(handed).groupBy(*NODE).agg(*(F.sum(s).alias(s) for s in sums)), "subtree-sums")


# Ends ----------------------------------------------------------------------------------

def _hash_ids(batches):
    """SHA-256 of comma-joined id strings of each (node, depth), from sorted rows; holds one row at a time."""
    schema = pa.schema([("node", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
    key, state = None, None
    for b in batches:
        done = []
        for node, depth, ids in zip(*(b.column(b.schema.get_field_index(k)).to_pylist() for k in ("node", "depth", "ids"))):
            if (node, depth) != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (node, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d)) for d in done], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*key, state.hexdigest())))], schema=schema)


def _end_digests(ends: DataFrame) -> DataFrame:
    """``node, depth, ends_sha256`` from ``c, node, depth`` of the conversations' ends.

    Ids are joined in blocks of numbers first, so a node where very many conversations end is
    a stream of short strings, and no task holds its list.
    """
    blocks = (ends.groupBy("node", "depth", F.floor(F.col("c") / ID_BLOCK).alias("block"))
              .agg(F.concat_ws(",", F.sort_array(F.collect_list("c")).cast("array<string>")).alias("ids")))  # ids are distinct: ID_BLOCK at most
    ordered = blocks.repartition("node", "depth").sortWithinPartitions("node", "depth", "block")
    return ordered.select("node", "depth", "ids").mapInArrow(_hash_ids, "node long, depth long, ends_sha256 string")


# Trie ----------------------------------------------------------------------------------

def prefix_trie(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                height: int = HEIGHT, block: int = BLOCK) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns are ordered by ``turn`` (null first), equal ones by a hash of role and text; a null
    role or text counts as empty; rows that repeat a turn are turns of their own.  Rows with a
    null conversation id belong to no conversation and are left out.  An empty table has no
    conversation and so no node; other columns are ignored, whatever their names.
    """
    turns = stage_table(_turns(rows, id_col, turn_col, role_col, text_col), "turns")
    rebuilt, convs = rebuilt_turns(turns)
    start = convs.select("c", F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("long").alias(k) for k in ("n_chars", "x1", "x2")))
    steps = stage_table(_prefixes(rebuilt, block).unionByName(start), "prefixes")

    name = ["depth", "x1", "x2"]
    named = steps.groupBy(*name).agg(F.min("c").alias("node"), F.count(F.lit(1)).alias("n_convs"), F.max("n_chars").alias("n_chars"))
    named = stage_table(named, "named")
    # All conversations pass the root: its one row is broadcast.
    root = F.broadcast(named.filter("depth = 0").select("depth", "node"))
    paths = stage_table(
        steps.filter("depth > 0").join(named.filter("depth > 0").select(*name, "node").hint("merge"), name).select("c", "depth", "node")
        .unionByName(steps.filter("depth = 0").select("c", "depth").join(root, "depth")), "paths")

    up = paths.select(F.col("c").alias("node"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    nodes = named.drop("x1", "x2").join(up.hint("merge"), NODE, "left")
    children = (nodes.filter("depth > 0").groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth"))
                .agg(F.count(F.lit(1)).alias("n_children")))
    nodes = stage_table(nodes.join(children.hint("merge"), NODE, "left").fillna({"n_children": 0}), "nodes")

    values = (nodes.select(*NODE, (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                           ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens"))
              .filter("n_leaves > 0 OR saved_tokens > 0"))
    totals = subtree_totals(paths, values, height)
    ends = _end_digests(paths.join(convs.hint("merge"), ["c", "depth"]))
    return (nodes.join(totals.hint("merge"), NODE, "left").join(ends.hint("merge"), NODE, "left")
            .select(F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                    "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


# Query ---------------------------------------------------------------------------------

# crc32 bit by bit over the digits: a byte is taken in, then eight times the register is shifted.
SQL = """
WITH own AS (
    SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce("text", '')} ORDER BY turn NULLS FIRST) AS l
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
steps AS (
    SELECT c, flatten(list_transform(string_split(c::VARCHAR, ''),
                                     lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS s FROM own),
heads AS (
    SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, s),
                  lambda r, y: CASE WHEN y >= 0 THEN xor(r, y) ELSE xor(r >> 1, 3988292384 * (r & 1)) END), 4294967295) % 6 AS h FROM steps),
rebuilt AS (
    SELECT o.c, list_concat(coalesce(b.l[1:h.h], []), o.l[h.h + 1:]) AS l
    FROM own o JOIN heads h USING (c) LEFT JOIN own b ON b.c = o.c - o.c % 100),
places AS (SELECT c, unnest(range(0, len(l) + 1)) AS depth, l FROM rebuilt),
named AS (
    SELECT c, depth, len(l) AS whole, md5(l[1:depth]::VARCHAR) AS k, CASE WHEN depth > 0 THEN md5(l[1:depth - 1]::VARCHAR) END AS up,
           CASE WHEN depth > 0 THEN length(l[depth].t) ELSE 0 END AS chars FROM places),
nodes AS (
    SELECT depth, k, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE whole = depth), '')) AS ends_sha256
    FROM named GROUP BY depth, k),
kids AS (SELECT depth - 1 AS depth, up AS k, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
full_nodes AS (
    SELECT n.*, coalesce(kids.n, 0) AS n_children FROM nodes n LEFT JOIN kids USING (depth, k)),
chains AS (SELECT DISTINCT a.depth, a.k, b.depth AS d2, b.k AS k2 FROM named a JOIN named b ON a.c = b.c AND b.depth >= a.depth),
sums AS (
    SELECT ch.depth, ch.k, sum((f.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(f.saved)::BIGINT AS saved_tokens
    FROM chains ch JOIN full_nodes f ON f.depth = ch.d2 AND f.k = ch.k2 GROUP BY 1, 2)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sums s USING (depth, k) LEFT JOIN full_nodes p ON p.depth = f.depth - 1 AND p.k = f.up
"""
