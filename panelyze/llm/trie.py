"""Prefix trie of conversations through fixed-length block hashing.

A conversation's turns are grouped in blocks of ``BLOCK`` turns, each block is
hashed whole, and a conversation is the path of its block digests.  Grouping is
by path first: conversations that agree up to a block are siblings there.
Where a block has no sibling, all of its turns have the members of the block,
and their nodes follow without any further grouping.  Only where siblings
diverge are the turn boundaries inside the blocks refined: the distinct blocks
(not the conversations) are grouped by their first 1 to ``BLOCK`` turns.

A path is kept as the XOR of the hashes of its (place, block) pairs, 128 bits
wide, so that it can be summed piecewise; a node is its depth and the path down
to it.

Scale: texts are reduced to digests and word counts before anything moves.
Turns are numbered in ranges: rows are dealt by ranges of (conversation, turn),
counted within each range, and the counts of the ranges before are added; so a
conversation of any length is spread over tasks.  Nodes come from partial
aggregation.  Sums over subtrees double their reach each round, so a trie
of depth d takes log2(d) rounds; a node's ancestor is looked up on the path
of its own first conversation, a key that no two nodes share.  A parent with
more than a thousandth of all nodes as children is broadcast (at most a
thousand such rows), the others are joined by shuffle.  A list of member ids is
hashed as a stream, in pieces of at most ``2 ** PIECE_BITS`` ids.

Defined cases: turns come in order of turn (null first); those of one number in
order of role and then of the MD5 of their text, and rows that repeat are turns
of their own.  A null role or text is empty; texts of any length are turned to
digests by Spark; rows without a conv_id belong to no conversation; a
conversation that is left without turns is a member of the root alone; an empty
table has no nodes, not even a root; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelyze.llm.common import WORD, discard, save, shuffle_parts, table

BLOCK = 4
# Member ids in one piece of an id list: 2 ** PIECE_BITS consecutive numbers at most.
PIECE_BITS = 8
HEAVY = 1000
# Rebuilding: conversations come in groups of so many, and take so many first turns at most.
GROUP, HEADS = 20, 4
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def digest(*cols: str) -> list[Column]:
    """Two 64-bit hashes of some columns, named a and b."""
    return [F.xxhash64(F.lit(salt), *cols).alias(n) for salt, n in ((101, "a"), (202, "b"))]


def numbered_turns(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``turns(c, p, local, a, b, words)`` and ``ranges(c, p, n, ahead)``.

    ``p`` is the range that holds a turn, ``local`` its number (from 1) in
    conversation and range, ``ahead`` the turns of the conversation in earlier
    ranges, ``n`` those in this one.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    flat = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"),
        F.col("turn").alias("t"),
        role.alias("role"),
        F.md5(text.cast("binary")).alias("text_md5"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = ["c", F.col("t").asc_nulls_first(), "role", "text_md5"]
    parts = shuffle_parts(rows.sparkSession)
    dealt = flat.repartitionByRange(parts, *order).withColumn("p", F.spark_partition_id())
    dealt = save(dealt.select("c", "p", "t", "role", "text_md5", *digest("role", "text_md5"), "words"), "trie-dealt")
    local = W.partitionBy("c", "p").orderBy(F.col("t").asc_nulls_first(), "role", "text_md5")
    turns = dealt.withColumn("local", F.row_number().over(local)).select("c", "p", "local", "a", "b", "words")
    before = W.partitionBy("c").orderBy("p").rowsBetween(W.unboundedPreceding, -1)
    ranges = dealt.groupBy("c", "p").agg(F.count("*").alias("n"))
    ranges = ranges.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return turns, save(ranges, "trie-ranges")


def whole(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``turns(c, p, pos, a, b, words)`` and ``ends(c, depth)`` of the conversations as they are."""
    turns, ranges = numbered_turns(rows)
    turns = turns.join(ranges, ["c", "p"]).select("c", "p", (F.col("local") + F.col("ahead")).alias("pos"), "a", "b", "words")
    return turns, ranges.groupBy("c").agg(F.sum("n").alias("depth"))


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``whole``, each conversation c taking its first h = crc32(c) % 4 turns from conversation c - c % 20."""
    turns, ranges = numbered_turns(rows)
    c = F.col("c")
    sizes = ranges.groupBy("c").agg(F.sum("n").alias("n"))
    h = F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(HEADS))
    base = c - c % F.lit(GROUP)
    asks = sizes.select("c", "n", base.alias("base"), h.alias("h"))
    # At most GROUP conversations (twice that around 0) ask for one base.
    has = sizes.select(F.col("c").alias("base"), F.col("n").alias("base_n"))
    asks = asks.join(has, "base", "left").withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0))))
    asks = save(asks.select("c", "n", "base", "h", "head"), "trie-asks")
    placed = turns.join(ranges.join(asks, "c").select("c", "p", "ahead", "h", "head"), ["c", "p"])
    pos = F.col("local") + F.col("ahead")
    placed = save(placed.select("c", "p", pos.alias("pos"), "a", "b", "words", "h", "head"), "trie-turns")
    own = placed.where("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("head")).drop("h", "head")
    # First turns of the bases, dealt to all who ask (range -1: before all others).
    first = placed.where(f"pos < {HEADS} and c % {GROUP} = 0").select(F.col("c").alias("base"), "pos", "a", "b", "words")
    heads = asks.where("h > 0").select("c", "base", "h").join(first, "base").where("pos <= h")
    heads = heads.select("c", F.lit(-1).alias("p"), "pos", "a", "b", "words")
    ends = asks.select("c", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("depth"))
    return own.unionByName(heads), ends


def block_rows(turns: DataFrame) -> DataFrame:
    """``(c, k, pa, pb, t, len)``: the path before each block, and its turns ``(a, b, words)`` in order."""
    k = F.floor((F.col("pos") - 1) / BLOCK).cast("long").alias("k")
    turn = F.struct("pos", "a", "b", "words")
    # At most BLOCK turns to a group.
    rows = turns.groupBy("c", k).agg(F.min("p").alias("p"), F.array_sort(F.collect_list(turn)).alias("t"))
    rows = rows.withColumn("len", F.size("t"))
    own = [F.xxhash64(F.lit(salt), "k", F.transform("t", lambda x: x[n])).alias(f"h{n}") for salt, n in ((1, "a"), (2, "b"))]
    rows = save(rows.select("c", "k", "p", "t", "len", *own), "trie-blocks")
    before = rows.groupBy("c", "p").agg(F.bit_xor("ha").alias("xa"), F.bit_xor("hb").alias("xb"))
    earlier = W.partitionBy("c").orderBy("p").rowsBetween(W.unboundedPreceding, -1)
    before = before.select("c", "p", *[F.coalesce(F.bit_xor(f"x{n}").over(earlier), F.lit(0)).alias(f"x{n}") for n in "ab"])
    inside = W.partitionBy("c", "p").orderBy("k").rowsBetween(W.unboundedPreceding, -1)
    local = rows.select(
        "c", "k", "p", "t", "len", *[F.coalesce(F.bit_xor(f"h{n}").over(inside), F.lit(0)).alias(f"l{n}") for n in "ab"]
    )
    path = [F.col(f"l{n}").bitwiseXOR(F.col(f"x{n}")).alias(f"p{n}") for n in "ab"]
    return local.join(before, ["c", "p"]).select("c", "k", *path, "t", "len")


def inner_path(i: Column) -> list[Column]:
    """The path down to the block's first ``i`` turns, named na and nb."""
    some = F.slice("t", 1, i)
    out = []
    for salt, n in ((1, "a"), (2, "b")):
        own = F.xxhash64(F.lit(salt), "k", F.transform(some, lambda x: x[n]))
        out.append(F.when(i == 0, F.col(f"p{n}")).otherwise(F.col(f"p{n}").bitwiseXOR(own)).alias(f"n{n}"))
    return out


def turn_nodes(blocks: DataFrame) -> DataFrame:
    """``(depth, na, nb, ua, ub, c, n, words)``: a node for each first 1 .. len turns of each block, and its parent's path."""
    i = F.col("i")
    each = blocks.select("*", F.explode(F.sequence(F.lit(1), F.col("len"))).alias("i"))
    node, up = inner_path(i), inner_path(i - 1)
    return each.select(
        (F.col("k") * BLOCK + i).alias("depth"),
        *node,
        up[0].alias("ua"),
        up[1].alias("ub"),
        "c",
        "n",
        F.element_at("t", i)["words"].alias("words"),
    )


def nodes_of(blocks: DataFrame, ends: DataFrame) -> DataFrame:
    """All nodes: ``(depth, na, nb, ua, ub, c, n, words)``, c the smallest member and n their number."""
    turns = F.transform("t", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["words"].alias("words")))
    # Distinct blocks under one path; copies go before anything is dealt by path alone.
    distinct = blocks.withColumn("t", turns).groupBy("k", "pa", "pb", "t", "len")
    distinct = save(distinct.agg(F.min("c").alias("c"), F.count("*").alias("n")), "trie-distinct")
    row = F.struct("t", "len", "c", "n")
    kin = distinct.groupBy("k", "pa", "pb").agg(F.count("*").alias("siblings"), F.min_by(row, "c").alias("only"))
    alone = save(kin.where("siblings = 1").select("k", "pa", "pb", "only.*"), "trie-alone")
    # A block's smallest member and number name it, so a path with many blocks is no hot key here.
    apart = distinct.join(alone.select("k", "c"), ["k", "c"], "left_anti")
    key = ["depth", "na", "nb", "ua", "ub"]
    refined = turn_nodes(apart).groupBy(*key).agg(F.min("c").alias("c"), F.sum("n").alias("n"), F.max("words").alias("words"))
    root = ends.agg(F.min("c").alias("c"), F.count("*").alias("n")).where("n > 0")
    none = F.lit(None).cast("long")
    root = root.select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("na"), F.lit(0).cast("long").alias("nb"), none.alias("ua"), none.alias("ub"), "c", "n", F.lit(0).cast("long").alias("words"))
    out = save(turn_nodes(alone).unionByName(refined).unionByName(root), "trie-nodes")
    discard(distinct, alone)
    return out


def member_paths(blocks: DataFrame, some: DataFrame) -> DataFrame:
    """``(c, depth, na, nb)``: the nodes on the path of each conversation in ``some(c)``, from depth 0 on."""
    mine = blocks.join(some, "c", "left_semi")
    each = mine.select("*", F.explode(F.sequence(F.lit(1), F.col("len"))).alias("i"))
    down = each.select("c", (F.col("k") * BLOCK + F.col("i")).alias("depth"), *inner_path(F.col("i")))
    zero = F.lit(0).cast("long")
    return down.unionByName(some.select("c", zero.alias("depth"), zero.alias("na"), zero.alias("nb")))


def subtree_sums(nodes: DataFrame, paths: DataFrame, values: list[str]) -> DataFrame:
    """``nodes`` with each of ``values`` summed over the subtree (the node itself included).

    After round j a node holds the sum over descendants less than 2**j below
    it, and adds those of the descendants exactly 2**j below.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    cur, step = nodes, 1
    while step <= deepest:
        at = cur.where(F.col("depth") >= step).select("c", (F.col("depth") - step).alias("depth"), *values)
        up = at.join(paths, ["c", "depth"]).groupBy("depth", "na", "nb")
        up = up.agg(*[F.sum(v).alias(f"more_{v}") for v in values])
        more = {v: F.col(v) + F.coalesce(f"more_{v}", F.lit(0)) for v in values}
        cur = save(cur.join(up, ["depth", "na", "nb"], "left").withColumns(more).drop(*[f"more_{v}" for v in values]), "trie-sums")
        step *= 2
    return cur


def with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``parent_c`` and ``n_children``, also where one parent has most of the nodes."""
    total = nodes.count()
    up = [(F.col("depth") - 1).alias("depth"), F.col("ua").alias("na"), F.col("ub").alias("nb")]
    children = nodes.where("depth > 0").select(*up).groupBy("depth", "na", "nb").agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["depth", "na", "nb"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = save(nodes, "trie-children")
    parent = [(F.col("depth") + 1).alias("depth"), F.col("na").alias("ua"), F.col("nb").alias("ub"), F.col("c").alias("parent_c")]
    # Children number at most all nodes, so at most HEAVY parents have more than 1/HEAVY of them.
    heavy = nodes.where(F.col("n_children") * HEAVY > total).select(*parent)
    key = ["depth", "ua", "ub"]
    tried = nodes.join(F.broadcast(heavy), key, "left")
    light = nodes.where((F.col("n_children") > 0) & (F.col("n_children") * HEAVY <= total)).select(*parent)
    rest = tried.where("parent_c is null").drop("parent_c").join(light, key, "left")
    return tried.where("parent_c is not null").select(*rest.columns).unionByName(rest)


def end_nodes(blocks: DataFrame, ends: DataFrame) -> DataFrame:
    """``(c, depth, na, nb)``: the node at which each conversation ends."""
    node = inner_path(F.col("len"))
    tail = F.struct((F.col("k") * BLOCK + F.col("len")).alias("depth"), *node)
    tails = blocks.groupBy("c").agg(F.max_by(tail, "k").alias("tail")).select("c", "tail.*")
    zero = F.lit(0).cast("long")
    turnless = ends.where("depth = 0").select("c", *[zero.alias(n) for n in ("depth", "na", "nb")])
    return tails.unionByName(turnless)


def end_lists(at: DataFrame) -> DataFrame:
    """``(depth, na, nb, ends_sha256)`` of the nodes ``at(c, depth, na, nb)``."""
    piece = F.shiftright("c", PIECE_BITS)
    # At most 2 ** PIECE_BITS ids to a group, as ids are distinct.
    pieces = at.groupBy("depth", "na", "nb", piece.alias("piece")).agg(F.array_sort(F.collect_list("c")).alias("ids"))
    pieces = pieces.select("depth", "na", "nb", "piece", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"))

    def run(batches):
        key, sha = None, None
        for pdf in batches:
            done = []
            for d, a, b, ids in zip(pdf["depth"], pdf["na"], pdf["nb"], pdf["ids"]):
                if (d, a, b) == key:
                    sha.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, sha.hexdigest()))
                key, sha = (d, a, b), hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=["depth", "na", "nb", "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, sha.hexdigest())], columns=["depth", "na", "nb", "ends_sha256"])

    parts = shuffle_parts(at.sparkSession)
    dealt = pieces.repartition(parts, "depth", "na", "nb").sortWithinPartitions("depth", "na", "nb", "piece")
    return dealt.mapInPandas(run, "depth long, na long, nb long, ends_sha256 string")


def trie(turns: DataFrame, ends: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns(c, p, pos, a, b, words)`` and ``ends(c, depth)``."""
    ends = save(ends, "trie-ends")
    blocks = save(block_rows(turns), "trie-paths")
    nodes = nodes_of(blocks, ends)
    paths = save(member_paths(blocks, nodes.select("c").distinct()), "trie-member-paths")
    nodes = with_parents(nodes)
    nodes = nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
    nodes = save(nodes.withColumn("saved_tokens", (F.col("n") - 1) * F.col("words")), "trie-parents")
    nodes = subtree_sums(nodes, paths, ["n_leaves", "saved_tokens"])
    listed = end_lists(end_nodes(blocks, ends))
    out = nodes.join(listed, ["depth", "na", "nb"], "left")
    return out.select(
        F.col("c").alias("conv_id"),
        "depth",
        F.col("parent_c").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("n_children").cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def op11_block_hash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(*rebuilt(table(spark, sf_dir, "conversations")))


# crc32 of a decimal number is worked out bit by bit (reflected polynomial 0xEDB88320).
SQL = """
WITH RECURSIVE t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), n AS (
  SELECT c, count(*) AS n, c - c % 20 AS base,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda i: 0::BIGINT)),
             lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))) % 4 AS h
  FROM t GROUP BY c
), r AS (
  SELECT n.c, t.pos, t.role, t.text FROM n JOIN t ON t.c = n.base WHERE t.pos <= n.h
  UNION ALL
  SELECT n.c, t.pos - n.h + least(n.h, coalesce(b.n, 0)), t.role, t.text
  FROM n JOIN t ON t.c = n.c LEFT JOIN n b ON b.c = n.base WHERE t.pos > n.h
), path AS (
  SELECT c, pos AS depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
         string_agg(md5(len(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY pos) AS k
  FROM r
  UNION ALL SELECT c, 0, 0, '' FROM n
), node AS (
  SELECT k, depth, min(c) AS c, count(*) AS n, max(words) AS words FROM path GROUP BY k, depth
), last AS (
  SELECT c, arg_max(k, depth) AS k FROM path GROUP BY c
), ended AS (
  SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM last GROUP BY k
), shape AS (
  SELECT a.k, a.c, a.depth, a.n, p.c AS parent, (SELECT count(*) FROM node x WHERE x.depth = a.depth + 1 AND starts_with(x.k, a.k)) AS children
  FROM node a LEFT JOIN node p ON p.k = left(a.k, len(a.k) - 32) AND p.depth = a.depth - 1
)
SELECT s.c AS conv_id, s.depth, s.parent AS parent_conv_id, s.n AS n_convs, s.children AS n_children,
       CAST(sum(CASE WHEN d.children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
       CAST(sum((d.n - 1) * w.words) AS BIGINT) AS saved_tokens,
       coalesce(any_value(e.ends), sha256('')) AS ends_sha256
FROM shape s JOIN shape d ON starts_with(d.k, s.k) JOIN node w ON w.k = d.k LEFT JOIN ended e ON e.k = s.k
GROUP BY s.k, s.c, s.depth, s.parent, s.n, s.children
"""
