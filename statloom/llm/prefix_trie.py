r"""The prefix trie of conversations, built level by level.

A conversation is a path of turns (role, text) from the root. At each depth the
live conversations are grouped by (parent node, next turn); a group is a node
and its smallest conv_id names it, as a conversation is in one node of a depth.
A conversation stays live while its node holds another one that differs from
it. When the levels are done, joins from the deepest level up add children,
leaves and saved tokens to the nodes above.

Two things keep the number of rows and of levels small. Conversations that are
equal as wholes take every step together, so they are one class with a weight
and its smallest conv_id walks for all. And below a node with one class there
is nothing left to group: the rest of that class's turns is a chain of nodes,
made in one join for all chains. So there are as many levels as two different
conversations share turns, and a level has a row for each live class.

Turns are compared by SHA-256 of role and text, and whole conversations by the
exclusive or of 128 hashed bits of each (depth, turn), which map-side partial
aggregates make without order. Places of turns come from one sort by ranges,
so a conversation of any length is split over tasks. The digest of a class's
members needs their ids in order: rows sorted by class stream through SHA-256,
and no group is held in memory.

Defined results: a null role or text is empty; turns are in order of turn, nulls
first, and rows of equal turn in order of role, then of the text's digest;
repeated rows are turns of their own; rows without a conv_id belong to no
conversation; the remainder of a negative conv_id has its sign; turns of any
length; other columns are ignored, whatever their names; an empty table gives
no rows, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import Scratch
from . import sql

#: Digest of no members.
NONE = hashlib.sha256(b"").hexdigest()
WORD = r"[^\x20\x09-\x0D]+"
#: Conversations in a block take their first turns from the block's first one, fewer than HEADS of them.
BLOCK, HEADS = 20, 4


def placed_turns(scratch: Scratch, conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, n, digest, words): each turn's place from 0 and its conversation's turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    in_order = rows.orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "digest").withColumn("m", F.monotonically_increasing_id())
    in_order = scratch.written(in_order.select("conv_id", "digest", "words", "m"), "in_order").withColumn("part", F.shiftright("m", 33))
    # One row for each range of the sort.
    sizes = in_order.groupBy("part").agg(F.count("*").alias("rows"))
    before = sizes.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    at = in_order.join(F.broadcast(before), "part").select("conv_id", "digest", "words", (F.col("before") + F.col("m").bitwiseAND(F.lit((1 << 33) - 1))).alias("at"))
    first = at.groupBy("conv_id").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    return at.join(first, "conv_id").select("conv_id", (F.col("at") - F.col("first")).alias("pos"), "n", "digest", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, depth, digest, words), (conv_id, length)) after first turns have come from each block's first conversation."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = turns.where("pos = 0").select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"))
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(lengths, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    lead = turns.where(F.col("pos") < HEADS - 1).select(F.col("conv_id").alias("base"), "pos", "digest", "words")
    heads = convs.join(lead, "base").where("pos < h").select("conv_id", (F.col("pos") + 1).alias("depth"), "digest", "words")
    rest = turns.where(F.col("pos") >= h).join(convs.select("conv_id", "h", "taken"), "conv_id")
    tails = rest.select("conv_id", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "digest", "words")
    return heads.unionByName(tails), convs.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each run of rows of one class: smallest member, length, members, digest of the ids in order."""
    key, held, found = None, None, []

    def done() -> None:
        found.append((held["first"], key[0], held["n"], held["sha"].hexdigest()))

    for batch in batches:
        ids = np.asarray(batch.column("conv_id"))
        cols = [np.asarray(batch.column(c)) for c in ("length", "x", "y")]
        cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1 if len(ids) else []
        for a, b in zip([0, *cut], [*cut, len(ids)], strict=True):
            if a == b:
                continue
            here, text = tuple(int(c[a]) for c in cols), ",".join(map(str, ids[a:b].tolist()))
            if here != key:
                if key is not None:
                    done()
                key, held = here, {"first": int(ids[a]), "n": 0, "sha": hashlib.sha256()}
            else:
                held["sha"].update(b",")
            held["sha"].update(text.encode())
            held["n"] += b - a
        if found:
            yield pa.RecordBatch.from_pylist([dict(zip(("conv_id", "length", "weight", "ends"), r, strict=True)) for r in found], schema=_CLASS)
            found.clear()
    if key is not None:
        done()
        yield pa.RecordBatch.from_pylist([dict(zip(("conv_id", "length", "weight", "ends"), r, strict=True)) for r in found], schema=_CLASS)


_CLASS = pa.schema([("conv_id", pa.int64()), ("length", pa.int64()), ("weight", pa.int64()), ("ends", pa.string())])


def classes(steps: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, length, weight, ends): conversations that are equal as wholes, named by their smallest conv_id."""
    mark: list[Column] = [F.bit_xor(F.xxhash64(F.lit(k), "depth", "digest")).alias(name) for k, name in ((1, "x"), (2, "y"))]
    marked = lengths.join(steps.groupBy("conv_id").agg(*mark), "conv_id", "left").fillna(0, ["x", "y"])
    dealt = marked.repartition("length", "x", "y").sortWithinPartitions("length", "x", "y", "conv_id")
    return dealt.mapInArrow(_members, "conv_id bigint, length bigint, weight bigint, ends string")


LEVEL = "depth bigint, conv_id bigint, parent bigint, n_convs bigint, k bigint, words bigint"


def trie(spark: SparkSession, conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = scratch.written(placed_turns(scratch, conversations), "turns")
    steps, lengths = rebuilt(turns)
    steps = scratch.written(steps, "steps")
    kinds = scratch.written(classes(steps, lengths), "classes")
    # Only the turns that classes walk by; a level's rows lie together in each file.
    walk = scratch.written(steps.join(kinds.select("conv_id"), "conv_id", "left_semi").sortWithinPartitions("depth"), "walk")

    # One row: the root.
    top = kinds.agg(F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.count("*").alias("k")).first()
    levels = [spark.createDataFrame([(0, top["conv_id"], None, top["n_convs"], top["k"], 0)] if top["k"] else [], LEVEL)]
    live = [kinds.select("conv_id", "length", "weight", F.lit(top["conv_id"]).cast("bigint").alias("node"))]
    while not levels[-1].where("k > 1").isEmpty():
        d = len(levels)
        onward = live[-1].where(F.col("length") >= d).join(walk.where(F.col("depth") == d).drop("depth"), "conv_id")
        grouped = onward.groupBy("node", "digest").agg(F.min("conv_id").alias("child"), F.sum("weight").alias("n_convs"), F.count("*").alias("k"), F.min("words").alias("words"))
        grouped = scratch.written(grouped, f"grouped-{d}")
        levels.append(grouped.select(F.lit(d).cast("bigint").alias("depth"), F.col("child").alias("conv_id"), F.col("node").alias("parent"), "n_convs", "k", "words"))
        joined = onward.select("conv_id", "length", "weight", "node", "digest").join(grouped.where("k > 1").select("node", "digest", "child"), ["node", "digest"])
        live.append(scratch.written(joined.select("conv_id", "length", "weight", F.col("child").alias("node")), f"live-{d}"))

    chains = scratch.written(_chains(levels, kinds, walk), "chains")
    made, below = [chains.drop("head")], None
    for d in reversed(range(len(levels))):
        # What ends in a node of this level that others pass through.
        ended = live[d].where(F.col("length") == d).join(kinds.select("conv_id", "ends"), "conv_id").select(F.col("node").alias("conv_id"), "ends") if d < len(live) else None
        here = levels[d].where("k > 1")
        if below is not None:
            here = here.join(below.groupBy("parent_conv_id").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved")), F.col("conv_id") == F.col("parent_conv_id"))
            here = here.join(ended, "conv_id", "left").select(
                "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                ((F.col("n_convs") - 1) * F.col("words") + F.col("saved")).alias("saved_tokens"), F.coalesce("ends", F.lit(NONE)).alias("ends_sha256"),
            )
            made.append(here := scratch.written(here, f"nodes-{d}"))
        heads = chains.where(F.col("head") & (F.col("depth") == d)).drop("head")
        below = heads if len(made) == 1 else heads.unionByName(here)
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return out


def _chains(levels: list[DataFrame], kinds: DataFrame, walk: DataFrame) -> DataFrame:
    """The nodes of one class, from the first of each class (head) to its last turn."""
    heads = levels[0].where("k = 1")
    for level in levels[1:]:
        heads = heads.unionByName(level.where("k = 1"))
    heads = heads.select("conv_id", F.col("depth").alias("top"), "parent").join(kinds, "conv_id")
    # The root is a head only where all conversations are equal; it has no turn of its own.
    root = heads.where("top = 0").select("*", F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("words"))
    rows = heads.join(walk.select("conv_id", "depth", "words"), "conv_id").where("depth >= top").unionByName(root)
    down = Window.partitionBy("conv_id").orderBy(F.col("depth").desc())
    # Only classes of several conversations save anything.
    saved = rows.where("weight > 1").withColumn("saved_tokens", (F.col("weight") - 1) * F.sum("words").over(down)).unionByName(rows.where("weight = 1").withColumn("saved_tokens", F.lit(0).cast("bigint")))
    is_head, last = F.col("depth") == F.col("top"), F.col("depth") == F.col("length")
    return saved.select(
        "conv_id", "depth", F.when(is_head, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"), F.col("weight").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"), "saved_tokens",
        F.when(last, F.col("ends")).otherwise(F.lit(NONE)).alias("ends_sha256"), is_head.alias("head"),
    )


# Every prefix of every rebuilt conversation, spelled out.
ORACLE = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % {BLOCK} AS base, {sql.crc32("CAST(conv_id AS VARCHAR)")} % {HEADS} AS h FROM t),
r AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
s AS (
  SELECT conv_id, row_number() OVER w AS depth, text, string_agg(md5(length(role) || ':' || role || text), '') OVER w AS path
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
m AS (SELECT * FROM s UNION ALL SELECT conv_id, 0, '', '' FROM c),
l AS (SELECT conv_id, max(depth) AS last FROM m GROUP BY conv_id),
n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * len(regexp_extract_all(min(text), '[^\\x20\\x09-\\x0D]+')) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = last), '')) AS ends_sha256
  FROM m JOIN l USING (conv_id) GROUP BY path, depth),
p AS (SELECT n.*, up.conv_id AS parent_conv_id, (SELECT count(*) FROM n x WHERE x.depth = n.depth + 1 AND left(x.path, 32 * n.depth) = n.path) AS n_children
  FROM n LEFT JOIN n up ON up.depth = n.depth - 1 AND up.path = left(n.path, 32 * n.depth - 32))
SELECT conv_id, depth, parent_conv_id, n_convs, n_children,
  (SELECT count(*) FROM p x WHERE x.n_children = 0 AND x.depth >= p.depth AND left(x.path, 32 * p.depth) = p.path) AS n_leaves,
  (SELECT CAST(sum(x.saved) AS BIGINT) FROM p x WHERE x.depth >= p.depth AND left(x.path, 32 * p.depth) = p.path) AS saved_tokens, ends_sha256
FROM p
"""
