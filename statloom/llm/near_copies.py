"""Near copies: every pair of texts whose shingle sets have a Jaccard similarity of ``SIMILARITY`` or more.

Texts are sets of XXH64 hashes of ``SHINGLE``-word shingles; texts of equal sets
are one node. Pairs come from two searches, and every pair is verified before it
links, by the counts of hashes in buckets, whose distance is at most that of the
sets, and if these do not rule it out on whole sets:

1. *SimHash* (``simhash``): fingerprints of the same shingles within its radius,
   found by the grid range join of their segment popcounts.
2. *Prefix filter*, for what lies beyond that radius: at similarity 0.8
   fingerprints differ in some 10 of 64 bits, and no radius holds every pair
   without holding most other pairs as well. Two sets of similarity s share a
   shingle among the first n - ceil(s n) + 1 of each, in any order that both
   follow. So nodes are entered under those shingles only, and nodes of one
   shingle are compared if their sizes and the shingle's places allow it.

The order is by the exact number of nodes that have a shingle, rarest first.
Shingles of one node come before all others and need no entry, so a node whose
text is a fifth its own is entered nowhere, and a passage that many documents
share brings two of them together only where nearly all of their text is as
common as that. Counts are made in shards of hashes: tasks deal packed runs of
shingles to shards, a shard counts and deals those of two nodes or more to
shards of nodes, and these cut the prefixes. Shingles of a thousandth of all
documents or more, as far as a sample shows them, would make a shard hot: they go
to their nodes directly and come last in the order. The sample decides on routes
and on how many pairs are compared, never on which are found.

Nodes of a shingle with more than ``CROWD`` entries are compared with some
``PIVOTS`` of them first, with more in a second round, and with all others
that are still not joined with them in a third.

Defined results: texts that are null or have no word are equal to each other;
a text with fewer words than a shingle has one shingle, its whole word
sequence; an empty table gives no rows; columns keep their names and values,
whatever they are called. One row of a component is kept: least doc_id, null
last, then least MD5 of the text, and of rows that agree in both the least row.
Texts of any length are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch
from ._bytes import flat_text, give_back, groups
from .components import connected_components
from .encode import forget
from .simhash import SEED, bit_majorities, shingle_hashes
from .simhash import links as simhash_links

SHINGLE = 5
SIMILARITY = 0.8
CROWD = 48
#: About so many nodes of a crowded shingle are compared with all others, round by round, before it lists its pairs.
PIVOTS = (4, 64)
#: Sampled documents, and how many of them make a shingle common.
SAMPLE, COMMON = 20_000, 20
#: Shingles that a task deals at once, and shingles of a shard.
FLUSH, SHARD = 2 << 20, 3 << 20
#: The count that stands for a common shingle's.
FAR = (1 << 31) - 1

_PAIR = "a bigint, b bigint"


def digest() -> Column:
    return F.coalesce(F.md5("text"), F.lit(""))


def _sets(value: np.ndarray, doc: np.ndarray, n: int, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct hashes of each of n documents, common ones last; offsets)."""
    late = np.isin(value, common)
    order = np.lexsort((value, late, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[new], np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=n))])


def _documents(batch: pa.RecordBatch, shingle: int, common: np.ndarray, prints: bool = False) -> Iterator[tuple[int, np.ndarray, int]]:
    """(node, set, fingerprint if asked for) of each document, in order."""
    buf, off, _ = flat_text(batch.column("text"))
    for a, b in groups(off, 1 << 18):
        value, doc = shingle_hashes(buf[off[a] : off[b]], off[a : b + 1] - off[a], shingle)
        bits = (bit_majorities(value, doc, b - a) if prints else np.zeros(b - a, np.uint64)).view(np.int64).tolist()
        value, cut = _sets(value, doc, b - a, common)
        for k in range(b - a):
            own = value[cut[k] : cut[k + 1]]
            yield xxhash.xxh64_intdigest(own.tobytes(), SEED) - (1 << 63), own, bits[k]


def _sketch(own: np.ndarray) -> bytes:
    """Counts of the hashes in 2^k buckets, a quarter as many as hashes or more; 255 stands for all above."""
    size = 1 << max(5, min(12, (len(own) // 4).bit_length()))
    return np.minimum(np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size), 255).astype(np.uint8).tobytes()


def _distance(x: np.ndarray, y: np.ndarray) -> int:
    """At most the number of hashes that only one of the two sets has."""
    size = min(len(x), len(y))
    x, y = (z.reshape(-1, size).sum(axis=0, dtype=np.int64) for z in (x, y))
    return int(np.abs(x - y).sum())


def _common(docs: DataFrame, shingle: int) -> np.ndarray:
    share = SAMPLE / max(docs.count(), SAMPLE)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, own, _ in _documents(batch, shingle, np.zeros(0, np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64))], names=["shingle"])

    some = docs.select("text", F.xxhash64("doc_id", "text").alias("h")).where((F.shiftrightunsigned("h", 33) / F.lit(float(1 << 31))) < share).select("text")
    found = some.mapInArrow(hashes, "shingle bigint").groupBy("shingle").count().where(F.col("count") >= COMMON).select("shingle").toArrow()
    return np.sort(np.asarray(found["shingle"].combine_chunks()).view(np.uint64)) if found.num_rows else np.zeros(0, np.uint64)


def _prints(docs: DataFrame, shingle: int, common: np.ndarray) -> DataFrame:
    """(doc_id, digest, node, fp, n, sketch); the last is null where the task has had the node already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        forget()
        for batch in batches:
            node, fp, n, sketch = [], [], [], []
            for name, own, bits in _documents(batch, shingle, common, prints=True):
                node.append(name)
                fp.append(bits)
                n.append(len(own))
                sketch.append(None if name in seen else _sketch(own))
                seen.add(name)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(node, pa.int64()), pa.array(fp, pa.int64()), pa.array(n, pa.int64()), pa.array(sketch, pa.binary())], names=["doc_id", "digest", "node", "fp", "n", "sketch"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest().alias("digest"), "text")
    return rows.mapInArrow(run, "doc_id bigint, digest string, node bigint, fp bigint, n bigint, sketch binary")


# --- prefixes by exact counts -------------------------------------------------------

RUNS = "stage int, shard int, nodes int, data binary"
_RUNS = (pa.int32(), pa.int32(), pa.int32(), pa.binary())


def _place(key: np.ndarray, shards: int) -> np.ndarray:
    return (((key >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def _packed(stage: int, shard: np.ndarray, node: np.ndarray, size: np.ndarray, value: np.ndarray, df: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of RUNS from rows of (shard, node, set size, shingle, count) in order of shard and node: nodes, sizes, run lengths, shingles, counts."""
    if not len(value):
        return
    new_shard = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
    for a, b in zip(new_shard.tolist(), [*new_shard[1:].tolist(), len(shard)], strict=True):
        own = node[a:b]
        cut = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        runs = np.diff(np.append(cut, b - a))
        data = own[cut].astype("<i8").tobytes() + size[a:b][cut].astype("<u4").tobytes() + runs.astype("<u4").tobytes() + value[a:b].astype("<u8").tobytes() + (df[a:b].astype("<u4").tobytes() if stage else b"")
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((stage, int(shard[a]), len(cut), data), _RUNS, strict=True)], names=[c.split()[0] for c in RUNS.split(", ")])


def _unpacked(table: pa.Table, stage: int) -> list[np.ndarray]:
    """(node, set size, shingle[, count]) of all rows, end to end."""
    parts: list[list[np.ndarray]] = [[], [], [], []]
    for k, data in zip(table.column("nodes").to_pylist(), table.column("data"), strict=True):
        raw = np.frombuffer(data.as_buffer(), np.uint8)
        runs = raw[12 * k : 16 * k].view("<u4")
        m, at = int(runs.sum()), 16 * k
        parts[0].append(np.repeat(raw[: 8 * k].view("<i8"), runs))
        parts[1].append(np.repeat(raw[8 * k : 12 * k].view("<u4"), runs))
        parts[2].append(raw[at : at + 8 * m].view("<u8"))
        if stage:
            parts[3].append(raw[at + 8 * m :].view("<u4"))
    return [np.concatenate(p) for p in parts[: 3 + stage]]


def _dealt(batches: Iterator[pa.RecordBatch], shingle: int, common: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """Each node's shingles, once a task: common ones for the nodes' shards, all others for the shingles' shards."""
    seen: set[int] = set()
    nodes: list[int] = []
    sets: list[np.ndarray] = []

    def out() -> Iterator[pa.RecordBatch]:
        if not sets:
            return
        size = np.array([len(x) for x in sets], np.int64)
        value, at = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
        node, late = np.array(nodes, np.int64), np.isin(value, common)
        for stage, some in ((0, ~late), (1, late)):
            v, k = value[some], at[some]
            shard = _place(v if stage == 0 else node.view(np.uint64)[k], shards)
            order = np.lexsort((k, shard))
            yield from _packed(stage, shard[order], node[k[order]], size[k[order]], v[order], np.full(len(v), FAR))
        nodes.clear()
        sets.clear()

    held = 0
    for batch in batches:
        for name, own, _ in _documents(batch, shingle, common):
            if name not in seen and len(own):
                seen.add(name)
                nodes.append(name)
                sets.append(own)
                held += len(own)
            if held > FLUSH:
                yield from out()
                held = 0
    yield from out()
    give_back()


def _counted(table: pa.Table, shards: int) -> pa.Table:
    """The shingles of one shard that two nodes or more have, with their counts, dealt by node."""
    node, size, value = _unpacked(table, 0)
    order = np.lexsort((node, value))
    node, size, value = node[order], size[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (node[1:] != node[:-1])  # a node that several tasks have sent
    node, size, value = node[new], size[new], value[new]
    cut = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    df = np.repeat(runs := np.diff(np.append(cut, len(value))), runs)
    some = df > 1
    node, size, value, df = node[some], size[some], value[some], df[some]
    shard = _place(node.view(np.uint64), shards)
    order = np.lexsort((node, shard))
    rows = list(_packed(1, shard[order], node[order], size[order], value[order], df[order]))
    give_back()
    return pa.Table.from_batches(rows) if rows else pa.table({c.split()[0]: pa.array([], t) for c, t in zip(RUNS.split(", "), _RUNS, strict=True)})


def _cut(table: pa.Table, share: Fraction) -> pa.Table:
    """(shingle, node, n, pos) of the prefixes of one shard's nodes, without shingles of one node."""
    node, size, value, df = _unpacked(table, 1)
    order = np.lexsort((value, df, node))
    node, size, value, df = node[order], size[order].astype(np.int64), value[order], df[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (node[1:] != node[:-1])
    node, size, value = node[new], size[new], value[new]
    cut = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.zeros(0, np.int64)
    runs = np.diff(np.append(cut, len(node)))
    # Shingles of one node alone come before all others.
    pos = np.arange(len(node)) - np.repeat(cut, runs) + size - np.repeat(runs, runs)
    kept = pos <= size + (-size * share.numerator // share.denominator)
    return pa.table({"shingle": value[kept].view(np.int64), "node": node[kept], "n": size[kept], "pos": pos[kept]})


def _entries(scratch: Scratch, docs: DataFrame, shingle: int, share: Fraction, common: np.ndarray, shingles: int, shard: int) -> DataFrame:
    """(shingle, node, n, pos) of all nodes' prefixes, in the order of exact counts."""
    shards = max(1, -(-shingles // shard))
    dealt = docs.select("text").mapInArrow(lambda it: _dealt(it, shingle, common, shards), RUNS)
    # Common shingles pass through: they are dealt by node already.
    counted = dealt.groupBy("stage", "shard").applyInArrow(lambda t: t if t.column("stage")[0].as_py() else _counted(t, shards), RUNS)
    counted = scratch.written(counted, "counted")
    return counted.groupBy("shard").applyInArrow(lambda t: _cut(t, share), "shingle bigint, node bigint, n bigint, pos bigint")


def _verified(scratch: Scratch, pairs: DataFrame, prints: DataFrame, docs: DataFrame, shingle: int, share: Fraction, common: np.ndarray, name: str) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    pairs = scratch.written(pairs, f"{name}_pairs")
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sketches = prints.where("sketch IS NOT NULL").select("node", "n", "sketch").join(ends, "node", "left_semi").groupBy("node").agg(F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    sketches = scratch.written(sketches, f"{name}_sketches")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(batch.column("n")) + np.asarray(batch.column("m"))
            gap = [_distance(np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)) for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
            # |A ^ B| <= (|A| + |B|) (1 - s) / (1 + s)
            keep = pa.array(np.array(gap, np.int64) * (share.denominator + share.numerator) <= size * (share.denominator - share.numerator))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    both = pairs.join(sketches.select(F.col("node").alias("a"), "n", F.col("sketch").alias("x")), "a").join(sketches.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y")), "b")
    pairs = scratch.written(both.mapInArrow(near, _PAIR), f"{name}_near")
    used = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = prints.join(used, "node", "left_semi").groupBy("node").agg(F.min("digest").alias("digest")).select("digest")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for node, own, _ in _documents(batch, shingle, common):
                if node not in seen:
                    seen.add(node)
                    yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([np.sort(own).tobytes()], pa.binary())], names=["node", "own"])

    held = docs.select("text", digest().alias("digest")).join(texts, "digest", "left_semi").select("text").mapInArrow(sets, "node bigint, own binary")
    held = scratch.written(held.groupBy("node").agg(F.first("own").alias("own")), f"{name}_sets")
    both = pairs.join(held.select(F.col("node").alias("a"), F.col("own").alias("x")), "a").join(held.select(F.col("node").alias("b"), F.col("own").alias("y")), "b")

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                shared = int((x[at] == y).sum())
                ok.append(shared * share.denominator >= (len(x) + len(y) - shared) * share.numerator)
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return scratch.written(both.mapInArrow(similar, _PAIR), f"{name}_links")


def _labels(scratch: Scratch, links: DataFrame, name: str) -> DataFrame:
    return scratch.written(connected_components(scratch.spark, links, scratch=scratch), f"{name}_labels")


def _close(spark: SparkSession, prints: DataFrame, crowd: int) -> DataFrame:
    """Pairs (a, b) of nodes whose fingerprints are linked, spanning: the least nodes of two fingerprints, and of one fingerprint with its others."""
    nodes = prints.where("n > 0").select("fp", "node").distinct()
    least = nodes.groupBy("fp").agg(F.min("node").alias("least"))
    linked = simhash_links(spark, least.select("fp"), crowd)
    of = lambda c: least.select(F.col("fp").alias(c), F.col("least").alias(f"{c}_node"))
    apart = linked.join(of("a"), "a").join(of("b"), "b").select("a_node", "b_node")
    same = nodes.join(least, "fp").where("node != least").select("least", "node")
    return apart.unionByName(same.toDF("a_node", "b_node")).select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).where("a != b").distinct()


def components(spark: SparkSession, docs: DataFrame, shingle: int, similarity: float, crowd: int, scratch: Scratch, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(prints of all rows, (node, component) of the nodes that have a link)."""
    share = Fraction(str(similarity))
    common = _common(docs, shingle)
    prints = scratch.written(_prints(docs, shingle, common), "prints")
    verified = lambda pairs, name: _verified(scratch, pairs.distinct(), prints, docs, shingle, share, common, name)
    total = prints.agg(F.sum("n")).first()[0] or 0
    placed = scratch.written(_shared(_entries(scratch, docs, shingle, share, common, total, shard)), "placed").withColumn("group", F.col("node"))
    few, many = placed.where(F.col("size") <= crowd), placed.where(F.col("size") > crowd).drop("group")
    links = verified(_close(spark, prints, crowd).unionByName(_joined(few, few, share)), "few")
    label = _labels(scratch, links, "few")
    for k, pivots in enumerate((*PIVOTS, None)):
        left = scratch.written(_open(many, label), f"left{k}")
        if left.isEmpty():
            break
        some = left if pivots is None else left.where(F.pmod(F.xxhash64("node"), "size") < pivots)
        links = links.unionByName(verified(_joined(left, some, share), f"again{k}"))
        label = _labels(scratch, links, f"again{k}")
    return prints, label


def _shared(rows: DataFrame) -> DataFrame:
    """(shingle, node, n, pos, size) of entries under shingles of more than one node."""
    held = rows.groupBy("shingle").agg(F.count("*").alias("size"), F.min("node").alias("least"), F.max("node").alias("most"), F.bit_xor(F.xxhash64("node")).alias("mix"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("mix2"), F.sum("pos").alias("at")).where("size > 1")
    # Shingles of the same nodes give the same pairs: the one that comes first in all of them is enough.
    held = held.groupBy("size", "least", "most", "mix", "mix2").agg(F.min(F.struct("at", "shingle")).alias("first")).select("first.shingle", "size")
    return rows.join(held, "shingle").select("shingle", "node", "n", "pos", "size")


def _grouped(placed: DataFrame, label: DataFrame) -> DataFrame:
    return placed.join(label, "node", "left").withColumn("group", F.coalesce("component", "node")).drop("component")


def _open(placed: DataFrame, label: DataFrame) -> DataFrame:
    """The entries, with their groups, under shingles whose nodes are not all joined."""
    named = _grouped(placed, label)
    return named.join(named.groupBy("shingle").agg(F.min("group").alias("g"), F.max("group").alias("z")).where("g != z").select("shingle"), "shingle")


def _joined(left: DataFrame, right: DataFrame, share: Fraction) -> DataFrame:
    """Pairs (a, b) of entries under one shingle that are not joined and that their sizes and places do not rule out."""
    other = right.select("shingle", F.col("node").alias("node_"), F.col("n").alias("m"), F.col("pos").alias("at"), F.col("group").alias("group_"))
    fits = (F.col("n") * share.numerator <= F.col("m") * share.denominator) & (F.col("m") * share.numerator <= F.col("n") * share.denominator)
    # Two sets share nothing before the first shingle that they share, and at most what comes after it.
    most = F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("at"))
    fits &= most * (share.numerator + share.denominator) >= (F.col("n") + F.col("m")) * share.numerator
    return left.join(other, "shingle").where("group != group_").where(fits).select(F.least("node", "node_").alias("a"), F.greatest("node", "node_").alias("b")).distinct()


def keep_first(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, crowd: int = CROWD, scratch: Scratch | None = None, shard: int = SHARD) -> DataFrame:
    """One row of each component. What was written on the way is read when the rows are used: pass a ``scratch`` to drop it after that."""
    prints, label = components(spark, docs, shingle, similarity, crowd, scratch or Scratch(spark), shard)
    named = prints.join(label, "node", "left").select("doc_id", "digest", F.coalesce("component", "node").alias("group"))
    chosen = named.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "digest")).alias("row")).select(F.col("row.doc_id").alias("id_"), F.col("row.digest").alias("digest_"))
    copies = prints.groupBy("doc_id", "digest").count().where("count > 1").select(F.col("doc_id").alias("id_"), F.col("digest").alias("digest_"))
    same = lambda rows: docs.doc_id.cast("bigint").eqNullSafe(rows.id_) & (digest() == rows.digest_)
    first = docs.join(chosen, same(chosen), "left_semi")
    if copies.isEmpty():
        return first
    fold = first.join(copies, same(copies), "left_semi").groupBy("doc_id", digest().alias("digest_")).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return first.join(copies, same(copies), "left_anti").unionByName(fold)
