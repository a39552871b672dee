r"""SimHash near-dedup with a segment-popcount embedding.

A fingerprint bit is set if it is set in over half of the XXH64 hashes (seed
42) of a document's word shingles. Fingerprints at ``RADIUS`` = 2 or fewer
differing bits are linked, and links make components.

Each distinct fingerprint is embedded as the bit counts of its 16 four-bit
segments. One differing bit moves one count by one, so the Manhattan distance
of two embeddings is a lower bound of their Hamming distance. The range join
works on the grid of embeddings: two cells within distance two share a cell
within distance one of both, so each fingerprint is entered in its own cell
and the up to 32 cells beside it, and an equi-join on cells finds exactly the
pairs within the range. Pairs are then verified on their 64 bits.

Cells with more than ``CROWD`` fingerprints do not list their pairs. There
each fingerprint is entered under the bit strings of that cell within one bit
of itself; two fingerprints are within two bits exactly if they share such a
string, so linking all holders of a string to its least holder gives the same
components with rows in proportion to the fingerprints.

Documents with equal fingerprints are one node. Defined results: a text that
is null or has no word has fingerprint zero and links like any other; a text
with fewer words than a shingle has one shingle, its whole word sequence;
rows with a null doc_id keep a null component of their own; repeated doc_ids
are rows of their own; columns other than doc_id and text are ignored, whatever
their names; an empty table gives no rows; texts of any length count whole. The pipeline's near-dedup stage
(``near_copies``) uses the same fingerprints and links on five-word shingles
and verifies pairs on whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch
from ._bytes import LOWER, VISIBLE, flat_text, groups, word_spans
from .components import connected_components

SHINGLE = 3
SEED = 42
SEGMENTS = 16
CROWD = 48
#: Hashes whose bits are counted at once.
BLOCK = 1 << 15


def shingle_hashes(buf: np.ndarray, off: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64, document) of every shingle, in order."""
    low = LOWER[buf]
    visible = VISIBLE[low]
    start, end, doc = word_spans(visible, off)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # Words with one space after each, end to end: a shingle is one slice of it.
    size = end - start
    at = np.concatenate([[0], np.cumsum(size + 1)])
    body = np.full(at[-1], 32, np.uint8)
    body[np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)] = low[visible]
    raw = body.tobytes()
    count = np.bincount(doc, minlength=len(off) - 1)
    base = np.concatenate([[0], np.cumsum(count)])[:-1]
    first = np.ones(len(start), bool)
    first[:] = np.arange(len(start)) - base[doc] <= np.maximum(count[doc] - shingle, 0)
    head = np.flatnonzero(first)
    tail = np.minimum(head + shingle, (base + count)[doc[head]]) - 1
    digest, seed = xxhash.xxh64_intdigest, SEED
    values = [digest(raw[a:b], seed) for a, b in zip(at[head].tolist(), (at[tail] + size[tail]).tolist(), strict=True)]
    return np.array(values, np.uint64), doc[head]


def fingerprints(buf: np.ndarray, off: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    return bit_majorities(*shingle_hashes(buf, off, shingle), len(off) - 1)


def bit_majorities(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """The fingerprint of each of n documents from its hashes, which are in document order."""
    ones, total = np.zeros((n, 64), np.int64), np.bincount(doc, minlength=n)
    for at in range(0, len(values), BLOCK):
        some, of = values[at : at + BLOCK], doc[at : at + BLOCK]
        bits = np.unpackbits(some.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        ones[of[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > total[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def _print_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, off, _ = flat_text(batch.column("text"))
        rest = [batch.column(c) for c in batch.schema.names if c != "text"]
        for a, b in groups(off, 1 << 18):
            prints = fingerprints(buf[off[a] : off[b]], off[a : b + 1] - off[a], shingle)
            yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in rest), pa.array(prints.view(np.int64))], names=[*(c for c in batch.schema.names if c != "text"), "fp"])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the 64 fingerprint bits as a signed integer."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(lambda it: _print_batches(it, shingle), "doc_id bigint, fp bigint")


def _cells(prints: DataFrame) -> DataFrame:
    """(cell, near, fp): own and neighbouring grid cells; near is the bit strings of that cell within one bit.

    A cell's key packs 16 counts of 0..4 as base-5 digits, which fit 38 bits.
    """
    width = 64 // SEGMENTS
    weight = [5**i for i in range(SEGMENTS)]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = np.array(weight, np.int64)
        pop = np.array([bin(x).count("1") for x in range(1 << width)], np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = np.asarray(batch.column("fp").slice(at, 4096)).view(np.uint64)
                seg = np.stack([(fp >> np.uint64(width * i)) & np.uint64((1 << width) - 1) for i in range(SEGMENTS)], axis=1).astype(np.int64)
                own = (pop[seg] * power).sum(axis=1)
                out = [(own, fp)]
                for i in range(SEGMENTS):
                    for step in (-1, 1):
                        ok = np.flatnonzero((pop[seg[:, i]] + step >= 0) & (pop[seg[:, i]] + step <= width))
                        out.append((own[ok] + step * power[i], fp[ok]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([c for c, _ in out])), pa.array(np.concatenate([f for _, f in out]).view(np.int64))], names=["cell", "fp"])

    return prints.select("fp").mapInArrow(cells, "cell bigint, fp bigint")


def _popcount_key(fp: Column) -> Column:
    width = 64 // SEGMENTS
    total = F.lit(0).cast("bigint")
    for i in range(SEGMENTS):
        total = total + F.bit_count(F.shiftrightunsigned(fp, width * i).bitwiseAND(F.lit((1 << width) - 1))).cast("bigint") * F.lit(5**i).cast("bigint")
    return total


def links(spark: SparkSession, prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b): verified links of distinct fingerprints that span the components of the full link graph."""
    cells = _cells(prints)
    held = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    placed = cells.join(held, "cell")
    few = placed.where(F.col("n") <= crowd)
    left, right = few.select("cell", F.col("fp").alias("a")), few.select("cell", F.col("fp").alias("b"))
    pairs = left.join(right, "cell").where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2).select("a", "b").distinct()

    many = placed.where(F.col("n") > crowd).select("cell", "fp")
    bit = F.explode(F.array(F.lit(0).cast("bigint"), *(F.lit(1 << i if i < 63 else -(1 << 63)).cast("bigint") for i in range(64))))
    near = many.select("cell", "fp", bit.alias("bit")).select("cell", "fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("near")).where(_popcount_key(F.col("near")) == F.col("cell"))
    least = near.groupBy("cell", "near").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a != z").select("cell", "near", "a")
    stars = near.join(least, ["cell", "near"]).where("fp != a").select("a", F.col("fp").alias("b")).distinct()
    return pairs.unionByName(stars).distinct()


def components(spark: SparkSession, docs: DataFrame, shingle: int, crowd: int, scratch: Scratch) -> DataFrame:
    """(doc_id, fp, component_id): the least doc_id that links reach."""
    prints = scratch.written(with_fingerprints(docs, shingle), "prints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).where("least IS NOT NULL")
    found = connected_components(spark, links(spark, nodes, crowd), scratch=scratch)
    named = nodes.join(found, nodes.fp == found.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("group"))
    group = named.groupBy("group").agg(F.min("least").alias("component_id"))
    label = named.join(group, "group").select("fp", "component_id")
    return prints.join(label, "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, crowd: int = CROWD) -> DataFrame:
    """(doc_id, fingerprint, component_id) with the fingerprint as 16 lowercase hex digits; written here, so that nothing else is left."""
    scratch = Scratch(spark)
    rows = components(spark, docs, shingle, crowd, scratch)
    return scratch.kept(rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"), "components")
