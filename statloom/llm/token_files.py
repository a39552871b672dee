r"""Flat token-id files with 64-bit document offsets.

Format. A folder holds ``tokens/shard=K/`` with one file of little-endian
unsigned ids (16 bits each if the vocabulary allows, else 32), every document
followed by the end id; ``offsets/shard=K/`` with one file of little-endian
64-bit numbers, the global position at which each document starts; and
``index``, a Parquet table of (shard, pos, doc_id). Shards follow each other in
ascending doc_id order and so do the documents in a shard (nulls first, equal
doc_ids in no fixed order). Both kinds of flat file are read memory-mapped
(``read_back``, ``document``).

Writing. Each text is encoded once. Documents are sorted by ranges, token counts
are summed within ranges on top of the sums of the ranges before, and a shard
takes the documents that start in its share of the positions. So shards are cut
by size, also between rows of one doc_id, and only a document that is itself
longer than a shard makes a longer one. Shards have about ``SHARD_TOKENS`` ids,
and more where there would be more than ``MOST_SHARDS``, as the first row of each
is what the tasks are told (at 100 TB of text that is some 250 million ids, 0.5
GB, a shard). The bytes are written by Spark's text writer: the end id is the
line separator, and so is the always-zero top byte of an offset. So any file
system that Spark knows can hold the files, and lost or repeated tasks are
settled by the commit protocol.

Reading. Rows of the index are dealt over tasks as they come; each task maps the
files of the shards that it meets and takes its documents from there, so no
content is shuffled and a large shard is read by many tasks. Where the folder is
not on a file system that the machines mount, whole files are read by Spark
instead, a shard in one row.

Defined results: a null or empty text is its end id alone; columns other than
doc_id and text are ignored, whatever their names; an empty table gives a folder
without shards and no rows; texts of any length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import delete, shuffles_dropped
from ._bytes import flat_text
from .encode import encoded_groups, encoder

SHARD_TOKENS = 4 << 20
#: Shards are written in this many rounds, which divides the shuffle files that exist at once.
ROUNDS = 2
MOST_SHARDS = 100_000
ENCODED = "doc_key bigint, doc_id bigint, uid bigint, n bigint, ids binary"
INDEX = "shard int, pos bigint, doc_id bigint, start bigint"


def _encode(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    width = encoder(path).width
    kind = "<u2" if width == 2 else "<u4"
    for batch in batches:
        buf, off, _ = flat_text(batch.column("text"))
        for a, b, ids, begin in encoded_groups(path, buf, off, end_id):
            raw = ids.astype(kind).tobytes()
            # The end id is left to the writer.
            body = [raw[s * width : (e - 1) * width] for s, e in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in ("doc_key", "doc_id", "uid")), pa.array(np.diff(begin)), pa.array(body, pa.binary())], names=["doc_key", "doc_id", "uid", "n", "ids"])


def _dealt(batches: Iterator[pa.RecordBatch], first: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(shard, doc_key, uid, ids): the last shard whose first (doc_key, uid) is not after the row's."""
    for batch in batches:
        key, uid = np.asarray(batch.column("doc_key")), np.asarray(batch.column("uid"))
        low, high = np.searchsorted(first[0], key, "left"), np.searchsorted(first[0], key, "right")
        shard = low - 1
        for k in np.flatnonzero(high > low):
            shard[k] = low[k] - 1 + np.searchsorted(first[1][low[k] : high[k]], uid[k], "right")
        yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), *(batch.column(c) for c in ("doc_key", "uid", "ids"))], names=["shard", "doc_key", "uid", "ids"])


def _separator(value: int, width: int) -> str:
    """The end id as the writer's line separator, in Latin-1."""
    return value.to_bytes(width, "little").decode("latin-1")


def write_tokens(spark: SparkSession, docs: DataFrame, path: str, end_id: int, folder: str, shard_tokens: int = SHARD_TOKENS) -> dict:
    """Encodes the documents and writes the format; returns its folder, width and end id."""
    id_ = F.col("doc_id").cast("bigint")
    rows = docs.select(F.coalesce(id_, F.lit(-(1 << 63))).alias("doc_key"), id_.alias("doc_id"), F.monotonically_increasing_id().alias("uid"), "text")
    width = encoder(path).width
    rows.mapInArrow(lambda it: _encode(it, path, end_id), ENCODED).write.options(compression="zstd", **{"parquet.compression.codec.zstd.level": "6"}).parquet(f"{folder}/encoded")
    encoded = spark.read.schema(ENCODED).parquet(f"{folder}/encoded")

    with shuffles_dropped(spark):
        # Sorted once and written, as a second sort might deal its ranges otherwise.
        encoded.drop("ids").orderBy("doc_key", "uid").withColumn("m", F.monotonically_increasing_id()).write.parquet(f"{folder}/sorted")
        placed = spark.read.parquet(f"{folder}/sorted").withColumn("part", F.shiftright("m", 33))
        # One row for each range.
        totals = placed.groupBy("part").agg(F.sum("n").alias("total"))
        base = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
        before = F.sum("n").over(Window.partitionBy("part").orderBy("m").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
        every = totals.agg(F.sum("total")).first()[0] or 0
        each = max(shard_tokens, -(-every // MOST_SHARDS))
        placed = placed.withColumn("before", before).join(F.broadcast(base), "part").withColumn("start", F.col("base") + F.col("before"))
        placed.select((F.col("start") / each).cast("int").alias("shard"), "doc_key", "uid", "doc_id", "start").write.parquet(f"{folder}/starts")
        starts = spark.read.schema("shard int, doc_key bigint, uid bigint, doc_id bigint, start bigint").parquet(f"{folder}/starts")
        # Shards that begin inside a long document have no rows; the others are numbered as they come. At most MOST_SHARDS rows.
        shards = sorted((r["f"]["doc_key"], r["f"]["uid"]) for r in starts.groupBy("shard").agg(F.min(F.struct("doc_key", "uid")).alias("f")).collect())
        first = np.array(shards, np.int64).reshape(-1, 2).T.copy()

        flat = {"encoding": "ISO-8859-1"}
        dealt = encoded.select("doc_key", "uid", "ids").mapInArrow(lambda it: _dealt(it, first), "shard int, doc_key bigint, uid bigint, ids binary")
        for r in range(ROUNDS):
            by_shard = dealt.where(F.col("shard") % ROUNDS == r).repartition(max(1, (len(shards) + ROUNDS - 1) // ROUNDS), "shard").sortWithinPartitions("shard", "doc_key", "uid")
            by_shard.select(F.col("ids").cast("string").alias("value"), "shard").write.mode("append").partitionBy("shard").options(**flat, lineSep=_separator(end_id, width)).text(f"{folder}/tokens")

        numbered = starts.withColumn("ids", F.lit(None).cast("binary")).select("doc_key", "uid", "ids").mapInArrow(lambda it: _dealt(it, first), "shard int, doc_key bigint, uid bigint, ids binary").select("shard", "uid")
        index = starts.drop("shard").join(numbered, "uid")
        along = Window.partitionBy("shard").orderBy("start")
        index.select("shard", (F.row_number().over(along) - 1).cast("bigint").alias("pos"), "doc_id", "start").write.parquet(f"{folder}/index")
        index = spark.read.schema(INDEX).parquet(f"{folder}/index")
        hexed = F.lpad(F.hex("start"), 16, "0")
        low = F.unhex(F.concat(*(F.substring(hexed, 15 - 2 * k, 2) for k in range(7))))
        index.repartition(max(1, len(shards)), "shard").sortWithinPartitions("shard", "pos").select(low.cast("string").alias("value"), "shard").write.partitionBy("shard").options(**flat, lineSep="\0").text(f"{folder}/offsets")
    for made in ("encoded", "sorted", "starts"):
        delete(spark, f"{folder}/{made}")
    return {"folder": folder, "width": width, "end_id": end_id, "shards": len(shards)}


def document(ids: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """The ids of the k-th document of a shard, with its end id."""
    end = int(offsets[k + 1]) if k + 1 < len(offsets) else int(offsets[0]) + len(ids)
    return ids[int(offsets[k]) - int(offsets[0]) : end - int(offsets[0])]


def mapped(tokens_file: str, offsets_file: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of one shard, memory-mapped."""
    return np.memmap(tokens_file, f"<u{width}", "r"), np.memmap(offsets_file, "<i8", "r")


READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _facts(doc_id: pa.Array, pos: np.ndarray, ids: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    found = [document(ids, offsets, k) for k in pos.tolist()]
    return pa.RecordBatch.from_arrays([doc_id, pa.array(np.asarray(offsets[pos], np.int64)), pa.array([len(x) for x in found], pa.int64()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64())], names=[c.split()[0] for c in READ.split(", ")])


def _read_mapped(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shard, pos = np.asarray(batch.column("shard")), np.asarray(batch.column("pos"))
        order = np.argsort(shard, kind="stable")
        cut = np.flatnonzero(np.concatenate([[True], np.diff(shard[order]) != 0])) if len(order) else np.zeros(0, int)
        for a, b in zip(cut, np.append(cut[1:], len(order)), strict=True):
            some = order[a:b]
            files = mapped(batch.column("tokens")[some[0]].as_py(), batch.column("offsets")[some[0]].as_py(), width)
            yield _facts(batch.column("doc_id").take(pa.array(some)), pos[some], *files)


def _read_whole(files: pa.Table, index: pa.Table, width: int) -> pa.Table:
    ids, offsets = np.frombuffer(files.column("ids")[0].as_buffer(), f"<u{width}"), np.frombuffer(files.column("starts")[0].as_buffer(), "<i8")
    return pa.Table.from_batches([_facts(index.column("doc_id").combine_chunks(), index.column("pos").to_numpy(), ids, offsets)])


def _files(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/{kind}")
    return read.where("length > 0").select(F.regexp_extract("path", r"shard=(\d+)", 1).cast("int").alias("shard"), F.col("path").alias(kind), F.col("content").alias({"tokens": "ids", "offsets": "starts"}[kind]))


def read_back(spark: SparkSession, made: dict, mounted: bool | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``mounted`` says whether the machines can open the folder's files; by
    default its address decides.
    """
    folder, width = made["folder"], made["width"]
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    if index.isEmpty():
        return spark.createDataFrame([], READ)
    tokens, offsets = _files(spark, folder, "tokens"), _files(spark, folder, "offsets")
    if folder.startswith(("file:", "/")) if mounted is None else mounted:
        local = lambda c: F.regexp_replace(c, "^file:/*", "/")
        # Addresses only, one row for each shard.
        files = tokens.select("shard", local("tokens").alias("tokens")).join(offsets.select("shard", local("offsets").alias("offsets")), "shard")
        rows = index.select("shard", "pos", "doc_id").join(F.broadcast(files), "shard")
        return rows.mapInArrow(lambda it: _read_mapped(it, width), READ)
    files = tokens.select("shard", "ids").join(offsets.select("shard", "starts"), "shard")
    return files.groupBy("shard").cogroup(index.select("shard", "pos", "doc_id").groupBy("shard")).applyInArrow(lambda a, b: _read_whole(a, b, width), READ)
