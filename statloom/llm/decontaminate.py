r"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts and benchmark items are lower-cased (A-Z) and reduced to words
`[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`. Every window of ``WINDOW`` consecutive item
words (all words of a shorter item) is a pattern, written as its words between
single spaces. A document is searched in the same form, so an occurrence of
the pattern's bytes is an occurrence of its words.

The search keeps a shift table over hashed blocks of a few bytes of the first m
bytes of the patterns, m being the shortest pattern's length in its class. A
cursor looks up the block that ends at it: a positive shift says how far no
pattern can end its first m bytes, so those positions are skipped; a zero
shift selects the bucket of patterns with that block hash and the same first
eight bytes, and each of them is compared directly. Many cursors, one for each
stretch of a run of documents, move in lock step as one array. Patterns are
held in length classes so that a few short ones do not shorten the shifts of
the rest.

Benchmark tables are read in blocks of at most ``BLOCK_BYTES`` of text, each
block one broadcast of bounded size and one pass over the documents; hits of
all blocks are united before they are counted.

Defined results: null or wordless texts have no words and no hits; wordless or
null items have no window; items with equal item_id count once; items with a
null item_id count as one item, which items_sha256 leaves out; repeated and
null doc_ids are judged one by one; words and texts of any length are searched; an
empty table gives no rows; an empty benchmark leaves every document clean; ``decontaminate`` reads doc_id and text
only and ``drop_contaminated`` gives all columns back, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from ._bytes import LOWER, PLAIN, flat_text, groups, per_doc, word_spans

WINDOW = 10
BLOCK_BYTES = 32 << 20
#: Upper ends of the pattern length classes, in bytes.
CLASSES = (8, 24, 1 << 30)
MOST_HEAD = 1024
HASH_BITS = 22
STRETCH = 512
SEP = 1  # between documents; no pattern has this byte


def plain_words(text: str | None) -> list[bytes]:
    """The words of one text, for small inputs."""
    if not text:
        return []
    raw = np.frombuffer(text.encode(), np.uint8)
    low = LOWER[raw]
    start, end, _ = word_spans(PLAIN[low], np.array([0, len(raw)]))
    data = low.tobytes()
    return [data[a:b] for a, b in zip(start, end, strict=True)]


def patterns_of(items: list[tuple[object, str | None]], window: int = WINDOW) -> dict[bytes, list[int]]:
    """Pattern bytes to the positions of the items that have it."""
    found: dict[bytes, list[int]] = {}
    for k, (_, text) in enumerate(items):
        words = plain_words(text)
        for at in range(max(1, len(words) - window + 1)) if words else ():
            of = found.setdefault(b" " + b" ".join(words[at : at + window]) + b" ", [])
            if not of or of[-1] != k:
                of.append(k)
    return found


class Searcher:
    """Shift and bucket tables of one length class."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        # Heads of at most MOST_HEAD bytes: shifts stay small numbers whatever the words' lengths.
        self.m = min(MOST_HEAD, min(map(len, patterns)))
        # The longer the block, the fewer of the text's blocks are in any pattern.
        self.block = min(self.m, max(3, 2 + (2 * self.m * len(patterns)).bit_length() // 4))
        heads = np.frombuffer(b"".join(p[: self.m] for p in patterns), np.uint8).reshape(-1, self.m)
        self.shift = np.full(1 << HASH_BITS, self.m - self.block + 1, np.int16)
        for end in range(self.block, self.m + 1):
            np.minimum.at(self.shift, self._hash(heads, end - 1, cols=True), np.int16(self.m - end))
        first = np.zeros((len(patterns), 8), np.uint8)
        first[:, : min(8, self.m)] = heads[:, :8]
        key = self._bucket(self._hash(heads, self.m - 1, cols=True), first.view(np.uint64).ravel())
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]

    def _hash(self, data: np.ndarray, at, cols: bool = False) -> np.ndarray:
        out = np.zeros(len(data) if cols else len(at), np.uint32)
        for back in range(self.block):
            out = out * np.uint32(257) + (data[:, at - back] if cols else data[at - back])
        return (out * np.uint32(2654435761)) >> np.uint32(32 - HASH_BITS)

    @staticmethod
    def _bucket(block: np.ndarray, first: np.ndarray) -> np.ndarray:
        return first * np.uint64(0x9E3779B97F4A7C15) + block.astype(np.uint64)

    def candidates(self, data: np.ndarray) -> np.ndarray:
        """Ends of stretches of m bytes whose last block is the last of some pattern's head."""
        n, m = len(data), self.m
        if n < m:
            return np.zeros(0, np.int64)
        at = np.arange(m - 1, n, STRETCH, dtype=np.int64)
        stop = np.minimum(at + STRETCH, n)
        found = []
        while len(at):
            step = self.shift[self._hash(data, at)]
            zero = step == 0
            if zero.any():
                found.append(at[zero])
            at = at + np.maximum(step, 1)
            live = at < stop
            if not live.all():
                at, stop = at[live], stop[live]
        return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def find(self, data: np.ndarray, raw: bytes) -> Iterator[tuple[int, int]]:
        """(start, pattern) of each occurrence."""
        start = self.candidates(data) - (self.m - 1)
        if not len(start):
            return
        first = np.zeros((len(start), 8), np.uint8)
        width = min(8, self.m)
        first[:, :width] = data[start[:, None] + np.arange(width)]
        key = self._bucket(self._hash(data, start + self.m - 1), first.view(np.uint64).ravel())
        low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        for k in np.flatnonzero(high > low):
            s = int(start[k])
            for p in self.order[low[k] : high[k]]:
                pattern = self.patterns[p]
                if raw.startswith(pattern, s):
                    yield s, int(p)


class Matcher:
    """All length classes over one block of items."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.ids = [None if i is None else str(i) for i, _ in items]
        found = patterns_of(items, window)
        self.classes, low = [], 0
        for high in CLASSES:
            chosen = [p for p in found if low < len(p) <= high]
            low = high
            if chosen:
                self.classes.append((Searcher(chosen), [found[p] for p in chosen], np.array([p.count(b" ") - 1 for p in chosen])))

    def spans(self, buf: np.ndarray, off: np.ndarray):
        """(words per document, first word of each document, [(first word, words, items)])."""
        low = LOWER[buf]
        word = PLAIN[low]
        start, _, doc = word_spans(word, off)
        n = len(off) - 1
        count = np.bincount(doc, minlength=n)
        base = np.concatenate([[0], np.cumsum(count)])
        if not len(start) or not self.classes:
            return count, base, []
        # Each word as it is, one space after it, and a separator before each document's first.
        size = len(low)
        keep = word.copy()
        keep[1:] |= word[:-1]
        ends = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < size)]
        text = np.where(word, low, 32).astype(np.uint8)
        # A document that ends in a word runs into the next one: all of these get a gap.
        gaps = np.unique(np.concatenate([ends, off[:1], off[-1:]]))
        body = np.insert(text, np.repeat(gaps, 3), np.tile(np.array([32, SEP, 32], np.uint8), len(gaps)))
        held = np.insert(keep, np.repeat(gaps, 3), True)
        body = body[held]
        # Double spaces come only from the inserted gaps and from runs that begin a document.
        double = np.zeros(len(body), bool)
        double[1:] = (body[1:] == 32) & (body[:-1] == 32)
        body = body[~double]
        begins = np.zeros(len(body), bool)
        begins[1:] = (body[:-1] == 32) & (body[1:] != 32) & (body[1:] != SEP)
        index = np.cumsum(begins) - 1
        raw, found = body.tobytes(), []
        for searcher, owners, words in self.classes:
            for s, p in searcher.find(body, raw):
                found.append((int(index[s + 1]), int(words[p]), owners[p]))
        return count, base, found


_held: dict[tuple, Matcher] = {}


def _matcher(items, window: int) -> Matcher:
    """The tables of one block; a worker builds them once and keeps those of the last block."""
    if not hasattr(items, "value"):
        return Matcher(items, window)
    name, block = items.value
    if (name, window) not in _held:
        _held.clear()
        _held[name, window] = Matcher(block, window)
    return _held[name, window]


def _sent(spark: SparkSession, block):
    """The block for all workers, under a name that no other block has."""
    return spark.sparkContext.broadcast((uuid.uuid4().hex, block))


def _hits(batches: Iterator[pa.RecordBatch], items, window: int) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray, list]]:
    matcher = _matcher(items, window)
    for batch in batches:
        buf, off, _ = flat_text(batch.column("text"))
        for a, b in groups(off):
            count, base, found = matcher.spans(buf[off[a] : off[b]], off[a : b + 1] - off[a])
            yield batch, a, b, count, base, found, matcher.ids


def digest(ids: set[str | None]) -> str:
    return hashlib.sha256(",".join(sorted(i for i in ids if i is not None)).encode()).hexdigest()


def _covered(count: np.ndarray, base: np.ndarray, found: list) -> tuple[np.ndarray, dict[int, set[int]]]:
    """Hit words per document, and the items of each document that has any."""
    total = int(base[-1])
    edge = np.zeros(total + 1, np.int64)
    owners: dict[int, set[int]] = {}
    if found:
        first = np.array([f[0] for f in found])
        np.add.at(edge, first, 1)
        np.add.at(edge, first + np.array([f[1] for f in found]), -1)
        for d, f in zip(np.searchsorted(base, first, "right") - 1, found, strict=True):
            owners.setdefault(int(d), set()).update(f[2])
    return per_doc(np.cumsum(edge)[:total] > 0, base), owners


RESULT = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def _single(batches, items, window):
    none = digest(set())
    for batch, a, b, count, base, found, ids in _hits(batches, items, window):
        hit, owners = _covered(count, base, found)
        n_items, sha = np.zeros(b - a, np.int64), [none] * (b - a)
        for d, of in owners.items():
            names = {ids[k] for k in of}
            n_items[d], sha[d] = len(names), digest(names)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(count.astype(np.int64)), pa.array(hit), pa.array(n_items), pa.array(sha), pa.array(hit > 0)], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def _spans(batches, items, window):
    """One row per document and block: its words, hit spans and items."""
    for batch, a, b, count, base, found, ids in _hits(batches, items, window):
        spans: dict[int, list] = {}
        for first, words, of in found:
            d = int(np.searchsorted(base, first, "right") - 1)
            spans.setdefault(d, []).append((int(first - base[d]), int(words), of))
        starts, ends, names = [], [], []
        for d in range(b - a):
            got = spans.get(d, [])
            starts.append([x for x, _, _ in got])
            ends.append([x + w for x, w, _ in got])
            names.append(list({ids[k] for _, _, of in got for k in of}))
        yield pa.RecordBatch.from_arrays(
            [batch.column("uid").slice(a, b - a), batch.column("doc_id").slice(a, b - a), pa.array(count.astype(np.int64)), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.string()))],
            names=["uid", "doc_id", "n_words", "starts", "ends", "items"],
        )


def _unite(batches):
    none = digest(set())
    for batch in batches:
        rows = {k: [] for k in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")}
        for r in batch.to_pylist():
            covered: set[int] = set()
            for s, e in zip(sum(r["starts"], []), sum(r["ends"], []), strict=True):
                covered.update(range(s, e))
            names = set(sum(r["items"], []))
            for k, v in (("doc_id", r["doc_id"]), ("n_words", r["n_words"]), ("n_hit", len(covered)), ("n_items", len(names)), ("items_sha256", digest(names) if names else none), ("contaminated", bool(covered))):
                rows[k].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(rows["doc_id"], pa.int64()), *(pa.array(rows[k], pa.int64()) for k in ("n_words", "n_hit", "n_items")), pa.array(rows["items_sha256"], pa.string()), pa.array(rows["contaminated"], pa.bool_())], names=list(rows))


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[object, str]]]:
    """The benchmark's items in blocks of bounded size, one block on the driver at a time."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        block.append((r["item_id"], r["text"]))
        size += len(r["text"]) * 4
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: words, hit words, items and verdict."""
    frame = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    blocks = item_blocks(benchmark, block_bytes)
    first, second = next(blocks, None), next(blocks, None)
    if second is None:
        items = [] if first is None else _sent(spark, first)
        return frame.mapInArrow(lambda it: _single(it, items, window), RESULT)
    rows = frame.withColumn("uid", F.monotonically_increasing_id())
    kept = f"{shared_dir(spark)}/blocks"
    schema = "uid bigint, doc_id bigint, n_words bigint, starts array<int>, ends array<int>, items array<string>"
    for block in itertools.chain((first, second), blocks):
        items = _sent(spark, block)
        rows.mapInArrow(lambda it, items=items: _spans(it, items, window), schema).write.mode("append").parquet(kept)
        items.destroy()
    united = spark.read.parquet(kept).groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.collect_list("starts").alias("starts"), F.collect_list("ends").alias("ends"), F.collect_list("items").alias("items"))
    return united.drop("uid").mapInArrow(_unite, RESULT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no window occurs, with the columns they came with."""
    kept = docs
    for block in item_blocks(benchmark, block_bytes):
        items = _sent(spark, block)

        def clean(batches, items=items):
            matcher = _matcher(items, window)
            for batch in batches:
                buf, off, _ = flat_text(batch.column("text"))
                for a, b in groups(off):
                    count, base, found = matcher.spans(buf[off[a] : off[b]], off[a : b + 1] - off[a])
                    good = np.ones(b - a, bool)
                    if found:
                        good[np.searchsorted(base, np.array([f[0] for f in found]), "right") - 1] = False
                    yield batch.slice(a, b - a).filter(pa.array(good))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept
