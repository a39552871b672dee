r"""Removal of repeated byte strings by longest-previous-factor arrays.

A byte goes if a ``WIDTH``-byte string that covers it also starts earlier: in
a document of smaller doc_id, or earlier in the same one. With LPF[p] the
length of the longest string at p that also starts at an earlier position,
that is every byte within [p, p + WIDTH) for LPF[p] >= WIDTH. LPF follows from
suffix order: the earlier positions that share most with p are the nearest
ones before and after it in that order whose positions are smaller.

One suffix array over a corpus can't be held anywhere, so suffixes are dealt
into blocks such that equal strings of ``WIDTH`` bytes meet in one block:

1. *Anchors.* Each WIDTH-byte window picks the leftmost of its GRAM-byte
   substrings with the least hash. Equal windows pick equal substrings, so
   they agree on the anchor's hash (the key). Successive windows with one
   anchor are one record: its context is the bytes that they cover.
2. *Screen.* Every part of the corpus gives its distinct keys, a row each, with
   the number of their contexts; keys with one context in all are done, as no
   window of theirs can repeat.
3. *Contexts* of the other keys are sent to the key's block, a row each. A
   context that is already in its part is not sent: it is a later copy. A key
   with more than ``HOT`` contexts is dealt on by window: each of its windows
   travels as a context of its own under a key of its own content, one for each
   part at most, so a passage or copy that a third of all documents share is
   spread over all blocks.
4. *Longest previous factors.* A block puts its contexts end to end, in corpus
   order for each key, sorts the suffixes at their window starts by prefix
   doubling, takes the lengths that neighbours share, and reads LPF off the
   previous and next smaller positions. Windows with LPF >= WIDTH go. Equal
   contexts enter the order once: a later copy's factors reach to its end.
5. Removed spans go back to the part that holds the document.

Factors are measured up to WIDTH bytes, the most that the windows of a context
are sure to have. All shuffled rows are keys, contexts or spans, so their
number grows with the text and not with parts times blocks.

Documents are staged once as a table bucketed by part, so the passes over the
text read it in place. The table lies in the run's scratch folder and goes with
it (``Scratch.drop``).

Defined results: a null text is empty; texts shorter than WIDTH stay whole; of
rows with equal doc_ids the one staged first is earlier; null doc_ids come
before all others; columns of any name, also those that this module uses
itself, come back as they were from ``remove_repeats``; an empty table gives no
rows. Texts of any length are read in pieces of ``PIECE`` bytes that overlap by
a window.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import Scratch
from ._bytes import BYTE_CODE, U64, Rolling, flat_text, give_back, groups, mix64

WIDTH = 100
GRAM = 50
HOT = 4096
#: Aim for the text whose contexts one suffix block holds.
BYTES_A_BLOCK = 4 << 20
#: Context bytes that are sorted at once; contexts of one key stay together.
SORT_BYTES = 1 << 20
#: Text that is hashed at once; longer documents are read in overlapping pieces of it.
PIECE = 1 << 18
#: Aim for the text of one part, and the most buckets of the staged table; beyond it a bucket holds several parts.
PART_BYTES = 8 << 20
MAX_BUCKETS = 50_000
_AT = (1 << 26) - 1


# --- suffix order -----------------------------------------------------------

def _ranked(key: np.ndarray) -> np.ndarray:
    """Dense ranks: equal keys have equal ranks, in key order."""
    order = np.argsort(key)
    step = np.empty(len(key), np.int64)
    step[0] = 0
    step[1:] = key[order][1:] != key[order][:-1]
    out = np.empty(len(key), U64)
    out[order] = np.cumsum(step).astype(U64)
    return out


class SuffixRanks:
    """Ranks of all positions by their first 8, 16, 32, ... bytes, by prefix doubling up to ``width``."""

    def __init__(self, text: np.ndarray, width: int):
        self.width = width
        padded = np.concatenate([text, np.zeros(2 * width + 16, np.uint8)])
        n = len(text) + width
        self.words = np.zeros(n, U64)
        for k in range(8):
            self.words = (self.words << U64(8)) | padded[k : k + n].astype(U64)
        self.levels = [(8, _ranked(self.words))]
        while 2 * self.levels[-1][0] <= width:
            have, rank = self.levels[-1]
            low = np.zeros(n, U64)
            low[: n - have] = rank[have:] + U64(1)
            self.levels.append((2 * have, _ranked((rank << U64(32)) | low)))

    def order(self, starts: np.ndarray) -> np.ndarray:
        """The suffix order of ``starts``, ascending: by ``width`` bytes, then by position."""
        have, rank = self.levels[-1]
        return np.argsort((rank[starts] << U64(32)) | rank[starts + self.width - have], kind="stable")

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many first bytes, up to ``width``, two positions share."""
        run = np.zeros(len(a), np.int64)
        for have, rank in reversed(self.levels):
            run += np.where(rank[a + run] == rank[b + run], have, 0)
            run = np.minimum(run, self.width)
        differ = self.words[a + run] ^ self.words[b + run]
        for k in range(1, 9):
            run += differ < (U64(1) << U64(64 - 8 * k))
        return np.minimum(run, self.width)


def _nearest_smaller(value: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each entry, what it shares with the nearest entry before it of a smaller value (0 without one).

    ``common[i]`` is shared by entries i - 1 and i, and what two entries share
    is the least of these between them. All entries look at once: one whose
    candidate is too large goes on to that one's own candidate.
    """
    before, least = np.arange(-1, len(value) - 1), common.copy()
    look = np.flatnonzero(value[before] > value)
    look = look[look > 0]
    while len(look):
        there = before[look]
        least[look] = np.minimum(least[look], least[there])
        before[look] = before[there]
        there = before[look]
        look = look[(there >= 0) & (value[there] > value[look])]
    return np.where(before >= 0, least, 0)


def previous_factors(text: np.ndarray, starts: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """LPF of each of ``starts`` (ascending): the longest string there, up to ``width`` bytes, that starts at an earlier one too."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ranks = SuffixRanks(text, width)
    order = ranks.order(starts)
    common = np.zeros(len(order) + 1, np.int64)
    common[1:-1] = ranks.shared(starts[order[:-1]], starts[order[1:]])
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(_nearest_smaller(order, common[:-1]), _nearest_smaller(order[::-1], common[:0:-1])[::-1])
    return out


# --- anchors ----------------------------------------------------------------

def anchors(buf: np.ndarray, off: np.ndarray, width: int = WIDTH, gram: int = GRAM):
    """(key, first window, windows, context hash) of each run of windows with one anchor."""
    n, span = len(buf), width - gram + 1
    if n < width:
        empty = np.zeros(0, np.int64)
        return empty.astype(U64), empty, empty, empty.astype(U64)
    rolling = Rolling(BYTE_CODE[buf])
    grams = rolling.windows(gram)
    least = (grams & ~U64(_AT)) | np.arange(len(grams), dtype=U64)
    size = 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if span > size:
        least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
    edge = np.zeros(n + 1, np.int32)
    some = np.flatnonzero(np.diff(off) >= width)
    np.add.at(edge, off[some], 1)
    np.add.at(edge, off[some + 1] - width + 1, -1)
    at = np.flatnonzero(np.cumsum(edge[:n]) > 0)
    if not len(at):
        empty = np.zeros(0, np.int64)
        return empty.astype(U64), empty, empty, empty.astype(U64)
    chosen = (least[at] & U64(_AT)).astype(np.int64)
    new = np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1)])
    head = np.flatnonzero(new)
    own = np.diff(np.concatenate([head, [len(at)]]))
    start = at[head]
    # Least hashes are small numbers: mixed again, they deal evenly into blocks.
    return mix64(grams[chosen[head]] + U64(1)), start, own, rolling.spans(start, start + own - 1 + width)


def _stretches(buf: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first document, bytes, offsets, position in that document): short documents together, long ones in overlapping pieces."""
    for a, b in groups(off, PIECE):
        if b - a == 1 and off[b] - off[a] > PIECE:
            for at in range(int(off[a]), int(off[b]) - WIDTH + 1, PIECE):
                to = min(int(off[b]), at + PIECE + WIDTH - 1)
                yield a, buf[at:to], np.array([0, to - at]), at - int(off[a])
        else:
            yield a, buf[off[a] : off[b]], off[a : b + 1] - off[a], 0


# --- the passes -------------------------------------------------------------

def _blocks(key: np.ndarray, blocks: int) -> np.ndarray:
    return (((key >> U64(32)) * U64(blocks)) >> U64(32)).astype(np.int32)


def _key_counts(found: list[np.ndarray], part: int) -> pa.RecordBatch:
    """A row for each key of one part with the number of its contexts."""
    both = np.concatenate(found, axis=1)
    order = np.lexsort((both[1], both[0]))
    key, context = both[0][order], both[1][order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    fresh = new.copy()
    fresh[1:] |= context[1:] != context[:-1]
    at = np.flatnonzero(new)
    kinds = np.add.reduceat(fresh.astype(np.int32), at) if len(at) else np.zeros(0, np.int32)
    times = np.diff(np.append(at, len(key)))
    # One context found twice in a part counts as two: its later copies have to be found.
    n = np.where((kinds == 1) & (times > 1), 2, kinds)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), part, np.int32)), pa.array(key[at].view(np.int64)), pa.array(n.astype(np.int32))], names=["part", "key", "n"])


def _screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, key, n); the rows of a part come one after the other, and only their keys are held."""
    found: list[np.ndarray] = []
    now = None
    for batch in batches:
        part = np.asarray(batch.column("part"))
        buf, off, _ = flat_text(batch.column("text"))
        edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, int)
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(part)], strict=False):
            if found and part[a] != now:
                yield _key_counts(found, now)
                found = []
            now = int(part[a])
            for _, data, cut, _ in _stretches(buf[off[a] : off[b]], off[a : b + 1] - off[a]):
                key, _, _, context = anchors(data, cut)
                found.append(np.stack([key, context]))
    if found:
        yield _key_counts(found, now)


CONTEXTS = "block int, key bigint, doc_key bigint, part int, row int, at int, own int, size int, body binary"
SPANS = "part int, row int, start int, end int"


def _table(schema: str, columns: list) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.Table.from_arrays([c.cast(kinds[k]) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c).cast(kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _lean(table: pa.Table) -> pa.Table:
    """The table, with memory that Arrow holds in reserve given back: workers live on between tasks."""
    give_back()
    return table


def _ordered(docs: pa.Table) -> pa.Table:
    """Rows in the order that decides what is earlier."""
    return docs.take(pc.sort_indices(docs, sort_keys=[("doc_key", "ascending"), ("row", "ascending")]))


def _slices(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The byte strings data[start : start + size]."""
    begin = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    body = data[np.repeat(start - begin[:-1], size) + np.arange(begin[-1])]
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(begin), pa.py_buffer(body)])


def _first(bodies: pa.Array) -> np.ndarray:
    """Whether a string is the first of its kind; strings themselves are compared."""
    if not len(bodies):
        return np.zeros(0, bool)
    seen = np.maximum.accumulate(np.asarray(bodies.dictionary_encode().indices))
    return np.concatenate([[True], seen[1:] > seen[:-1]])


def _contexts(docs: pa.Table, marks: pa.Table, blocks: int) -> pa.Table:
    """The contexts of one part that its blocks have to compare; spans of those that are settled here have no body."""
    docs = _ordered(docs)
    part = docs.column("part")[0].as_py()
    doc_key, row = docs.column("doc_key").to_numpy(), docs.column("row").to_numpy()
    keys = marks.column("key").to_numpy().view(U64)
    order = np.argsort(keys)
    keys, heat = keys[order], np.asarray(marks.column("hot"))[order]
    buf, off, _ = flat_text(docs.column("text"))
    found, bodies, dealt = [], [], []
    for first, data, cut, base in _stretches(buf, off) if len(keys) else ():
        key, start, own, _ = anchors(data, cut)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        some = np.flatnonzero(keys[at] == key)
        key, start, own, hot = key[some], start[some], own[some], heat[at[some]]
        doc = np.searchsorted(cut, start, "right") - 1
        found.append(np.stack([key.view(np.int64), doc + first, start - cut[doc] + base, own, hot]))
        bodies.append(_slices(data, start, own - 1 + WIDTH))
        if hot.any():
            windows = Rolling(BYTE_CODE[data]).windows(WIDTH)
            dealt.append([windows[s : s + o].view(np.int64) for s, o in zip(start[hot].tolist(), own[hot].tolist(), strict=True)])
    if not found:
        return _table(CONTEXTS, [np.zeros(0, np.int64)] * 8 + [pa.array([], pa.binary())])
    key, doc, at, own, hot = np.concatenate(found, axis=1)
    body, hot = pa.concat_arrays(bodies), hot.astype(bool)
    new = _first(body)
    size = own - 1 + WIDTH
    send = new & ~hot
    out = [_table(CONTEXTS, [_blocks(key[send].view(U64), blocks), key[send], doc_key[doc[send]], np.full(send.sum(), part), row[doc[send]], at[send], own[send], size[send], body.filter(pa.array(send))])]
    settled = [np.stack([doc[~new], at[~new], at[~new] + size[~new]])]
    some = np.flatnonzero(new & hot)
    if len(some):
        # The windows of hot keys, each under a key of its own content.
        window = np.concatenate([w for k, w in enumerate(w for of in dealt for w in of) if new[hot][k]])
        of = np.repeat(some, own[some])
        step = np.arange(len(of)) - np.repeat(np.cumsum(own[some]) - own[some], own[some])
        begin, data = np.frombuffer(body.buffers()[1], np.int64)[: len(body) + 1], np.frombuffer(body.buffers()[2], np.uint8)
        single = _slices(data, begin[:-1][of] + step, np.full(len(of), WIDTH))
        new = _first(single)
        settled.append(np.stack([doc[of][~new], (at[of] + step)[~new], (at[of] + step)[~new] + WIDTH]))
        of, step, window = of[new], step[new], window[new]
        ones = np.ones(len(of), np.int64)
        out.append(_table(CONTEXTS, [_blocks(window.view(U64), blocks), window, doc_key[doc[of]], ones * part, row[doc[of]], at[of] + step, ones, ones * WIDTH, single.filter(pa.array(new))]))
    doc, start, end = _merged(np.concatenate(settled, axis=1))
    none = np.zeros(len(doc), np.int64)
    out.append(_table(CONTEXTS, [none + part % blocks, none, none, none + part, row[doc], start, none, end - start, pa.nulls(len(doc), pa.binary())]))
    return _lean(pa.concat_tables(out))


def _merged(spans: np.ndarray) -> np.ndarray:
    """(group, start, end) rows with those of a group that meet made one."""
    group, start, end = spans[:, np.lexsort((spans[1], spans[0]))]
    if not len(group):
        return spans
    # Ends of groups before are below every start of this one.
    far = np.int64(1 << 32) * (np.cumsum(np.concatenate([[0], group[1:] != group[:-1]])))
    reach = np.maximum.accumulate(end + far)
    head = np.flatnonzero(np.concatenate([[True], (start + far)[1:] > reach[:-1]]))
    return np.stack([group[head], start[head], (reach - far)[np.append(head[1:] - 1, len(group) - 1)]])


def _repeats(rows: pa.Table) -> pa.Table:
    """Spans of one block that have an earlier copy."""
    done = np.asarray(rows.column("body").is_null())
    found = [np.stack([rows.column(c).to_numpy()[done].astype(np.int64) for c in ("part", "row", "at", "size")])]
    rows = rows.filter(pa.array(~done))
    rows = rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in ("key", "doc_key", "part", "row", "at")]))
    part, row, at, own, size, key = (rows.column(c).to_numpy().astype(np.int64) for c in ("part", "row", "at", "own", "size", "key"))
    body = rows.column("body").cast(pa.large_binary()).combine_chunks()
    if len(rows):
        new = _first(body)
        # The factors of a later copy reach to the end of its context.
        found.append(np.stack([part, row, at, size])[:, ~new])
        begin, data = np.frombuffer(body.buffers()[1], np.int64)[body.offset : body.offset + len(body)], np.frombuffer(body.buffers()[2], np.uint8)
        part, row, at, own, size, key, begin = (x[new] for x in (part, row, at, own, size, key, begin))
        # A key with one kind of context has no two windows to compare.
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        many = np.repeat(np.diff(np.append(cut, len(key))) > 1, np.diff(np.append(cut, len(key))))
        part, row, at, own, size, key, begin = (x[many] for x in (part, row, at, own, size, key, begin))
        sums = np.concatenate([[0], np.cumsum(size)])
        bounds = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int), len(key))
        low = 0
        while low < len(key):
            high = int(bounds[max(np.searchsorted(bounds, low, "right"), np.searchsorted(sums[bounds], sums[low] + SORT_BYTES, "right") - 1)])
            some = slice(low, high)
            base = sums[some] - sums[low]
            text = data[np.repeat(begin[some] - base, size[some]) + np.arange(size[some].sum())]
            of = np.repeat(np.arange(high - low), own[some])
            step = np.arange(len(of)) - np.repeat(np.cumsum(own[some]) - own[some], own[some])
            hit = previous_factors(text, base[of] + step) >= WIDTH
            of, start, end = _merged(np.stack([of[hit], step[hit], step[hit] + WIDTH]))
            found.append(np.stack([part[some][of], row[some][of], at[some][of] + start, end - start]))
            low = high
    part, row, start, size = np.concatenate(found, axis=1)
    return _lean(_table(SPANS, [part, row, start, start + size]))


def _removals(docs: pa.Table, spans: pa.Table) -> Iterator[tuple[int, bytes, list[tuple[int, int]]]]:
    """(index, text, removed runs) of each row of one part."""
    of, start, end = _merged(np.stack([spans.column(c).to_numpy().astype(np.int64) for c in ("row", "start", "end")]))
    row = docs.column("row").to_numpy()
    low, high = np.searchsorted(of, row, "left"), np.searchsorted(of, row, "right")
    buf, off, _ = flat_text(docs.column("text"))
    for i in range(len(row)):
        yield i, buf[off[i] : off[i + 1]].tobytes(), list(zip(start[low[i] : high[i]].tolist(), end[low[i] : high[i]].tolist(), strict=True))


def _kept(text: bytes, runs: list) -> bytes:
    at, out = 0, []
    for s, e in runs:
        out.append(text[at:s])
        at = e
    return b"".join([*out, text[at:]])


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _report(docs: pa.Table, spans: pa.Table) -> pa.Table:
    cols: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
    for _, text, runs in _removals(docs, spans):
        cols["n_bytes"].append(len(text))
        cols["n_removed"].append(sum(e - s for s, e in runs))
        cols["n_spans"].append(len(runs))
        cols["kept_sha256"].append(hashlib.sha256(_kept(text, runs)).hexdigest())
    return pa.table({"doc_id": docs.column("doc_id"), **{k: pa.array(v, pa.string() if k == "kept_sha256" else pa.int64()) for k, v in cols.items()}})


def _cleaned(docs: pa.Table, spans: pa.Table, fields: list[str]) -> pa.Table:
    texts, keep = [], []
    null = np.asarray(docs.column("text").is_null())
    for i, text, runs in _removals(docs, spans):
        left = _kept(text, runs).decode("utf-8", "ignore") if runs else None
        texts.append(left if runs else None if null[i] else text.decode("utf-8", "replace"))
        keep.append(not runs or bool(left))
    out = docs.select([f"c{k}" for k in range(len(fields))]).rename_columns(fields)
    out = out.set_column(fields.index("text"), "text", pa.array(texts, pa.string()))
    if "n_chars" in fields and pa.types.is_integer(out.schema.field("n_chars").type):
        changed = pa.array([None if t is None else len(t) for t in texts], out.schema.field("n_chars").type)
        out = out.set_column(fields.index("n_chars"), "n_chars", pc.if_else(pc.equal(pc.fill_null(changed, -1), pc.fill_null(out.column("n_chars"), -1)), out.column("n_chars"), changed))
    return out.filter(pa.array(keep))


def _bucket_of(label: np.ndarray, buckets: int) -> np.ndarray:
    """Spark's bucket of an integer: its Murmur3 hash with seed 42, modulo the buckets."""
    turn = lambda x, r: (x << np.uint32(r)) | (x >> np.uint32(32 - r))
    with np.errstate(over="ignore"):
        h = np.uint32(42) ^ (turn(label.astype(np.uint32) * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593))
        h = (turn(h, 13) * np.uint32(5) + np.uint32(0xE6546B64)) ^ np.uint32(4)
        h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(16)
    return h.view(np.int32).astype(np.int64) % buckets


def part_labels(parts: int) -> list[int]:
    """As many labels that fall into different buckets, or fewer if some bucket has none among those tried."""
    _, at = np.unique(_bucket_of(np.arange(parts * (parts.bit_length() + 12)), parts), return_index=True)
    return at.tolist()


def _stage(spark: SparkSession, docs: DataFrame, extra: list[str], scratch: Scratch) -> tuple[DataFrame, int]:
    """The documents as a table bucketed by part, and their bytes.

    A part is a share of one partition of the input, of about ``PART_BYTES``,
    which bounds what a worker holds whatever the input's partitions are like.
    """
    size = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    n = max(1, docs.rdd.getNumPartitions())
    share = max(1, -(-size // (n * PART_BYTES)))
    parts = n * share
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).cast("int")
    staged = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("doc_key"), F.col("text"),
        (F.spark_partition_id() * share + row % share).alias("part"), row.alias("row"), *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(extra)),
    )
    if 1 < parts <= MAX_BUCKETS and len(labels := part_labels(parts)) == parts:
        # One part a bucket: at most MAX_BUCKETS small rows.
        names = spark.createDataFrame(list(enumerate(labels)), "part int, label int")
        staged = staged.join(F.broadcast(names), "part", "left").withColumn("part", F.coalesce("label", "part")).drop("label")
    name = f"statloom_parts_{uuid.uuid4().hex}"
    staged.write.bucketBy(min(parts, MAX_BUCKETS), "part").sortBy("part").option("compression", "zstd").option("path", f"{scratch.path}/{name}").saveAsTable(name)
    scratch.tables.append(name)
    return spark.table(name), size


def _spans(staged: DataFrame, size: int, hot: int) -> DataFrame:
    """(part, row, start, end) of all that goes."""
    blocks = 1 + size // BYTES_A_BLOCK
    keys = staged.select("text", "part").mapInArrow(_screen, "part int, key bigint, n int")
    # A key has a row for each part at most.
    total = F.sum("n").over(Window.partitionBy("key"))
    marks = keys.withColumn("total", total).where("total > 1").select("part", "key", (F.col("total") > hot).alias("hot"))
    text = staged.select("doc_key", "text", "part", "row")
    contexts = text.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(lambda a, b: _contexts(a, b, blocks), CONTEXTS)
    return contexts.groupBy("block").applyInArrow(_repeats, SPANS)


def repeated_bytes(spark: SparkSession, docs: DataFrame, hot: int = HOT, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: its bytes, removed bytes, removed runs and the digest of what is left.

    The rows are written here, so that the staged table can go at once.
    """
    mine = scratch or Scratch(spark)
    staged, size = _stage(spark, docs, [], mine)
    spans = _spans(staged, size, hot)
    found = staged.select("doc_id", "text", "part", "row").groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(_report, RESULT)
    return mine.kept(found, "repeats", drop=scratch is None)


def remove_repeats(spark: SparkSession, docs: DataFrame, hot: int = HOT, scratch: Scratch | None = None) -> DataFrame:
    """The documents without repeated bytes, with the columns they came with.

    A character that a cut splits goes as a whole; n_chars follows the text;
    documents of which nothing is left go. Rows are read from the staged table
    when they are used: pass a ``scratch`` to drop it after that.
    """
    fields = docs.columns
    staged, size = _stage(spark, docs, fields, scratch or Scratch(spark))
    spans = _spans(staged, size, hot)
    rows = staged.select("text", "part", "row", *(f"c{k}" for k in range(len(fields))))
    return rows.groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(lambda a, b: _cleaned(a, b, fields), docs.schema)
