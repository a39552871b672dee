r"""Pattern packing by non-negative least squares.

Documents become token ids plus an end id; those over ``LENGTH`` ids are cut
into pieces. Packing works on the histogram of piece lengths, which has at
most ``LENGTH`` entries at any input size, so the plan is made on the driver
and is bounded; only its application to rows is distributed.

1. Lengths are rounded to the nearest of ``UNITS`` equal steps, and all
   patterns of at most ``PARTS`` such lengths that fill a sequence are
   enumerated. Lengths that round to nothing are left as fillers.
2. Non-negative least squares (active sets, so no more patterns are in use than
   there are steps) fits repeat counts of patterns to the rounded histogram;
   counts are rounded down.
3. Each use of a pattern takes pieces of its rounded lengths such that rounding
   errors cancel out: all parts but two are the lengths nearest to the running
   sum that the pattern aims at, and the last two are the pair that leaves the
   least room. A pattern is used as often as asked for and as pieces last.
4. Residual pieces, longest first, go to the fullest sequence with room for
   them (best fit), whole classes of equal sequences at a time, and then to new
   sequences.

A plan is a list of (number of equal sequences, lengths in them). The piece of
rank r among pieces of its length takes the r-th place for that length. Ranks
are counted within salted groups on top of the sums of the groups before; a
length has groups in proportion to its pieces, so a length that a third of all
pieces share is not ranked in one task at any size.

Defined results: a null or empty text is one piece of its end id; rows with
equal or null doc_ids are packed like others; columns other than doc_id and
text are ignored, whatever their names; an empty table gives no rows; a text of
any length is encoded whole and cut into pieces.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._bytes import flat_text
from ..session import Scratch
from .encode import encoded_groups, encoder

LENGTH = 4096
UNITS = 32
PARTS = 12
#: Pieces of one group in which ranks are counted: so many, or more where that would make more than ``GROUPS`` groups.
RANKED = 256
GROUPS = 65_536


def enumerate_patterns(units: int, parts: int) -> list[tuple[int, ...]]:
    """Non-increasing tuples of at most ``parts`` positive numbers that sum to ``units``."""
    out: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], left: int, most: int) -> None:
        if left == 0:
            out.append(head)
            return
        if len(head) == parts:
            return
        for k in range(min(left, most), 0, -1):
            if k * (parts - len(head)) < left:
                break
            grow((*head, k), left - k, k)

    grow((), units, units)
    return out


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with least |ax - b|, by active sets: at most as many positive entries as rows."""
    x, used = np.zeros(a.shape[1]), []
    for _ in range(3 * max(a.shape)):
        slope = a.T @ (b - a[:, used] @ x[used])
        slope[used] = -np.inf
        new = int(slope.argmax())
        if slope[new] <= 1e-9 * max(1.0, float(np.abs(b).max())):
            break
        used.append(new)
        while True:
            best = np.linalg.lstsq(a[:, used], b, rcond=None)[0]
            if best.min() > 0:
                break
            # As far towards it as all entries stay positive; those that reach zero leave.
            old = x[used]
            share = np.divide(old, np.maximum(old - best, 1e-300), out=np.full(len(old), np.inf), where=best <= 0)
            moved = np.where(share <= share.min(), 0.0, old + share.min() * (best - old))
            x[:] = 0.0
            x[used] = moved
            used = [k for k, v in zip(used, moved, strict=True) if v > 0]
        x[:] = 0.0
        x[used] = best
    return x


Plan = list[tuple[int, list[tuple[int, int]]]]


def unit_of(n: int, length: int) -> int:
    return (2 * n * UNITS + length) // (2 * length)


def plan(histogram: dict[int, int], length: int = LENGTH, parts: int = PARTS) -> Plan:
    """[(sequences, [(piece length, how many in each)])], placing every piece of the histogram."""
    left = {n: c for n, c in histogram.items() if c > 0}
    if not left:
        return []
    groups = by_patterns(left, length, parts)
    return _best_fit(groups, left, length)


def fit(histogram: dict[int, int], length: int, parts: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """The patterns and their repeats by non-negative least squares."""
    held = np.zeros(UNITS + 1, np.int64)
    for n, c in histogram.items():
        held[unit_of(n, length)] += c
    patterns = enumerate_patterns(UNITS, parts)
    a = np.zeros((UNITS, len(patterns)))
    for j, p in enumerate(patterns):
        for k in p:
            a[k - 1, j] += 1
    # Rows are weighted by 1/sqrt(count), so that rare lengths are fitted too.
    weight = 1.0 / np.sqrt(np.maximum(held[1:], 1))
    return patterns, nnls(a * weight[:, None], held[1:] * weight)


class _Stock:
    """Pieces that are left, by rounded length."""

    def __init__(self, left: dict[int, int], length: int):
        self.left, self.length = left, length
        self.of: list[list[int]] = [[] for _ in range(UNITS + 1)]
        for n in sorted(left):
            self.of[unit_of(n, length)].append(n)

    def free(self, n: int, taken: list[int]) -> bool:
        return self.left[n] > taken.count(n)

    def nearest(self, unit: int, aim: float, taken: list[int]) -> int | None:
        return min((n for n in self.of[unit] if self.free(n, taken)), key=lambda n: abs(n - aim), default=None)

    def longest(self, unit: int, room: int, taken: list[int]) -> int | None:
        held = self.of[unit]
        for at in range(bisect.bisect_right(held, room) - 1, -1, -1):
            if self.free(held[at], taken):
                return held[at]
        return None

    def fill(self, pattern: tuple[int, ...]) -> list[int] | None:
        """Lengths for one use of a pattern, or None if pieces do not last."""
        taken: list[int] = []
        aim = 0.0
        for unit in pattern[:-2]:
            aim += unit * self.length / UNITS
            n = self.nearest(unit, aim - sum(taken), taken)
            if n is None:
                return None
            taken.append(n)
        room = self.length - sum(taken)
        if len(pattern) == 1:
            n = self.longest(pattern[0], room, taken)
            return None if n is None else [n]
        ends = []
        for n in self.of[pattern[-2]]:
            if n < room and self.free(n, taken):
                m = self.longest(pattern[-1], room - n, [*taken, n])
                if m is not None:
                    ends.append((room - n - m, n, m))
        return [*taken, *min(ends)[1:]] if ends else None

    def take(self, chosen: list[int], times: int) -> None:
        for n in chosen:
            self.left[n] -= times
        for n in set(chosen):
            if not self.left[n]:
                self.of[unit_of(n, self.length)].remove(n)
                del self.left[n]


def by_patterns(left: dict[int, int], length: int = LENGTH, parts: int = PARTS) -> list[tuple[int, list[int]]]:
    """(uses, lengths) of the fitted patterns, few parts first; ``left`` keeps the residual pieces."""
    patterns, repeats = fit(left, length, parts)
    whole = np.floor(repeats + 1e-6).astype(np.int64)
    stock = _Stock(left, length)
    groups = []
    for j in sorted(np.flatnonzero(whole), key=lambda j: (len(patterns[j]), patterns[j])):
        uses = int(whole[j])
        while uses and (chosen := stock.fill(patterns[j])):
            # As many uses at once as can take exactly these lengths.
            same = min(uses, *(left[n] // chosen.count(n) for n in chosen))
            stock.take(chosen, same)
            groups.append((same, chosen))
            uses -= same
    return groups


def _best_fit(groups: list[tuple[int, list[int]]], left: dict[int, int], length: int) -> Plan:
    """The groups and the residual pieces: into the least room that holds them, then into new sequences."""
    rest = sorted(left.items(), reverse=True)
    # Open sequences by room; a group that takes a piece moves to its new room.
    rooms: dict[int, list[list]] = {}
    for count, chosen in groups:
        rooms.setdefault(length - sum(chosen), []).append([count, list(chosen)])
    open_rooms = sorted(rooms)

    def put(room: int, entry: list) -> None:
        if room not in rooms:
            rooms[room] = []
            bisect.insort(open_rooms, room)
        rooms[room].append(entry)

    for n, c in rest:
        while c > 0:
            i = bisect.bisect_left(open_rooms, n)
            if i == len(open_rooms):
                each = length // n
                full, part = divmod(c, each)
                if full:
                    put(length - each * n, [full, [n] * each])
                if part:
                    put(length - part * n, [1, [n] * part])
                c = 0
                continue
            room = open_rooms[i]
            count, chosen = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                open_rooms.pop(i)
            each = min(room // n, c)
            if count * each <= c:
                used = count
            else:
                used = max(1, c // each)
            if used < count:
                put(room, [count - used, chosen])
            put(room - each * n, [used, chosen + [n] * each])
            c -= used * each
    out = []
    for room in sorted(rooms):
        for count, chosen in rooms[room]:
            sizes, times = np.unique(chosen, return_counts=True)
            out.append((int(count), [(int(n), int(m)) for n, m in zip(sizes[::-1], times[::-1], strict=True)]))
    return out


def places(made: list) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: (first rank, pieces a sequence, first sequence, offset) of each run of places."""
    found: dict[int, list] = {}
    first, ranks = 0, {}
    for count, content in made:
        at = 0
        for n, m in content:
            rank = ranks.get(n, 0)
            found.setdefault(n, []).append((rank, m, first, at))
            ranks[n] = rank + count * m
            at += n * m
        first += count
    return {n: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for n, rows in found.items()}


PIECES = "doc_id bigint, uid bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, length: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    width = encoder(path).width
    for batch in batches:
        buf, off, _ = flat_text(batch.column("text"))
        for a, b, ids, begin in encoded_groups(path, buf, off, end_id):
            n = np.diff(begin)
            count = -(-n // length)
            doc = np.repeat(np.arange(b - a), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * length
            size = np.minimum(length, n[doc] - start)
            at = (begin[:-1][doc] + start).tolist()
            wide, kept = (memoryview(ids.astype(kind).tobytes()) for kind in ("<u4", f"<u{width}"))
            cuts = [wide[4 * s : 4 * (s + z)] for s, z in zip(at, size.tolist(), strict=True)]
            bodies = [bytes(kept[width * s : width * (s + z)]) for s, z in zip(at, size.tolist(), strict=True)] if keep_ids else [None] * len(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a).take(pa.array(doc)), batch.column("uid").slice(a, b - a).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array([zlib.crc32(c) for c in cuts], pa.int64()), pa.array(bodies, pa.binary())],
                names=[c.split()[0] for c in PIECES.split(", ")],
            )


def _place(batches: Iterator[pa.RecordBatch], where: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
        sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        for n in np.unique(size):
            some = np.flatnonzero(size == n)
            first, each, base, at = where[int(n)]
            k = np.searchsorted(first, rank[some], "right") - 1
            within = rank[some] - first[k]
            sequence[some] = base[k] + within // each[k]
            offset[some] = at[k] + within % each[k] * n
        names = [c for c in batch.schema.names if c not in ("uid", "salt", "rank")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])


def pack(spark: SparkSession, docs: DataFrame, path: str, end_id: int, length: int = LENGTH, keep_ids: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    If kept, ids are unsigned little-endian numbers as wide as the vocabulary
    needs; the checksum is over 32-bit ones. Pieces are read from the scratch
    folder when rows are used: pass a ``scratch`` to drop it after that.
    """
    scratch = scratch or Scratch(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.monotonically_increasing_id().alias("uid"))
    pieces = scratch.written(rows.mapInArrow(lambda it: _pieces(it, path, end_id, length, keep_ids), PIECES), "pieces")
    if not keep_ids:
        pieces = pieces.drop("ids")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    where = places(plan(histogram, length))
    each = max(RANKED, sum(histogram.values()) // GROUPS)
    many = [F.lit(x).cast("bigint") for n, c in histogram.items() if c > each for x in (n, -(-c // each))]
    groups = F.coalesce(F.element_at(F.create_map(*many), F.col("length")), F.lit(1)) if many else F.lit(1)
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("uid", "piece"), groups).cast("int"))
    counts = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    along = Window.partitionBy("length").orderBy("salt")
    base = counts.select("length", "salt", (F.sum("n").over(along) - F.col("n")).alias("base"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("uid", "piece")).cast("bigint") - 1
    ranked = pieces.withColumn("within", within)
    # At most a row for each length and GROUPS more: a bounded table.
    ranked = ranked.join(F.broadcast(base), ["length", "salt"]).withColumn("rank", F.col("base") + F.col("within")).drop("base", "within")
    fields = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if keep_ids else "")
    ordered = ranked.select(*(c.split()[0] for c in fields.split(", ")), "rank")
    return ordered.mapInArrow(lambda it: _place(it, where), fields + ", sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, spans): the packed rows themselves, from pieces that kept their ids."""
    place = ("offset", "length", "doc_id", "piece", "ids_crc32")
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct(*place, "ids"))).alias("p"))
    return rows.select("sequence_id", F.expr("aggregate(p, CAST('' AS BINARY), (s, x) -> concat(s, x.ids))").alias("ids"), F.transform("p", lambda x: F.struct(*(x[c].alias(c) for c in place))).alias("spans"))


def placed_pieces(written: DataFrame, width: int, length: int = LENGTH) -> DataFrame:
    """The rows of ``pack``, with ids, from written sequences of ids of ``width`` bytes."""
    rows = written.select("sequence_id", "ids", F.explode("spans").alias("s"))
    ids = F.substring("ids", (F.col("s.offset") * width + 1).cast("int"), (F.col("s.length") * width).cast("int"))
    return rows.select("s.doc_id", "s.piece", (F.col("s.piece").cast("bigint") * length).alias("start"), "s.length", "s.ids_crc32", ids.alias("ids"), "sequence_id", "s.offset")
