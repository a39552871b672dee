r"""Where two tokenizers cut the same text, and which of their tokens overlap.

All documents of a run are one row of bytes with document offsets, each with a
space before it. Token lengths summed up give the ends of A's and B's tokens;
one count of both kinds of ends over all bytes says where only A, only B or
both end. Where both do, a group ends. Between two neighbouring ends of any
kind exactly one token of A and one of B overlap, and any two overlapping
tokens do so in one such place: these places are the links. Prefix sums over
the bytes, read at the document offsets, give each document's numbers.

Corpus-wide counts. Each document's distinct linked pairs and how often it has
them are written once, packed. A pair's count is the number of these lists that
hold it, summed in tasks before the shuffle. Going back, the most frequent
pairs, ``COMMON`` of them at most, are looked up in a broadcast table; it holds
nearly all links and every pair that is hot. The rest are rows of a join on
the pair, and none of them is in more than a ``COMMON``-th of all entries.

B's words. A sentencepiece model without a piece that has a blank after another
character never merges over the start of a word, so each distinct word with the
blanks before it is encoded once and kept in a bounded table of the worker. The
vocabulary is asked whether that holds; else texts are encoded whole. A text
of more than ``LONG`` bytes is taken in stretches that start where a word does
for both tokenizers, so memory does not grow with its length.

Defined results: texts that are null, empty, or not given back by one of the
tokenizers have no tokens, zeros and an empty ``groups_sha256``; a null doc_id
is kept, repeated rows are documents of their own; other columns are ignored,
whatever their names; an empty table gives no rows; texts of any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch
from ._bytes import BYTE_CODE, Rolling, flat_text, give_back, groups, per_doc
from .encode import _stand, encoder

#: Pairs that are looked up in a broadcast table, 17 bytes each.
COMMON = 1 << 20
#: Distinct pairs that a task counts before it gives them out.
HELD = 1 << 20
LONG = 1 << 20
#: Distinct words and ids that a worker keeps of B; beyond it the table starts anew.
TABLE_WORDS, TABLE_IDS = 400_000, 1 << 23
MARK = "▁"

_pieces: dict[str, Pieces] = {}
_pairs: dict[tuple[str, str], Pair] = {}


class Pieces:
    """A sentencepiece model by words."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(k) for k in range(self.model.vocab_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace(MARK, " ").encode() for k, p in enumerate(names)]
        probe = "a  bé ﬁ\tc "
        keeps = "".join(self.model.encode(probe, out_type=str)).replace(MARK, " ").replace("<0x09>", "\t") == " " + probe
        self.by_word = keeps and not any(p[k] != MARK and p[k + 1] == MARK for p in names for k in range(len(p) - 1))
        self._reset()

    def _reset(self) -> None:
        self.of: dict[int, int] = {}
        self.flat, self.begin, self.used = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), 0

    def _learn(self, keys: list[int], words: list[str]) -> None:
        for key, word, ids in zip(keys, words, self.model.encode(words, num_threads=1), strict=True):
            k, ids = len(self.of), ids if word else [self.model.piece_to_id(MARK)]  # the model adds no blank to nothing
            if k + 1 == len(self.begin):
                self.begin = np.resize(self.begin, 2 * len(self.begin))
            while self.used + len(ids) > len(self.flat):
                self.flat = np.resize(self.flat, 2 * len(self.flat))
            self.flat[self.used : self.used + len(ids)] = ids
            self.begin[k], self.begin[k + 1] = self.used, self.used + len(ids)
            self.used += len(ids)
            self.of[key] = k

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each document has) of texts that all start with the blank that the model adds."""
        n = len(off) - 1
        raw = buf.tobytes()
        if not self.by_word:
            whole = [np.array(self.model.encode(raw[a + 1 : b].decode("utf-8", "replace")), np.int64) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            return np.concatenate([np.zeros(0, np.int64), *whole]), np.array([len(x) for x in whole], np.int64)
        blank = buf == 32
        first = blank.copy()
        first[1:] &= ~blank[:-1]
        first[off[:-1]] = True
        start = np.flatnonzero(first)
        end = np.append(start[1:], len(buf))
        found = pa.array(Rolling(BYTE_CODE[buf]).spans(start, end)).dictionary_encode()
        code, keys = np.asarray(found.indices), np.asarray(found.dictionary)
        index = np.array([self.of.get(k, -1) for k in keys.tolist()], np.int64)
        missing = np.flatnonzero(index < 0)
        if len(self.of) + len(missing) > TABLE_WORDS or self.used > TABLE_IDS:
            self._reset()
            missing = np.arange(len(keys))
        if len(missing):
            at = np.empty(len(keys), np.int64)
            at[code[::-1]] = np.arange(len(code))[::-1]
            at = at[missing]
            index[missing] = len(self.of) + np.arange(len(missing))
            self._learn(keys[missing].tolist(), [raw[a + 1 : b].decode("utf-8", "replace") for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)])
        word = index[code]
        size = self.begin[word + 1] - self.begin[word]
        ids = self.flat[np.repeat(self.begin[word] - (np.cumsum(size) - size), size) + np.arange(size.sum())].astype(np.int64)
        return ids, np.bincount(np.searchsorted(off, start, "right") - 1, weights=size, minlength=n).astype(np.int64)


class Side:
    """A vocabulary's bytes: every token's length and place in one row of bytes."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def text(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        return self.flat[np.repeat(self.begin[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())]


class Pair:
    """Both tokenizers, with the decimal strings of their ids."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = encoder(path_a), Pieces(path_b)
        back, vocab = {c: bytes([k]) for k, c in _stand.items()}, self.a.library.get_vocab()
        tokens = [b""] * (max(vocab.values()) + 1)
        for token, k in vocab.items():
            tokens[k] = b"".join(back.get(c) or c.encode() for c in token)
        self.sides = Side(tokens), Side(self.b.bytes)
        self.width = len(self.b.bytes)
        self.names = np.array([b"%d%b" % (k, end) for size, ends in ((len(tokens), (b",", b"|")), (self.width, (b",", b";"))) for k in range(size) for end in ends], object)
        self.second = 2 * len(tokens)
        #: A stretch can start at any blank between two words.
        self.splits = self.a.cut == "gpt2" and self.b.by_word


def pair(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(path_a, path_b)
    return _pairs[path_a, path_b]


def _per_doc(ids: np.ndarray, count: np.ndarray, kept: np.ndarray) -> np.ndarray:
    return ids[np.repeat(kept, count)]


class Aligned:
    """A run of documents: numbers of each, its groups spelled out, and its distinct linked pairs."""

    def __init__(self, both: Pair, buf: np.ndarray, off: np.ndarray, kept: np.ndarray):
        """Texts with the space before them; only those of ``kept`` are looked at."""
        n, size = len(off) - 1, np.diff(off)
        ids, counts = zip(*(side.encode(buf, off) for side in (both.a, both.b)), strict=True)
        ids = [x.astype(np.int64) for x in ids]
        sums = [np.concatenate([[0], np.cumsum(side.size[x])]) for side, x in zip(both.sides, ids, strict=True)]
        for s, c in zip(sums, counts, strict=True):
            at = np.concatenate([[0], np.cumsum(c)])
            kept = kept & (np.diff(s[at]) == size)
        while True:
            held, cut = [_per_doc(x, c, kept) for x, c in zip(ids, counts, strict=True)], np.concatenate([[0], np.cumsum(size * kept)])
            text = buf if kept.all() else buf[np.repeat(kept, size)]
            odd = sum(per_doc(side.text(x) != text, cut) for side, x in zip(both.sides, held, strict=True)) > 0
            if not odd.any():
                break
            kept = kept & ~odd
        self.kept = kept
        self.n_a, self.n_b = (np.where(kept, c, 0) for c in counts)
        a, b = held
        ends_a, ends_b = np.cumsum(both.sides[0].size[a]), np.cumsum(both.sides[1].size[b])
        total = int(cut[-1])
        # 1: only A ends here, 2: only B, 3: both.
        marks = np.bincount(ends_a, minlength=total + 1) + 2 * np.bincount(ends_b, minlength=total + 1)
        links_to, groups_to = np.cumsum(marks > 0), np.cumsum(marks == 3)
        self.n_links, self.n_groups = np.diff(links_to[cut]), np.diff(groups_to[cut])
        place = np.flatnonzero(marks)
        kind = marks[place]
        which_a, which_b = np.cumsum(kind & 1) - (kind & 1), np.cumsum(kind >> 1) - (kind >> 1)
        every = len(both.sides[0].size) * both.width
        doc = np.repeat(np.arange(n), self.n_links)
        found, self.times = np.unique((doc * every + a[which_a] * both.width + b[which_b]).astype(np.uint64), return_counts=True)
        self.pairs = (found % np.uint64(every)).astype(np.int64)
        self.first = np.searchsorted(found, np.arange(n + 1, dtype=np.uint64) * np.uint64(every))

        last_a, last_b = marks[ends_a] == 3, marks[ends_b] == 3
        group_a, group_b = groups_to[ends_a] - last_a, groups_to[ends_b] - last_b
        all_groups = int(groups_to[-1]) if total else 0
        before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=all_groups))])
        upto_a = np.cumsum(np.bincount(group_a, minlength=all_groups))
        name = np.empty(len(a) + len(b), np.int64)
        name[np.arange(len(a)) + before_b[group_a]] = 2 * a + last_a
        name[np.arange(len(b)) + upto_a[group_b]] = both.second + 2 * b + last_b
        self._name, self._names, self._at = name, both.names, np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])

    def spelled(self, k: int) -> bytes:
        """`a1,a2|b1;a3|b2,b3` of the k-th document."""
        return b"".join(self._names[self._name[self._at[k] : self._at[k + 1]]].tolist())[:-1]


def stretches(buf: np.ndarray) -> list[tuple[int, int]]:
    """Spans of about LONG bytes that start at a single blank between two words."""
    blank = buf == 32
    start = np.flatnonzero(blank[1:-1] & ~np.isin(buf[:-2], list(b" \t\n\v\f\r")) & ~np.isin(buf[2:], list(b" \t\n\v\f\r")) & (buf[:-2] < 128) & (buf[2:] < 128)) + 1
    cuts = [0]
    while len(buf) - cuts[-1] > LONG:
        k = np.searchsorted(start, cuts[-1] + LONG)
        if k == len(start):
            break
        cuts.append(int(start[k]))
    return list(zip(cuts, [*cuts[1:], len(buf)], strict=True))


def _long(both: Pair, buf: np.ndarray) -> tuple:
    """The row of one document that is taken in stretches."""
    sums, sha, pairs, times = np.zeros(4, np.int64), hashlib.sha256(), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for k, (a, b) in enumerate(stretches(buf) if both.splits else [(0, len(buf))]):
        part = Aligned(both, buf[a:b], np.array([0, b - a]), np.ones(1, bool))
        if not part.kept[0]:
            return 0, 0, 0, 0, "", b"", b""
        sums += [part.n_a[0], part.n_b[0], part.n_groups[0], part.n_links[0]]
        sha.update((b";" if k else b"") + part.spelled(0))
        pairs, at = np.unique(np.concatenate([pairs, part.pairs]), return_inverse=True)
        times = np.bincount(at, weights=np.concatenate([times, part.times])).astype(np.int64)
        give_back()
    return *sums.tolist(), sha.hexdigest(), pairs.astype("<i8").tobytes(), times.astype("<i4").tobytes()


ROW = "uid bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs binary, times binary"
_ROW = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())])


def _align(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    both = pair(path_a, path_b)
    for batch in batches:
        buf, off, null = flat_text(batch.column("text"))
        for a, b in groups(off):
            size = np.diff(off[a : b + 1])
            spaced = np.full(off[b] - off[a] + b - a, 32, np.uint8)
            begin = np.concatenate([[0], np.cumsum(size + 1)])
            there = np.ones(len(spaced), bool)
            there[begin[:-1]] = False
            spaced[there] = buf[off[a] : off[b]]
            if b - a == 1 and len(spaced) > LONG:
                rows = [_long(both, spaced)]
            else:
                got = Aligned(both, spaced, begin, (size > 0) & ~null[a:b])
                rows = [
                    (*numbers, hashlib.sha256(got.spelled(k)).hexdigest() if numbers[0] else "", got.pairs[got.first[k] : got.first[k + 1]].astype("<i8").tobytes(), got.times[got.first[k] : got.first[k + 1]].astype("<i4").tobytes())
                    for k, numbers in enumerate(zip(got.n_a.tolist(), got.n_b.tolist(), got.n_groups.tolist(), got.n_links.tolist(), strict=True))
                ]
            cols = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(_ROW)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("uid").slice(a, b - a), batch.column("doc_id").slice(a, b - a), *cols], schema=_ROW)


def aligned(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str, scratch: Scratch) -> DataFrame:
    """One written row for each document, with its distinct linked pairs packed."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return scratch.written(rows.mapInArrow(lambda it: _align(it, path_a, path_b), ROW), "aligned")


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, times, row of each) of a batch of packed rows."""
    pairs, off, _ = flat_text(batch.column("pairs"))
    times, _, _ = flat_text(batch.column("times"))
    return pairs.view("<i8") if len(pairs) else np.zeros(0, np.int64), times.view("<i4") if len(times) else np.zeros(0, np.int32), np.repeat(np.arange(len(off) - 1), np.diff(off) // 8)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        distinct, more = np.unique(_lists(batch)[0], return_counts=True)
        held, at = np.unique(np.concatenate([held, distinct]), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([n, more]), minlength=len(held)).astype(np.int64)
        if len(held) > HELD:
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n)], names=["pair", "n"])
            held, n = held[:0], n[:0]
    give_back()
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n)], names=["pair", "n"])


def pair_counts(spark: SparkSession, made: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """(pair, n, best): how many documents hold a pair linked, and whether no pair of its A id has more."""
    counts = scratch.written(made.select("pairs", "times").mapInArrow(_count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")), "counts")
    a = F.expr(f"pair div {width}")
    # One row for each id of A's vocabulary.
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return scratch.written(counts.withColumn("a", a).join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "best")


def _threshold(counts: DataFrame, common: int) -> tuple[int, int]:
    """(the least count of which no more than ``common`` pairs have it or more, pairs below it), from some 500 sums."""
    # The four leading bits of a count.
    least = F.expr("shiftleft(shiftright(n, greatest(length(bin(n)) - 4, 0)), greatest(length(bin(n)) - 4, 0))").alias("least")
    sizes = sorted(((r["least"], r["k"]) for r in counts.groupBy(least).agg(F.count("*").alias("k")).collect()), reverse=True)
    taken, at = 0, 1 << 62
    for value, k in sizes:
        if taken + k > common:
            break
        taken, at = taken + k, value
    return at, sum(k for _, k in sizes) - taken


def align(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str, scratch: Scratch, common: int = COMMON) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row for each document."""
    made = aligned(spark, docs, path_a, path_b, scratch)
    counts = pair_counts(spark, made, pair(path_a, path_b).width, scratch)
    least, others = _threshold(counts, common)
    known = counts.where(F.col("n") >= least).orderBy("pair").toArrow()
    table = spark.sparkContext.broadcast((known.column("pair").to_numpy(), known.column("n").to_numpy(), known.column("best").to_numpy()))

    def found(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        pairs, times, row = _lists(batch)
        keys, n, best = table.value
        at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
        there = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
        return pairs, times.astype(np.int64), row, there, n[at[there]], best[at[there]]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, times, row, there, n, best = found(batch)
            rows, times = row[there], times[there]
            # Sums of whole numbers, exact where floats would not be.
            at = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            total, of_best = (np.concatenate([[0], np.cumsum(x)]) for x in (times * n, times * best))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in KEPT), pa.array(np.diff(of_best[at])), pa.array(np.diff(total[at]))], names=[*KEPT, "n_best", "count_sum"])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times, row, there, _, _ = found(batch)
            yield pa.RecordBatch.from_arrays([batch.column("uid").take(pa.array(row[~there])), pa.array(pairs[~there]), pa.array(times[~there])], names=["uid", "pair", "times"])

    out = made.mapInArrow(sums, "uid bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint")
    if others:
        rest = made.select("uid", "pairs", "times").mapInArrow(rare, "uid bigint, pair bigint, times bigint").join(counts.where(F.col("n") < least), "pair")
        rest = rest.groupBy("uid").agg(F.sum(F.col("times") * F.col("best").cast("bigint")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more"))
        out = out.join(rest, "uid", "left").withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0))).withColumn("count_sum", F.col("count_sum") + F.coalesce("more", F.lit(0)))
    out = scratch.kept(out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), "alignment")
    table.destroy()
    return out


KEPT = ["uid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
