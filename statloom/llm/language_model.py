r"""An interpolated modified Kneser-Ney n-gram model, counted in Spark and read memory-mapped.

Tokens are lower-cased words and an end after each document; a start stands
before it. An n-gram is a 64-bit hash, made from left to right of the hashes of
its words. A token gives one record, its longest n-gram of at most ``order``
symbols, with the hashes of all its contexts, so the shorter n-grams of one
order are the distinct records of the order above without their first symbol:
how many there are of each is the Kneser-Ney count. N-grams that begin a
document have nothing before them and keep their plain counts.

Counting. Tasks make the n-grams of a few million tokens distinct and deal them
to shards by context, packed; a shard adds up its rows and gives a sorted array
of hashes with counts, the number of followers seen once, twice and more often
for each context, and the distinct records of the next order. Contexts that
hold more than about one token in ``HOT`` are dealt by the whole n-gram, so no
shard gets much more than ``SHARD_TOKENS`` tokens; their followers are added up
afterwards, at most ``2 * HOT`` contexts an order. Nothing is cut off: every
n-gram of every training document is in the model.

Files. ``ORDER-grams``, ``ORDER-contexts`` and ``words`` hold a file of sorted
64-bit hashes and one of numbers for each shard, written by Spark's text writer
with eight bytes of 255 as its line separator, so lost and repeated tasks are
settled by the commit protocol. Workers map them and look up sorted distinct
hashes. Where machines do not mount the folder, Spark hands the files out.

The probability of a word after a context is its discounted share there plus
the weight that discounts have freed times its probability after the shorter
context; below single words every one of V known words and the unknown one has
1 / (V + 1). So probabilities after any context sum to one.

Defined results: a null or empty text is its end alone; a null doc_id is not
held out; if nothing can be learned all scores are 0; repeated rows count and
are scored one by one; other columns are ignored, whatever their names; an
empty table gives no rows; texts of any length, hashed in stretches.
"""

from __future__ import annotations

import glob
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch, delete, shuffles_dropped
from ._bytes import BYTE_CODE, LOWER, U64, VISIBLE, Rolling, flat_text, give_back, groups, mix64, word_spans

ORDER = 2
#: Tokens whose n-grams a task makes distinct at once, and tokens of a shard.
FLUSH, SHARD_TOKENS = 2 << 20, 3 << 20
HOT = 4096
#: Bytes of one text that are hashed at once.
STRETCH = 4 << 20
START, END = U64(0x5F3759DF9E3779B9), U64(0xA0761D6478BD642F)
_STEP = U64(0x9E3779B97F4A7C15)
_CLOSE = b"\xff" * 8
#: Discounts where the counts do not give any.
PLAIN = (0.5, 1.0, 1.5)


def held_out(docs: DataFrame):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, document of each)."""
    buf = LOWER[buf]
    start, end, doc = word_spans(VISIBLE[buf], off)
    return Rolling(BYTE_CODE[buf]).spans(start, end), doc


def _hashes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same; one long text is hashed in stretches that end where a word does."""
    if len(off) > 2 or len(buf) <= STRETCH:
        return _words(buf, off)
    found, at = [], 0
    while at < len(buf):
        to = at + STRETCH
        while to < len(buf) and VISIBLE[buf[to]]:
            to += 1
        found.append(_words(buf[at:to], np.array([0, len(buf[at:to])]))[0])
        at = to
    words = np.concatenate(found)
    return words, np.zeros(len(words), np.int64)


class Tokens:
    """The tokens of a run of documents, each with its place and the symbols before it."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        words, doc = _hashes(buf, off)
        n = len(off) - 1
        self.n = np.bincount(doc, minlength=n) + 1
        first = np.cumsum(self.n + 1) - (self.n + 1)
        self._line = np.empty(len(words) + 2 * n, U64)
        self._line[first], self._line[first + self.n] = START, END
        self._line[np.arange(len(words)) + 2 * doc + 1] = words
        there = np.ones(len(self._line), bool)
        there[first] = False
        self._at = np.flatnonzero(there)
        self.doc = np.repeat(np.arange(n), self.n)
        self.place = self._at - first[self.doc] - 1
        self.word = self._line[self._at]

    def contexts(self, order: int, some: np.ndarray) -> np.ndarray:
        """The hash of the ``order - 1`` symbols before each of these tokens, which have that many."""
        at = self._at[some]
        context = self._line[at - order + 1]
        for back in range(order - 2, 0, -1):
            context = joined(context, self._line[at - back])
        return context


def joined(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(context * _STEP + word)


def _shards(context: np.ndarray, gram: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """By context, or by the whole n-gram where the context is hot; ``hot`` is sorted."""
    key = context
    if len(hot):
        at = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
        key = np.where(hot[at] == context, gram, context)
    return (((key >> U64(32)) * U64(shards)) >> U64(32)).astype(np.int64)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Tokens]:
    for batch in batches:
        buf, off, _ = flat_text(batch.column("text"))
        for a, b in groups(off):
            yield Tokens(buf[off[a] : off[b]], off[a : b + 1] - off[a])


def _frequent(batches: Iterator[pa.RecordBatch], order: int, share: int, flush: int) -> Iterator[pa.RecordBatch]:
    """(level, context, n): contexts that hold a share of a stretch's tokens; level 0 has the tokens."""
    held: dict[int, list[np.ndarray]] = {k: [] for k in range(2, order + 1)}
    total = since = 0

    def out() -> Iterator[pa.RecordBatch]:
        for level, arrays in held.items():
            found, n = np.unique(np.concatenate([np.zeros(0, U64), *arrays]), return_counts=True)
            some = n * 2 * share > since
            arrays.clear()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(some.sum(), level)), pa.array(found[some].view(np.int64)), pa.array(n[some])], names=["level", "context", "n"])

    for run in _runs(batches):
        total, since = total + len(run.word), since + len(run.word)
        for level, arrays in held.items():
            arrays.append(run.contexts(level, run.place >= level - 2))
        if since > flush:
            yield from out()
            since = 0
    if since:
        yield from out()
    yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0]), pa.array([total])], names=["level", "context", "n"])


RECORDS = "level int, shard int, n bigint, data binary"


def _sums(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(distinct keys ascending, a row of each, sums of the values)."""
    order = np.argsort(key, kind="stable")
    held = key[order]
    cut = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])) if len(held) else np.zeros(0, np.int64)
    return held[cut], order[cut], [np.add.reduceat(v[order], cut) if len(cut) else v[:0] for v in values]


def _dealt(level: int, columns: list[np.ndarray], counts: list[np.ndarray], hot: np.ndarray, shards: int) -> Iterator[tuple]:
    """Records of one order as rows of RECORDS: contexts from the longest, the word, then 32-bit counts."""
    if not len(columns[-1]):
        return
    key = columns[0] if level == 1 else joined(columns[0], columns[-1])
    shard = _shards(columns[0], key, hot, shards)
    order = np.lexsort((columns[0], shard))
    shard = shard[order]
    cut = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
    arrays = [c[order] for c in columns] + [c[order].astype("<u4") for c in counts]
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(shard)], strict=True):
        yield level, int(shard[a]), b - a, b"".join(c[a:b].tobytes() for c in arrays)


def _records(batches: Iterator[pa.RecordBatch], order: int, hot: dict[int, np.ndarray], shards: int, flush: int) -> Iterator[pa.RecordBatch]:
    held: dict[int, list[list[np.ndarray]]] = {}
    since = 0

    def out() -> Iterator[pa.RecordBatch]:
        for level, parts in held.items():
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            key = columns[0] if level == 1 else joined(columns[0], columns[-1])
            _, row, (n,) = _sums(key, np.ones(len(key), np.int64))
            for r in _dealt(level, [c[row] for c in columns], [n, n], hot.get(level, NOTHING), shards):
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(r, (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["level", "shard", "n", "data"])
        held.clear()

    for run in _runs(batches):
        longest = np.minimum(run.place + 2, order)
        for level in range(min(2, order), order + 1):
            some = longest == level
            if some.any():
                held.setdefault(level, []).append([run.contexts(k, some) for k in range(level, 1, -1)] + [run.word[some]])
        since += len(run.word)
        if since > flush:
            yield from out()
            since = 0
    yield from out()
    give_back()


NOTHING = np.zeros(0, U64)
#: ``keys`` are sorted hashes, ``numbers`` a 32- or 64-bit row for each; ``facts`` are sums over a shard.
COUNTED = "kind string, level int, shard int, n bigint, keys binary, numbers binary, facts array<bigint>"


def _packed(numbers: np.ndarray) -> bytes:
    return numbers.astype("<u4" if not len(numbers) or numbers.max() < 1 << 32 else "<u8").tobytes()


def _shard(table: pa.Table, level: int, hot: dict[int, np.ndarray], shards: int) -> pa.Table:
    """All rows of one shard and order, added up."""
    wide, rows = level + 1, []
    parts: list[list[np.ndarray]] = [[] for _ in range(wide + 1)]
    for n, data in zip(table.column("n").to_pylist(), table.column("data"), strict=True):
        raw = np.frombuffer(data.as_buffer(), np.uint8)
        for k in range(level):
            parts[k].append(raw[8 * n * k : 8 * n * (k + 1)].view("<u8"))
        for k in range(2):
            at = 8 * n * level + 4 * n * k
            parts[level + k].append(raw[at : at + 4 * n].view("<u4"))
    columns, (counts, raws) = [np.concatenate(p) for p in parts[:level]], [np.concatenate(p).astype(np.int64) for p in parts[level:]]
    del parts
    shard, mine = table.column("shard")[0].as_py(), hot.get(level, NOTHING)
    key, row, (counts, raws) = _sums(columns[0] if level == 1 else joined(columns[0], columns[-1]), counts, raws)
    columns = [c[row] for c in columns]
    facts = [len(key), int(counts.sum()), *(int((counts == k).sum()) for k in range(1, 5))]
    rows.append(("grams", level, shard, len(key), key.tobytes(), _packed(counts), facts))
    if level == 1:
        rows.append(("words", 1, shard, len(key), key.tobytes(), _packed(raws), None))
    else:
        context, _, stats = _sums(columns[0], counts, *(((counts == k) if k < 3 else counts >= k).astype(np.int64) for k in (1, 2, 3)))
        stats = np.stack(stats, axis=1)
        is_hot = np.isin(context, mine)
        rows.append(("contexts", level, shard, int((~is_hot).sum()), context[~is_hot].tobytes(), _packed(stats[~is_hot]), None))
        rows += [("hot", level, shard, 1, k.tobytes(), None, s.tolist()) for k, s in zip(context[is_hot], stats[is_hot], strict=True)]
        shorter = columns[1] if level == 2 else joined(columns[1], columns[-1])
        _, row, (n, raws) = _sums(shorter, np.ones(len(key), np.int64), raws)
        rows += [("records", lower, to, size, data, None, None) for lower, to, size, data in _dealt(level - 1, [c[row] for c in columns[1:]], [n, raws], hot.get(level - 1, NOTHING), shards)]
    give_back()
    return pa.table({c.split()[0]: pa.array(v, t) for c, v, t in zip(COUNTED.split(", "), zip(*rows, strict=True), (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())), strict=True)})


def _adder(level: int, hot: dict[int, np.ndarray], shards: int) -> Callable[[pa.Table], pa.Table]:
    return lambda table: _shard(table, level, hot, shards)


def discounts(ones: int, twos: int, threes: int, fours: int) -> list[float]:
    """What is taken off counts of one, two and more."""
    if not (ones and twos):
        return list(PLAIN)
    y = ones / (ones + 2 * twos)
    found = [1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes if threes else PLAIN[2]]
    return [d if 0 < d <= k + 1 else PLAIN[k] for k, d in enumerate(found)]


def train(spark: SparkSession, docs: DataFrame, scratch: Scratch, order: int = ORDER, share: int = HOT, flush: int = FLUSH, shard_tokens: int = SHARD_TOKENS) -> dict:
    """Counts the documents' n-grams and writes the model; returns where and the few numbers beside it."""
    texts = docs.select("text")
    found = texts.mapInArrow(lambda it: _frequent(it, order, share, flush), "level bigint, context bigint, n bigint").groupBy("level", "context").agg(F.sum("n").alias("n"))
    found = scratch.written(found, "frequent")
    tokens = found.where("level = 0").agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-tokens // shard_tokens))
    hot: dict[int, np.ndarray] = {}
    for r in found.where((F.col("level") > 0) & (F.col("n") * share > tokens)).collect():  # at most HOT contexts an order
        hot.setdefault(r["level"], []).append(r["context"])
    hot = {k: np.sort(np.array(v, np.int64).view(U64)) for k, v in hot.items()}

    model = {"order": order, "tokens": tokens, "shards": shards, "hot": hot, "discounts": {}, "hot_stats": {}, "folder": f"{scratch.path}/model", "words": 0, "total": 0, "ones": (0, 0, 0)}
    level_rows = texts.mapInArrow(lambda it: _records(it, order, hot, shards, flush), RECORDS)
    if order > 2:  # those of short contexts join the lower orders' rows below
        level_rows = scratch.written(level_rows, "records")
    below = level_rows
    for level in range(order, 0, -1):
        rows = below if level == order else below.unionByName(level_rows.where(F.col("level") == level)) if order > 2 else below
        rows = rows.where(F.col("level") == level).select("shard", "n", "data")
        made = rows.groupBy("shard").applyInArrow(_adder(level, hot, shards), COUNTED)
        path = f"{scratch.path}/counted-{level}"
        with shuffles_dropped(spark):
            made.write.partitionBy("kind").option("compression", "zstd").parquet(path)
        got = spark.read.schema(COUNTED).parquet(path)
        sums = got.where("kind = 'grams'").agg(*(F.sum(F.get("facts", F.lit(k))) for k in range(6))).first()
        model["discounts"][level] = discounts(*(x or 0 for x in sums[2:]))
        if level == 1:
            types, model["total"], one, two = (x or 0 for x in sums[:4])
            model["words"], model["ones"] = types, (one, two, types - one - two)
        parts = got.where("kind = 'hot'").groupBy("keys").agg(*(F.sum(F.get("facts", F.lit(k))).alias(f"s{k}") for k in range(4))).collect()  # at most HOT rows
        model["hot_stats"][level] = {int.from_bytes(r["keys"], "little"): tuple(r)[1:] for r in parts}
        for kind in ("grams", "words") if level == 1 else ("grams", "contexts"):
            for column in ("keys", "numbers"):
                flat = got.where((F.col("kind") == kind) & (F.col("n") > 0)).select(F.col(column).cast("string").alias("value"), "shard")
                flat.write.partitionBy("shard").options(encoding="ISO-8859-1", lineSep=_CLOSE.decode("latin-1")).text(f"{model['folder']}/{level}-{kind}-{column}")
            delete(spark, f"{path}/kind={kind}")
        below = spark.read.schema(COUNTED).parquet(path).where("kind = 'records'").select("level", "shard", "n", F.col("keys").alias("data"))
    return model


_maps: dict[str, tuple[np.ndarray, np.ndarray] | None] = {}


def _mapped(folder: str, name: str, shard: int, columns: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(hashes, numbers) of one shard, memory-mapped."""
    at = f"{folder}/{name}-{shard}"
    if at not in _maps:
        if len(_maps) > 4096:
            _maps.clear()
        files = [glob.glob(f"{glob.escape(folder)}/{name}-{c}/shard={shard}/part-*") for c in ("keys", "numbers")]
        _maps[at] = None
        if all(files):
            keys = np.memmap(files[0][0], "<u8", "r")[:-1]
            each = (os.path.getsize(files[1][0]) - len(_CLOSE)) // (len(keys) * columns)
            _maps[at] = keys, np.memmap(files[1][0], f"<u{each}", "r", shape=(len(keys), columns))
    return _maps[at]


class Model:
    """A written model as a worker sees it."""

    def __init__(self, spec: dict):
        self.spec = spec
        self.folder = SparkFiles.get(spec["sent"]) if "sent" in spec else re.sub("^file:/+", "/", spec["folder"])

    def _find(self, name: str, key: np.ndarray, shard: np.ndarray, columns: int = 1) -> np.ndarray:
        """The numbers of each key, 0 where it is not there."""
        distinct, first, back = np.unique(key, return_index=True, return_inverse=True)
        out = np.zeros((len(distinct), columns), np.int64)
        where = shard[first]
        order = np.argsort(where, kind="stable")
        cut = np.flatnonzero(np.concatenate([[True], np.diff(where[order]) != 0])) if len(order) else []
        for a, b in zip(cut, [*cut[1:], len(order)], strict=True) if len(order) else ():
            some = order[a:b]
            if held := _mapped(self.folder, name, int(where[some[0]]), columns):
                keys, numbers = held
                at = np.minimum(np.searchsorted(keys, distinct[some]), len(keys) - 1)
                hit = keys[at] == distinct[some]
                out[some[hit]] = numbers[at[hit]]
        return out[back]

    def _taken(self, level: int, count: np.ndarray) -> np.ndarray:
        return np.concatenate([[0.0], self.spec["discounts"][level]])[np.minimum(count, 3)]

    def score(self, run: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(plain count, probability) of each token."""
        spec, word = self.spec, run.word
        shard = _shards(word, word, NOTHING, spec["shards"])
        plain = self._find("1-words", word, shard)[:, 0]
        count = self._find("1-grams", word, shard)[:, 0]
        base = 1.0 / (spec["words"] + 1)
        p = np.full(len(word), base)
        if spec["total"]:
            p = (count - self._taken(1, count) + spec["freed"] * base) / spec["total"]
        for level in range(2, spec["order"] + 1):
            some = np.flatnonzero(run.place >= level - 2)
            context, hot = run.contexts(level, some), spec["hot"].get(level, NOTHING)
            gram = joined(context, word[some])
            count = self._find(f"{level}-grams", gram, _shards(context, gram, hot, spec["shards"]))[:, 0]
            stats = self._find(f"{level}-contexts", context, _shards(context, context, NOTHING, spec["shards"]), 4)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
                is_hot = hot[at] == context
                stats[is_hot] = np.array([spec["hot_stats"][level].get(int(k), (0, 0, 0, 0)) for k in hot], np.int64)[at[is_hot]]
            seen = stats[:, 0] > 0
            total = np.where(seen, stats[:, 0], 1)
            freed = stats[:, 1:] @ np.array(spec["discounts"][level])
            p[some] = np.where(seen, (count - self._taken(level, count) + freed * p[some]) / total, p[some])
        return plain, p


SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _score(batches: Iterator[pa.RecordBatch], spec: dict) -> Iterator[pa.RecordBatch]:
    model = Model(spec)
    for batch in batches:
        buf, off, _ = flat_text(batch.column("text"))
        for a, b in groups(off):
            run = Tokens(buf[off[a] : off[b]], off[a : b + 1] - off[a])
            plain, p = model.score(run)
            each = np.cumsum(run.n) - run.n
            base = np.log10((plain + 1) / (spec["tokens"] + spec["words"] + 1))
            cols = [np.add.reduceat(x, each) for x in ((plain > 0).astype(np.int64), base, np.log10(p))]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(a, b - a), batch.column("held_out").slice(a, b - a), pa.array(run.n.astype(np.int64)), pa.array(cols[0]),
                pa.array(np.full(b - a, spec["tokens"], np.int64)), pa.array(cols[1]), pa.array(cols[2]),
            ], names=[c.split()[0] for c in SCORED.split(", ")])


def score(spark: SparkSession, docs: DataFrame, model: dict, mounted: bool | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each document.

    ``mounted`` says whether the machines can open the model's files; by default
    its address decides. If not, each machine gets a copy from Spark.
    """
    spec = model | {"freed": sum(d * n for d, n in zip(model["discounts"][1], model["ones"], strict=True))}
    if not (model["folder"].startswith(("file:", "/")) if mounted is None else mounted):
        spark.sparkContext.addFile(model["folder"], recursive=True)
        spec["sent"] = model["folder"].rstrip("/").rpartition("/")[2]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(docs).alias("held_out"), "text")
    return rows.mapInArrow(lambda it: _score(it, spec), SCORED)


def perplexity(scored: DataFrame) -> DataFrame:
    """(held_out, n_tokens, perplexity) of the training and the held-out documents."""
    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("n_tokens"), F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"))


def score_documents(spark: SparkSession, docs: DataFrame, scratch: Scratch, order: int = ORDER) -> DataFrame:
    """All documents scored by a model of those that are not held out."""
    return scratch.kept(score(spark, docs, train(spark, docs.where(~held_out(docs)), scratch, order)), "scores")
