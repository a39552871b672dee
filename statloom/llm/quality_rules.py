r"""Quality rules with a hashed n-gram log-likelihood ratio.

Base rules come from counts of words, symbols, repeated lines and repeated
word windows. Documents that pass them are scored by how much likelier their
hashed byte n-grams are under the trusted-target multinomial than under the
raw-corpus multinomial, per n-gram; every document is held against one
threshold.

The raw multinomial is a sum over every document. The target one is fitted on
the documents with a positive label among at most ``LABELLED_ROWS`` labelled
ones, those of least hash; only this bounded list is broadcast, so texts are
never shuffled. Tasks add up their own counts first, so one row per bucket and
task is shuffled and the model that returns to the driver has ``buckets`` rows
at any input size. The threshold comes from a histogram of the scores of the
same labelled documents.

Defined results: a null or empty text has no words and fails the base rules;
without labels of both kinds the target is every document that passes the
base rules and the threshold is ``DEFAULT_THRESHOLD``; repeated doc_ids are
judged one by one, null ones too, which no label can name; other columns are
ignored, whatever their names; an empty table gives no rows; a text of any length
counts whole, in arrays of some 60 bytes a byte of one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import BYTE_CODE, U64, VISIBLE, Rolling, flat_text, groups, lengths_cover, mix64, per_doc, table_of, word_spans

BUCKETS = 1 << 15
DEFAULT_THRESHOLD = -0.25
#: Bound of the labelled rows that the target model and the threshold are fitted on.
LABELLED_ROWS = 50_000
SMOOTHING = 1.0
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: A wrongly rejected document weighs as much as this many wrongly kept ones.
REJECT_COST = 20
#: Cuts within this of the best one count as equally good.
SLACK = 0.005
#: Score histogram: bins of this width from -8 to 8 nats per n-gram.
BIN, EDGE = 0.02, 8.0

SYMBOL = table_of(lambda b: chr(b) in "#*$%&|<>")
BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def ngram_buckets(buf: np.ndarray, off: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of each byte trigram inside one document."""
    if len(buf) < 3:
        empty = np.zeros(0, np.int64)
        return empty, empty
    wide = buf.astype(np.uint32)
    code = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - (buckets - 1).bit_length())
    size = np.maximum(np.diff(off) - 2, 0)
    at = np.repeat(off[:-1] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    return code[at].astype(np.int64), np.repeat(np.arange(len(size)), size)


def base_counts(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of the base rules for each document of a flat run of texts."""
    visible = VISIBLE[buf]
    start, end, doc = word_spans(visible, off)
    n = len(off) - 1
    out = {"n_words": np.bincount(doc, minlength=n), "word_chars": per_doc(visible & ((buf & 0xC0) != 0x80), off), "n_symbols": per_doc(SYMBOL[buf], off)}
    text = Rolling(BYTE_CODE[buf])

    breaks = buf == 10
    line_end = np.sort(np.concatenate([np.flatnonzero(breaks), off[1:]]))
    line_start = np.sort(np.concatenate([np.flatnonzero(breaks) + 1, off[:-1]]))
    seen = np.concatenate([[0], np.cumsum(visible, dtype=np.int64)])
    full = seen[line_end] > seen[line_start]
    line_start, line_end = line_start[full], line_end[full]
    of = np.searchsorted(off, line_start, "right") - 1
    key = mix64(text.spans(line_start, line_end) + of.astype(U64) * U64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(of, minlength=n) - np.bincount(of[first], minlength=n)

    repeat = np.zeros(n, np.int64)
    if len(start) >= WINDOW:
        windows = Rolling(text.spans(start, end)).windows(WINDOW)
        inside = np.flatnonzero(doc[: len(windows)] == doc[WINDOW - 1 :])
        if len(inside):
            key = mix64(windows[inside] + doc[inside].astype(U64) * U64(0x9E3779B97F4A7C15))
            order = np.argsort(key)
            same = key[order][1:] == key[order][:-1]
            if same.any():
                twice = np.zeros(len(key), bool)
                twice[order[1:][same]] = True
                twice[order[:-1][same]] = True
                hit = lengths_cover(inside[twice], WINDOW, len(start))
                repeat = np.bincount(doc[hit], minlength=n)
    out["n_repeat_words"] = repeat
    return out


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])


def _count_batches(batches: Iterator[pa.RecordBatch], buckets: int, labelled: bool) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for batch in batches:
        buf, off, _ = flat_text(batch.column("text"))
        trusted = np.asarray(batch.column("trusted").to_numpy(zero_copy_only=False), bool) if labelled else None
        for a, b in groups(off):
            part, cut = buf[off[a] : off[b]], off[a : b + 1] - off[a]
            code, doc = ngram_buckets(part, cut, buckets)
            raw += np.bincount(code, minlength=buckets)
            good = trusted[a:b] if labelled else ~base_failed(base_counts(part, cut))
            target += np.bincount(code[good[doc]], minlength=buckets)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(raw[some]), pa.array(target[some])], names=["bucket", "n_raw", "n_target"])


def fit(docs: DataFrame, labels: DataFrame | None, buckets: int = BUCKETS) -> dict:
    """Log-ratio per bucket from all documents, and the threshold."""
    labelled = False
    if labels is not None:
        marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
        marks = F.broadcast(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED_ROWS))
        kinds = {r[0] for r in marks.where("quality IN (0, 1)").groupBy("quality").count().collect()}
        labelled = {0, 1} <= kinds
    if labelled:
        found = docs.select("doc_id", "text").join(marks, "doc_id", "left")
        frame = found.select("text", (F.coalesce("quality", F.lit(0)) == 1).alias("trusted"))
    else:
        frame = docs.select("text")
    rows = (
        frame.mapInArrow(lambda it: _count_batches(it, buckets, labelled), "bucket int, n_raw bigint, n_target bigint")
        .groupBy("bucket").agg(F.sum("n_raw").alias("r"), F.sum("n_target").alias("t")).collect()
    )
    raw, target = np.full(buckets, SMOOTHING), np.full(buckets, SMOOTHING)
    for r in rows:
        raw[r["bucket"]] += r["r"]
        target[r["bucket"]] += r["t"]
    model = {"ratio": np.log(target / target.sum()) - np.log(raw / raw.sum()), "threshold": DEFAULT_THRESHOLD, "buckets": buckets}
    if labelled:
        scored = found.where("quality IS NOT NULL").mapInArrow(lambda it: _histogram(it, model), "bin int, quality int, n bigint")
        bins = int(2 * EDGE / BIN) + 1
        tally = np.zeros((2, bins))
        for r in scored.groupBy("bin", "quality").agg(F.sum("n").alias("n")).collect():
            tally[int(r["quality"] == 1), r["bin"]] += r["n"]
        bad, good = np.cumsum(tally[0]) / max(1, tally[0].sum()), np.cumsum(tally[1]) / max(1, tally[1].sum())
        # The middle of the cuts whose weighted error is all but the least.
        gain = np.round(bad - REJECT_COST * good, 9)
        best = np.flatnonzero(gain >= gain.max() - SLACK)
        model["threshold"] = float(-EDGE + BIN * (best[0] + best[-1] + 2) / 2)
    return model


def _scores(buf: np.ndarray, off: np.ndarray, model: dict) -> np.ndarray:
    code, doc = ngram_buckets(buf, off, model["buckets"])
    n = len(off) - 1
    return np.bincount(doc, weights=model["ratio"][code], minlength=n) / np.maximum(np.bincount(doc, minlength=n), 1)


def _histogram(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    bins = int(2 * EDGE / BIN) + 1
    tally = np.zeros((2, bins), np.int64)
    for batch in batches:
        buf, off, _ = flat_text(batch.column("text"))
        good = np.asarray(batch.column("quality").to_numpy(zero_copy_only=False)) == 1
        for a, b in groups(off):
            score = _scores(buf[off[a] : off[b]], off[a : b + 1] - off[a], model)
            at = np.clip(((score + EDGE) / BIN).astype(np.int64), 0, bins - 1)
            for kind in (0, 1):
                tally[kind] += np.bincount(at[good[a:b] == bool(kind)], minlength=bins)
    kind, at = np.nonzero(tally)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(kind, pa.int32()), pa.array(tally[kind, at])], names=["bin", "quality", "n"])


SCHEMA = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, score double, kept boolean"


def _judge(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for batch in batches:
        buf, off, _ = flat_text(batch.column("text"))
        ids = batch.column("doc_id")
        for a, b in groups(off):
            part, cut = buf[off[a] : off[b]], off[a : b + 1] - off[a]
            counts = base_counts(part, cut)
            failed, score = base_failed(counts), _scores(part, cut, model)
            cols = [ids.slice(a, b - a), *(pa.array(counts[c].astype(np.int64)) for c in BASE_COLUMNS), pa.array(failed), pa.array(score), pa.array(~failed & (score >= model["threshold"]))]
            yield pa.RecordBatch.from_arrays(cols, names=names)


def judge(docs: DataFrame, model: dict) -> DataFrame:
    """One row per document: counts, whether the base rules fail, score, verdict."""
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(lambda it: _judge(it, model), SCHEMA)


def quality_rules(spark: SparkSession, docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    return judge(docs, fit(docs, labels))


def filter_documents(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The documents that pass, with the columns they came with.

    The verdict is computed beside the row it belongs to, so nothing is joined
    back and documents without a doc_id or with a repeated one are judged too.
    """
    model, fields = fit(docs, labels), docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off, _ = flat_text(batch.column("text"))
            for a, b in groups(off):
                part, cut = buf[off[a] : off[b]], off[a : b + 1] - off[a]
                good = ~base_failed(base_counts(part, cut)) & (_scores(part, cut, model) >= model["threshold"])
                yield batch.slice(a, b - a).filter(pa.array(good))

    return docs.select(*fields).mapInArrow(keep, docs.schema)
