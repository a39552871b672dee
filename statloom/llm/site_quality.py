r"""Quality classifier with hierarchical empirical Bayes over sites.

Evidence of one document comes from two scores: the mean log-odds of its
hashed byte trigrams between documents labelled good and bad, and the summed
log-odds of its significant hashed words between documents labelled toxic and
not. Each score becomes a log-odds by a logistic curve fitted on the labelled
documents. Models are fitted on at most ``LABELLED_ROWS`` labelled rows, those
of least hash, which is the bound of what is broadcast.

Sites are hosts (``source``) and paths below them (``source`` and ``lang`` for
the documents table). For each host the mean probability is shrunk towards the
global mean, for each path towards its host's, with a prior strength estimated
from the spread of all sites' means, so sparse sites take the value above them.
A document's final log-odds is its own evidence plus its path's log-odds less
the global log-odds. Counts per site are partial sums over all documents.

Defined results: a null or empty text has no evidence of its own and takes its
site's; null host or path values are a site of their own; without labels of
both kinds a score is 0 everywhere and every document has probability 1/2 of
that kind, is not toxic and is kept; repeated and null doc_ids are judged one by
one; only doc_id, text and the two site columns are read, so other columns may
have any names; an empty table gives no rows; texts of any length count whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch
from ._bytes import BYTE_CODE, LOWER, PLAIN, U64, Rolling, flat_text, groups, word_spans
from .quality_rules import BUCKETS, ngram_buckets

LABELLED_ROWS = 50_000
WORD_BITS = 18
#: A word bucket counts if its difference between classes is this many standard errors.
SIGNIFICANT = 6.0
LIMIT = 12.0


def _word_buckets(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of each document's distinct words."""
    low = LOWER[buf]
    start, end, doc = word_spans(PLAIN[low], off)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (Rolling(BYTE_CODE[low]).spans(start, end) >> U64(64 - WORD_BITS)).astype(np.int64)
    both = np.unique(doc * (1 << WORD_BITS) + code)
    return both & ((1 << WORD_BITS) - 1), both >> WORD_BITS


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams = np.zeros((2, BUCKETS), np.int64)
    words = np.zeros((2, 1 << WORD_BITS), np.int64)
    docs = np.zeros((2, 2), np.int64)
    for batch in batches:
        buf, off, _ = flat_text(batch.column("text"))
        quality, toxic = (np.asarray(batch.column(c).fill_null(-1)) for c in ("quality", "toxic"))
        for a, b in groups(off):
            part, cut = buf[off[a] : off[b]], off[a : b + 1] - off[a]
            code, doc = ngram_buckets(part, cut)
            word, of = _word_buckets(part, cut)
            for k in (0, 1):
                grams[k] += np.bincount(code[quality[a:b][doc] == k], minlength=BUCKETS)
                words[k] += np.bincount(word[toxic[a:b][of] == k], minlength=1 << WORD_BITS)
                docs[0, k] += int((quality[a:b] == k).sum())
                docs[1, k] += int((toxic[a:b] == k).sum())
    for kind, table in enumerate((grams, words, docs)):
        some = np.flatnonzero(table.sum(axis=0) if kind < 2 else np.ones(2))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), kind), pa.int32()), pa.array(some, pa.int32()), pa.array(table[0][some]), pa.array(table[1][some])], names=["kind", "bucket", "n0", "n1"])


def _scores(buf: np.ndarray, off: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    n = len(off) - 1
    code, doc = ngram_buckets(buf, off)
    quality = np.bincount(doc, weights=model["grams"][code], minlength=n) / np.maximum(np.bincount(doc, minlength=n), 1)
    word, of = _word_buckets(buf, off)
    return quality, np.bincount(of, weights=model["words"][word], minlength=n)


def _labelled_scores(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, off, _ = flat_text(batch.column("text"))
        for a, b in groups(off):
            q, t = _scores(buf[off[a] : off[b]], off[a : b + 1] - off[a], model)
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(t), batch.column("quality").slice(a, b - a), batch.column("toxic").slice(a, b - a)], names=["q", "t", "quality", "toxic"])


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a ridge logistic curve by Newton steps."""
    if len(x) == 0 or y.min() == y.max():
        return 0.0, 0.0
    scale = x.std() or 1.0
    z = np.stack([x / scale, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + np.array([1e-2, 0]) * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic"))
    marks = F.broadcast(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED_ROWS))
    found = docs.select("doc_id", "text").join(marks, "doc_id").select("text", "quality", "toxic")
    tables = {0: np.zeros((2, BUCKETS)), 1: np.zeros((2, 1 << WORD_BITS)), 2: np.zeros((2, 2))}
    for r in found.mapInArrow(_tally, "kind int, bucket int, n0 bigint, n1 bigint").groupBy("kind", "bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect():
        tables[r["kind"]][:, r["bucket"]] = r["n0"], r["n1"]
    (bad, good), (clean, toxic), kinds = tables[0], tables[1], tables[2]
    model = {"grams": np.zeros(BUCKETS), "words": np.zeros(1 << WORD_BITS), "q": (0.0, 0.0), "t": (0.0, 0.0)}
    # kinds[k, j]: documents of value k for quality (j = 0) and toxicity (j = 1).
    if kinds[:, 0].min() > 0:
        model["grams"] = np.log((good + 1) / (good + 1).sum()) - np.log((bad + 1) / (bad + 1).sum())
    if kinds[:, 1].min() > 0:
        p1, p0 = toxic / kinds[1, 1], clean / kinds[0, 1]
        both = (toxic + clean) / kinds[:, 1].sum()
        error = np.sqrt(np.maximum(both * (1 - both) * (1 / kinds[1, 1] + 1 / kinds[0, 1]), 1e-12))
        weight = np.log((toxic + 0.5) / (kinds[1, 1] + 1)) - np.log((clean + 0.5) / (kinds[0, 1] + 1))
        model["words"] = np.where(np.abs(p1 - p0) >= SIGNIFICANT * error, weight, 0.0)
    rows = found.mapInArrow(lambda it: _labelled_scores(it, model), "q double, t double, quality int, toxic int").toPandas()
    for key, label in (("q", "quality"), ("t", "toxic")):
        some = rows[rows[label].notna()]
        model[key] = _logistic(some[key].to_numpy(), some[label].to_numpy(float)) if len(some) else (0.0, 0.0)
    return model


def _evidence(batches: Iterator[pa.RecordBatch], model: dict, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, off, _ = flat_text(batch.column("text"))
        for a, b in groups(off):
            cut = off[a : b + 1] - off[a]
            q, t = _scores(buf[off[a] : off[b]], cut, model)
            some = np.diff(cut) > 0
            odds = [np.where(some, np.clip(s * x + c, -LIMIT, LIMIT), 0.0) for (s, c), x in ((model["q"], q), (model["t"], t))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in names), *(pa.array(o) for o in odds)], names=[*names, "q", "t"])


def _odds(p: Column) -> Column:
    low = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(low / (1 - low))


def _chance(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _shrunk(sites: DataFrame, n: str, total: str, above: Column, strength: Column) -> Column:
    return (F.col(total) + strength * above) / (F.col(n) + strength)


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """(doc_id, quality_prob, toxic_prob, toxic, kept) of every document; written here, so that nothing else is left."""
    model, scratch = fit(docs, labels), Scratch(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), "text")
    names = ["doc_id", "host", "path"]
    docs_odds = scratch.written(rows.mapInArrow(lambda it: _evidence(it, model, names), "doc_id bigint, host string, path string, q double, t double"), "evidence")

    p = {c: _chance(F.col(c)) for c in "qt"}
    paths = scratch.written(docs_odds.groupBy("host", "path").agg(F.count("*").alias("n"), *(F.sum(p[c]).alias(c) for c in "qt")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), *(F.sum(c).alias(f"h{c}") for c in "qt"))
    world = hosts.agg(F.sum("hn").alias("gn"), *(F.sum(f"h{c}").alias(f"s{c}") for c in "qt"), *(F.var_pop(F.col(f"h{c}") / F.col("hn")).alias(f"v{c}") for c in "qt"), F.avg(1 / F.col("hn")).alias("thin")).first()
    joined = paths.join(hosts, "host")
    for c in "qt":
        mean = (world[f"s{c}"] or 0.0) / max(world["gn"] or 0, 1)
        # Spread of the sites' means beyond what their sizes explain; the strength m(1-m)/spread - 1.
        within = mean * (1 - mean)
        spread = max((world[f"v{c}"] or 0.0) - within * (world["thin"] or 0.0), 1e-6)
        strength = F.lit(float(min(max(within / spread - 1, 1.0), 1e4)))
        joined = joined.withColumn(f"host_{c}", _shrunk(joined, "hn", f"h{c}", F.lit(mean), strength))
        joined = joined.withColumn(f"shift_{c}", _odds(_shrunk(joined, "n", c, F.col(f"host_{c}"), strength)) - _odds(F.lit(mean)))
    sites = joined.select("host", "path", "shift_q", "shift_t")
    final = docs_odds.join(sites, ["host", "path"])
    quality, toxic = _chance(F.col("q") + F.col("shift_q")), _chance(F.col("t") + F.col("shift_t"))
    has_q, has_t = model["q"] != (0.0, 0.0), model["t"] != (0.0, 0.0)
    is_toxic = (toxic >= 0.5) if has_t else F.lit(False)
    good = (quality >= 0.5) if has_q else F.lit(True)
    return scratch.kept(final.select("doc_id", quality.alias("quality_prob"), toxic.alias("toxic_prob"), is_toxic.alias("toxic"), (good & ~is_toxic).alias("kept")), "verdicts")
