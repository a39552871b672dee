"""The Kneser-Ney model against dictionaries of counts, for several orders, shards and hot contexts."""

import collections
import math
import re
import zlib

import pytest

from statloom.llm import language_model as lm
from statloom.llm import queries
from statloom.session import Scratch

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
START, END = object(), object()


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP)), END]


def out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


class Brute:
    def __init__(self, texts, order):
        self.order, self.plain = order, collections.Counter()
        self.counts = [collections.Counter() for _ in range(order + 1)]
        for t in texts:
            line = [START, *words(t)]
            self.plain.update(line[1:])
            for k in range(1, len(line)):
                n = min(order, k + 1)
                self.counts[n][tuple(line[k + 1 - n : k + 1])] += 1
        for k in range(order, 1, -1):
            for gram in self.counts[k]:
                self.counts[k - 1][gram[1:]] += 1
        self.tokens, self.known = sum(self.plain.values()), len(self.plain)
        self.off, self.follow = [None], [None]
        for k in range(1, order + 1):
            sizes = collections.Counter(self.counts[k].values())
            self.off.append([0.0, *lm.discounts(sizes[1], sizes[2], sizes[3], sizes[4])])
            stats = collections.defaultdict(lambda: [0, 0, 0, 0])
            for gram, n in self.counts[k].items():
                stats[gram[:-1]][0] += n
                stats[gram[:-1]][min(n, 3)] += 1
            self.follow.append(stats)

    def p(self, context, word):
        k = len(context) + 1
        lower = self.p(context[1:], word) if k > 1 else 1 / (self.known + 1)
        stats = self.follow[k].get(context)
        if stats is None:
            return lower
        n, off = self.counts[k][(*context, word)], self.off[k]
        return (n - off[min(n, 3)] + sum(d * x for d, x in zip(off[1:], stats[1:], strict=True)) * lower) / stats[0]

    def row(self, i, text):
        line = [START, *words(text)]
        score = sum(math.log10(self.p(tuple(line[max(0, k + 1 - self.order) : k]), line[k])) for k in range(1, len(line)))
        base = sum(math.log10((self.plain[w] + 1) / (self.tokens + self.known + 1)) for w in line[1:])
        return i, out(i), len(line) - 1, sum(w in self.plain for w in line[1:]), self.tokens, round(base, 6), round(score, 6)


def brute(rows, order):
    model = Brute([t for i, t in rows if not out(i)], order)
    return sorted((model.row(i, t) for i, t in rows), key=str), model


def got(df):
    return sorted(((*tuple(r)[:5], round(r["base_score"], 6), round(r["score"], 6)) for r in df.collect()), key=str)


def odd_rows():
    same = "the cat sat on the mat the cat sat"
    texts = [None, "", " \n", same, same, same.upper(), "The dog sat on a mat.", "é É naïve 北京 北京", "the " * 50, "a", "one two three four five six seven " * 3, "x" * 5000, "\tonly\x0bwhite\x0cspace\r\nwords "]
    return [(k, t) for k, t in enumerate(texts)] + [(k, f"the cat saw number {k % 7} and the mat") for k in range(20, 60)] + [(None, same), (4, "repeated id")]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_orders(spark, order):
    df = spark.createDataFrame(odd_rows(), DOCS).repartition(4)
    want, model = brute(odd_rows(), order)
    assert got(lm.score_documents(spark, df, Scratch(spark), order)) == want
    for context in ((), (START,), ("the",), ("nowhere",), ("the", "cat"))[: 5 if order > 2 else 4 if order > 1 else 1]:
        assert sum(model.p(context, w) for w in [*model.plain, "unknown word"]) == pytest.approx(1)


@pytest.mark.parametrize("mounted", [True, False])
def test_shards_and_hot_contexts(spark, mounted):
    df = spark.createDataFrame(odd_rows(), DOCS).repartition(4)
    model = lm.train(spark, df.where(~lm.held_out(df)), Scratch(spark), 3, share=40, flush=60, shard_tokens=50)
    assert model["shards"] > 5 and len(model["hot"][2]) and len(model["hot_stats"][2])
    assert got(lm.score(spark, df, model, mounted)) == brute(odd_rows(), 3)[0]


def test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    scored = queries.op12_language_model(spark, SF)
    want, _ = brute(rows, lm.ORDER)
    assert got(scored) == want
    seen = {r["held_out"]: r["perplexity"] for r in lm.perplexity(scored).collect()}
    plain = {h: 10 ** (-sum(r[5] for r in want if r[1] == h) / sum(r[2] for r in want if r[1] == h)) for h in (True, False)}
    assert seen[False] < seen[True] < plain[True]


def test_long_text(spark):
    text = "some words and more of them \n" * 200_000
    k = next(k for k in range(1, 99) if not out(k))
    rows = [(k, text), (100, "some words"), (101, "more of it")]
    assert len(text) > 5_000_000
    row = lm.score_documents(spark, spark.createDataFrame(rows, DOCS), Scratch(spark)).where(f"doc_id = {k}").first()
    assert (row["n_tokens"], row["n_known"]) == (1_200_001, 1_200_001)
    assert row["score"] == pytest.approx(next(r for r in brute(rows, 2)[0] if r[0] == k)[6], rel=1e-6)


def test_nothing_to_learn_and_clashing_columns(spark):
    assert got(lm.score_documents(spark, spark.createDataFrame([], DOCS), Scratch(spark))) == []
    held = [(k, "never learned") for k in range(60) if out(k)]
    assert {r[3:] for r in got(lm.score_documents(spark, spark.createDataFrame(held, DOCS), Scratch(spark)))} == {(0, 0, 0.0, 0.0)}
    df = spark.createDataFrame([(*r, 1, 2, b"x") for r in odd_rows()], DOCS + ", shard int, held_out int, data binary")
    assert got(lm.score_documents(spark, df, Scratch(spark))) == brute(odd_rows(), lm.ORDER)[0]
