"""Cross-tokenizer alignment against a walk over every token of both tokenizers."""

import collections
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from statloom.llm import alignment, queries
from statloom.session import Scratch

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    return a, sentencepiece.SentencePieceProcessor(model_file=B), byte_of


def tokens(tokenizers, text):
    a, b, byte_of = tokenizers
    if not text:
        return [], []
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    side_a = [(k, bytes(byte_of[c] for c in a.id_to_token(k))) for k in ids_a]
    side_b = [(k, bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()) for k in b.encode(text)]
    want = (" " + text).encode()
    if any(b"".join(t for _, t in side) != want for side in (side_a, side_b)):
        return [], []
    return side_a, side_b


def spans(side):
    out, at = [], 0
    for k, t in side:
        out.append((k, at, at + len(t)))
        at += len(t)
    return out


def brute(tokenizers, rows):
    linked, found = [], []
    for i, text in rows:
        a, b = (spans(s) for s in tokens(tokenizers, text))
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        parts, lo = [], 0
        for hi in cuts:
            parts.append(",".join(str(k) for k, s, e in a if lo <= s and e <= hi) + "|" + ",".join(str(k) for k, s, e in b if lo <= s and e <= hi))
            lo = hi
        links = [(x, y) for x, s, e in a for y, t, f in b if max(s, t) < min(e, f)]
        found.append((i, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
        linked.append(set(links))
    counts = collections.Counter(p for s in linked for p in s)
    best = collections.defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return sorted(((i, na, nb, g, len(ls), sum(counts[p] == best[p[0]] for p in ls), sum(counts[p] for p in ls), sha) for i, na, nb, g, ls, sha in found), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def odd_texts():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 9))) for _ in range(40)]
    run = " ".join(rnd.choice(words) for _ in range(200))
    return [None, "", " ", "  ", "\n", "a", "  two  blanks   three ", "<s> </s> <unk> <|endoftext|>", "<0x41> <0x0A>", "a▁b ▁", "北京 大学。很长的句子", "naïve ﬁ ½ é", "tab\tand\x00nul\x7f", "🙂🙂 ok", "don't we'll 123 4567", run, run, run + "!", "　wide blank", "x" * 300, "é" * 200, " ends with blank "]


def odd_rows():
    return [(k, t) for k, t in enumerate(odd_texts())] + [(3, "a"), (None, "no id"), (None, "no id")]


@pytest.mark.parametrize("common", [alignment.COMMON, 40, 0])
def test_odd_texts(spark, tokenizers, common):
    df = spark.createDataFrame(odd_rows(), DOCS).repartition(3)
    assert got(alignment.align(spark, df, A, B, Scratch(spark), common)) == brute(tokenizers, odd_rows())


def test_table(spark, tokenizers):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    short = [(i, t) for i, t in rows if t is None or len(t) < 2500]
    df = spark.createDataFrame(short, DOCS)
    assert got(alignment.align(spark, df, A, B, Scratch(spark))) == brute(tokenizers, short)
    whole = queries.op11_alignment(spark, SF)
    assert whole.count() == len(rows) and set(whole.columns) >= {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}


def test_stretches_and_small_tables(spark, tokenizers, monkeypatch):
    both = alignment.Pair(A, B)
    text = " ".join(t for t in odd_texts() if t and "▁" not in t)
    whole = alignment._long(both, memoryview_of(" " + text))
    monkeypatch.setattr(alignment, "LONG", 64)
    monkeypatch.setattr(alignment, "TABLE_WORDS", 50)
    assert len(alignment.stretches(memoryview_of(" " + text))) > 5
    assert alignment._long(both, memoryview_of(" " + text)) == whole
    a, b = tokens(tokenizers, text)
    assert whole[:2] == (len(a), len(b))
    assert alignment._long(both, memoryview_of(" " + text + " a▁b")) == (0, 0, 0, 0, "", b"", b"")


def memoryview_of(text):
    import numpy as np

    return np.frombuffer(text.encode(), np.uint8)


def test_long_text(spark, tokenizers):
    text = " ".join(t for t in odd_texts() if t and "▁" not in t) * 2500
    assert len(text.encode()) > 5_000_000
    row = alignment.align(spark, spark.createDataFrame([(1, text), (2, "a")], DOCS), A, B, Scratch(spark)).where("doc_id = 1").first()
    a, b = tokens(tokenizers, text)
    ends = [set(e for _, _, e in spans(s)) for s in (a, b)]
    assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"]) == (len(a), len(b), len(ends[0] & ends[1]), len(ends[0] | ends[1]))


def test_empty_table_and_clashing_columns(spark, tokenizers):
    assert got(alignment.align(spark, spark.createDataFrame([], DOCS), A, B, Scratch(spark))) == []
    df = spark.createDataFrame([(*r, 1, b"x", 2) for r in odd_rows()], DOCS + ", uid int, pairs binary, n int")
    assert got(alignment.align(spark, df, A, B, Scratch(spark))) == brute(tokenizers, odd_rows())
