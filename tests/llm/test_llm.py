"""The training-data operators against brute force, on small tables with nulls, ties, empty and long texts."""

import collections
import hashlib
import random
import re
import unicodedata
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from statloom.llm import chat, components, decontaminate, encode, language_id, licenses, near_copies, packing, quality_rules, queries, simhash, site_quality, suffix_dedup, token_files
from statloom.session import Scratch, shared_dir, table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def odd_texts():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    base = " ".join(word() for _ in range(60))
    long = " ".join(word() for _ in range(4000))
    return [None, "", " ", "\n\n", "a", "Ö", "!!", base, base, base + " tail", "head " + base, base[:150] + "X" + base[150:], long, long[:9000], "é" * 250, "é" * 250, "北京" * 80, "x" * 300, base.upper(), "It's mit license, MIT License and Apache-License.", "don't 'til we're\t\n  ok", None]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k // 2 if k in (8, 9) else k, t, None if t is None else "en", "s", None if t is None else len(t)) for k, t in enumerate(odd_texts())]
    return spark.createDataFrame([*rows, (None, "no id " * 30, None, None, 1)], DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def empty(spark):
    return spark.createDataFrame([], DOCS)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# --- suffix-array dedup -------------------------------------------------------

def brute_repeats(rows, width=100):
    seen, out = set(), []
    for i, t in rows:
        data, hit = (t or "").encode(), np.zeros(len((t or "").encode()) + 1, int)
        for p in range(len(data) - width + 1):
            w = data[p : p + width]
            if w in seen:
                hit[p] += 1
                hit[p + width] -= 1
            seen.add(w)
        gone = np.cumsum(hit)[:-1] > 0
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(data) else 0
        out.append((i, len(data), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [4096, 1])
@pytest.mark.parametrize("parts", [1, 4])
def test_repeats(spark, docs, hot, parts):
    got = suffix_dedup.repeated_bytes(spark, docs.repartition(parts), hot).collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(sorted(pairs(docs)))


def test_repeats_odd(spark, odd):
    rows = pairs(odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))
    one = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(map(tuple, suffix_dedup.repeated_bytes(spark, one).collect()), key=str) == brute_repeats(sorted(rows))
    assert suffix_dedup.repeated_bytes(spark, odd).count() == odd.count()
    assert suffix_dedup.repeated_bytes(spark, empty(spark)).count() == 0
    assert not spark.catalog.listTables(pattern="statloom_parts_*")
    scratch, other = Scratch(spark), Scratch(spark)
    kept = suffix_dedup.remove_repeats(spark, odd.withColumn("part", F.lit("mine")).withColumn("row", F.lit(1)), scratch=scratch)
    suffix_dedup.remove_repeats(spark, odd, scratch=other)
    assert kept.columns == [*odd.columns, "part", "row"] and {r.part for r in kept.collect()} == {"mine"}
    assert [r.n_chars == len(r.text) for r in kept.where("text IS NOT NULL AND n_chars > 1").collect()].count(False) == 0
    # A run's handle drops its own table and no other.
    scratch.drop()
    assert [t.name for t in spark.catalog.listTables(pattern="statloom_parts_*")] == other.tables
    other.drop()
    assert not spark.catalog.listTables(pattern="statloom_parts_*")


def shared_bytes(x, y):
    return next((k for k, (a, b) in enumerate(zip(x, y, strict=False)) if a != b), min(len(x), len(y)))


@pytest.mark.parametrize("width", [8, 12, 16, 100])
def test_previous_factors(width):
    for seed, kind in enumerate((b"a", b"ab", b"abc", bytes(range(256)))):
        raw = bytes(random.Random(seed).choices(kind, k=150)) * 2 + bytes(random.Random(seed + 9).choices(kind, k=150))
        starts = np.array(sorted(random.Random(seed).sample(range(len(raw) - width + 1), 120)))
        want = [max([0, *(shared_bytes(raw[p : p + width], raw[q : q + width]) for q in starts[:k])]) for k, p in enumerate(starts)]
        assert suffix_dedup.previous_factors(np.frombuffer(raw, np.uint8), starts, width).tolist() == want


def test_repeats_go_by_factors(spark, docs, monkeypatch):
    """Windows that meet in contexts of their own go by their LPF alone."""
    seen = []

    def counted(text, starts, width=100, real=suffix_dedup.previous_factors):
        seen.append(int((real(text, starts, width) >= width).sum()))
        return real(text, starts, width)

    monkeypatch.setattr(suffix_dedup, "previous_factors", counted)
    passage = "".join(random.Random(3).choices("abcdefgh ", k=130))
    texts = ["".join(random.Random(k).choices("ijklmnop ", k=300)) for k in range(30)]
    block = []
    for k, t in enumerate(texts):
        data = np.frombuffer((t[:149] + chr(65 + k) + passage + chr(65 + k) + t[151:]).encode(), np.uint8)
        key, start, own, _ = suffix_dedup.anchors(data, np.array([0, len(data)]))
        for a, s, o in zip(key.view(np.int64).tolist(), start.tolist(), own.tolist(), strict=True):
            block.append((0, a, k, 0, k, s, o, o + 99, data[s : s + o + 99].tobytes()))
    rows = pa.Table.from_pylist([dict(zip((f.split()[0] for f in suffix_dedup.CONTEXTS.split(", ")), r, strict=True)) for r in block])
    spans = suffix_dedup._repeats(rows).to_pylist()
    assert 0 < sum(seen) <= 31 * 29
    for k in range(30):
        mine = [(s["start"], s["end"]) for s in spans if s["row"] == k]
        assert (min((a for a, _ in mine), default=None), max((b for _, b in mine), default=None)) == ((None, None) if k == 0 else (150, 280))


def test_repeats_of_a_long_text(spark):
    """9 MB in one document, read in many pieces, and the same bytes again in two others."""
    long = np.random.default_rng(1).integers(97, 123, 9 << 20, np.uint8).tobytes().decode()
    rows = [(1, long), (2, "x" + long[5_000_000:5_000_400] + "y"), (3, long[: 3 << 20])]
    got = {r.doc_id: r for r in suffix_dedup.repeated_bytes(spark, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)).collect()}
    assert (got[1].n_removed, got[2].n_removed, got[2].n_spans, got[3].n_removed, got[3].n_spans) == (0, 400, 1, 3 << 20, 1)
    assert got[1].kept_sha256 == hashlib.sha256(long.encode()).hexdigest() and got[2].kept_sha256 == hashlib.sha256(b"xy").hexdigest()


def test_repeats_shuffle_rows(spark, monkeypatch):
    """Shuffled rows grow with the text, not with parts times blocks."""
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 1 << 14)
    monkeypatch.setattr(suffix_dedup, "BYTES_A_BLOCK", 1 << 12)
    rows = {}
    for times in (1, 4):
        rnd = np.random.default_rng(times)
        texts = [(k, rnd.integers(97, 123, 4000, np.uint8).tobytes().decode()) for k in range(30 * times)]
        scratch = Scratch(spark)
        staged, size = suffix_dedup._stage(spark, spark.createDataFrame([*texts, *((k + 1000, t) for k, t in texts)], "doc_id bigint, text string").repartition(2), [], scratch)
        keys = staged.select("text", "part").mapInArrow(suffix_dedup._screen, "part int, key bigint, n int").count()
        rows[times] = keys, suffix_dedup._spans(staged, size, 4096).count()
        scratch.drop()
    for small, large in zip(*rows.values(), strict=True):
        assert 0 < small and 3 * small < large < 5 * small


def test_part_labels(spark):
    labels = suffix_dedup.part_labels(50)
    found = [r[0] for r in spark.createDataFrame([(k,) for k in labels], "k int").select(F.pmod(F.hash("k"), F.lit(50))).collect()]
    assert sorted(found) == list(range(50))


# --- language ID -----------------------------------------------------------------

def test_language(spark, docs, odd):
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in pairs(docs) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.9 and all(0 <= r.score <= 1 for r in got)
    model = language_id.learn(docs, F.lit(True))
    marked = {(r.doc_id, r.text): r.lang_pred for r in language_id.predict(odd, model, F.col("doc_id"), F.col("text").alias("text_")).withColumnRenamed("text_", "text").collect()}
    assert all((v == "und") == (t is None or not any(c.isalpha() for c in t)) for (_, t), v in marked.items())
    assert language_id.identify(empty(spark)).count() == 0
    assert {r.lang_pred for r in language_id.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def brute_grams(text):
    low = [unicodedata.normalize("NFD", c.lower())[0] if len(c.lower()) > 1 else c.lower() for c in text]
    line = re.sub(" +", " ", " " + "".join(x if c.isalpha() else " " for c, x in zip(text, low, strict=True)) + " ")
    return collections.Counter(line[k : k + 3] for k in range(len(line) - 2))


def test_language_against_brute_force(spark, docs):
    """Every prediction, from letters bound and bundled one trigram at a time."""
    vectors = {}

    def bundle(grams):
        total = np.zeros(language_id.DIM)
        for g, n in grams.items():
            if g not in vectors:
                x, y, z = (language_id.letter_vector(ord(c)) for c in g)
                vectors[g] = (np.roll(x, 2) * np.roll(y, 1) * z).astype(np.float64)
            total += n * vectors[g]
        return total / max(np.linalg.norm(total), 1e-12)

    rows = docs.select("doc_id", "text", "lang").collect()
    learned = collections.defaultdict(collections.Counter)
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None and r.text is not None:
            learned[r.lang].update(brute_grams(r.text))
    langs = sorted(learned)
    prototypes = np.array([bundle(learned[n]) for n in langs])
    centre = prototypes.mean(axis=0)
    cosine = lambda x, y: (x @ y) / (np.linalg.norm(x) * np.linalg.norm(y))
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id].lang_pred == "und"
            continue
        near = sorted(((cosine(bundle(brute_grams(r.text)) - centre, p - centre), n) for n, p in zip(langs, prototypes, strict=True)), reverse=True)
        # Arithmetic of 32 bits may turn near-ties round.
        assert got[r.doc_id].lang_pred in {n for c, n in near if near[0][0] - c < 1e-4}


def test_sites_against_brute_force(spark, docs):
    """Posteriors of every document from its own evidence and its site's, host and path counted one by one."""
    labels = table(spark, SF, "labels")
    rows = docs.withColumn("source", F.when(F.col("doc_id") % 7 != 0, F.col("source"))).cache()
    model = site_quality.fit(rows, labels)
    held = rows.select(F.col("doc_id"), F.coalesce("source", F.lit("")).alias("host"), F.coalesce("lang", F.lit("")).alias("path"), "text").toArrow()
    seen = [r for b in site_quality._evidence(iter(held.to_batches()), model, ["doc_id", "host", "path"]) for r in b.to_pylist()]
    chance = lambda x: 1 / (1 + np.exp(-x))
    odds = lambda p: np.log((p := min(max(p, 1e-4), 1 - 1e-4)) / (1 - p))
    want = {}
    for c in "qt":
        hosts, paths = collections.defaultdict(list), collections.defaultdict(list)
        for r in seen:
            hosts[r["host"]].append(chance(r[c]))
            paths[r["host"], r["path"]].append(chance(r[c]))
        mean = sum(map(sum, hosts.values())) / len(seen)
        spread = max(np.var([np.mean(x) for x in hosts.values()]) - mean * (1 - mean) * np.mean([1 / len(x) for x in hosts.values()]), 1e-6)
        strength = min(max(mean * (1 - mean) / spread - 1, 1.0), 1e4)
        for r in seen:
            h, p = hosts[r["host"]], paths[r["host"], r["path"]]
            host = (sum(h) + strength * mean) / (len(h) + strength)
            path = (sum(p) + strength * host) / (len(p) + strength)
            want[r["doc_id"], c] = chance(r[c] + odds(path) - odds(mean))
    for r in site_quality.classify(spark, rows, labels).collect():
        assert abs(r.quality_prob - want[r.doc_id, "q"]) < 1e-6 and abs(r.toxic_prob - want[r.doc_id, "t"]) < 1e-6
        assert r.toxic == (want[r.doc_id, "t"] >= 0.5) and r.kept == (want[r.doc_id, "q"] >= 0.5 and want[r.doc_id, "t"] < 0.5)


def test_language_learns_every_trigram(spark):
    rnd = random.Random(1)
    texts = {"zh": "".join(chr(rnd.randrange(0x4E00, 0x9000)) for _ in range(60_000)), "en": "plain words of a small alphabet"}
    df = spark.createDataFrame([(k, t, n, "s", len(t)) for k, (n, t) in enumerate(texts.items())], DOCS).repartition(2)
    total = []
    for name in sorted(texts):
        raw = texts[name].encode()
        code, _, _ = language_id.trigrams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert name == "en" or len(np.unique(code)) > 50_000
        total.append(sum(language_id.trigram_vectors(code[at : at + 4096]).sum(axis=0, dtype=np.float64) for at in range(0, len(code), 4096)))
    unit = np.array([x / np.linalg.norm(x) for x in total])
    want = unit - unit.mean(axis=0)
    got = language_id.learn(df, F.lit(True))
    assert got["langs"] == ["en", "zh"]
    assert np.allclose(got["prototypes"], want / np.linalg.norm(want, axis=1, keepdims=True), atol=1e-5)


# --- tokens ----------------------------------------------------------------------

@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_is_the_library(name):
    rnd = random.Random(3)
    texts = [t or "" for t in odd_texts()] + ["".join(rnd.choice("ab'sStrelvmd \n\t1.!éÀß  'œ\x00") for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    raw = "".join(texts).encode()
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    made = encode.Encoder(public_tokenizers.path(name))
    ids, begin = made.with_end(np.frombuffer(raw, np.uint8), off, 7)
    library = Tokenizer.from_file(public_tokenizers.path(name))
    library.encode_special_tokens = True
    for k, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[begin[k] : begin[k + 1]].tolist() == [*e.ids, 7], texts[k]


def library_ids(name, texts, end):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    library.encode_special_tokens = True
    return [np.array([*e.ids, end], "<u4") for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("mounted", [True, False])
@pytest.mark.parametrize("which", ["docs", "odd"])
def test_token_files(spark, request, which, mounted):
    df = request.getfixturevalue(which).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    made = token_files.write_tokens(spark, df, public_tokenizers.path("byte_bpe_50k.json"), 0, shared_dir(spark), 1 << 13)
    rows, at, expected = sorted(pairs(df)), 0, []
    for (i, _), ids in zip(rows, library_ids("byte_bpe_50k.json", [t for _, t in rows], 0), strict=True):
        expected.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert made["shards"] >= 2
    assert sorted(map(tuple, token_files.read_back(spark, made, mounted).collect())) == expected


def test_token_files_of_equal_ids(spark):
    """Rows of one doc_id, or of none, are cut into shards as well."""
    import glob
    import os

    rows = [(7, f"some words here {k} " * 40) for k in range(60)] + [(None, "no id " * k) for k in range(20)] + [(9, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    made = token_files.write_tokens(spark, df, public_tokenizers.path("byte_bpe_50k.json"), 0, shared_dir(spark), 1 << 10)
    got = token_files.read_back(spark, made).orderBy("start").collect()
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == collections.Counter((i, len(x), zlib.crc32(x.tobytes())) for (i, _), x in zip(rows, library_ids("byte_bpe_50k.json", [t for _, t in rows], 0), strict=True))
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: -1 if i is None else i)
    sizes = [os.path.getsize(f) for f in glob.glob(made["folder"].removeprefix("file:") + "/tokens/shard=*/*.txt")]
    longest = max(r.n_tokens for r in got)
    assert made["shards"] == len(sizes) > 5 and max(sizes) <= 2 * ((1 << 10) + longest)


def test_token_files_empty(spark):
    made = token_files.write_tokens(spark, empty(spark), public_tokenizers.path("byte_bpe_50k.json"), 0, shared_dir(spark))
    assert token_files.read_back(spark, made).count() == 0


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packing(spark, request, which):
    df = request.getfixturevalue(which)
    got = packing.pack(spark, df, public_tokenizers.path("word_bpe_49k.json"), 1, 512, keep_ids=True).collect()
    texts = [t for _, t in pairs(df)]
    want = collections.Counter()
    for (i, _), ids in zip(pairs(df), library_ids("word_bpe_49k.json", texts, 1), strict=True):
        for k in range(0, len(ids), 512):
            want[(i, k // 512, k, len(ids[k : k + 512]), zlib.crc32(ids[k : k + 512].tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    room = collections.defaultdict(list)
    for r in got:
        room[r.sequence_id].append((r.offset, r.length))
    for placed in room.values():
        placed.sort()
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:k]) for k in range(len(placed))] and sum(n for _, n in placed) <= 512
    assert len(room) <= 1.03 * sum(r.length for r in got) / 512 + 2
    whole = packing.sequences(spark.createDataFrame(got)).collect()
    assert sum(len(r.ids) for r in whole) == 2 * sum(r.length for r in got)
    assert packing.pack(spark, empty(spark), public_tokenizers.path("word_bpe_49k.json"), 1).count() == 0


def test_plan_places_everything():
    rnd = random.Random(4)
    for _ in range(20):
        histogram = {rnd.randint(1, 256): rnd.randint(1, 500) for _ in range(rnd.randint(1, 60))}
        made = packing.plan(histogram, 256)
        placed = collections.Counter()
        for count, content in made:
            assert sum(n * m for n, m in content) <= 256
            for n, m in content:
                placed[n] += count * m
        assert placed == collections.Counter(histogram)


def test_patterns_place_most_pieces():
    import duckdb

    texts = [t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    histogram = collections.Counter()
    for ids in library_ids("word_bpe_49k.json", texts, 1):
        for k in range(0, len(ids), packing.LENGTH):
            histogram[min(packing.LENGTH, len(ids) - k)] += 1
    bound = -(-sum(n * c for n, c in histogram.items()) // packing.LENGTH)
    assert sum(c for c, _ in packing.plan(histogram)) <= bound * 1.001 + 1
    by_patterns = packing.by_patterns(dict(histogram))
    assert sum(uses * len(lengths) for uses, lengths in by_patterns) > 0.7 * sum(histogram.values())
    assert all(sum(lengths) <= packing.LENGTH for _, lengths in by_patterns)
    # The plan grows with the lengths that there are, not with the pieces.
    assert len(packing.plan({n: c * 10**9 for n, c in histogram.items()})) < 6 * packing.LENGTH


def test_nnls():
    rnd = np.random.default_rng(3)
    for _ in range(20):
        a, x = rnd.integers(0, 3, (8, 30)).astype(float), np.zeros(30)
        x[rnd.choice(30, 5, False)] = rnd.uniform(1, 9, 5)
        got = packing.nnls(a, a @ x)
        assert (got >= 0).all() and np.allclose(a @ got, a @ x, atol=1e-6) and (got > 0).sum() <= 8


def test_packing_salts(spark, docs, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 1)
    got = packing.pack(spark, docs.unionByName(docs), public_tokenizers.path("word_bpe_49k.json"), 1, 256).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    room = collections.Counter()
    for r in got:
        room[r.sequence_id] += r.length
    assert max(room.values()) <= 256 and all(r.offset + r.length <= room[r.sequence_id] for r in got)


# --- chat --------------------------------------------------------------------------

def test_chat(spark):
    texts = ["<|end|>", "<\\|end|> <\\\\|x", "a<", "|b", None, "</s>[INST] ok [/INST]", "", "<<|text|>é"]
    rows = [(c, t, r, x) for c in (1, None) for t, (r, x) in enumerate((r, x) for x in texts for r in ("user", "assistant"))] + [(2, 0, "user", "only"), (3, 0, "assistant", "x"), (3, 0, None, "y"), (4, 1, "<|role|>", "z")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    folder = chat.write_examples(spark, df, shared_dir(spark))
    got = {r.conv_id: r for r in chat.read_back(spark, folder).collect()}
    for c in (1, 2, 3, 4, None):
        mine = sorted(((t, r or "", x or "") for k, t, r, x in rows if k == c))
        said = "".join(x for _, r, x in mine if r == "assistant")
        assert got[c].n_turns == len(mine) and got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in mine).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    examples = chat.example_texts(spark, folder).where("conv_id = 1").collect()
    assert len(examples) == len(texts)
    for r in examples:
        assert r.text[: r.mask_start].endswith("<|role|>assistant<|text|>") and r.text[r.mask_end :] == "<|end|>"
    plan = chat.read_back(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert chat.read_back(spark, chat.write_examples(spark, df.limit(0), shared_dir(spark))).count() == 0


# --- decontamination ------------------------------------------------------------

def test_decontamination_long_words(spark):
    """Windows of over 32,767 bytes, and a text of 6 MB around one."""
    words = [chr(97 + k) * 4000 for k in range(10)]
    item = " ".join(words)
    bench = spark.createDataFrame([(1, item), (2, "x" * 70_000)], "item_id bigint, text string")
    filler = "lorem ipsum " * 500_000
    df = spark.createDataFrame([(1, f"a {item.upper()}, b"), (2, " ".join(words[:9])), (3, filler + item), (4, "y " + "x" * 70_000), (None, item)], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.decontaminate(spark, df, bench).collect()}
    assert got == {1: (10, 1), 2: (0, 0), 3: (10, 1), 4: (1, 1), None: (10, 1)}
    assert {r.doc_id for r in decontaminate.drop_contaminated(spark, df, bench).collect()} == {2}


def brute_hits(rows, items, size=10):
    windows = {}
    for i, t in items:
        w = PLAIN.findall((t or "").translate(UP))
        for k in range(max(1, len(w) - size + 1)) if w else ():
            windows.setdefault(tuple(w[k : k + size]), set()).add(str(i))
    out = []
    for i, t in rows:
        w, hit, ids = PLAIN.findall((t or "").translate(UP)), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    ids |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1 << 25, 400])
def test_decontamination(spark, docs, odd, block):
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()] + [(900, "X"), (901, "mit license"), (902, None), (903, "!!"), (904, "Ö"), (905, "北京" * 80)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for df in (docs, odd):
        got = decontaminate.decontaminate(spark, df, benchmark, block_bytes=block)
        assert sorted(map(tuple, got.collect()), key=str) == brute_hits(pairs(df), items)
        clean = decontaminate.drop_contaminated(spark, df, benchmark, block_bytes=block)
        assert clean.columns == df.columns and clean.count() == got.where("NOT contaminated").count()
    assert decontaminate.decontaminate(spark, docs, benchmark.limit(0)).where("contaminated").count() == 0
    assert decontaminate.decontaminate(spark, empty(spark), benchmark).count() == 0


@pytest.mark.parametrize("block", [1 << 25, 1])
def test_decontamination_null_item(spark, block):
    benchmark = spark.createDataFrame([(None, "alpha beta"), (None, "gamma delta"), (7, "beta gamma"), (None, None)], "item_id bigint, text string")
    df = spark.createDataFrame([(1, "an Alpha beta here"), (2, "alpha beta gamma delta"), (3, "clean")], "doc_id bigint, text string")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = sorted(map(tuple, decontaminate.decontaminate(spark, df, benchmark, block_bytes=block).collect()))
    assert got == [(1, 4, 2, 1, sha(""), True), (2, 4, 4, 2, sha("7"), True), (3, 1, 0, 0, sha(""), False)]
    assert [r.doc_id for r in decontaminate.drop_contaminated(spark, df, benchmark, block_bytes=block).collect()] == [3]


# --- licenses ------------------------------------------------------------------------

def test_licenses(spark, docs, odd):
    for df in (docs, odd):
        got = collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(spark, df).collect())
        want = collections.Counter()
        for i, t in pairs(df):
            w = PLAIN.findall((t or "").translate(UP))
            hits = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
            want[(i, len(w), len(hits), min((k for k, _ in hits), default=None), max((k for k, _ in hits), default=None), ",".join(sorted({x for _, x in hits})))] += 1
        assert got == want
    text = dict(enumerate(t for _, t in licenses.TEMPLATES))
    moved = " ".join(w for k, w in enumerate(text[0].split()) if k != 9)
    rows = spark.createDataFrame([(1, f"before {moved} after"), (2, " ".join(text[0].split()[:8])), (3, "nothing at all"), (4, f"{text[9]} {text[9]}")], "doc_id bigint, text string")
    assert {r.doc_id: r.labels for r in licenses.scan(spark, rows).collect()} == {1: "mit", 2: "", 3: "", 4: "bsd"}
    plan = licenses.scan(spark, docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
    assert licenses.scan(spark, empty(spark)).count() == 0


# --- quality ----------------------------------------------------------------------

def brute_base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    hit = set()
    for k in range(len(w) - 7):
        if windows[tuple(w[k : k + 8])] > 1:
            hit.update(range(k, k + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)


def test_quality_rules(spark, docs, odd):
    labels = table(spark, SF, "labels")
    for df in (docs, odd):
        got = quality_rules.quality_rules(spark, df, labels).collect()
        assert collections.Counter(tuple(r)[:7] for r in got) == collections.Counter((i, *brute_base(t)) for i, t in pairs(df))
        assert not [r for r in got if r.kept and r.base_failed]
    kept = quality_rules.filter_documents(docs, labels)
    good = {r.doc_id for r in labels.where("quality = 1").collect()} & {i for i, t in pairs(docs) if not brute_base(t)[5]}
    left = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns and len(good & left) >= 0.98 * len(good)
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert len(bad & left) <= 0.2 * len(bad)
    assert quality_rules.quality_rules(spark, empty(spark), labels).count() == 0
    assert quality_rules.quality_rules(spark, docs, labels.limit(0)).count() == docs.count()


def test_site_quality(spark, docs, odd):
    big, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = site_quality.classify(spark, big, labels).join(labels.withColumnRenamed("toxic", "is_toxic"), "doc_id").collect()
    assert sum((r.quality_prob >= 0.5) == (r.quality == 1) for r in got) > 0.9 * len(got)
    assert sum(r.toxic == (r.is_toxic == 1) for r in got) > 0.85 * len(got)
    clean = [r for r in got if r.quality == 1 and r.is_toxic == 0]
    assert sum(r.kept for r in clean) > 0.95 * len(clean)
    assert site_quality.classify(spark, odd, labels).count() == odd.count()
    assert site_quality.classify(spark, empty(spark), labels).count() == 0
    assert site_quality.classify(spark, docs, labels.limit(0)).where("kept").count() == docs.count()


# --- simhash -----------------------------------------------------------------------

def brute_print(t):
    w = (t or "").encode().lower().split()
    shingles = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, prints):
    ids = sorted(rows)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("crowd", [48, 1])
def test_simhash(spark, odd, crowd):
    df = odd.dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in simhash.near_duplicates(spark, df, crowd=crowd).collect()}
    prints = {i: brute_print(t) for i, t in pairs(df)}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    want = brute_components([i for i in prints if i is not None], prints)
    assert {i: r.component_id for i, r in got.items() if i is not None} == want and got[None].component_id is None
    assert simhash.near_duplicates(spark, empty(spark)).count() == 0


@pytest.mark.parametrize("crowd", [48, 2])
def test_links(spark, crowd):
    rnd = random.Random(7)
    prints, seeds = set(), [rnd.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    for s in seeds:
        for _ in range(25):
            x = s
            for _ in range(rnd.randint(0, 5)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    nodes = spark.createDataFrame([(signed(x),) for x in prints], "fp bigint")
    found = components.connected_components(spark, simhash.links(spark, nodes, crowd))
    label = {r.node: r.component for r in found.collect()}
    got = collections.defaultdict(set)
    for x in prints:
        got[label.get(signed(x), signed(x))].add(x)
    number = {k: x for k, x in enumerate(sorted(prints))}
    want = collections.defaultdict(set)
    for k, c in brute_components(list(number), number).items():
        want[c].add(number[k])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def brute_sets(t):
    w = (t or "").encode().lower().split()
    return frozenset(b" ".join(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()


def brute_similar(rows):
    sets = {i: brute_sets(t) for i, t in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            x, y = sets[i], sets[j]
            if x == y or 5 * len(x & y) >= 4 * len(x | y) > 0:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {find(i) for i in ids}


@pytest.mark.parametrize(("crowd", "shard"), [(48, near_copies.SHARD), (2, 500)])
def test_stage_keeps_one_of_similar(spark, crowd, shard):
    import corpus_pipeline

    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    line = " ".join(word() for _ in range(30))
    texts = [None, "", "one two", "one TWO"]
    for size in (20, 60, 300):
        for _ in range(3):
            base = [word() for _ in range(size)]
            for _ in range(12):
                w = list(base)
                for _ in range(rnd.randint(0, size // 25 + 1)):
                    w[rnd.randrange(size)] = word()
                texts.append(" ".join(w) + rnd.choice(["", " " + line]))
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(3)
    want = brute_similar(rows)
    assert 5 < len(want) < len(rows) - 20
    assert sorted(r.doc_id for r in near_copies.keep_first(spark, df, crowd=crowd, shard=shard).collect()) == sorted(want)
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, SF).collect()) == sorted(want)


@pytest.mark.parametrize("common", [near_copies.COMMON, 2])
def test_shared_passage_makes_no_pairs(spark, monkeypatch, common):
    """Half of all documents share a passage: it enters no prefix of texts that are their own for a fifth, and every near copy is found."""
    monkeypatch.setattr(near_copies, "COMMON", common)
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 7)))
    passage = " ".join(word() for _ in range(60))
    texts = [f"{' '.join(word() for _ in range(40))} {passage if k % 2 else ''}" for k in range(400)]
    # Near copies of ten of them, and texts that are the passage but for a few words.
    texts += [t.replace(" ", f" {word()} ", 1) for t in texts[:10]] + [f"{word()} {passage} {word()}" for _ in range(8)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS).repartition(5)
    assert sorted(r.doc_id for r in near_copies.keep_first(spark, df).collect()) == sorted(brute_similar(list(enumerate(texts))))
    hashes = near_copies._common(df, 5)
    assert bool(len(hashes))
    rows = near_copies._entries(Scratch(spark), df, 5, Fraction(4, 5), hashes, 40_000, near_copies.SHARD).collect()
    # Without exact counts each document would be entered under a fifth of its shingles, some 6,000 rows.
    assert len(rows) < 1500 and max(collections.Counter(r.shingle for r in rows).values()) < 40
    assert near_copies._joined(*2 * [near_copies._shared(spark.createDataFrame(rows)).withColumn("group", F.col("node"))], Fraction(4, 5)).count() < 200


def test_stage_keeps_one_row(spark):
    import corpus_pipeline

    base = " ".join(f"w{k}" for k in range(100))
    rows = [(1, base), (1, base), (1, "another text of its own here"), (1, base + " tail"), (2, base), (None, base), (None, "only without an id"), (None, "only without an id"), (None, "lone")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(3)
    got = pairs(corpus_pipeline.near_dedup(spark, df, SF))
    first = min((base, base + " tail"), key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert sorted(got, key=str) == sorted([(1, first), (1, "another text of its own here"), (None, "only without an id"), (None, "lone")], key=str)


# --- SQL ---------------------------------------------------------------------------

def test_against_sql(spark):
    import os

    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    for name, text in queries.ORACLE_SQL.items():
        df, want = queries.QUERIES[name](spark, SF), con.sql(text)
        assert df.columns == want.columns and sorted(map(tuple, df.collect())) == sorted(want.fetchall()), name


# --- the pipeline ----------------------------------------------------------------

def test_pipeline(spark, docs):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF).collect()
    assert len(corpus_pipeline.STAGES) == 5 and got
    # Rules, then one of each group of near copies, then repeats, then windows, by brute force on what the rules keep.
    kept = {r.doc_id: r.text for r in quality_rules.filter_documents(docs, table(spark, SF, "labels")).collect()}
    first = sorted(brute_similar(list(kept.items())))
    left = brute_left([(i, kept[i]) for i in first])
    clean = {i for i, text in left.items() if text and not brute_windows(text, [r.text for r in table(spark, SF, "benchmark").collect()])}
    assert {r.doc_id for r in got} == clean


def brute_left(rows, width=100):
    """The bytes of each document that no earlier place has, where any are left."""
    seen, out = set(), {}
    for i, t in rows:
        data, gone = t.encode(), set()
        for p in range(len(data) - width + 1):
            if data[p : p + width] in seen:
                gone.update(range(p, p + width))
            seen.add(data[p : p + width])
        out[i] = bytes(b for k, b in enumerate(data) if k not in gone).decode("utf-8", "ignore")
    return out


def brute_windows(text, items):
    words = PLAIN.findall(text.translate(UP))
    for item in items:
        w = PLAIN.findall((item or "").translate(UP))
        n = min(10, len(w))
        windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
        if any(tuple(words[k : k + n]) in windows for k in range(len(words) - n + 1)):
            return True
    return False


def test_pipeline_packs_ids(spark, docs):
    import corpus_pipeline

    some = docs.limit(40).cache()
    plain = packing.pack(spark, some, public_tokenizers.path("word_bpe_49k.json"), 1).collect()
    got = corpus_pipeline.pack(spark, some, SF).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in plain)
    assert all(len(r.ids) == 2 * r.length and zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) == r.ids_crc32 for r in got)


def test_pipeline_writes_sequences(spark, docs):
    import corpus_pipeline

    some = docs.limit(40).cache()
    rows = corpus_pipeline.pack(spark, some, SF)
    got = rows.collect()
    whole = {r.sequence_id: r.ids for r in spark.read.parquet(*rows.inputFiles()).collect()}
    assert {r.sequence_id for r in got} == set(whole) and sum(map(len, whole.values())) == 2 * sum(r.length for r in got)
    assert all(whole[r.sequence_id][2 * r.offset : 2 * (r.offset + r.length)] == r.ids for r in got)


def test_pipeline_drops_scratch(spark):
    import os

    import corpus_pipeline

    base = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(base))
    corpus_pipeline.run(spark, SF).count()
    made = [f for f in os.listdir(base) if f not in before and f.startswith("statloom-")]
    assert sorted(sorted(os.listdir(f"{base}/{f}")) for f in made) == [["decontamination", "packing", "quality_rules", "simhash_near_dedup", "suffix_dedup"], ["sequences"]]
    assert not spark.catalog.listTables(pattern="statloom_parts_*")


def test_pipeline_odd(spark, odd):
    import corpus_pipeline

    for df in (odd, empty(spark)):
        rows = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, SF)
            assert rows.columns == df.columns
            rows = spark.createDataFrame(rows.collect(), df.schema)
        corpus_pipeline.STAGES[-1][1](spark, rows, SF).count()


# --- faults that were found --------------------------------------------------------

def test_decontamination_under_encryption(tmp_path):
    """Broadcasts come another way to workers when Spark encrypts what it writes."""
    import subprocess
    import sys

    code = f"""
from statloom.llm import decontaminate
from statloom.session import build_session
spark = build_session("t", "local[2]", **{{"spark.io.encryption.enabled": "true", "spark.driver.memory": "1g", "spark.checkpoint.dir": "{tmp_path}"}})
docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "nothing of it")], "doc_id bigint, text string")
items = spark.createDataFrame([(1, "b c d e f g h i j k"), (2, "other words in this one")], "item_id bigint, text string")
for size in (1 << 25, 10):
    print(sorted((r.doc_id, r.contaminated) for r in decontaminate.decontaminate(spark, docs, items, block_bytes=size).collect()))
print([r.doc_id for r in decontaminate.drop_contaminated(spark, docs, items).collect()])
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=__file__.rsplit("/tests/", 1)[0])
    assert done.stdout.splitlines()[-3:] == ["[(1, True), (2, False)]"] * 2 + ["[2]"], done.stderr[-2000:]


def test_labels_of_other_values(spark, docs):
    """Labels beside 0 and 1 neither hide those two nor count as them."""
    labels = table(spark, SF, "labels")
    more = docs.join(labels, "doc_id", "left_anti").select("doc_id", (F.col("doc_id") % 3 + 2).alias("quality"), F.lit(0).alias("toxic")).limit(30)
    model = quality_rules.fit(docs, labels.select("doc_id", F.col("quality").cast("bigint").alias("quality"), F.col("toxic").cast("int").alias("toxic")).unionByName(more))
    assert model["threshold"] != quality_rules.DEFAULT_THRESHOLD


# --- any table, any length -----------------------------------------------------------

def _runs(spark):
    word, byte = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
    labels, benchmark = table(spark, SF, "labels"), table(spark, SF, "benchmark")
    return {
        "op2": lambda d: language_id.identify(d), "op3": lambda d: packing.pack(spark, d, word, 1).select("doc_id", "piece", "start", "length", "ids_crc32"),
        "op4": lambda d: token_files.read_back(spark, token_files.write_tokens(spark, d, byte, 0, shared_dir(spark))).select("doc_id", "n_tokens", "ids_crc32"), "op6": lambda d: decontaminate.decontaminate(spark, d, benchmark),
        "op7": lambda d: licenses.scan(spark, d), "op8": lambda d: quality_rules.quality_rules(spark, d, labels), "op9": lambda d: site_quality.classify(spark, d, labels), "op10": lambda d: simhash.near_duplicates(spark, d)}


CLASHING = ("uid", "node", "n", "shard", "words", "score", "held_out", "lang_pred", "starts", "piece", "ids", "labels", "quality", "kept", "site", "fp", "component_id", "value", "doc_key", "h")


@pytest.mark.parametrize("name", ["op2", "op3", "op4", "op6", "op7", "op8", "op9", "op10"])
def test_clashing_columns_and_null_ids(spark, odd, name):
    run = _runs(spark)[name]
    plain = run(odd)
    more = run(odd.withColumns({c: F.lit(k) for k, c in enumerate(CLASHING)}))
    as_text = lambda df: sorted(str(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.collect())
    assert plain.columns == more.columns and as_text(plain) == as_text(more)
    assert run(empty(spark)).count() == 0


@pytest.mark.parametrize("name", ["op2", "op3", "op4", "op7", "op8", "op9", "op10"])
def test_text_over_5_mb(spark, name):
    line = "It was under the MIT license that the words of this text went on and on, said the licence.\n"
    text = line * 60_000
    assert len(text) > 5_000_000
    df = spark.createDataFrame([(0, text, "en", "s", 1), (1, line, "en", "s", 1), (3, "anderes", "de", "s", 1)], DOCS)
    row = {r["doc_id"]: r.asDict() for r in _runs(spark)[name](df).collect() if r["doc_id"] == 0}[0]
    n = len(text.split())
    want = {
        "op2": lambda: row["lang_pred"] == "en", "op3": lambda: row["length"] <= 4096, "op4": lambda: row["n_tokens"] == len(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids) + 1,
        "op7": lambda: row["n_base"] == 60_000 and row["n_words"] == n, "op8": lambda: row["n_words"] == n and row["n_dup_lines"] == 59_999 and not row["kept"], "op9": lambda: True, "op10": lambda: row["component_id"] == 0}
    assert want[name]()
