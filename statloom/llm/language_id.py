r"""Language identification by hyperdimensional profiles.

Every letter has a random +-1 vector of ``DIM`` components, drawn from a seed
and its code point. A trigram's vector is the product of its letters' vectors,
the first rotated twice and the second once; runs of non-letters count as one
blank letter, also before the first and after the last letter. A document is
the sum of its trigram vectors, a language's prototype the sum over its
training documents, and a document's language is the prototype of greatest
cosine after the mean of the prototypes is taken off both.

Because bundling is a sum, a document vector is its trigram counts times the
trigram vectors, and a prototype is the language's trigram counts times the
same vectors. So training is a sum of whole numbers, which no order changes:
tasks add up their trigram counts, turn them into ``DIM`` sums a language, and
the driver gets one vector of each language. All trigrams of all documents take
part; a task holds at most about ``HELD`` distinct ones before it adds them up.

Defined results: a null text or one without a letter is `und` with score 0; if
nothing can be learned every document is `und`; score is the share of the best
cosine in a softmax over languages. Repeated doc_ids are predicted one by one, null
ones are not held out and are learned from; an empty table gives no rows; only
doc_id, text and lang are read, so other columns may have any names; a text of
any length counts whole, in arrays of some 50 bytes a letter of one document.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._bytes import flat_text, groups

DIM = 1024
SEED = 20240229
#: Distinct trigrams after which a task turns its counts into sums.
HELD = 1 << 18
#: Sharpness of the softmax behind the score.
SHARPNESS = 12.0
UNKNOWN = "und"
BLANK = 0x20
#: Documents that are compared at once.
ROWS = 128

_letter: list[np.ndarray] = []
_vectors: dict[int, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """For every code point its single lower-case letter, or the blank."""
    if not _letter:
        table = np.full(0x110000, BLANK, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else ord(unicodedata.normalize("NFD", low)[0])
        _letter.append(table)
    return _letter[0]


def letter_vector(code: int) -> np.ndarray:
    if code not in _vectors:
        if len(_vectors) > 20_000:
            _vectors.clear()
        _vectors[code] = np.random.default_rng([SEED, code]).integers(0, 2, DIM).astype(np.float32) * 2 - 1
    return _vectors[code]


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    """One row for each packed trigram (21 bits a letter)."""
    a, b, c = codes >> 42, (codes >> 21) & 0x1FFFFF, codes & 0x1FFFFF
    used, place = np.unique(np.concatenate([a, b, c]), return_inverse=True)
    base = np.stack([letter_vector(int(x)) for x in used])
    n = len(codes)
    return np.roll(base, 2, axis=1)[place[:n]] * np.roll(base, 1, axis=1)[place[n : 2 * n]] * base[place[2 * n :]]


def trigrams(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed trigram, document, letters per document) of whole UTF-8 texts."""
    n = len(off) - 1
    lead = (buf & 0xC0) != 0x80
    points = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    sums = np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])
    cut = sums[off]
    letter = letter_table()[points]
    # A blank before and after each document.
    at = np.arange(len(letter)) + 2 * np.repeat(np.arange(n), np.diff(cut)) + 1
    line = np.full(len(letter) + 2 * n, BLANK, np.uint32)
    line[at] = letter
    doc = np.repeat(np.arange(n), np.diff(cut) + 2)
    kept = np.ones(len(line), bool)
    kept[1:] = (line[1:] != BLANK) | (line[:-1] != BLANK) | (doc[1:] != doc[:-1])
    line, doc = line[kept].astype(np.int64), doc[kept]
    letters = np.bincount(doc[line != BLANK], minlength=n)
    if len(line) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), letters
    code = (line[:-2] << 42) | (line[1:-1] << 21) | line[2:]
    inside = doc[:-2] == doc[2:]
    return code[inside], doc[:-2][inside], letters


def _dense(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes ascending, index of each)."""
    letters, small = np.unique(np.concatenate([code >> 42, (code >> 21) & 0x1FFFFF, code & 0x1FFFFF]) if len(code) < 1000 else _alphabet(code)), None
    size = len(letters)
    if size <= 200:
        place = np.zeros(0x200000, np.int64)
        place[letters] = np.arange(size)
        small = (place[code >> 42] * size + place[(code >> 21) & 0x1FFFFF]) * size + place[code & 0x1FFFFF]
        there = np.zeros(size**3, bool)
        there[small] = True
        some = np.flatnonzero(there)
        index = np.zeros(size**3, np.int64)
        index[some] = np.arange(len(some))
        distinct = (letters[some // size**2] << 42) | (letters[some // size % size] << 21) | letters[some % size]
        return distinct, index[small]
    return np.unique(code, return_inverse=True)


def _alphabet(code: np.ndarray) -> np.ndarray:
    there = np.zeros(0x200000, bool)
    for part in (code >> 42, (code >> 21) & 0x1FFFFF, code & 0x1FFFFF):
        there[part] = True
    return np.flatnonzero(there)


def bundle(codes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The sum of n times each trigram's vector, exact."""
    total = np.zeros(DIM, np.int64)
    for at in range(0, len(codes), 4096):
        total += (n[at : at + 4096].astype(np.float64) @ trigram_vectors(codes[at : at + 4096])).astype(np.int64)
    return total


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    sums: dict[str, np.ndarray] = {}

    def add_up() -> None:
        for name, (codes, n) in held.items():
            sums[name] = sums.get(name, 0) + bundle(codes, n)
        held.clear()

    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        names, which = langs.dictionary.to_pylist(), np.asarray(langs.indices)
        buf, off, _ = flat_text(batch.column("text"))
        for a, b in groups(off):
            code, doc, _ = trigrams(buf[off[a] : off[b]], off[a : b + 1] - off[a])
            if not len(code):
                continue
            distinct, index = _dense(code)
            lang = which[a:b][doc]
            table = np.bincount(lang * len(distinct) + index, minlength=len(names) * len(distinct)).reshape(len(names), -1)
            for k, name in enumerate(names):
                some = np.flatnonzero(table[k])
                if len(some):
                    old = held.get(name, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    merged, at = np.unique(np.concatenate([old[0], distinct[some]]), return_inverse=True)
                    held[name] = merged, np.bincount(at, weights=np.concatenate([old[1], table[k][some]])).astype(np.int64)
            if sum(len(codes) for codes, _ in held.values()) > HELD:
                add_up()
    add_up()
    for name, total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([name] * DIM, pa.string()), pa.array(np.arange(DIM, dtype=np.int32)), pa.array(total)], names=["lang", "place", "n"])


def learn(docs: DataFrame, train: Column) -> dict:
    """Prototypes from the documents where ``train`` holds and lang is known."""
    rows = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text").mapInArrow(_sums, "lang string, place int, n bigint")
    found: dict[str, np.ndarray] = {}
    for r in rows.groupBy("lang", "place").agg(F.sum("n").alias("n")).collect():
        found.setdefault(r["lang"], np.zeros(DIM))[r["place"]] = r["n"]
    langs = sorted(found)
    prototypes = np.array([found[lang] for lang in langs]).reshape(len(langs), DIM)
    prototypes /= np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-12)
    centre = prototypes.mean(axis=0) if len(langs) > 1 else np.zeros(DIM)
    shifted = prototypes - centre
    shifted /= np.maximum(np.linalg.norm(shifted, axis=1, keepdims=True), 1e-12)
    return {"langs": langs, "prototypes": shifted.astype(np.float32), "centre": centre.astype(np.float32)}


def _predict(buf: np.ndarray, off: np.ndarray, model: dict) -> tuple[list[str], np.ndarray]:
    n = len(off) - 1
    code, doc, letters = trigrams(buf, off)
    names, score = [UNKNOWN] * n, np.zeros(n)
    if not len(code) or not model["langs"]:
        return names, score
    distinct, index = _dense(code)
    docs = np.zeros((n, DIM), np.float32)
    if n * len(distinct) <= 1 << 24:
        counts = np.bincount(doc * len(distinct) + index, minlength=n * len(distinct)).reshape(n, -1).astype(np.float32)
        for at in range(0, len(distinct), 4096):
            docs += counts[:, at : at + 4096] @ trigram_vectors(distinct[at : at + 4096])
    else:
        for at in range(0, len(distinct), 4096):
            some = (index >= at) & (index < at + 4096)
            part = np.bincount(doc[some] * 4096 + index[some] - at, minlength=n * 4096).reshape(n, -1).astype(np.float32)
            docs += part[:, : min(4096, len(distinct) - at)] @ trigram_vectors(distinct[at : at + 4096])
    docs /= np.maximum(np.linalg.norm(docs, axis=1, keepdims=True), 1e-12)
    docs -= model["centre"]
    docs /= np.maximum(np.linalg.norm(docs, axis=1, keepdims=True), 1e-12)
    cosine = docs @ model["prototypes"].T
    best = cosine.argmax(axis=1)
    share = np.exp(SHARPNESS * (cosine - cosine.max(axis=1, keepdims=True)))
    share = 1.0 / share.sum(axis=1)
    for k in np.flatnonzero(letters):
        names[k], score[k] = model["langs"][best[k]], float(share[k])
    return names, score


def predict(docs: DataFrame, model: dict, *keep: Column) -> DataFrame:
    """The ``keep`` columns with lang_pred and score, from the text alone."""
    rows = docs.select(*keep, "text")
    fields = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off, _ = flat_text(batch.column("text"))
            for lo, hi in groups(off):
                for a in range(lo, hi, ROWS):
                    b = min(hi, a + ROWS)
                    names, score = _predict(buf[off[a] : off[b]], off[a : b + 1] - off[a], model)
                    yield pa.RecordBatch.from_arrays([*(batch.column(f.name).slice(a, b - a) for f in fields), pa.array(names, pa.string()), pa.array(score)], names=[*(f.name for f in fields), "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): a quarter of the documents by doc_id is never learned from."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = learn(docs, ~held_out)
    return predict(docs, model, F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"))
