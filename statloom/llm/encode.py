r"""Token ids of whole columns, as the tokenizers library gives them.

Both public vocabularies cut a text into words by a fixed pattern and then
encode each word by itself, so a word's ids never depend on its neighbours.
Texts of ASCII and U+00C0-U+00FF without control characters are cut by array
arithmetic; each distinct word is encoded once by the library's own model and
kept in a bounded table of the worker. Every other text, and every tokenizer
whose cutting is not one of these two, goes through the library whole.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa

from ._bytes import BYTE_CODE, Rolling, groups

#: Distinct words that a worker keeps; beyond it the table starts anew.
TABLE_WORDS = 600_000
#: Bytes of text handed to the library at once.
BATCH_BYTES = 1 << 18

LETTER, DIGIT, SPACE, OTHER = 1, 2, 3, 0
_KIND = np.zeros(256, np.uint8)
for _b in range(256):
    _c = chr(_b)
    if (_b < 128 and _c.isalpha()) or (_b >= 0xC0 and _b not in (0xD7, 0xF7)):
        _KIND[_b] = LETTER
    elif 48 <= _b <= 57:
        _KIND[_b] = DIGIT
    elif _b == 32 or 9 <= _b <= 13:
        _KIND[_b] = SPACE
_LOW = np.array([b + 32 if 65 <= b <= 90 or (0xC0 <= b <= 0xDE and b != 0xD7) else b for b in range(256)], np.uint8)
#: Bytes that keep a text off the fast way: control characters and lead bytes other than C3.
_ODD = np.array([b < 9 or 14 <= b < 32 or b == 127 or 0xC0 <= b <= 0xC2 or b >= 0xC4 for b in range(256)])

# Fixed value: the printable stand-in for each byte in byte-level vocabularies.
_plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
_stand = {b: chr(b) for b in _plain}
_stand |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _stand)}

# Fixed value: the two word patterns that the arithmetic below follows.
GPT2_CUT = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
WORD_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_encoders: dict[str, Encoder] = {}


def forget() -> None:
    """Drops the worker's word tables; other work does not need them."""
    _encoders.clear()


def encoder(path: str) -> Encoder:
    """The worker's encoder for this file; its word table lives as long as the worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path) as f:
            spec = json.load(f)
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.cut = None
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        # An added token's string is ordinary text here, but only if the library can be told so.
        if all(t["special"] for t in spec.get("added_tokens", [])):
            if pre == GPT2_CUT and norm is None:
                self.cut = "gpt2"
            elif pre.get("type") == "Sequence" and norm and [n["type"] for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
                if pre["pretokenizers"][0].get("pattern") == {"Regex": WORD_CUT}:
                    self.cut = "word"
        self._reset()

    def _reset(self) -> None:
        self.of: dict[int, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _learn(self, key: int, word: str) -> int:
        k = len(self.of)
        if k == len(self.begin):
            self.begin, self.size = np.resize(self.begin, 2 * k), np.resize(self.size, 2 * k)
        ids = [t.id for t in self.library.model.tokenize("".join(map(_stand.__getitem__, word.encode())))]
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used : self.used + len(ids)] = ids
        self.begin[k], self.size[k] = self.used, len(ids)
        self.used += len(ids)
        self.of[key] = k
        return k

    def _words(self, text: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, document) of each word of Latin-1 texts, by the vocabulary's pattern."""
        n, word = len(text), self.cut == "word"
        kind = _KIND[text]
        new = np.zeros(n + 1, bool)
        new[off] = True
        begin = new[:n].copy()
        begin[1:] |= kind[1:] != kind[:-1]
        if word:
            begin |= kind == DIGIT
        else:
            # The last blank before a word: a space joins the word, any other stands alone.
            after = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~new[1:n]) + 1
            begin[after - 1] = True
            begin[after] = text[after - 1] != 32
        mark = np.flatnonzero((text == 39) & begin)
        mark = mark[mark + 1 < n]
        mark = mark[(kind[mark + 1] == LETTER) & ~new[mark + 1]]
        if len(mark):
            one = text[mark + 1]
            two = np.where((mark + 2 < n) & ~new[np.minimum(mark + 2, n)], text[np.minimum(mark + 2, n - 1)], 0)
            short = np.isin(one, list(b"stmd"))
            double = ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))
            hit = short | double
            begin[mark[hit] + 1] = False
            rest = mark[hit] + np.where(double[hit], 3, 2)
            begin[rest[rest < n]] = True
        start = np.flatnonzero(begin)
        end = np.append(start[1:], n)
        if word:
            kept = kind[start] != SPACE
            start, end = start[kept], end[kept]
        return start, end, np.searchsorted(off, start, "right") - 1

    def _fast(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lead = buf == 0xC3
        text = buf.copy()
        text[1:][lead[:-1]] |= 0x40
        text = text[~lead]
        sums = np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])
        off = off - sums[off]
        if self.cut == "word":
            text = _LOW[text]
        n = len(off) - 1
        if not len(text):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        start, end, doc = self._words(text, off)
        found = pa.array(Rolling(BYTE_CODE[text]).spans(start, end)).dictionary_encode()
        code, keys = np.asarray(found.indices), np.asarray(found.dictionary)
        index = np.array([self.of.get(k, -1) for k in keys.tolist()], np.int64)
        missing = np.flatnonzero(index < 0)
        if len(self.of) + len(missing) > TABLE_WORDS:
            self._reset()
            index[:], missing = -1, np.arange(len(keys))
        if len(missing):
            raw = text.tobytes().decode("latin-1")
            first = np.empty(len(keys), np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            for k in missing.tolist():
                w = int(first[k])
                index[k] = self._learn(int(keys[k]), raw[start[w] : end[w]])
        word = index[code]
        size = self.size[word]
        total = int(size.sum())
        ids = self.flat[np.repeat(self.begin[word] - (np.cumsum(size) - size), size) + np.arange(total)]
        return ids, np.bincount(doc, weights=size, minlength=n).astype(np.int64)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        out, at = [], 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size < BATCH_BYTES):
                size += len(texts[to])
                to += 1
            out += [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts[at:to], add_special_tokens=False)]
            at = to
        return out

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, how many of them each document has)."""
        n = len(off) - 1
        odd = _ODD[buf]
        sums = np.concatenate([[0], np.cumsum(odd, dtype=np.int64)])
        slow = sums[off[1:]] > sums[off[:-1]]
        if self.cut is None:
            slow = np.ones(n, bool)
        if not slow.any():
            return self._fast(buf, off)
        size = np.diff(off)
        held = np.repeat(~slow, size)
        ids, fast = self._fast(buf[held], np.concatenate([[0], np.cumsum(size[~slow])]))
        raw = buf.tobytes()
        whole = self._whole([raw[off[k] : off[k + 1]].decode() for k in np.flatnonzero(slow)])
        count = np.zeros(n, np.int64)
        count[~slow] = fast
        count[slow] = [len(x) for x in whole]
        out = np.zeros(count.sum(), np.uint32)
        is_slow = np.repeat(slow, count)
        out[~is_slow] = ids
        out[is_slow] = np.concatenate(whole)
        return out, count

    def with_end(self, buf: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids with ``end_id`` after each document, offsets of the documents in them)."""
        ids, count = self.encode(buf, off)
        begin = np.concatenate([[0], np.cumsum(count + 1)])
        out = np.full(begin[-1], end_id, np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(count)), count)] = ids
        return out, begin


def encoded_groups(path: str, buf: np.ndarray, off: np.ndarray, end_id: int):
    """(a, b, ids, offsets) for runs of whole documents."""
    held = encoder(path)
    for a, b in groups(off):
        yield a, b, *held.with_end(buf[off[a] : off[b]], off[a : b + 1] - off[a], end_id)
