"""Byte-level BPE ids through the tokenizers library, with a bounded memo of words.

The pre-tokenizer of such a vocabulary never puts a white-space character after another
character into one token, so a text may be cut before every white-space run and its parts
encoded alone. Texts are split at spaces and line feeds a batch at a time; each different word of a
batch is looked up once, a new one goes to the library, and the ids of all texts are gathered from
the pool of known words by their places in it. A new word of Latin letters, or of these and ASCII marks
behind them, goes straight to the library's BPE model: there the pre-tokenizer would cut between
letters and marks and nowhere else. Many such words go at once, joined by a byte that no merge rule
knows, so that nothing is merged across it. All other words go through the whole library. A full memo
is emptied.
A vocabulary with another pre-tokenizer, and a text that holds one of the added tokens, goes to the
library whole; so does, in parts, a text with other runs of white space.
"""

from __future__ import annotations

import functools
import json
import os
import re
import sys
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer  # noqa: E402

#: White space of the pre-tokenizer's pattern (Unicode White_Space).
SPACES = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
PARTS = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
BLANK = frozenset(SPACES)
#: Words that a worker remembers, some 200 bytes each.
MEMO = 1_000_000
GROUP_CHARS = 2_000_000
#: Numbers of words: a new one, one whose end is white space, so that the cut after it would fall inside
#: a run, and the word without ids.
NEW, ODD, NONE = -2, -1, 0
#: A word's number may have a second one above it: that of the marks at its end.
SECOND = 40
#: Latin letters (U+00D7 and U+00F7 are none) and ASCII marks but the apostrophe, which may stand in
#: contractions.
SIMPLE = re.compile("(\n?)([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+)([!-&(-/:-@\\[-`{-~]*)")
#: The characters that stand for bytes in the vocabulary: printable ones for themselves, the others
#: in order from U+0100.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = [b for b in range(256) if b not in _PRINTED]
SHOWN = {b: 0x100 + _OTHERS.index(b) for b in _OTHERS}


#: What Latin letters beyond ASCII look like there.
_LETTERS = {c: chr(c).encode().decode("latin-1").translate(SHOWN) for c in range(0xC0, 0x250)}
JOINED = 200


def shown(letters: str) -> str:
    return letters if letters.isascii() else letters.translate(_LETTERS)


class _Pool:
    """The ids of all known words in one array, by the number of the word."""

    def __init__(self, dtype):
        self.ids, self.used = np.zeros(1 << 16, dtype), 0
        self.start, self.size, self.words = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 1

    @staticmethod
    def _room(a, used, more):
        return a if used + more <= len(a) else np.concatenate([a, np.zeros(max(len(a), more), a.dtype)])

    def add(self, ids, sizes) -> range:
        """Words with these ids, one after the other; returns their numbers."""
        n, k, m = len(sizes), self.words, len(ids)
        self.ids = self._room(self.ids, self.used, m)
        self.start, self.size = self._room(self.start, k, n), self._room(self.size, k, n)
        self.ids[self.used:self.used + m] = ids
        self.size[k:k + n] = sizes
        self.start[k:k + n] = self.used + np.cumsum(self.size[k:k + n]) - self.size[k:k + n]
        self.used += m
        self.words += n
        return range(k, k + n)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these words in a row, and where each word ends."""
        both = np.empty(2 * len(numbers), np.int64)
        both[::2], both[1::2] = numbers & (1 << SECOND) - 1, numbers >> SECOND
        sizes = self.size[both]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.start[both] - ends + sizes, sizes) + np.arange(total)], ends[1::2]


class ByteTokens:
    def __init__(self, path: str, memo: int = MEMO):
        self.most = memo
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_part = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                        and not pre.get("add_prefix_space") and not spec.get("normalizer")
                        and spec["model"]["type"] == "BPE" and not spec["model"].get("ignore_merges"))
        self.added = [a["content"] for a in spec.get("added_tokens", [])]
        self.code = "H" if self.tok.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = {"H": "<u2", "I": "<u4"}[self.code]
        line_feed = self.tok.encode("\n", add_special_tokens=False).ids
        self.line_feed, self.space = line_feed[0] if len(line_feed) == 1 else None, chr(SHOWN[32])
        if self.by_part:
            rules = "".join(x for m in spec["model"]["merges"] for x in m)
            vocab = spec["model"]["vocab"]
            # a byte that UTF-8 has no use for; by itself in the vocabulary, and in no merge rule
            self.between = next((c for c in map(chr, (0xC0, 0xC1, *range(0xF5, 0x100))) if c in vocab and c not in rules), None)
            self.between_id = vocab.get(self.between)
            plain = spec | {"pre_tokenizer": None, "post_processor": None, "decoder": None, "added_tokens": []}
            self.model = Tokenizer.from_str(json.dumps(plain))
        self.raw: dict[str, bytes] = {}
        self._empty()

    def _empty(self) -> None:
        self.pool, self.memo, self.first, self.marks = _Pool(self.dtype), {}, {}, {}

    def _pack(self, ids: list[int]) -> bytes:
        a = array(self.code, ids)
        if sys.byteorder == "big":
            a.byteswap()
        return a.tobytes()

    def _merged(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of the model's characters, in a row, and the number of each word's."""
        if not parts:
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        if self.between is None:
            each = [[t.id for t in self.tok.model.tokenize(p)] for p in parts]
            return np.array([i for e in each for i in e], self.dtype), np.array([len(e) for e in each])
        joined = [self.between.join(parts[k:k + JOINED]) + self.between for k in range(0, len(parts), JOINED)]
        ids = np.concatenate([np.array(e.ids, self.dtype) for e in self.model.encode_batch_fast(joined, add_special_tokens=False)])
        ends = ids == self.between_id
        return ids[~ends], np.diff(np.flatnonzero(ends), prepend=-1) - 1

    def _learn(self, words: list[str]) -> None:
        """Numbers for new words. A word stands for itself behind a space, or for itself if a line feed
        leads it."""
        memo, marks, match = self.memo, self.marks, SIMPLE.fullmatch
        spaced: dict[str, None] = {}
        led: dict[str, None] = {}
        tailed: list[tuple[str, str, str]] = []
        others: list[str] = []
        for w in words:
            if w.isascii() and w.isalpha():
                spaced[w] = None
            elif m := match(w):
                lead, letters, tail = m.groups()
                if tail:
                    tailed.append((w, lead + letters, tail))
                if lead + letters not in memo:
                    (led if lead else spaced)[lead + letters] = None
            elif not w or w[-1] in BLANK:
                memo[w] = ODD
            else:
                others.append(w)
        ids, n = self._merged([self.space + shown(w) for w in spaced])
        memo.update(zip(spaced, self.pool.add(ids, n), strict=True))
        ids, n = self._merged([shown(w[1:]) for w in led])
        memo.update(zip(led, self.pool.add(np.insert(ids, np.cumsum(n) - n, self.line_feed), n + 1), strict=True))
        new = list(dict.fromkeys(t for _, _, t in tailed if t not in marks))
        marks.update(zip(new, self.pool.add(*self._merged(new)), strict=True))
        memo.update((w, memo[base] | marks[tail] << SECOND) for w, base, tail in tailed)
        each = [self.tok.encode(w if w[0] == "\n" else " " + w, add_special_tokens=False).ids for w in others]
        memo.update(zip(others, self.pool.add([i for e in each for i in e], [len(e) for e in each]), strict=True))

    def _learn_first(self, words: list[str]) -> None:
        """Numbers for words at the start of a text."""
        for w in words:
            if not w or w[-1] in BLANK:
                self.first[w] = ODD
            else:
                ids = np.frombuffer(self._whole(w), self.dtype)
                self.first[w] = self.pool.add(ids, np.array([len(ids)]))[0]

    def _whole(self, text: str) -> bytes:
        """White space in runs: cut before each run instead."""
        if not self.by_part or any(a in text for a in self.added):
            return self._pack(self.tok.encode(text, add_special_tokens=False).ids)
        parts = PARTS.findall(text)
        raw = self.raw
        new = list(set(parts).difference(raw))
        if len(raw) + len(new) > self.most // 4:
            raw.clear()
            new = list(set(parts))
        for p, e in zip(new, self.tok.encode_batch_fast(new, add_special_tokens=False), strict=True):
            raw[p] = self._pack(e.ids)
        return b"".join(map(raw.__getitem__, parts))

    def _group(self, texts: list[str]) -> list[bytes]:
        column = pa.array([t.replace("\n", " \n") for t in texts], pa.large_string())
        split = pc.split_pattern(column, " ")
        at = split.offsets.to_numpy()
        coded = split.values.dictionary_encode()
        # no word has a space, so all different ones come as one string
        all_words = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        words, where = pc.binary_join(all_words, pa.scalar(" ", pa.large_string()))[0].as_py().split(" "), coded.indices.to_numpy()
        lead = [words[k] for k in where[at[:-1]].tolist()]
        if len(self.memo) + len(self.first) > self.most:
            self._empty()
        numbers = self._numbers(self.memo, words, self._learn)[where]
        numbers[at[:-1]] = self._numbers(self.first, lead, self._learn_first)
        odd = np.add.reduceat(numbers == ODD, at[:-1]) > 0
        numbers[numbers == ODD] = NONE
        ids, ends = self.pool.gather(numbers)
        raw, width = ids.tobytes(), ids.itemsize
        edges = (np.concatenate([[0], ends])[at] * width).tolist()
        return [self._whole(t) if o and t else raw[s:e] for t, o, s, e in zip(texts, odd.tolist(), edges[:-1], edges[1:], strict=True)]

    @staticmethod
    def _numbers(memo: dict[str, int], words: list[str], learn) -> np.ndarray:
        found = np.fromiter(map(memo.get, words, repeat(NEW)), np.int64, len(words))
        new = np.flatnonzero(found == NEW)
        if len(new):
            asked = list(dict.fromkeys(words[k] for k in new.tolist()))
            learn(asked)
            found[new] = [memo[words[k]] for k in new.tolist()]
        return found

    def packed(self, texts: list[str]) -> list[bytes]:
        """Per text its ids, packed as ``dtype``."""
        out: list[bytes] = []
        some, chars = [], 0
        for t in texts:
            if not self.by_part or self.line_feed is None or any(a in t for a in self.added):
                out += self._group(some) if some else []
                some, chars = [], 0
                out.append(self._whole(t))
                continue
            some.append(t)
            chars += len(t)
            if chars >= GROUP_CHARS:
                out += self._group(some)
                some, chars = [], 0
        return out + (self._group(some) if some else [])


@functools.lru_cache(maxsize=2)
def byte_tokens(path: str, memo: int = MEMO) -> ByteTokens:
    """One per worker process and file."""
    return ByteTokens(path, memo)
