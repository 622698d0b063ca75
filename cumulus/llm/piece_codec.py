"""Exact merge-type (BPE) SentencePiece encoding by backtracking, and decoding.

A segmentation is the one that repeated best-score merging gives exactly when every token is
its own encoding and every two neighbours stay apart when their joined text is merged again. So
a word is encoded left to right: take the longest piece that starts here (Aho-Corasick over the
vocabulary), accept it if it is compatible with the token before it, else try the next shorter
piece; if none is left, mark the position as failed in a bitfield and step back. Compatibility
is decided by re-merging the two tokens' text and is remembered.

No piece of such a vocabulary has the word mark after another character (checked on loading), so
merging never crosses the start of a word and words can be remembered. The memo is bounded: when
it is full it is emptied. Characters outside the vocabulary become byte pieces; they never merge.

Null text is the empty text: begin and end ids only, decoded to the empty text.
"""

from __future__ import annotations

import functools
import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, text_lists

MARK = "▁"
SEGMENT = re.compile(f"{MARK}+[^{MARK}]*")
MEMO_WORDS = 400_000
MEMO_PAIRS = 400_000


class _Memo(dict):
    """Bounded memo of a function of one key."""

    def __init__(self, make, most):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


class PieceCodec:
    def __init__(self, model_file: str):
        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        self.ids = {sp.id_to_piece(i): i for i in range(n) if i not in special}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(sp.is_unknown(i) for i in self.bytes):
            raise ValueError("the model has no byte pieces")
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("a piece goes beyond the start of a word")
        if sp.encode("a  b ") != sp.encode("a") + sp.encode("a  b ")[len(sp.encode("a")):] or sp.encode(" ") == []:
            raise ValueError("the model changes spaces")
        self.chars = {p for p in self.ids if len(p) == 1}
        self.find = ahocorasick.Automaton()
        for p in self.ids:
            self.find.add_word(p, len(p))
        self.find.make_automaton()
        self.apart = _Memo(self._stay_apart, MEMO_PAIRS)
        self.alone = _Memo(lambda p: self.merge(p) == [p], MEMO_PAIRS)
        self.shorter = _Memo(self._next_shorter, MEMO_PAIRS)
        self.word = _Memo(lambda w: self._packed(MARK + w), MEMO_WORDS)
        self.rest = _Memo(self._packed, MEMO_WORDS)
        self.newline = "\n" not in self.chars
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (sp.bos_id(), sp.eos_id()))
        self.line_feed = np.array([self.bytes[10]], "<u4").tobytes()

    def merge(self, text: str) -> list[str]:
        """Repeatedly join the best-scored neighbours, the leftmost of equals."""
        parts = list(text)
        score = self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stay_apart(self, pair: tuple[str, str]) -> bool:
        return self.merge(pair[0] + pair[1]) == [*pair]

    def _next_shorter(self, piece: str) -> str | None:
        return next((piece[:k] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.ids), None)

    def _backtrack(self, text: str) -> list[str]:
        """Pieces of a text all of whose characters are pieces."""
        n = len(text)
        longest = [0] * n
        for end, size in self.find.iter(text):  # by end, so the last one for a start is the longest
            longest[end - size + 1] = size
        failed = bytearray(n + 1)
        tokens: list[str] = []
        apart, shorter, alone = self.apart, self.shorter, self.alone
        pos, token = 0, text[:longest[0]]
        while True:
            while True:
                end = pos + len(token)
                if not failed[end] and alone[token] and (not tokens or apart[(tokens[-1], token)]):
                    tokens.append(token)
                    pos = end
                    break
                token = shorter[token]
                if token is None:
                    failed[pos] = 1
                    token = tokens.pop()  # its end has failed now, so a shorter one is next
                    pos -= len(token)
            if pos == n:
                return tokens
            token = text[pos:pos + longest[pos]]

    def _packed(self, text: str) -> bytes:
        out: list[int] = []
        k, n = 0, len(text)
        while k < n:
            if text[k] in self.chars:
                e = k + 1
                while e < n and text[e] in self.chars:
                    e += 1
                out += [self.ids[p] for p in self._backtrack(text[k:e])]
                k = e
            else:
                out += [self.bytes[b] for b in text[k].encode("utf-8", "replace")]
                k += 1
        return np.array(out, "<u4").tobytes()

    def packed(self, text: str) -> bytes:
        """Ids of ``text`` without begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            words = [s[1:] for s in SEGMENT.findall(MARK + text.replace(" ", MARK))]
        else:
            words = text.split(" ")
        if not (self.newline and "\n" in text):
            return b"".join(map(self.word.__getitem__, words))
        out = []
        for w in words:
            if "\n" in w:
                first, *more = w.split("\n")
                out.append(self.word[first])
                for m in more:
                    out.append(self.line_feed)
                    if m:
                        out.append(self.rest[m])
            else:
                out.append(self.word[w])
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        """Ids with begin and end."""
        return np.frombuffer(self.begin + self.packed(text) + self.end, "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


@functools.lru_cache(maxsize=2)
def codec(model_file: str) -> PieceCodec:
    """One codec per worker process and model."""
    return PieceCodec(model_file)


def _digest(batches, model_file):
    c = codec(model_file)
    for ids, texts in text_lists(batches, "doc_id", "text"):
        n, a, b = [], [], []
        for t in texts:
            packed = c.begin + c.packed(t) + c.end
            n.append(len(packed) // 4)
            a.append(hashlib.sha256(packed).hexdigest())
            b.append(hashlib.sha256(c.decode(np.frombuffer(packed, "<u4").tolist()).encode("utf-8")).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def digests(docs: DataFrame, model_file: str) -> DataFrame:
    """Per document: number of ids, digest of the ids and of the text decoded from them."""
    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _digest,
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", model_file)


def _encode(batches, model_file):
    c = codec(model_file)
    for ids, texts in text_lists(batches, "doc_id", "text"):
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([c.encode(t) for t in texts], pa.list_(pa.int32()))],
            ["doc_id", "ids"])


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """Per document: the ids with begin and end."""
    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _encode,
                    "doc_id long, ids array<int>", model_file)


def _decode(batches, model_file):
    c = codec(model_file)
    for b in batches:
        texts = [c.decode(x or []) for x in b.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """Per document: the text of its ids."""
    return in_arrow(encoded.select("doc_id", "ids"), _decode, "doc_id long, text string", model_file)
