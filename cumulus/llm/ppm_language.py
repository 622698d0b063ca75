"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order context tree over bytes: in a context of up to ``ORDER``
bytes, a byte seen there ``n`` times among ``N`` (``D`` of them different) costs
``-log2(n / (N + D))`` bits; an unseen one costs the escape ``-log2(D / (N + D))`` and is then
coded in the context shortened by its oldest byte, down to a uniform code over 256 bytes. A
context never seen costs nothing to leave. Statistics are frozen after training, so the cost of
every (context, byte) is fixed. A language's model is what its sample holds and no more: sorted
arrays of the strings seen, of one to ``ORDER + 1`` bytes, and how often. A text is counted as
the different strings of ``ORDER + 1`` bytes in it; the costs of a string in all languages are worked
out when it is first met and kept in a table of bounded size, and the sum over the strings is the
exact code length. The shortest code wins; the score is the winner's posterior under equal priors.

Training takes a bounded sample: about ``SAMPLE_DOCS`` labelled documents per language, chosen by
a hash of the id, whole texts. All documents are predicted. Texts are coded with A-Z lower-cased
and every run of bytes that are not letters squeezed to one space.

Null text, an empty text and one without a letter give ``und`` with score 0, as does a table
without labels; equal code lengths go to the first language in alphabetical order.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, text_lists

ORDER = 3
SAMPLE_DOCS = 250
#: Size of the table of costs in each worker.
TABLE_BYTES = 64 << 20
#: Bytes that are not letters of ASCII and not part of a longer character.
GAP = re.compile(rb"[^a-z\x80-\xff]+")


def coded(text: str) -> bytes:
    return b" " + GAP.sub(b" ", text.encode("utf-8", "replace").lower())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _grams(batches):
    """Counts of all (language, context, next byte) up to ORDER, as strings of bytes."""
    counts: dict[tuple[str, int], dict[int, int]] = {}
    for langs, texts in text_lists(batches, "lang", "text"):
        for lang in set(langs):
            raw = [np.frombuffer(coded(t), np.uint8).astype(np.uint32) for x, t in zip(langs, texts, strict=True) if x == lang]
            for size in range(1, ORDER + 2):
                keys = []
                for b in raw:
                    n = len(b) - size + 1
                    if n > 0:
                        k = np.zeros(n, np.uint32)
                        for j in range(size):
                            k = (k << np.uint32(8)) | b[j:j + n]
                        keys.append(k)
                if keys:
                    c = counts.setdefault((lang, size), {})
                    for k, n in zip(*(x.tolist() for x in np.unique(np.concatenate(keys), return_counts=True)), strict=True):
                        c[k] = c.get(k, 0) + n
    for (lang, size), c in counts.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(c)), pa.array([size] * len(c), pa.int64()), pa.array(list(c), pa.int64()),
             pa.array(list(c.values()), pa.int64())], ["lang", "size", "gram", "n"])


class _Tree:
    """One language: the strings seen, by their length, and of every context how many bytes followed
    it and how many different ones."""

    def __init__(self, grams: list[dict[int, int]]):
        self.levels = []
        for size in range(1, ORDER + 2):
            gram = np.array(sorted(grams[size]), np.int64)
            n = np.array([grams[size][g] for g in gram.tolist()], np.float64)
            context, at = np.unique(gram >> 8, return_inverse=True)
            total, kinds = (np.bincount(at, w, minlength=len(context)) if len(gram) else np.zeros(0) for w in (n, None))
            # bits of each string behind its context, and of the escape from each context
            self.levels.append((gram, (-np.log2(n / (total + kinds)[at])).astype(np.float32) if len(gram) else np.zeros(0, np.float32),
                                context, (-np.log2(kinds / (total + kinds))).astype(np.float32)))

    def costs(self, strings: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each string, in its longest context that leads there."""
        out = np.full(len(strings), 8.0, np.float32)
        for size, (gram, bits, context, escape) in enumerate(self.levels, 1):
            if len(gram):
                own = strings & (1 << 8 * size) - 1
                before, at = _find(context, own >> 8)
                out[before] += escape[at[before]]
                seen, at = _find(gram, own)
                out[seen] = bits[at[seen]]
        return out


def _find(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return known[at] == asked, at


class Model:
    """Frozen context trees of all languages."""

    def __init__(self, grams: dict[str, list[dict[int, int]]]):
        self.langs = sorted(grams)
        self.trees = [_Tree(grams[lang]) for lang in self.langs]
        self._forget()

    def _forget(self) -> None:
        self.row: dict[int, int] = {}
        self.table = np.zeros((1 << 10, len(self.langs)), np.float32)

    def __getstate__(self):  # the table of costs is filled where it is used
        return {"langs": self.langs, "trees": self.trees}

    def __setstate__(self, state):
        self.__dict__ |= state
        self._forget()

    def _rows(self, strings: np.ndarray) -> np.ndarray:
        asked = strings.tolist()
        found = np.fromiter(map(self.row.get, asked, repeat(-1)), np.int64, len(asked))
        new = np.flatnonzero(found < 0)
        if len(new):
            if (len(self.row) + len(new)) * 4 * len(self.langs) > TABLE_BYTES and self.row:
                self._forget()
                return self._rows(strings)
            n, own = len(self.row), strings[new].astype(np.int64)
            if n + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((max(len(self.table), len(new)), len(self.langs)), np.float32)])
            self.table[n:n + len(new)] = np.stack([t.costs(own) for t in self.trees], axis=1)
            found[new] = np.arange(n, n + len(new))
            self.row.update(zip(own.tolist(), range(n, n + len(new)), strict=True))
        return found

    def bits(self, text: str) -> np.ndarray:
        """Code length of ``text`` in every language."""
        b = np.frombuffer(coded(text), np.uint8).astype(np.uint32)
        if len(b) <= ORDER:  # too short for the longest context: coded after spaces
            b = np.concatenate([np.full(ORDER, 32, np.uint32), b])
        strings = np.zeros(len(b) - ORDER, np.uint32)
        for k in range(ORDER + 1):
            strings = strings << np.uint32(8) | b[k:len(b) - ORDER + k]
        strings, n = np.unique(strings, return_counts=True)
        rows = self._rows(strings)  # may empty the table
        return n.astype(np.float64) @ self.table[rows]

    def predict(self, text: str) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return "und", 0.0
        bits = self.bits(text)
        best = int(bits.argmin())
        return self.langs[best], float(1.0 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum())


def held_out(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def train(docs: DataFrame, lang: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Model from the labelled documents that are not held out. What comes to the driver, and the size
    of the model, is bounded by the sample: its different four-byte strings per language, 12 bytes each."""
    seen = docs.where(F.col(lang).isNotNull() & ~held_out()).select("doc_id", F.col(lang).cast("string").alias("lang"), "text")
    sizes = {r.lang: r.n for r in seen.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model({})
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample_docs / n) * (1 << 20))])
    picked = seen.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")]).select("lang", "text")
    grams: dict[str, list[dict[int, int]]] = {k: [{} for _ in range(ORDER + 2)] for k in sizes}
    counted = in_arrow(picked, _grams, "lang string, size long, gram long, n long")
    for r in counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")).collect():
        grams[r.lang][r.size][r.gram] = r.n
    return Model(grams)


def _predict(batches, held):
    model = held.value
    for ids, out, texts in text_lists(batches, "doc_id", "held_out", "text"):
        found = [model.predict(t) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(out, pa.bool_()), pa.array([f[0] for f in found], pa.string()),
             pa.array([f[1] for f in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score. The model's size is bounded by the
    training sample, so it is broadcast."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text"),
                    _predict, "doc_id long, held_out boolean, lang_pred string, score double", held)
