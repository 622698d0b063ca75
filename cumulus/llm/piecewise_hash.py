"""Context-triggered piecewise hashing: fingerprints that survive local edits.

A rolling hash over the last seven bytes ends a chunk where it is ``-1`` modulo the block size,
so an edit changes only the chunks it touches. A chunk becomes one of 64 signature characters. The
block size is the smallest ``3 * 2**k`` that leaves about 64 chunks, halved while the signature
has under 32 characters; a fingerprint holds the signatures at that size and at twice it:
``size:signature:signature``. Two fingerprints are compared by edit distance where they share a
block size, so sizes may differ by a factor of two; otherwise they are unlike (0).

The edit distance counts insertions and deletions (a replacement is both), from the longest common
subsequence, computed with one big-integer operation per character. Likeness is one minus the
distance over the summed lengths; equal fingerprints are alike (1).

Null text is the empty text, whose fingerprint is ``3::``.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, saved

WINDOW = 7
SMALLEST = 3
PIECES = 64
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
#: What a row of the id-ordered pass is: a result, or the first or last row of a partition, with its text.
DONE, FIRST, LAST = 0, 1, 2


def rolling(data: bytes) -> np.ndarray:
    """At each byte: the sum of the last seven bytes, their weighted sum and their shifted
    exclusive-or, added up modulo 2**32."""
    b = np.concatenate([np.zeros(WINDOW - 1, np.uint32), np.frombuffer(data, np.uint8)])
    n = len(data)
    out = np.zeros(n, np.uint32)
    mixed = np.zeros(n, np.uint32)
    for age in range(WINDOW):
        at = b[WINDOW - 1 - age:WINDOW - 1 - age + n]
        out += at * np.uint32(WINDOW - age + 1)
        mixed ^= at << np.uint32(5 * age)
    return out + mixed


def _signature(data: bytes, hashes: np.ndarray, size: int) -> str:
    ends = (np.nonzero(hashes % np.uint32(size) == size - 1)[0] + 1)[:PIECES - 1].tolist()
    edges = [0, *ends]
    if edges[-1] < len(data):
        edges.append(len(data))
    view = memoryview(data)
    return "".join([LETTERS[zlib.crc32(view[a:b]) * 2654435761 >> 8 & 63] for a, b in zip(edges, edges[1:])])  # noqa: B905


def fingerprint(text: str) -> str:
    data = text.encode("utf-8", "replace")
    size = SMALLEST
    while size * PIECES < len(data):
        size *= 2
    hashes = rolling(data)
    sign = _signature(data, hashes, size)
    wide = None
    while size > SMALLEST and len(sign) < PIECES // 2:
        wide, size = sign, size // 2
        sign = _signature(data, hashes, size)
    return f"{size}:{sign}:{_signature(data, hashes, 2 * size) if wide is None else wide}"


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & at.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    total = len(a) + len(b)
    return 2 * common_length(a, b) / total if a and b else 0.0


def likeness(a: str, b: str) -> float:
    """0 to 1; 0 without a common block size."""
    if a == b:
        return 1.0
    size_a, near_a, far_a = a.split(":")
    size_b, near_b, far_b = b.split(":")
    x, y = int(size_a), int(size_b)
    if x == y:
        return max(_alike(near_a, near_b), _alike(far_a, far_b))
    if x == 2 * y:
        return _alike(near_a, far_b)
    if y == 2 * x:
        return _alike(far_a, near_b)
    return 0.0


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many of the following text's first."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def _pair(doc_id, text: str, print_: str, following: str, print_next: str) -> tuple:
    e = edited(text, following)
    print_e = fingerprint(e)
    return (doc_id, len(text), hashlib.sha256(e.encode("utf-8", "replace")).hexdigest(), print_, print_e,
            likeness(print_, print_e), likeness(print_, print_next))


_NAMES = [c.split()[0] for c in RESULT.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _results(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * len(_KINDS), _KINDS, strict=True)]


def _digest(batches):
    """A partition in order: the results of all rows but the last, and the first and last row."""
    part, last = TaskContext.get().partitionId(), None
    for b in batches:
        for at in range(0, b.num_rows, 500):
            rows, edges = [], []
            for i, text in zip(*(b.slice(at, 500).column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                print_ = fingerprint(text)
                if last is None:
                    edges.append((FIRST, i, text, print_))
                else:
                    rows.append(_pair(*last, text, print_))
                last = (i, text, print_)
            yield _edged(part, rows, edges)
    if last is not None:
        yield _edged(part, [], [(LAST, *last)])


def _edged(part: int, rows: list[tuple], edges: list[tuple]) -> pa.RecordBatch:
    whole = [*rows, *((i, None, None, print_, None, None, None) for _, i, _, print_ in edges)]
    edge = [DONE] * len(rows) + [e[0] for e in edges]
    text = [None] * len(rows) + [e[2] for e in edges]
    return pa.RecordBatch.from_arrays([pa.array([part] * len(whole), pa.int64()), pa.array(edge, pa.int32()), pa.array(text, pa.string()), *_results(whole)],
                                      ["part", "edge", "text", *_NAMES])


def _edges(batches):
    for b in batches:
        rows = [_pair(*r) for r in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")), strict=True)]
        yield pa.RecordBatch.from_arrays(_results(rows), _NAMES)


def compare(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Per document its fingerprint, and its likeness to its edited text and to the next document
    by ascending id (the first follows the last).

    Documents are range partitioned by id, into as many parts as the session's shuffles have unless
    ``parts`` is given, and each part is read in order. Its last row waits for the first one of the
    next part that has rows: these are brought together by a join on the part's number. Only part
    numbers, one for each task, are ordered in one place. Equal ids follow each other in order of a
    hash of their text; a null id is smaller than all others."""
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keys = [F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k"), F.xxhash64("text").alias("t")]
    ordered = docs.select("*", *keys).repartitionByRange(parts, "k", "t").sortWithinPartitions("k", "t")
    done = saved(in_arrow(ordered.select("doc_id", "text"), _digest, "part long, edge int, text string, " + RESULT), "prints")
    firsts = done.where(F.col("edge") == FIRST).select(F.col("part").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    lasts = done.where(F.col("edge") == LAST).select("part", "doc_id", "text", "fingerprint")
    numbers = firsts.select(F.col("next").alias("part"))
    after = numbers.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next"))
    met = lasts.join(after, "part").join(firsts, "next").select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")
    return done.where(F.col("edge") == DONE).select(*_NAMES).union(in_arrow(met, _edges, RESULT))
