"""Importance resampling towards a target distribution.

A text's features are its runs of one to three plain words; a feature's bucket is a checksum modulo
``BUCKETS``. Counting the buckets of all rows and of the target's gives one gain per bucket, an array
of ``BUCKETS`` numbers that is sent to every task; a row's weight is the sum of gains over its
features, and its score the weight plus Gumbel noise drawn from a hash of its id. Taking the highest
scores is then a draw without replacement in proportion to exp(weight).

The checksums of whole documents are computed at once: a CRC-32 of joined strings follows from those
of the parts by a linear map that depends on the length of the second, so each different word is
read once and features are table look-ups.

The rows to draw are found without sorting all of them. Every scored row has a key of its own
(score, id, row number). In each round every partition takes the median of its keys on either side
of the last pivot; the median of these medians, weighted by the keys they stand for, is the next
pivot, and counting the keys beyond it discards the side that the cutoff can't be in - at least an
eighth of the keys in any round, about half as a rule. The driver holds one row per partition and
round. Rows that are still in question are rewritten when they are few, so all rounds together read
a few times the key table. When at most ``FINISH`` keys are left they are ordered on the spot. The
winners alone are sorted, by ranges; a prefix sum over partition sizes gives their ranks.

Null text has no words; a null id stands as the empty text in the hash, and comes last among equal
scores. Rows with equal score and id are ranked in the order in which they were stored; each counts.
Rows with fewer than ``MIN_WORDS`` words get a score and are never drawn. An empty table gives no
rows; an empty target gives the gains of counts of 0. Other columns are kept by ``resampled``.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_arrow, saved
from .plain_words import in_parts, raw_texts, words

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = 42
SCALE = 1000
FINISH = 5000
BLOCK = 1 << 20
SHRINK = 4
MEMO = 400_000
LONGEST = 64
NO_ID = (1 << 63) - 1
SCORES = "n_words long, n_features long, weight long, score long, row long"


@functools.cache
def _tables() -> np.ndarray:
    """For each length up to ``LONGEST``, and each of the four bytes of a CRC-32: what the byte becomes
    after so many bytes of zeros."""
    out = np.zeros((LONGEST + 1, 4, 256), np.uint32)
    one = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, LONGEST + 1):
        out[n] = one[out[n - 1] & np.uint32(255)] ^ (out[n - 1] >> np.uint32(8))
    return out


def _after(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The checksums moved by ``length`` bytes."""
    t, left = _tables(), length
    while left.max() > LONGEST:  # long words in several steps
        step = np.minimum(left, LONGEST)
        crc, left = _moved(t, crc, step), left - step
    return _moved(t, crc, left)


def _moved(t, crc, n):
    at = n * 4
    flat = t.reshape(-1, 256)
    return (flat[at, crc & np.uint32(255)] ^ flat[at + 1, crc >> np.uint32(8) & np.uint32(255)]
            ^ flat[at + 2, crc >> np.uint32(16) & np.uint32(255)] ^ flat[at + 3, crc >> np.uint32(24)])


class _Words(dict):
    """Checksum of a word, and its length beyond 32 bits."""

    def __missing__(self, word):
        if len(self) >= MEMO:
            self.clear()
        v = self[word] = zlib.crc32(word) | len(word) << 32
        return v


_KNOWN = _Words()
_SPACE = np.uint32(zlib.crc32(b" "))


def buckets(text: list[bytes]) -> np.ndarray:
    """The bucket of every feature."""
    if not text:
        return np.empty(0, np.int64)
    v = np.fromiter(map(_KNOWN.__getitem__, text), np.int64, len(text))
    one, length = (v & 0xFFFFFFFF).astype(np.uint32), v >> 32
    found, last = [one], one
    for k in (1, 2):
        if len(text) > k:
            spaced = _moved(_tables(), last[:-1], np.ones(len(last) - 1, np.int64)) ^ _SPACE
            last = _after(spaced, length[k:]) ^ one[k:]
            found.append(last)
    return np.concatenate(found) % np.uint32(BUCKETS)


def _count(batches):
    total = np.zeros(BUCKETS, np.int64)
    for b in in_parts(batches):
        for text in raw_texts(b, "text"):
            total += np.bincount(buckets(words(text)), minlength=BUCKETS) if text else 0
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])


def counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Number of features in each bucket; ``BUCKETS`` numbers at most come to the driver."""
    out = np.zeros(BUCKETS, np.int64)
    found = in_arrow(docs.select(F.col(text).alias("text")), _count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in found.collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratio = ((t + 1) * s_all / ((s + 1) * t_all) for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist(), strict=True))
    return np.array([math.floor(SCALE * math.log(r)) for r in ratio], np.int64)


def noise(key: str, seed: int = SEED) -> int:
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(batches, gain, seed):
    row = TaskContext.get().partitionId() << 40
    for b in in_parts(batches):
        n, n_features, weight, score = [], [], [], []
        for key, text in zip(b.column("id").to_pylist(), raw_texts(b, "text"), strict=True):
            w = words(text)
            found = buckets(w)
            n.append(len(w))
            n_features.append(len(found))
            weight.append(int(gain[found].sum()) if len(found) else 0)
            score.append(weight[-1] + noise(key, seed))
        yield pa.RecordBatch.from_arrays([b.column("whole"), *[pa.array(c, pa.int64()) for c in (n, n_features, weight, score, range(row, row + len(n)))]],
                                         ["whole", *[c.split()[0] for c in SCORES.split(", ")]])
        row += len(n)


def scored(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, keep: tuple[str, ...] = ("*",)) -> DataFrame:
    """``docs`` as one struct ``whole`` with weights and scores, on shared storage: the row numbers in
    them are fixed from then on."""
    rows = docs.select(F.struct(*keep).alias("whole"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["whole"], *T._parse_datatype_string(SCORES).fields])
    return saved(in_arrow(rows, _score, schema, gain, seed), "scores")


# ---- selection: keys (a, b, c) ascending; a is the negative score, b the id, c the row ----

def _weighted_median(keys: list[tuple], weights: list[int]) -> tuple | None:
    """The first key up to which at least half of the weight lies."""
    total, seen = sum(weights), 0
    for key, w in sorted(zip(keys, weights, strict=True)):
        seen += w
        if 2 * seen >= total and w:
            return key
    return None


def _below(key, a, b, c):
    """Which keys are smaller than ``key``."""
    return (a < key[0]) | (a == key[0]) & ((b < key[1]) | (b == key[1]) & (c < key[2]))


def _median(a, b, c):
    order = np.lexsort((c, b, a))
    k = order[(len(order) - 1) // 2]
    return int(a[k]), int(b[k]), int(c[k])


def _sides(batches, low, high, pivot, size):
    """Of the keys from ``low`` to below ``high``: number and median of those up to the pivot, and of
    those beyond it. Blocks bound the memory; a partition's median is the weighted one of its blocks'."""
    medians, sizes = ([], []), ([], [])

    def block(cols):
        a, b, c = (np.concatenate(x) for x in zip(*cols, strict=True))
        first = np.ones(len(a), bool) if pivot is None else _below(pivot, a, b, c) | (a == pivot[0]) & (b == pivot[1]) & (c == pivot[2])
        for k, m in enumerate((first, ~first)):
            if m.any():
                medians[k].append(_median(a[m], b[m], c[m]))
                sizes[k].append(int(m.sum()))

    held, n = [], 0
    for batch in batches:
        a, b, c = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("a", "b", "c"))
        inside = np.ones(len(a), bool)
        if low is not None:
            inside &= ~_below(low, a, b, c) & ~((a == low[0]) & (b == low[1]) & (c == low[2]))
        if high is not None:
            inside &= _below(high, a, b, c) | (a == high[0]) & (b == high[1]) & (c == high[2])
        if inside.any():
            held.append((a[inside], b[inside], c[inside]))
            n += len(held[-1][0])
        if n >= size:
            block(held)
            held, n = [], 0
    if held:
        block(held)
    for k in (0, 1):
        if sizes[k]:
            key = _weighted_median(medians[k], sizes[k])
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (k, sum(sizes[k]), *key)], ["side", "n", "a", "b", "c"])


def _within(keys: DataFrame, low, high) -> DataFrame:
    """The keys beyond ``low`` and up to ``high``; the plain bound on ``a`` reaches the scan."""
    order = F.struct("a", "b", "c")
    if low is not None:
        keys = keys.where((F.col("a") >= low[0]) & (order > F.struct(*[F.lit(x).cast("long") for x in low])))
    if high is not None:
        keys = keys.where((F.col("a") <= high[0]) & (order <= F.struct(*[F.lit(x).cast("long") for x in high])))
    return keys


def cutoff(keys: DataFrame, k: int, finish: int = FINISH) -> tuple | None:
    """The k-th smallest of the distinct keys (a, b, c); None if there are fewer."""
    low = high = pivot = None
    stored = 0
    while True:
        found = in_arrow(keys, _sides, "side long, n long, a long, b long, c long", low, high, pivot, BLOCK).collect()
        sides = [[r for r in found if r.side == s] for s in (0, 1)]
        sizes = [sum(r.n for r in s) for s in sides]
        if pivot is None:
            remaining = stored = sizes[0]
            if k < 1 or k > remaining:
                return None
            side = 0
        else:
            side = int(k > sizes[0])
            if side:
                k, low = k - sizes[0], pivot
            else:
                high = pivot
            remaining = sizes[side]
        if remaining <= max(1, finish):
            rest = sorted((r.a, r.b, r.c) for r in _within(keys, low, high).collect())
            return rest[k - 1]
        pivot = _weighted_median([(r.a, r.b, r.c) for r in sides[side]], [r.n for r in sides[side]])
        if remaining * SHRINK <= stored:
            keys, stored = saved(_within(keys, low, high), "keys"), remaining


def _numbered(batches):
    part, at = TaskContext.get().partitionId(), 0
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int64)), pa.array(np.arange(at, at + b.num_rows))],
                                         [*b.schema.names, "part", "place"])
        at += b.num_rows


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` (with a, b, c) and their rank, from 1, in the order of the keys."""
    parts = max(1, int(winners.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = winners.repartitionByRange(parts, "a", "b", "c").sortWithinPartitions("a", "b", "c")
    schema = T.StructType([*winners.schema.fields, T.StructField("part", T.LongType()), T.StructField("place", T.LongType())])
    placed = saved(in_arrow(ordered, _numbered, schema), "ranked")
    totals = placed.groupBy("part").agg(F.count("*").alias("in_part"))
    # one row per task of the sort, whatever it holds: small enough to broadcast
    base = totals.select("part", (F.sum("in_part").over(Window.orderBy("part")) - F.col("in_part")).alias("base"))
    return placed.join(F.broadcast(base), "part").withColumn("rank", (F.col("base") + F.col("place") + 1).cast("long")).drop("part", "place", "base")


def drawn(rows: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, doc_id: str = "doc_id") -> DataFrame:
    """The scored rows with ``rank``, null if not drawn."""
    keyed = rows.withColumns({"a": -F.col("score"), "b": F.coalesce(F.col("whole").getField(doc_id).cast("long"), F.lit(NO_ID)), "c": F.col("row")})
    fit = keyed.where(F.col("n_words") >= min_words)
    keys = saved(fit.select("a", "b", "c"), "keys")
    last = cutoff(keys, percent * keys.count() // 100)
    if last is None:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    here = (F.col("n_words") >= min_words) & (F.struct("a", "b", "c") <= F.struct(*[F.lit(x).cast("long") for x in last]))
    rest = keyed.where(~here).withColumn("rank", F.lit(None).cast("long"))
    return ranked(keyed.where(here)).unionByName(rest).drop("a", "b", "c")


def report(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs``."""
    rows = scored(docs, gains(counts(docs, text), counts(target, text)), doc_id, text, keep=(doc_id,))
    return drawn(rows, doc_id=doc_id).select(F.col("whole").getField(doc_id).cast("long").alias("doc_id"), "n_features", "weight", "score", "rank")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text",
              target_text: str = "text", seed: int = SEED) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns."""
    rows = scored(docs, gains(counts(docs, text), counts(target, target_text)), doc_id, text, seed)
    return drawn(rows, percent, doc_id=doc_id).where("rank IS NOT NULL").select("whole.*")
