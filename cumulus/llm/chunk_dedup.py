"""Passage removal by content-defined chunking.

A gear rolling hash over the last 16 bytes ends a chunk where its top bits are zero, so chunk
borders depend only on nearby text: an insertion moves the borders next to it and no others.
Chunks (16 to 256 bytes, cut only between characters) are known by a 96-bit digest. From each
chunk on, and up to each chunk, the fewest neighbouring chunks of ``MIN_RUN`` bytes together are a
*window*, known by the digest of its chunks' digests. A window is removed where a smaller document
has the same one: so whatever is removed lies in passages of ``MIN_RUN`` bytes or more that single
smaller documents hold as they are, and a run of chunks that one of them holds is covered as a
whole. Shorter runs stay, as ordinary text shares them by chance. The first document with a passage
keeps it.

Digests are counted with partial aggregates (a chunk that a third of all documents share costs one
row per task). Only chunks of two or more documents are joined back, with their places; windows are
formed of these, and counted and joined in the same way.

Null text stays null and has no chunks; rows with the same id count as one document and take
nothing from each other; a null id is smaller than all others; other columns are kept, whatever their
names. Rows are told apart by their id and, where an id has several texts, by a 64-bit hash of
the text; equal rows have equal results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_table, in_arrow, saved
from .plain_words import in_parts, raw_texts

LEAST, MOST = 16, 256
TOP_BITS = 4
MIN_RUN = 64
#: Of a chunk's digest 64 bits are a column of their own and 22 lie in its place.
DIGEST = np.dtype([("h1", "<i8"), ("h2", "<i4")])
REST = (1 << 22) - 1
NO_ID = -(1 << 63)


def borders(data: bytes) -> list[int]:
    """Chunk ends, ascending; the last is the end of the data."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    b = np.frombuffer(data, np.uint8)
    h = byte_table(3)[b]
    for k in (1, 2, 4, 8):  # h[i] = sum of table[b[i - j]] << j over the last 2k bytes
        more = np.zeros(n, np.uint64)
        more[k:] = h[:-k] << np.uint64(k)
        h = h + more
    # the shifts reach 16 bits, so the top of the sum is spread by one multiplication
    h = h * np.uint64(0x9E3779B97F4A7C15)
    ends = np.nonzero(h >> np.uint64(64 - TOP_BITS) == 0)[0] + 1
    ends = ends[(ends < n)]
    ends = ends[(b[ends] & 0xC0) != 0x80].tolist()
    out, last = [], 0
    for e in [*ends, n]:
        while e - last > MOST:
            last += MOST
            while last < n and data[last] & 0xC0 == 0x80:
                last += 1
            if last < n:
                out.append(last)
        if e - last >= LEAST:
            out.append(e)
            last = e
    if not out or out[-1] != n:
        out.append(n)
    return out


def _digests(data: bytes, ends: list[int]) -> list[bytes]:
    view, last, out = memoryview(data), 0, []
    for e in ends:
        out.append(xxhash.xxh3_128_digest(view[last:e])[:12])
        last = e
    return out


def _places(start, end, rest=0):
    """Start, length (below 1024) and 22 bits of a digest in one number."""
    return start << 32 | (end - start) << 22 | rest


def _split(places: np.ndarray):
    """Start, end and rest of places in order, without repetitions; and where they were."""
    p, first = np.unique(places, return_index=True)
    start = p >> 32
    return start, start + (p >> 22 & (1 << 10) - 1), p & REST, first


def _chunks(batches):
    for batch in in_parts(batches):
        rows, places, found = [], [], []
        for i, text in enumerate(raw_texts(batch, "text")):
            if text:
                ends = np.array(borders(text), np.int64)
                rows.append(np.full(len(ends), i, np.int64))
                places.append(_places(np.concatenate([[0], ends[:-1]]), ends))
                found += _digests(text, ends.tolist())
        if found:
            d = np.frombuffer(b"".join(found), DIGEST)
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays([batch.column("k").take(at), batch.column("t").take(at),
                                              pa.array(np.concatenate(places) | d["h2"] & REST), pa.array(np.ascontiguousarray(d["h1"]))],
                                             ["k", "t", "place", "h1"])


def windows(edges: np.ndarray, min_run: int) -> list[tuple[int, int]]:
    """From each chunk on, and up to each chunk, the fewest chunks of ``min_run`` bytes; first and
    behind the last. ``edges``: where the chunks start, and the end of the last."""
    n = len(edges) - 1
    after = np.searchsorted(edges, edges[:-1] + min_run)
    before = np.searchsorted(edges, edges[1:] - min_run, side="right") - 1
    return sorted({*((i, j) for i, j in enumerate(after.tolist()) if j <= n),
                   *((i, j + 1) for j, i in enumerate(before.tolist()) if i >= 0)})


def _of_rows(batches, *cols: str):
    """Sorted by row (k, t): each row's numbers in ``cols``, whole, however batches cut them."""
    held: list[tuple[np.ndarray, ...]] = []
    own = None

    def whole():
        return own, tuple(np.concatenate(x) for x in zip(*held, strict=True))

    for b in batches:
        if not b.num_rows:
            continue
        k, t = b.column("k").to_numpy(), b.column("t").to_numpy()
        values = [b.column(c).to_numpy() for c in cols]
        edges = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])])).tolist()
        for s, e in zip(edges, [*edges[1:], len(k)], strict=True):
            row = int(k[s]), int(t[s])
            if held and row != own:
                yield whole()
                held = []
            own = row
            held.append(tuple(v[s:e] for v in values))
    if held:
        yield whole()


SOME = 50_000


def _windows(batches, min_run):
    rows: list[tuple] = []
    places: list[np.ndarray] = []
    found: list[bytes] = []

    def batch():
        d = np.frombuffer(b"".join(found), DIGEST)
        k, t = (np.repeat(np.array([r[i] for r, _ in rows], np.int64), [m for _, m in rows]) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(t), pa.array(np.concatenate(places)),
                                           *[pa.array(np.ascontiguousarray(d[c])) for c in ("h1", "h2")]], ["k", "t", "place", "h1", "h2"])

    for row, (place, h1) in _of_rows(batches, "place", "h1"):
        start, end, rest, first = _split(place)
        d = np.empty(len(first), DIGEST)
        d["h1"], d["h2"] = h1[first], rest
        cuts = np.nonzero(start[1:] != end[:-1])[0] + 1
        for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(first)], strict=True):
            if end[y - 1] - start[x] >= min_run:
                raw, edges = d[x:y].tobytes(), np.append(start[x:y], end[y - 1])
                own = np.array(windows(edges, min_run))
                rows.append((row, len(own)))
                places.append(_places(edges[own[:, 0]], edges[own[:, 1]]))
                found += [xxhash.xxh3_128_digest(raw[12 * i:12 * j])[:12] for i, j in own.tolist()]
        if len(found) >= SOME:
            yield batch()
            rows, places, found = [], [], []
    if found:
        yield batch()


def _spans(batches):
    """Per row the stretches that windows cover; what overlaps or touches is one."""
    out: list[tuple] = []

    def batch():
        k, t, first, last = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(t, pa.int64()), pa.array(first, pa.list_(pa.int64())),
                                           pa.array(last, pa.list_(pa.int64()))], ["k", "t", "first", "last"])

    for row, (place,) in _of_rows(batches, "place"):
        start, end, _, _ = _split(place)
        far = np.maximum.accumulate(end)
        begin = np.flatnonzero(np.concatenate([[True], start[1:] > far[:-1]]))
        out.append((*row, start[begin], far[np.append(begin[1:], len(far)) - 1]))
        if len(out) >= 2000:
            yield batch()
            out = []
    if out:
        yield batch()


FIGURES = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _remove(batches, with_figures):
    for b in batches:
        rows = []
        for text, first, last in zip(*(b.column(c).to_pylist() for c in ("text", "first", "last")), strict=True):
            data = (text or "").encode("utf-8", "replace")
            spans, kept = list(zip(first or (), last or (), strict=True)), data
            if spans:
                edges = [0, *[x for s in spans for x in s], len(data)]
                kept = b"".join(data[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True))
                text = kept.decode("utf-8", "replace")
            rows.append((text, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest() if with_figures else ""))
        done = list(zip(*rows, strict=True)) or [[]] * 5
        cols = [b.column("whole"), pa.array(done[0], pa.string())]
        if with_figures:
            cols += [pa.array(done[i], pa.int64()) for i in (1, 2, 3)] + [pa.array(done[4], pa.string())]
        yield pa.RecordBatch.from_arrays(cols, ["whole", "text", *[c.split()[0] for c in FIGURES.split(", ")]][:len(cols)])


def _told_apart(rows: DataFrame, text: str) -> tuple[DataFrame, bool]:
    """``rows`` (whole, k) with ``t``: a hash of the text for rows of ids that have several, else 0; and
    whether ids repeat at all."""
    t = F.xxhash64(F.col("whole").getField(text))
    ids = rows.select("k", t.alias("t")).groupBy("k").agg(F.min("t").alias("lo"), F.max("t").alias("hi"), F.count("*").alias("n"))
    again = saved(ids.where("n > 1").select("k", (F.col("lo") != F.col("hi")).alias("several")), "ids")
    if again.isEmpty():
        return rows.withColumn("t", F.lit(0).cast("long")), False
    t = F.when(F.col("several"), t).otherwise(F.lit(0).cast("long"))
    return rows.join(again, "k", "left").withColumn("t", t).drop("several"), True


def _in_rows(found: DataFrame) -> DataFrame:
    """Brought together and sorted by row. Rows travel as they are: lists built before the exchange would
    hold one or two of them each."""
    return found.repartition("k", "t").sortWithinPartitions("k", "t")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_figures: bool = False,
                    min_run: int = MIN_RUN) -> DataFrame:
    """All rows and columns of ``docs`` with repeated passages taken out of ``text``;
    ``with_figures`` adds n_bytes, n_removed, n_spans and kept_sha256."""
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))
    rows, repeated = _told_apart(docs.select(F.struct("*").alias("whole"), key.alias("k")), text)
    own = F.col("whole").getField(text).alias("text")
    texts = rows.select("k", "t", own)
    chunks = in_arrow(texts.dropDuplicates(["k", "t"]) if repeated else texts, _chunks, "k long, t long, place long, h1 long")
    # chunks are only chosen here: most of the digest will do, and one that a document has twice may come along
    shared = chunks.groupBy("h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1")
    found = in_arrow(_in_rows(chunks.join(shared, "h1")), _windows, "k long, t long, place long, h1 long, h2 int", min_run)
    # windows of two or more documents, with the smallest id
    first = (found.groupBy("h1", "h2").agg(F.min("k").alias("least"), F.max("k").alias("most"))
             .where("least < most").drop("most"))
    repeats = found.join(first, ["h1", "h2"]).where("k > least").select("k", "t", "place")
    spans = in_arrow(_in_rows(repeats), _spans, "k long, t long, first array<long>, last array<long>")
    joined = rows.join(spans, ["k", "t"], "left").select("whole", own, "first", "last")  # the text travels once
    schema = T.StructType([rows.schema["whole"], T.StructField("text", docs.schema[text].dataType),
                           *(T._parse_datatype_string(FIGURES).fields if with_figures else [])])
    done = in_arrow(joined, _remove, schema, with_figures)
    return done.select(*[F.col("text") if c == text else F.col("whole").getField(c).alias(c) for c in docs.columns],
                       *[c for c in done.columns[2:]])
