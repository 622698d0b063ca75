"""Token-id files: each document compressed alone with one shared zstandard dictionary.

The dictionary is trained on the serialized ids of a bounded sample of documents
(``SAMPLE_DOCS`` chosen by a hash of their id, of each up to ``SAMPLE_BYTES`` from a place chosen by
another hash of it); all documents are stored. Documents are range partitioned and sorted by id, so a partition's files hold a
consecutive stretch. A file row is a *segment*: the dictionary's hash, an index (ids of the
documents, token counts, end offset of each frame) and the frames. A document is read by its
offset without touching its neighbours. Spark writes the rows, so a lost task leaves nothing
half-written.

Each segment also records how many ids of its partition come before it, so a second pass needs
only one total per partition to give every document its place among all ids.

Null text: only the end id. Null or repeated document ids: kept, nulls first, equal ids in order
of their text. An empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .byte_tokens import byte_tokens
from .common import in_arrow, text_lists

SAMPLE_DOCS = 2000
SAMPLE_BYTES = 16_384
DICT_BYTES = 65_536
SEGMENT_BYTES = 4 << 20
SEGMENT = ("part long, start_in_part long, first_doc long, last_doc long, n_tokens long, dict_sha256 string, "
           "width long, index binary, frames binary")


def _sample(batches, path, end_id):
    t = byte_tokens(path)
    end, width = t._pack([end_id]), np.dtype(t.dtype).itemsize
    for ids, texts in text_lists(batches, "doc_id", "text"):
        out = []
        for i, x in zip(ids, t.packed(texts), strict=True):
            x += end
            over = max(0, len(x) - SAMPLE_BYTES) // width
            at = xxhash.xxh3_64_intdigest(b"%d" % (i or 0)) % (over + 1) * width
            out.append(x[at:at + SAMPLE_BYTES])
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int = 0, sample_docs: int = SAMPLE_DOCS) -> bytes:
    total = docs.count()
    if not total:
        return b""
    share = min(1.0, sample_docs / total)
    picked = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(share * (1 << 20)))
    samples = [bytes(r.ids) for r in in_arrow(picked, _sample, "ids binary", tokenizer, end_id).collect()]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples: their bytes serve as they are
        return b"".join(samples)[:DICT_BYTES]


def _dict(raw: bytes):
    return zstandard.ZstdCompressionDict(raw) if raw else None


def _write(batches, path, end_id, raw):
    t = byte_tokens(path)
    press = zstandard.ZstdCompressor(level=3, dict_data=_dict(raw), write_content_size=True)
    end, sha, width = t._pack([end_id]), hashlib.sha256(raw).hexdigest(), np.dtype(t.dtype).itemsize
    part, start = TaskContext.get().partitionId(), 0
    ids, counts, frames, size = [], [], [], 0

    def segment():
        nonlocal start
        ends = np.cumsum([len(f) for f in frames])
        known = [i for i in ids if i is not None]
        index = np.array([[-1 if i is None else i for i in ids], [i is None for i in ids], counts, ends], "<i8").tobytes()
        row = [part, start, min(known, default=None), max(known, default=None), sum(counts), sha, width, index, b"".join(frames)]
        start += sum(counts)
        types = [pa.int64()] * 5 + [pa.string(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, types, strict=True)],
                                          [c.split()[0] for c in SEGMENT.split(", ")])

    for doc_ids, texts in text_lists(batches, "doc_id", "text"):
        for k in range(0, len(texts), 256):
            for i, packed in zip(doc_ids[k:k + 256], t.packed(texts[k:k + 256]), strict=True):
                packed += end
                f = press.compress(packed)
                ids.append(i)
                counts.append(len(packed) // width)
                frames.append(f)
                size += len(f)
                if size >= SEGMENT_BYTES:
                    yield segment()
                    ids, counts, frames, size = [], [], [], 0
    if ids:
        yield segment()


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encode all ``docs`` (doc_id, text) into segments under ``path``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    raw = train_dictionary(docs, tokenizer, end_id)
    spark.createDataFrame([(hashlib.sha256(raw).hexdigest(), bytearray(raw))], "dict_sha256 string, dict binary") \
        .coalesce(1).write.parquet(f"{path}/dictionary")
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    in_arrow(ordered, _write, SEGMENT, tokenizer, end_id, raw).write.option("compression", "uncompressed") \
        .parquet(f"{path}/segments")


def _dictionary(spark: SparkSession, path: str) -> dict[str, bytes]:
    return {r.dict_sha256: bytes(r.dict) for r in spark.read.parquet(f"{path}/dictionary").collect()}


def _documents(batches, dicts, wanted):
    """(doc_id, ids, start in partition) of the wanted documents, or of all."""
    for b in batches:
        for s in b.to_pylist():
            open_ = zstandard.ZstdDecompressor(dict_data=_dict(dicts[s["dict_sha256"]]))
            ids, null, counts, ends = np.frombuffer(s["index"], "<i8").reshape(4, -1)
            before = s["start_in_part"] + np.cumsum(counts) - counts
            pick = range(len(ids)) if wanted is None else np.nonzero(np.isin(ids, wanted) & (null == 0))[0]
            for k in pick:
                frame = s["frames"][ends[k - 1] if k else 0:ends[k]]
                packed = np.frombuffer(open_.decompress(frame), f"<u{s['width']}").astype("<u4")
                yield s, None if null[k] else int(ids[k]), int(before[k]), packed


def _rows(batches, dicts, with_ids, wanted):
    rows: list[tuple] = []
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * with_ids

    def flush():
        cols = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names)

    for s, i, before, ids in _documents(batches, dicts, wanted):
        rows.append((i, s["base"] + before, len(ids), zlib.crc32(ids.tobytes()), *([ids.tolist()] if with_ids else [])))
        if len(rows) >= 2000:
            yield flush()
            rows.clear()
    if rows:
        yield flush()


def read(spark: SparkSession, path: str, with_ids: bool = False, doc_ids: list[int] | None = None) -> DataFrame:
    """Per stored document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32
    and on request the ids; ``doc_ids`` reads only the frames of these documents.

    The offsets come from one total per partition of the writing job: that table has as many rows
    as that job had tasks, whatever the documents hold, so it is broadcast."""
    seg = spark.read.schema(SEGMENT).parquet(f"{path}/segments")
    totals = seg.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    base = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    if doc_ids is not None:
        lo, hi = min(doc_ids, default=0), max(doc_ids, default=0)
        seg = seg.where((F.col("last_doc") >= lo) & (F.col("first_doc") <= hi))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return in_arrow(seg.join(F.broadcast(base), "part"), _rows, schema, _dictionary(spark, path), with_ids, doc_ids)
