"""Concatenate and cut: fixed-length training sequences from the stream of all documents' ids.

First pass: each partition encodes its documents, ends each with the end id, and writes the ids
with their place in the partition (shared storage). The partitions' totals, one row per
partition, are prefix-summed to global offsets. Second pass: each document knows its place in
the stream and is cut at the multiples of the sequence length; a piece is the boundary record
(document, start in it, length, sequence, offset in it). Only the last sequence is padded. The
stream follows the order of the input's partitions, and no row moves between machines.

Null text: the end id alone. Null and repeated document ids are kept as they are. An empty table
gives no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_tokens import MEMO, byte_tokens
from .common import in_arrow, saved, text_lists

LENGTH = 2048
PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _encode(batches, path, end_id, memo):
    t = byte_tokens(path, memo)
    end, width = t._pack([end_id]), np.dtype(t.dtype).itemsize
    part, at = TaskContext.get().partitionId(), 0
    for ids, texts in text_lists(batches, "doc_id", "text"):
        for k in range(0, len(texts), 512):
            packed = [p + end for p in t.packed(texts[k:k + 512])]
            n = np.array([len(p) // width for p in packed])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[k:k + 512], pa.int64()), pa.array(np.full(len(n), part)), pa.array(at + np.cumsum(n) - n),
                 pa.array(n), pa.array(np.full(len(n), width)), pa.array(packed, pa.binary())],
                ["doc_id", "part", "start_in_part", "n_tokens", "width", "ids"])
            at += int(n.sum())


def _cut(batches, length, with_ids):
    names = [c.split()[0] for c in PIECE.split(", ")] + ["ids"] * with_ids
    for b in batches:
        rows = []
        for r in b.to_pylist():
            place, n = r["base"] + r["start_in_part"], r["n_tokens"]
            ids = np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4")
            first = min(n, length - place % length)
            edges = [0, *range(first, n, length), n]
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                if s < e:
                    rows.append((r["doc_id"], s, e - s, zlib.crc32(ids[s:e].tobytes()), n, (place + s) // length,
                                 (place + s) % length, *([ids[s:e].tolist()] if with_ids else [])))
        cols = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), pa.list_(pa.int64()) if k == "ids" else pa.int64()) for c, k in zip(cols, names, strict=True)],
            names)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = LENGTH, with_ids: bool = False, memo: int = MEMO) -> DataFrame:
    """Boundary records of all pieces; ``with_ids`` adds each piece's ids. ``memo``: words that a worker
    remembers."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    stream = saved(in_arrow(docs, _encode, "doc_id long, part long, start_in_part long, n_tokens long, width long, ids binary",
                            tokenizer, end_id, memo), "ids")
    totals = stream.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row per partition of the first pass, whatever the documents hold: small enough to broadcast
    base = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return in_arrow(stream.join(F.broadcast(base), "part"), _cut, PIECE + (", ids array<long>" if with_ids else ""),
                    length, with_ids)


def sequences(pieces: DataFrame) -> DataFrame:
    """Sequence ids from pieces with ids: at most one sequence length per group."""
    return (pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
            .select("sequence_id", F.flatten("p.ids").alias("ids")))
