"""Secret scan: fixed patterns, and two character Markov models compared by log-likelihood ratio.

The patterns find assignments, access keys and hex runs. Their values are the labelled samples
of *random strings*; every other run of identifier characters is a sample of *ordinary
identifiers*. First-order character transitions of both classes are counted over all texts (a
few thousand counters per task, summed by Spark), smoothed by the frequencies of single
characters (these by one), and frozen. In a run of 16 or more identifier characters, a stretch of
16 or more that no pattern covers is then reported as ``markov`` when the random model explains it
better by ``min_bits`` per transition; stretches that overlap or touch are reported as one. So a
random string is found behind a name or path that '=', '/', '_' or '-' joins to it. Transitions
from or into such a sign count against a stretch, but not for it: they are too rare in ordinary
text to tell a joint of two names. Only what stands between patterns and the ends of the run is
scored as a whole, too, with all its transitions. Where a pattern covers a part of a run, what is left
on either side is scored by itself; a rest of 4 to 15 characters next to an access key or hex run
belongs to its key, and is reported when its transitions, the one into the key included, reach
``min_bits`` on average. Digits alone are numbers and are left out. Without any labelled sample the
smoothed models are flat, so nothing is added.

Null text is the empty text; an empty text has no spans; repeated rows give repeated results;
other columns of the input are ignored by the scan and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, text_lists

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Characters of a stretch that is scored by itself, and of a rest that is scored with the key next to it.
LEAST, REST = 16, 4
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Substrings one of which every assignment contains once lower-cased.
HINTS = ("passw", "secret", "token", "api")
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
K = len(SYMBOLS) + 1  # 0: anything else
SIGN = 62  # codes above it are the signs
CODE = np.zeros(256, dtype=np.int64)
for _i, _c in enumerate(SYMBOLS):
    CODE[ord(_c)] = _i + 1

Span = tuple[int, int, int]  # start, kind, end


def pattern_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, in code points, sorted by start, then kind."""
    out: list[Span] = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _values(text: str, spans: list[Span]) -> list[str]:
    out = []
    for s, kind, e in spans:
        v = text[s:e]
        if kind == 0:
            v = ASSIGN.match(v)[2]
        out.append(v)
    return out


def _transitions(texts: list[str]) -> np.ndarray:
    raw = np.frombuffer("\n".join(texts).encode("latin-1", "replace"), dtype=np.uint8)
    # the replacement mark is not an identifier character, so it counts as "anything else"
    codes = CODE[raw]
    return np.bincount(codes[:-1] * K + codes[1:], minlength=K * K) if len(codes) > 1 else np.zeros(K * K, np.int64)


def _count(batches):
    everything = np.zeros(K * K, dtype=np.int64)
    random = np.zeros(K * K, dtype=np.int64)
    for (texts,) in text_lists(batches, "text"):
        for k in range(0, len(texts), 500):
            part = texts[k:k + 500]
            values = [v for t in part for v in _values(t, pattern_spans(t))]
            everything += _transitions(part)
            random += _transitions(values)
    for kind, counts in ((0, np.maximum(everything - random, 0)), (1, random)):
        at = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), kind)), pa.array(at), pa.array(counts[at])], ["kind", "pair", "n"])


def train(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Bits by which the random model beats the ordinary one, per transition (K x K). Only the
    2 x K x K summed counters come to the driver, whatever the input."""
    counts = in_arrow(docs.select(F.col(text).alias("text")), _count, "kind long, pair long, n long")
    seen = np.zeros((2, K * K))
    for r in counts.groupBy("kind", "pair").agg(F.sum("n").alias("n")).collect():
        seen[r.kind, r.pair] = r.n
    seen = seen.reshape(2, K, K)[:, 1:, 1:]  # only inside runs
    plain = seen.sum(axis=1, keepdims=True) + 1.0
    plain /= plain.sum(axis=2, keepdims=True)
    bits = np.log2((seen + (K - 1) * plain) / (seen.sum(axis=2, keepdims=True) + K - 1))
    out = np.zeros((K, K))
    out[1:, 1:] = bits[1] - bits[0]
    return out


def _stretches(bits: np.ndarray, min_bits: float) -> list[tuple[int, int]]:
    """All stretches of ``LEAST`` or more characters whose transitions reach ``min_bits`` on
    average, joined where they overlap or touch."""
    level = np.concatenate([[0.0], np.cumsum(bits - min_bits)])
    # the last character up to which the level is not below that of each start: the greatest level
    # from a character on never rises
    ahead = np.maximum.accumulate(level[::-1])
    far = len(level) - 1 - np.searchsorted(ahead, level)
    starts = np.nonzero(far - np.arange(len(level)) >= LEAST - 1)[0]
    if not len(starts):
        return []
    ends = np.maximum.accumulate(far[starts]) + 1
    new = np.nonzero(starts[1:] > ends[:-1])[0] + 1
    return list(zip(starts[[0, *new]].tolist(), ends[[*(new - 1), -1]].tolist(), strict=True))


def markov_spans(text: str, known: list[Span], ratio: np.ndarray, min_bits: float) -> list[Span]:
    out, k = [], 0
    ends = sorted((s, e, kind) for s, kind, e in known)
    for m in RUN.finditer(text):
        start, stop = m.span()
        while k < len(ends) and ends[k][1] <= start:
            k += 1
        # what the patterns leave of the run, and whether a key is next to it on either side
        parts, at, key, j = [], start, False, k
        while j < len(ends) and ends[j][0] < stop:
            s, e, kind = ends[j]
            if s > at:
                parts.append((at, s, key, kind > 0))
            if e > at:
                at, key = e, kind > 0
            j += 1
        if at < stop:
            parts.append((at, stop, key, False))
        if not parts:
            continue
        codes = CODE[np.frombuffer(m[0].encode("ascii"), dtype=np.uint8)]
        bits = ratio[codes[:-1], codes[1:]]
        sure = np.where(np.maximum(codes[:-1], codes[1:]) > SIGN, np.minimum(bits, 0.0), bits)
        for s, e, before, after in parts:
            if e - s >= LEAST and bits[s - start:e - start - 1].mean() >= min_bits:
                found = [(s, e)]
            elif e - s >= LEAST:
                found = [(s + x, s + y) for x, y in _stretches(sure[s - start:e - start - 1], min_bits)]
            elif e - s >= REST and (before or after) and sure[s - start - before:e - start - 1 + after].mean() >= min_bits:
                found = [(s, e)]
            else:
                continue
            out += [(x, 3, y) for x, y in found if not text[x:y].isdigit()]
    return out


def _say(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(batches, ratio, min_bits):
    for ids, texts in text_lists(batches, "doc_id", "text"):
        rows = []
        for t in texts:
            base = pattern_spans(t)
            more = sorted(base + markov_spans(t, base, ratio, min_bits))
            n = [sum(x[1] == k for x in more) for k in range(4)]
            rows.append((*n, hashlib.sha256(_say(base).encode()).hexdigest(), _say(more)))
        cols = list(zip(*rows, strict=True)) or [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *[pa.array(c, pa.int64()) for c in cols[:3]],
             pa.array(cols[4], pa.string()), pa.array(cols[5], pa.string()), pa.array(cols[3], pa.int64())],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"])


def scan(docs: DataFrame, ratio: np.ndarray, doc_id: str = "doc_id", text: str = "text",
         min_bits: float = 1.5) -> DataFrame:
    """Per document: counts of the patterns' spans, their digest, all spans, and how many the models add."""
    return in_arrow(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), _scan,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long",
        ratio, min_bits)


def redacted(text: str, spans: list[Span], mark: str = "[secret]") -> str:
    """``text`` with every stretch that spans cover replaced by one ``mark``."""
    out, at, last = [], 0, -1
    for s, _, e in sorted(spans):
        if s >= last:
            out += [text[at:s], mark]
        last = at = max(last, e)
    return "".join([*out, text[at:]]) if out else text


def _redact(batches, text_col, ratio, min_bits):
    for b in batches:
        k = b.schema.get_field_index(text_col)
        out = []
        for t in b.column(k).to_pylist():
            if t:
                base = pattern_spans(t)
                t = redacted(t, base + markov_spans(t, base, ratio, min_bits))
            out.append(t)
        cols = b.columns
        cols[k] = pa.array(out, b.schema.field(k).type)
        yield pa.RecordBatch.from_arrays(cols, schema=b.schema)


def redact(docs: DataFrame, ratio: np.ndarray, text: str = "text", min_bits: float = 1.5) -> DataFrame:
    """All rows and columns of ``docs``; secrets in ``text`` are masked, a null text stays null."""
    return in_arrow(docs, _redact, docs.schema, text, ratio, min_bits)
