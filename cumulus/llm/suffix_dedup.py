"""Exact removal of bytes covered by a 50-byte string that a smaller document holds too.

A common-prefix-aware distributed merge sort of suffixes. Only suffixes that can matter are
sorted: every 50-byte window has an *anchor*, the 24-byte string in it with the least hash, and
equal windows have equal anchors at equal offsets. So it is enough to sort the suffixes that start
at anchors (about one position in 14), and of these only those whose first 24 bytes also occur at
an anchor of another document.

1. Documents are dealt to blocks by a hash of their id. A block finds its anchors and sends their
   hashes, once each, as sorted arrays per bucket.
2. A bucket merges the arrays and returns to each block the hashes that two documents share.
3. A block sorts its suffixes at shared anchors and sends them as *runs*: front-coded (length of
   the prefix shared with the one before, and the rest), one run per bucket. Repeats of a suffix
   with the same left context within the block are settled there and not sent.
4. A bucket merges its runs with a loser tree that keeps, for every waiting suffix, the length of
   the prefix it shares with the last one put out. Two suffixes with different lengths are ordered
   by these alone; with equal lengths they are compared from there on. No known prefix is compared
   again. Suffixes in a row that share an anchor's 24 bytes are then matched: prefix lengths give
   how far two matches reach to the right, left contexts how far to the left; 50 bytes or more
   together are a repeat of the smaller document. Large groups match window by window instead.
5. The blocks take the repeats out of their documents.

An anchor with more than ``HOT`` occurrences - a phrase of 24 to 49 bytes that is everywhere, with other
text around it - would make one such group grow with the corpus. The counts of step 2 find it, and its
occurrences are not sent as suffixes: every 50-byte window goes by a hash of its own to a bucket of
windows, once per block and id, and a holder is a repeat where a smaller id holds the same window.

Suffixes are dealt by a hash of their first 24 bytes, so equal strings meet and no range of the
alphabet becomes hot; a passage that every document shares is sent once per block.

Null text is the empty text. Rows with the same id take nothing from each other; a null id counts
as smaller than all others. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_table, mix64, ship_code

LENGTH = 50
ANCHOR = 24
SLICE = 1 << 18
BLOCK_BYTES = 6 << 20
BUCKET_BYTES = 24 << 20
HOT = 300_000
FEW = 12
NO_ID = -(1 << 63)
LOW = np.uint64(0xFFFFFFFF)


# ---- a block of documents ----------------------------------------------------------------
class Block:
    """Documents in order of (id, text), their bytes in one array, and the anchors of all windows."""

    def __init__(self, keys: list[int], texts: list[str | None]):
        data = [(t or "").encode("utf-8", "replace") for t in texts]
        self.order = sorted(range(len(keys)), key=lambda i: (keys[i], data[i]))
        self.keys = [keys[i] for i in self.order]
        self.data = b"".join(data[i] for i in self.order)
        ends = np.cumsum([0] + [len(data[i]) for i in self.order])
        self.starts, self.ends = ends[:-1], ends[1:]
        self._anchors()

    def _anchors(self) -> None:
        """Runs of windows with the same anchor, a slice of windows at a time."""
        windows = np.zeros(len(self.data), bool)  # windows that stay inside one document
        for s, e in zip(self.starts.tolist(), self.ends.tolist(), strict=True):
            if e - s >= LENGTH:
                windows[s:e - LENGTH + 1] = True
        raw = np.frombuffer(self.data, np.uint8)
        parts = []
        for s in range(0, len(raw), SLICE):
            window = np.nonzero(windows[s:s + SLICE])[0]
            if not len(window):
                continue
            hashes = _hash(raw[s:s + SLICE + LENGTH])
            at = _least(hashes)[window]
            doc = np.searchsorted(self.ends, window + s, side="right")
            begin = np.nonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))[0]
            last = window[np.concatenate([begin[1:], [len(window)]]) - 1]
            parts.append((at[begin] + s, window[begin] + s, last + s, doc[begin], hashes[at[begin]]))
        if not parts:
            self.at = self.first = self.last = self.doc = np.empty(0, np.int64)
            self.hash = np.empty(0, np.uint64)
            return
        at, first, last, doc, self.hash = (np.concatenate(x) for x in zip(*parts, strict=True))
        # a run cut by the end of a slice stays two runs with the same anchor: both are matched
        self.at, self.first, self.last, self.doc = at, first, last, doc

    def bucket(self, buckets: int) -> np.ndarray:
        return (self.hash >> np.uint64(32)) % np.uint64(buckets)


def _hash(raw: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR bytes that start at each place, by doubling. The factors are odd, so no
    byte is lost."""
    h, size, got, have, rest = byte_table(5)[raw], 1, None, 0, ANCHOR
    f = np.uint64(0x9E3779B97F4A7C15)
    while rest:
        if rest & 1:
            if got is None:
                got, have = h, size
            else:
                m = len(h) - have
                got, have = got[:m] * _power(f, size) + h[have:], have + size
        rest >>= 1
        if rest:
            h = h[:-size] * _power(f, size) + h[size:]
            size *= 2
    return mix64(got)


def _least(hashes: np.ndarray) -> np.ndarray:
    """Per window the place of its anchor: the least hash, the first of equals."""
    least = (hashes & ~LOW) | np.arange(len(hashes), dtype=np.uint64)
    width, size = LENGTH - ANCHOR + 1, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[:size - width], least[width - size:])
    return (least & LOW).astype(np.int64)


@lru_cache
def _power(f: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(f), n, 1 << 64))


def _keyed(table: pa.Table) -> Block:
    return Block(table.column("k").to_pylist(), table.column("text").to_pylist())


_PRESS, _OPEN = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _packed(*arrays: np.ndarray) -> bytes:
    parts = [np.array([len(arrays)], "<i8").tobytes()]
    for a in arrays:
        parts += [np.array([ord(a.dtype.char), len(a)], "<i8").tobytes(), a.tobytes()]
    return _PRESS.compress(b"".join(parts))


def _unpacked(blob: bytes) -> list[np.ndarray]:
    raw = _OPEN.decompress(blob)
    n, at, out = int(np.frombuffer(raw, "<i8", 1)[0]), 8, []
    for _ in range(n):
        kind, size = np.frombuffer(raw, "<i8", 2, at).tolist()
        dt = np.dtype(chr(kind))
        out.append(np.frombuffer(raw, dt, size, at + 16))
        at += 16 + size * dt.itemsize
    return out


# ---- 1 and 2: which anchors are shared ---------------------------------------------------
def _hashes(buckets):
    def run(key, table):
        b = _keyed(table)
        rows = []
        if len(b.hash):
            order = np.argsort(b.hash, kind="stable")
            h, k = b.hash[order], np.array(b.keys, np.int64)[b.doc[order]]
            begin = np.nonzero(np.concatenate([[True], h[1:] != h[:-1]]))[0]
            two = np.minimum.reduceat(k, begin) != np.maximum.reduceat(k, begin)
            h, n = h[begin], np.diff(np.append(begin, len(h))).astype(np.uint32)
            to = (h >> np.uint64(32)) % np.uint64(buckets)
            for t in np.unique(to).tolist():
                m = to == t
                rows.append((t, _packed(h[m], two[m], n[m])))
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()), "g": pa.array([key[0].as_py()] * len(rows), pa.int64()),
                         "data": pa.array([r[1] for r in rows], pa.binary())})
    return run


def _shared(hot):
    def run(key, table):
        runs = [(g, *_unpacked(d)) for g, d in zip(table.column("g").to_pylist(), table.column("data").to_pylist(), strict=True)]
        every = np.concatenate([h for _, h, _, _ in runs])
        order = np.argsort(every, kind="stable")
        every = every[order]
        begin = np.nonzero(np.concatenate([[True], every[1:] != every[:-1]]))[0]
        blocks = np.diff(np.append(begin, len(every)))
        inside, n = (np.concatenate([r[k] for r in runs])[order] for k in (2, 3))
        keep = (blocks > 1) | np.logical_or.reduceat(inside, begin)
        many, often = every[begin][keep], (np.add.reduceat(n.astype(np.int64), begin) > hot)[keep]
        g, out = [], []
        for at, h, _, _ in runs:
            place = np.minimum(np.searchsorted(many, h), max(0, len(many) - 1))
            found = many[place] == h if len(many) else np.zeros(len(h), bool)
            if found.any():
                g.append(at)
                out.append(_packed(h[found], often[place[found]]))
        return pa.table({"g": pa.array(g, pa.int64()), "data": pa.array(out, pa.binary())})
    return run


# ---- 3: front-coded runs -----------------------------------------------------------------
def front_coded(suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Lengths of the prefix shared with the one before, lengths of the rest, all rests."""
    before, shared, rest = b"", [], []
    for s in suffixes:
        k = common_prefix(before, s, 0)
        shared.append(k)
        rest.append(s[k:])
        before = s
    return np.array(shared, np.uint8), np.array([len(r) for r in rest], np.uint8), b"".join(rest)


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that agree on ``known`` bytes."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    diff = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (diff.bit_length() + 7 >> 3)


def _runs(buckets):
    def run(key, left, right):
        g = key[0].as_py()
        rows: list[tuple[int, int, bytes]] = []
        if right.num_rows and left.num_rows:
            b = _keyed(left)
            shared, often = (np.concatenate(x) for x in zip(*(_unpacked(d) for d in right.column("data").to_pylist()), strict=True))
            order = np.argsort(shared)
            shared, often = shared[order], often[order]
            place = np.minimum(np.searchsorted(shared, b.hash), len(shared) - 1)
            pick = np.nonzero(shared[place] == b.hash)[0]
            to, hot = b.bucket(buckets)[pick].tolist(), often[place[pick]].tolist()
            data, starts = b.data, b.starts.tolist()
            known: dict[tuple[bytes, int], int] = {}
            sent: dict[int, list] = {}
            done = ([], [], [])
            held: dict[bytes, int] = {}
            windows: list[tuple] = []
            for t, often, a, f, e, d in zip(to, hot, *(x[pick].tolist() for x in (b.at, b.first, b.last, b.doc)), strict=True):
                # documents come by ascending id, so the first holder of a context is the smallest
                context, own = (data[f:e + LENGTH], a - f), b.keys[d]
                if known.setdefault(context, own) < own:
                    for x, v in zip(done, (d, f - starts[d], e + LENGTH - starts[d]), strict=True):
                        x.append(v)
                elif often:
                    for w in range(f, e + 1):
                        window = data[w:w + LENGTH]
                        if held.setdefault(window, own) < own:
                            for x, v in zip(done, (d, w - starts[d], w + LENGTH - starts[d]), strict=True):
                                x.append(v)
                        else:
                            windows.append((xxhash.xxh3_128_digest(window), own, d, w - starts[d]))
                else:
                    sent.setdefault(t, []).append((data[a:e + LENGTH], data[f:a], own, d, a - starts[d]))
            for t, found in sent.items():
                found.sort()
                left_parts = [x[1] for x in found]
                s, r, rest = front_coded([x[0] for x in found])
                rows.append((0, t, _packed(s, r, np.frombuffer(rest, np.uint8), np.array([len(x) for x in left_parts], np.uint8),
                                           np.frombuffer(b"".join(left_parts), np.uint8), np.array([x[2] for x in found], np.int64),
                                           np.array([x[3] for x in found], np.int32), np.array([x[4] for x in found], np.int64))))
            if windows:
                h = np.frombuffer(b"".join(x[0] for x in windows), "<u8").reshape(-1, 2)
                rest = [np.array(x, np.int64) for x in list(zip(*windows, strict=True))[1:]]
                to_window = (h[:, 0] % np.uint64(buckets)).astype(np.int64)
                for t in np.unique(to_window).tolist():
                    m = to_window == t
                    rows.append((2, t, _packed(np.ascontiguousarray(h[m, 0]), np.ascontiguousarray(h[m, 1]), *[x[m] for x in rest])))
            if done[0]:
                rows.append((1, g, _packed(*[np.array(x, np.int64) for x in done])))
        return pa.table({"kind": pa.array([r[0] for r in rows], pa.int64()), "target": pa.array([r[1] for r in rows], pa.int64()),
                         "g": pa.array([g] * len(rows), pa.int64()), "data": pa.array([r[2] for r in rows], pa.binary())})
    return run


# ---- 4: the merge ------------------------------------------------------------------------
def _read_run(g: int, blob: bytes):
    """Entries of a run in order: (suffix, shared with the one before, left, id, block, document, place)."""
    shared, sizes, rest, left_sizes, lefts, keys, docs, places = _unpacked(blob)
    rest, lefts = rest.tobytes(), lefts.tobytes()
    before, r, q = b"", 0, 0
    for k, n, m, key, d, p in zip(shared.tolist(), sizes.tolist(), left_sizes.tolist(), keys.tolist(), docs.tolist(), places.tolist(),
                                  strict=True):
        before = before[:k] + rest[r:r + n]
        r += n
        yield before, k, lefts[q:q + m], key, g, d, p
        q += m


def merged(runs: list):
    """Entries of all runs in order of their suffix, each with the length of the prefix it shares
    with the entry before it. A tree of losers; ``shared[i]`` is what run i's head shares with the
    last entry put out."""
    runs = [iter(r) for r in runs]
    heads = [next(r, None) for r in runs]
    width = 1
    while width < len(runs):
        width *= 2
    heads += [None] * (width - len(heads))
    shared = [0] * width

    def before(i: int, j: int) -> bool:
        """Whether head i comes first; the later one learns what it shares with the earlier."""
        a, b = heads[i], heads[j]
        if b is None:
            return True
        if a is None:
            return False
        x, y = shared[i], shared[j]
        if x != y:  # the one that shares more with the last entry is nearer to it
            return x > y
        a, b = a[0], b[0]
        k = common_prefix(a, b, x)
        first = a[k:k + 1] <= b[k:k + 1]
        shared[j if first else i] = k
        return first

    losers = [0] * width
    winners = [0] * width + list(range(width))
    for node in range(width - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if before(a, b) else (b, a)
    top = winners[1] if width > 1 else 0
    while heads[top] is not None:
        entry = heads[top]
        yield entry, shared[top]
        heads[top] = nxt = next(runs[top], None)
        if nxt is not None:
            shared[top] = nxt[1]
        node, up = top, (top + width) >> 1
        node = top
        while up:
            other = losers[up]
            if not before(node, other):
                losers[up], node = node, other
            up >>= 1
        top = node


def _group(entries: list, shared: list[int], put) -> None:
    """Repeats among entries with a common anchor; ``shared[i]``: prefix entry i shares with i - 1."""
    least: dict[tuple[bytes, bytes], int] = {}
    for e in entries:
        c = (e[0], e[2])
        if c not in least or e[3] < least[c]:
            least[c] = e[3]
    lo, hi = min(e[3] for e in entries), max(e[3] for e in entries)
    if lo == hi:
        return
    for e in entries:  # the whole context is in a smaller document
        if least[(e[0], e[2])] < e[3]:
            put(e, len(e[2]), len(e[0]))
    contexts = list(least)
    if len(contexts) == 1:
        return
    if len(contexts) <= FEW:
        # in sorted order two suffixes share the least of the lengths between them
        between: list[int] = []
        new, run = set(contexts), LENGTH
        for e, k in zip(entries, shared, strict=True):
            run = min(run, k)
            if (e[0], e[2]) in new:
                new.discard((e[0], e[2]))
                between.append(run)
                run = LENGTH
        reach: dict[tuple[bytes, bytes], list] = {c: [] for c in contexts}
        for x, cx in enumerate(contexts):
            r = LENGTH
            for y in range(x + 1, len(contexts)):
                cy = contexts[y]
                r = min(r, between[y])
                n = common_prefix(cx[1][::-1], cy[1][::-1], 0)
                if n + r >= LENGTH:
                    reach[cx].append((least[cy], n, r))
                    reach[cy].append((least[cx], n, r))
        for e in entries:
            for key, n, r in reach[(e[0], e[2])]:
                if key < e[3]:
                    put(e, n, r)
        return
    for n in range(LENGTH - ANCHOR + 1):  # windows that start n bytes before the anchor
        windows: dict[bytes, int] = {}
        have = []
        for c, key in least.items():
            if len(c[1]) >= n and len(c[0]) >= LENGTH - n:
                w = c[1][len(c[1]) - n:] + c[0][:LENGTH - n]
                have.append((c, w))
                if w not in windows or key < windows[w]:
                    windows[w] = key
        of = dict(have)
        for e in entries:
            w = of.get((e[0], e[2]))
            if w is not None and windows[w] < e[3]:
                put(e, n, LENGTH - n)


def _windows_held(g: list[int], data: list[bytes]) -> pa.Table:
    """Holders of windows that a smaller id holds too."""
    parts = [_unpacked(d) for d in data]
    at = np.repeat(np.array(g, np.int64), [len(x[0]) for x in parts])
    h1, h2, key, doc, place = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((h2, h1))
    at, h1, h2, key, doc, place = (x[order] for x in (at, h1, h2, key, doc, place))
    begin = np.nonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))[0]
    least = np.repeat(np.minimum.reduceat(key, begin), np.diff(np.append(begin, len(key))))
    again = key > least
    blocks = np.unique(at[again])
    out = [_packed(doc[m], place[m], place[m] + LENGTH) for m in (again & (at == x) for x in blocks)]
    return pa.table({"g": pa.array(blocks, pa.int64()), "data": pa.array(out, pa.binary())})


def _match(key, table):
    g, data = table.column("g").to_pylist(), table.column("data").to_pylist()
    if key[0].as_py() == 2:
        return _windows_held(g, data)
    if key[0].as_py() == 1:  # settled inside the block
        return pa.table({"g": pa.array(g, pa.int64()), "data": pa.array(data, pa.binary())})
    found: dict[int, tuple[list, list, list]] = {}

    def put(e, left: int, right: int) -> None:
        out = found.setdefault(e[4], ([], [], []))
        out[0].append(e[5])
        out[1].append(e[6] - left)
        out[2].append(e[6] + right)

    entries: list = []
    lengths: list[int] = []
    for e, k in merged([_read_run(*x) for x in sorted(zip(g, data, strict=True))]):
        if k < ANCHOR and entries:
            if len(entries) > 1:
                _group(entries, lengths, put)
            entries, lengths = [], []
        entries.append(e)
        lengths.append(k)
    if len(entries) > 1:
        _group(entries, lengths, put)
    return pa.table({"g": pa.array(list(found), pa.int64()),
                     "data": pa.array([_packed(*[np.array(x, np.int64) for x in v]) for v in found.values()], pa.binary())})


# ---- 5: removal --------------------------------------------------------------------------
def _removed(key, left, right):
    keys, texts = left.column("k").to_pylist(), left.column("text").to_pylist()
    data = [(t or "").encode("utf-8", "replace") for t in texts]
    order = sorted(range(len(keys)), key=lambda i: (keys[i], data[i]))
    spans: dict[int, list] = {}
    if right.num_rows:
        d, s, e = (np.concatenate(x) for x in zip(*[_unpacked(x) for x in right.column("data").to_pylist()], strict=True))
        o = np.lexsort((s, d))
        for x, y, z in zip(d[o].tolist(), s[o].tolist(), e[o].tolist(), strict=True):
            own = spans.setdefault(x, [])
            if own and y <= own[-1][1]:
                own[-1][1] = max(own[-1][1], z)
            else:
                own.append([y, z])
    rows = []
    for place, i in enumerate(order):
        own, b = spans.get(place, []), data[i]
        edges = [0, *[x for s in own for x in s], len(b)]
        kept = b"".join(b[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True)) if own else b
        rows.append((None if keys[i] == NO_ID else keys[i], len(b), len(b) - len(kept), len(own), hashlib.sha256(kept).hexdigest()))
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    return pa.table({**{n: pa.array(c, pa.int64()) for n, c in zip(("doc_id", "n_bytes", "n_removed", "n_spans"), cols, strict=False)},
                     "kept_sha256": pa.array(cols[4], pa.string())})


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    ship_code(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # blocks and buckets grow with the square root of the input beyond 16 GB, so that the arrays between them stay whole
    more = max(1.0, (size / 16e9) ** 0.5)
    blocks = max(1, round(size / (BLOCK_BYTES * more)))
    buckets = max(1, round(size / (BUCKET_BYTES * more)))
    dealt = docs.withColumn("g", F.pmod(F.xxhash64("k"), F.lit(blocks)))
    by_block = dealt.groupBy("g")
    hashes = by_block.applyInArrow(_hashes(buckets), "bucket long, g long, data binary")
    shared = hashes.groupBy("bucket").applyInArrow(_shared(hot), "g long, data binary")
    runs = by_block.cogroup(shared.groupBy("g")).applyInArrow(_runs(buckets), "kind long, target long, g long, data binary")
    spans = runs.groupBy("kind", "target").applyInArrow(_match, "g long, data binary")
    return by_block.cogroup(spans.groupBy("g")).applyInArrow(
        _removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
