"""Near-duplicate groups by a chosen-path set similarity join.

A document is the set of its distinct five-word shingles, embedded as ``WIDTH`` minwise tokens.
A *tree* starts with all documents at its root. A node picks one position, and a second one with a
probability that makes ``1 / SIMILARITY`` on average, by a hash of the node's own path, so every
document makes the same choice; it sends its documents down one branch per picked position and token
there. Two sets of similarity s agree at a position with probability s, so a pair at the threshold
keeps one shared branch per level on average while others die out. A node of at most ``LEAF``
documents is compared exhaustively; a larger one branches again, ``DEPTH`` times at most, and is then
compared in blocks, so no size is beyond it. The number of independent trees follows from
``TARGET``, the recall wanted for a pair exactly at the threshold: by the recursion of this branching
process a pair is lost in one tree of full depth with probability 0.60, in ten with 0.006. Roots pick
positions of their own, so the trees do not share their first choice.

Work is saved in exact ways. Equal sets are one representative. A node compares its members with one
chosen member first (the same order in every node, so a group meets around few members); one such
pair per document is confirmed, then its likeliest other one, and the links are joined into components.
After that only pairs from *different* components are compared, since a link inside a component
changes nothing; nodes within one component are dropped, whatever their size. A pair that meets in
several roots of at most ``LEAF`` documents is compared in the first of them only.

A node then names the documents that may be linked into another component - each of them once,
however many partners it has. Only their texts are brought into the node, where pairs are confirmed,
the likeliest first, and joined by union-find on the spot: two documents that anything has joined
are not looked at again, and a node of n documents puts out n - 1 links at most. Documents of more
than ``HEFT`` shingles together are dealt into parts, and every two parts meet in a group of their own.

Pairs are pre-selected by the sizes of their sets and by the share of equal minwise tokens
(``MAYBE``, almost three standard deviations below the threshold: it keeps 99.8 % of the pairs
that are exactly at it), and every link is confirmed
on the full sets. Comparing takes only the low 8 bits of each token, which adds a 256th of the
unequal ones to the share.

Null text, and text without words, has the empty set and is linked with nothing; shorter texts
have their whole word sequence as one shingle. Rows with the same id are linked. A null id
counts as smaller than all others. Other columns are not read.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, mix64, saved, ship_code
from .components import components

WORDS = 5
SIMILARITY = 0.75
WIDTH = 128
TARGET = 0.99
LEAF = 2048
DEPTH = 6
MAYBE = 0.64
HEFT = 2_000_000  # shingles that meet in one group, and OVER for each document
OVER = 500
FOUND = "node long, root int, k long"
MEMBER = ["k", "n", "comp", "large"]
NO_ID = -(1 << 63)
MEMO = 200_000


class _WordHash(dict):
    def __missing__(self, word):
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASH = _WordHash()
_FACTOR = [np.uint64(xxhash.xxh3_64_intdigest(b"f%d" % k) | 1) for k in range(WORDS)]
_MULT = np.array([xxhash.xxh3_64_intdigest(b"m%d" % k) | 1 for k in range(WIDTH)], np.uint64)
_ADD = np.array([xxhash.xxh3_64_intdigest(b"a%d" % k) for k in range(WIDTH)], np.uint64)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; A-Z lower-cased, words as bytes between spaces."""
    w = text.encode("utf-8", "replace").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASH.__getitem__, w), np.uint64, len(w))
    if len(w) < words:
        return mix64(np.array([xxhash.xxh3_64_intdigest(b" ".join(w), seed=len(w))], np.uint64))
    n = len(w) - words + 1
    s = np.zeros(n, np.uint64)
    for k in range(words):
        s += h[k:k + n] * _FACTOR[k]
    return np.unique(mix64(s))


def minwise(tokens: np.ndarray) -> np.ndarray:
    """For each position the 32-bit token that is least under the position's hash."""
    least = np.full(WIDTH, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(tokens), 256):
        np.minimum(least, (tokens[k:k + 256, None] * _MULT + _ADD).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _sets(batches):
    for b in batches:
        rows = []
        for key, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
            s = shingles(text or "")
            h = xxhash.xxh3_128_digest(s.tobytes())
            h1, h2 = np.frombuffer(h, "<i8").tolist()
            rows.append((key, len(s), h1, h2, minwise(s).tobytes() if len(s) else None))
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.binary()), b.column("t")],
                                         ["id", "n", "h1", "h2", "sig", "t"])


def lost(levels: int, similarity: float = SIMILARITY) -> float:
    """Probability that a pair of this similarity shares no node any more after so many levels of one tree."""
    q, second = 0.0, 1 / similarity - 1
    for _ in range(levels):
        x = 1 - similarity * (1 - q)
        q = x * (1 - second + second * x)
    return q


def trees_for(target: float, depth: int) -> int:
    """Trees with which a pair at the threshold is found with probability ``target`` after ``depth``
    branchings below the root."""
    return math.ceil(math.log(1 - target) / math.log(lost(depth + 1)))


def _draw(path: int, k: int) -> int:
    return int(mix64(np.array([path + k * 0x9E3779B97F4A7C15 & (1 << 64) - 1], np.uint64))[0])


def _picks_two(path: int) -> bool:
    return _draw(path, 1) < int((1 / SIMILARITY - 1) * 2 ** 64)


@functools.lru_cache(maxsize=1 << 16)
def _picked(path: int) -> tuple[int, ...]:
    """The positions that the node of this path branches on: one or two."""
    first = _draw(path, 2) % WIDTH
    return (first, (first + 1 + _draw(path, 3) % (WIDTH - 1)) % WIDTH) if _picks_two(path) else (first,)


@functools.lru_cache(maxsize=8)
def root_positions(trees: int) -> tuple[tuple[int, int], ...]:
    """(path of the tree, position) of all branches of all roots; no position comes twice."""
    order = sorted(range(WIDTH), key=lambda p: _draw(p, 4))
    paths = [xxhash.xxh3_64_intdigest(b"tree%d" % t) for t in range(trees)]
    branches = [path for path in paths for _ in range(1 + _picks_two(path))]
    return tuple(zip(branches, order, strict=False))


def _child(path, position, token):
    with np.errstate(over="ignore"):
        return mix64(np.uint64(path & (1 << 64) - 1) * np.uint64(0xD6E8FEB86659FD93) + _ADD[position] + token.astype(np.uint64) * _MULT[position])


def _roots(batches, trees):
    for b in batches:
        sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), "<u4").reshape(-1, WIDTH)
        k, n = b.column("k").to_numpy(), b.column("n").to_numpy()
        for i, (path, p) in enumerate(root_positions(trees)):
            node = _child(path, p, sig[:, p])
            yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(np.full(len(k), i, np.int32)), pa.array(k), pa.array(n)],
                                             ["node", "root", "k", "n"])


def _branch(batches):
    for b in batches:
        sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), "<u2").reshape(-1, WIDTH)
        out: list[tuple] = []
        for i, node in enumerate(b.column("node").to_pylist()):
            for p in _picked(node):
                out.append((i, int(_child(node, p, sig[i, p:p + 1])[0].view(np.int64))))
        if out:
            rows = b.take(pa.array([i for i, _ in out]))
            yield pa.RecordBatch.from_arrays([pa.array([c for _, c in out], pa.int64()), pa.array(np.full(len(out), -1, np.int32)),
                                              *map(rows.column, MEMBER)], ["node", "root", *MEMBER])


def _shortened(batches, trees):
    """Of the minwise tokens 16 bits to branch on below the root, and 8 to compare with the roots'
    whole tokens behind them."""
    at = [p for _, p in root_positions(trees)]
    for b in batches:
        sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), "<u4").reshape(-1, WIDTH)
        branch = [x.tobytes() for x in sig.astype("<u2")]
        short = [x.tobytes() + y.tobytes() for x, y in zip(sig.astype(np.uint8), sig[:, at], strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(branch, pa.binary()), pa.array(short, pa.binary())], ["k", "branch", "sig"])


def _parts(sigs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens to compare, and the roots' tokens."""
    if not sigs:
        return np.empty((0, WIDTH), np.uint8), np.empty((0, 1), "<u4")
    raw = np.frombuffer(b"".join(sigs), np.uint8).reshape(len(sigs), -1)
    return raw[:, :WIDTH], np.ascontiguousarray(raw[:, WIDTH:]).view("<u4")


def _alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x == y).mean(axis=-1)


def _maybe(batches):
    """Pairs whose minwise tokens agree often enough, with the share."""
    for b in batches:
        x, y = (_parts(b.column(c).to_pylist())[0] for c in ("sig_a", "sig_b"))
        s = _alike(x, y)
        keep = np.nonzero(s >= MAYBE)[0]
        yield pa.RecordBatch.from_arrays([b.column("a").take(pa.array(keep)), b.column("b").take(pa.array(keep)), pa.array(s[keep])],
                                         ["a", "b", "s"])


class _Members:
    """Members of one node, or of two parts of one, and which pairs of them are to be looked at."""

    def __init__(self, table: pa.Table):
        self.k, self.n, self.comp, self.large, self.root, side = (table.column(c).to_numpy() for c in (*MEMBER, "root", "side"))
        self.sig, self.roots = _parts(table.column("sig").to_pylist())
        # roots that are compared exhaustively: whoever meets there need not meet here
        small = (self.large[:, None] >> np.arange(self.roots.shape[1]) & 1) == 0
        here = self.root[0] if len(self.root) else 0
        self.small = small & (np.arange(self.roots.shape[1]) < (here if here >= 0 else WIDTH))
        both = np.nonzero(side == 2)[0]
        self.left, self.right = (both, both) if len(both) else (np.nonzero(side == 0)[0], np.nonzero(side == 1)[0])
        self.one = len(both) > 0

    def partners(self, i: int, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Members of other components that ``i`` may be linked with, and the share of equal tokens."""
        j = self.right[self.right > i] if self.one else self.right
        j = j[(comp[j] != comp[i]) & (4 * np.minimum(self.n[j], self.n[i]) >= 3 * np.maximum(self.n[j], self.n[i]))]
        share = _alike(self.sig[j], self.sig[i])
        near = share >= MAYBE
        j, share = j[near], share[near]
        new = ~((self.roots[j] == self.roots[i]) & self.small[i]).any(axis=1)
        return j[new], share[new]


def _compare(table: pa.Table) -> pa.Table:
    """The members that may be linked into another component; each once."""
    m = _Members(table)
    hit = np.zeros(len(m.k), bool)
    for i in m.left:
        j, _ = m.partners(i, m.comp)
        if len(j):
            hit[i] = True
            hit[j] = True
    return table.select(["node", "root", "k"]).filter(pa.array(hit))


def _links(table: pa.Table) -> pa.Table:
    """The links that join components which nothing in this table joined before, on the full sets. Pairs
    that are likely links come before those that are not."""
    m = _Members(table)
    texts = table.column("text")
    sets: dict[int, np.ndarray] = {}
    comp = m.comp.copy()
    held: dict[int, list[int]] = {}
    for i, c in enumerate(comp.tolist()):
        held.setdefault(c, []).append(i)
    links = []

    def tokens(i):
        if i not in sets:
            sets[i] = shingles(texts[int(i)].as_py() or "")
        return sets[i]

    def join(i, j):
        """The smaller component takes the larger one's name."""
        a, b = sorted((int(comp[i]), int(comp[j])), key=lambda c: len(held[c]))
        comp[held[a]] = b
        held[b] += held.pop(a)

    for likely in (True, False):
        for i in m.left:
            j, share = m.partners(i, comp)
            mine = (share >= SIMILARITY) == likely
            j, share = j[mine], share[mine]
            for x in j[np.argsort(-share, kind="stable")]:
                if comp[x] != comp[i] and _link(tokens(i), tokens(x)):
                    join(i, x)
                    links.append((m.k[i], m.k[x]))
    a, b = zip(*links, strict=True) if links else ([], [])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _link(x: np.ndarray, y: np.ndarray) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= 75 * (len(x) + len(y) - shared)


def _linked(batches):
    for b in batches:
        keep = []
        for x, y in zip(b.column("text_a").to_pylist(), b.column("text_b").to_pylist(), strict=True):
            keep.append(_link(shingles(x or ""), shingles(y or "")))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("a").filter(mask), b.column("b").filter(mask)], ["a", "b"])


class _Texts:
    """The texts of representatives. A representative is known by its number ``k``, and its text by id
    and hash, of which any row will do."""

    def __init__(self, reps: DataFrame, docs: DataFrame):
        self.reps, self.docs = reps.select("k", "id", "t"), docs

    def of(self, wanted: DataFrame) -> DataFrame:
        """(k, text) for the ``k`` in ``wanted``."""
        own = self.reps.join(wanted.select("k").distinct(), "k")
        rows = self.docs.join(own.select("id", "t"), ["id", "t"], "left_semi").dropDuplicates(["id", "t"])
        return own.join(rows, ["id", "t"]).select("k", "text")


def _confirmed(pairs: DataFrame, texts: _Texts) -> DataFrame:
    """The pairs that are linked, on their full sets. Texts travel, not sets: they compress."""
    found = texts.of(pairs.select(F.col("a").alias("k")).union(pairs.select(F.col("b").alias("k"))))
    out = (pairs.select("a", "b").join(found.withColumnsRenamed({"k": "b", "text": "text_b"}), "b")
           .join(found.withColumnsRenamed({"k": "a", "text": "text_a"}), "a"))
    return in_arrow(out.select("a", "b", "text_a", "text_b"), _linked, "a long, b long").distinct()


def _across(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs (a, b, s) whose ends are in different components, with these."""
    one = _labelled(pairs.withColumnRenamed("a", "k"), comps).withColumnsRenamed({"k": "a", "comp": "ca", "b": "k"})
    two = _labelled(one, comps).withColumnsRenamed({"k": "b", "comp": "cb"})
    return two.where("ca <> cb").select("a", "b", "s", F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb"))


def _likeliest(pairs: DataFrame, comps: DataFrame, texts: _Texts) -> DataFrame:
    """The components after confirming each document's likeliest pair into another one."""
    left = _across(pairs, comps)
    ends = left.select(F.col("a").alias("v"), "s", "a", "b").union(left.select(F.col("b").alias("v"), "s", "a", "b"))
    top = saved(ends.groupBy("v").agg(F.max(F.struct("s", "a", "b")).alias("p")).select("p.a", "p.b").distinct(), "pairs")
    return comps if top.isEmpty() else _joined(comps, _confirmed(top, texts))


def _dealt(rows: DataFrame, size: Column) -> DataFrame:
    """Members of a node dealt into ``size`` parts: every two parts (x, y) meet in a group of their own,
    a single one is one group. ``side`` says which of the two a row belongs to, 2 if there is one."""
    other = F.explode(F.sequence(F.lit(0), F.col("_size") - 1))
    met = (rows.withColumn("_size", size.cast("int")).withColumn("own", F.pmod(F.xxhash64("k"), F.col("_size")).cast("int"))
           .withColumn("other", other))
    return met.withColumns({
        "x": F.least("own", "other"), "y": F.greatest("own", "other"),
        "side": F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)}).drop("own", "other", "_size")


def _settled(found: DataFrame, comps: DataFrame, members: DataFrame, texts: _Texts, sigs: DataFrame) -> DataFrame:
    """The components after confirming, node by node, what may be linked there."""
    rows = saved(found.distinct().join(members, "k"), "found")
    heft = rows.groupBy("node").agg((F.floor(F.sum(F.col("n") + OVER) / F.lit(HEFT)) + 1).alias("parts"))
    dealt = _dealt(rows.join(heft, "node"), F.col("parts")).drop("parts")
    ship_code(rows.sparkSession)
    held = dealt.join(sigs, "k").join(texts.of(rows), "k")
    return _joined(comps, held.groupBy("node", "x", "y").applyInArrow(_links, "a long, b long"))


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    return components(comps.select(F.col("vertex").alias("a"), F.col("root").alias("b")).union(links.select("a", "b")))


def _labelled(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """``rows`` (k, ...) with the component of k so far."""
    return (rows.join(comps.withColumnRenamed("vertex", "k"), "k", "left")
            .withColumn("comp", F.coalesce("root", "k")).drop("root"))


def _open(nodes: DataFrame) -> DataFrame:
    """Rows of the nodes that span several components, with the node's size."""
    spread = (nodes.groupBy("node").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"))
              .where("lo <> hi").select("node", "size"))
    return nodes.join(spread, "node")


def _compared(nodes: DataFrame, sigs: DataFrame) -> DataFrame:
    """(node, k) of the members that may be linked into another component."""
    rows = _dealt(nodes, F.ceil(F.col("size") / F.lit(LEAF))).select("node", "x", "y", "side", "root", *MEMBER)
    ship_code(nodes.sparkSession)
    return rows.join(sigs, "k").groupBy("node", "x", "y").applyInArrow(_compare, FOUND)


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", target: float = TARGET) -> DataFrame:
    """Per row of ``docs``: its key (the id; null as the smallest number), n_shingles and
    component, the smallest key reachable over links."""
    trees = trees_for(target, DEPTH)
    keyed = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"))
    keyed = keyed.withColumn("t", F.xxhash64("text"))
    sets = saved(in_arrow(keyed, _sets, "id long, n long, h1 long, h2 long, sig binary, t long"), "sets")
    # one representative per distinct set, with a number of its own
    alike = sets.where("n > 0").groupBy("h1", "h2").agg(F.min(F.struct("id", "t")).alias("p"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    reps = saved(alike.select(F.monotonically_increasing_id().alias("k"), "p.id", "p.t", "n", "sig", "h1", "h2"), "reps")
    texts = _Texts(reps, keyed)
    short = saved(in_arrow(reps.select("k", "sig"), _shortened, "k long, branch binary, sig binary", trees), "short")
    sigs = short.select("k", "sig")

    nodes = in_arrow(reps.select("k", "n", "sig"), _roots, "node long, root int, k long, n long", trees)
    # the same order in every node, so that a group meets around few members
    order = F.struct(F.xxhash64("k").alias("o"), F.col("k").alias("k"), F.col("n").alias("n"))
    lead = saved(nodes.groupBy("node").agg(F.min(order).alias("lead"), F.count("*").alias("size")).where("size > 1")
                 .select("node", "size", F.col("lead.k").alias("lead"), F.col("lead.n").alias("lead_n")), "leaders")
    stars = (nodes.join(lead, "node").where("k <> lead AND 4 * least(n, lead_n) >= 3 * greatest(n, lead_n)")
             .select(F.col("k").alias("a"), F.col("lead").alias("b")).distinct())
    both = (stars.join(sigs.withColumnsRenamed({"k": "a", "sig": "sig_a"}), "a")
            .join(sigs.withColumnsRenamed({"k": "b", "sig": "sig_b"}), "b").select("a", "b", "sig_a", "sig_b"))
    maybe = saved(in_arrow(both, _maybe, "a long, b long, s double"), "maybe")

    # each member with the first leader in that order that is likely a link
    first = F.min(F.struct((F.col("s") < F.lit(SIMILARITY + 0.04)).alias("unsure"), F.xxhash64("b").alias("o"), F.col("b").alias("b")))
    around = maybe.groupBy("a").agg(first.alias("p")).select("a", "p.b")
    links = _confirmed(around, texts).union(_of_one_id(sets, reps))
    comps = _likeliest(maybe, components(links), texts)

    # which of its roots branch again, for every representative
    large = (nodes.join(lead.where(F.col("size") > LEAF).select("node"), "node", "left_semi")
             .groupBy("k").agg(F.bit_or(F.expr("shiftleft(1L, root)")).alias("large")))
    members = saved(_labelled(reps.select("k", "n"), comps).join(large, "k", "left")
                    .select("k", "n", "comp", F.coalesce("large", F.lit(0).cast("long")).alias("large")), "members")
    level, found = saved(_open(nodes.select("node", "root", "k").join(members, "k")), "nodes"), None
    for depth in range(DEPTH + 1):
        last = depth == DEPTH
        own = _compared(level if last else level.where(F.col("size") <= LEAF), sigs)
        found = own if found is None else found.union(own)
        above = level.where(F.col("size") > LEAF)
        if last or above.isEmpty():
            break
        below = in_arrow(above.select("node", *MEMBER).join(short.select("k", F.col("branch").alias("sig")), "k"), _branch,
                         "node long, root int, " + ", ".join(f"{c} long" for c in MEMBER))
        level = saved(_open(below.distinct()), "nodes")
    comps = _settled(found, comps, members, texts, sigs)

    rooted = saved(_labelled(reps.select("k", "id", "h1", "h2"), comps).select("comp", "id", "h1", "h2"), "roots")
    least = rooted.groupBy("comp").agg(F.min("id").alias("set_root"))
    roots = rooted.join(least, "comp").select("h1", "h2", "set_root")
    return (sets.select(F.col("id").alias("k"), "n", "h1", "h2").join(roots, ["h1", "h2"], "left")
            .select("k", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("set_root")).otherwise(F.col("k")).alias("component")))


def _of_one_id(sets: DataFrame, reps: DataFrame) -> DataFrame:
    """Links between the representatives of rows that share an id, around one of them."""
    ids = sets.where("n > 0").groupBy("id").agg(F.min(F.struct("h1", "h2")).alias("lo"), F.max(F.struct("h1", "h2")).alias("hi")).where("lo <> hi")
    several = sets.where("n > 0").select("id", "h1", "h2").join(ids, "id").select("h1", "h2", F.col("lo.h1").alias("l1"), F.col("lo.h2").alias("l2")).distinct()
    one, two = (reps.select(F.col("k").alias(k), F.col("h1").alias(h1), F.col("h2").alias(h2)) for k, h1, h2 in (("a", "h1", "h2"), ("b", "l1", "l2")))
    return several.join(one, ["h1", "h2"]).join(two, ["l1", "l2"]).where("a <> b").select("a", "b")


def _null(c: str):
    return F.when(F.col(c) != NO_ID, F.col(c))


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    return groups(docs).select(_null("k").alias("doc_id"), "n_shingles", _null("component").alias("component_id"),
                               (F.col("k") == F.col("component")).alias("kept"))


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that are the first of their group."""
    first = groups(docs, doc_id, text).where("k = component").select("k").distinct()
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))
    kept = docs.select(F.struct("*").alias("whole"), key.alias("k")).join(first, "k", "left_semi")
    return kept.select(*[F.col("whole").getField(c).alias(c) for c in docs.columns])
