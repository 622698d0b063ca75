"""Spelling variants by a frequency-vector trie.

Words are counted first: maximal runs of Latin letters (A-Z lower-cased), of which a few, chosen by
a checksum of document and run, lose one letter. Each document's runs are counted in its task, so
what is shuffled is one row per task and word.

Letters fall into ``GROUPS`` groups; a word's *frequency vector* says how many letters of each group
it has, and the trie arranges the words by these numbers, one group after the other. Two words that
differ by one letter have vectors with at most one letter less in one group and at most one more in
another. So a word looks for its partners depth first with a budget of one deficit and one surplus;
what is left at a leaf is verified letter by letter. Every pair is found once: the longer word looks
for the shorter, and of two words of one length the one whose first difference is a deficit (or, if
their vectors are equal, the larger one) looks for the other. So a surplus may only follow a deficit.

The trie is spread over the cluster. A node is known by a hash of its path. All words descend the
first ``CROWN`` levels; those in nodes of more than ``NODE`` words descend further, level by level,
until the nodes are small, and what looks for them follows. A small node is one group: its words
become a trie in memory, and the words that look are searched in it. Words with the very same
vector that are still more than ``NODE`` are dealt into parts by a hash, and all that look visit
every part, so no group exceeds the bound and no pair is missed. Words that look are dealt as well,
``VISITS`` to a group. Per word only the number of near words and the best one leave a group.

A word's form is its most frequent near word, if that is ``RATIO`` times as frequent; forms are
followed to the last by pointer doubling.

Null and empty texts have no words; a null id stands as the empty text in the checksum; repeated rows
count each time; ties go to the smaller word. An empty table, or one without frequent words, gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import in_arrow, saved, ship_code
from .plain_words import in_parts

LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
EVERY = 199
GROUPS = 12
CROWN = 3
NODE = 20_000
VISITS = 100_000
LEAF = 12
MEMO = 200_000

#: Letters of one byte in ISO 8859-1: a-z and U+00C0 to U+00FF; A-Z are lower-cased.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
#: Frequent letters first, one after the other into the groups.
_ORDER = "etaoinshrdlcumwfgypbvkxjqz"
GROUP_OF = np.array([_ORDER.index(chr(b)) % GROUPS if 97 <= b <= 122 else b % GROUPS for b in range(256)])
FOUND = "word string, n long, n_near long, best_n long, best string"


def runs(text: str) -> list[bytes]:
    """Maximal runs of letters, A-Z lower-cased, in ISO 8859-1."""
    return text.encode("latin-1", "replace").translate(_FOLD).split()


def _count(batches):
    total: Counter = Counter()
    for b in in_parts(batches):
        for key, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
            if not text:
                continue
            start = zlib.crc32(f"{key}:".encode())
            for w, n in Counter([w for w in runs(text) if len(w) >= LEAST_LETTERS]).items():
                h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                if h % EVERY == 0:
                    k = h % len(w)
                    w = w[:k] + w[k + 1:]
                    if len(w) < LEAST_LETTERS:
                        continue
                total[w] += n
            if len(total) > MEMO:
                yield _counted(total)
                total.clear()
    if total:
        yield _counted(total)


def _counted(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(list(total.values()), pa.int64())],
                                      ["word", "n"])


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the words with their number of occurrences, ``LEAST_COUNT`` or more."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    return in_arrow(rows, _count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def vector(word: bytes) -> tuple[int, ...]:
    return tuple(np.bincount(GROUP_OF[np.frombuffer(word, np.uint8)], minlength=GROUPS).tolist())


def _path(node: int, count: int) -> int:
    """The child of a node for this number of letters in the next group."""
    return zlib.crc32(b"%d" % count, node & 0xFFFFFFFF) | (zlib.crc32(b"+%d" % count, node >> 32) & 0x7FFFFFFF) << 32


#: What was spent: nothing, the deficit, the deficit and then the surplus.
_SPENT = {0: ((0, 0), (-1, 1)), 1: ((0, 1), (1, 2)), 2: ((0, 2),)}


def _below(words, nodes, spent, looks, first: int, last: int):
    """Rows of the nodes at level ``last`` for words in nodes at level ``first``."""
    out = []
    for w, node, state, look in zip(words, nodes, spent, looks, strict=True):
        v = vector(w)
        at = [(node, state)]
        for level in range(first, last):
            at = [(_path(x, v[level] + more), after) for x, s in at
                  for more, after in (_SPENT[s] if look else _SPENT[2]) if v[level] + more >= 0]
        out += [(w, x, s, look) for x, s in at]
    return out


NODES = "word string, n long, node long, spent int, looks boolean"


def _descend(batches, first, last):
    for b in in_parts(batches):
        names = b.schema.names
        words, counts = (b.column(c).to_pylist() for c in ("word", "n"))
        n_of = dict(zip(words, counts, strict=True))
        raw = [w.encode("latin-1") for w in words]
        if "node" in names:
            rows = _below(raw, *(b.column(c).to_pylist() for c in ("node", "spent", "looks")), first, last)
        else:
            rows = [r for look in (False, True) for r in _below(raw, [0] * len(raw), [0 if look else 2] * len(raw), [look] * len(raw), first, last)]
        w, node, spent, looks = zip(*rows, strict=True) if rows else ((), (), (), ())
        w = [x.decode("latin-1") for x in w]
        yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array([n_of[x] for x in w], pa.int64()), pa.array(node, pa.int64()),
                                          pa.array(spent, pa.int32()), pa.array(looks, pa.bool_())], [c.split()[0] for c in NODES.split(", ")])


def one_apart(a: bytes, b: bytes) -> bool:
    """Whether one inserted, deleted or replaced letter makes one word of the other; ``a`` is not shorter."""
    if len(a) - len(b) > 1 or a == b:
        return False
    k = 0
    while k < len(b) and a[k] == b[k]:
        k += 1
    return a[k + 1:] == (b[k:] if len(a) > len(b) else b[k + 1:])


def _trie(words: list[tuple[tuple[int, ...], bytes, int]], level: int):
    """Nested dictionaries by the number of letters of each group; few words are a list."""
    if len(words) <= LEAF or level == GROUPS:
        return words
    parts: dict[int, list] = {}
    for w in words:
        parts.setdefault(w[0][level], []).append(w)
    return {c: _trie(p, level + 1) for c, p in parts.items()}


def _leaves(node, v, level, spent):
    """The words in the leaves that a vector reaches with what is left of its budget."""
    if isinstance(node, list):
        yield from node
        return
    for more, after in _SPENT[spent]:
        child = node.get(v[level] + more)
        if child is not None:
            yield from _leaves(child, v, level + 1, after)


def _looks_for(v, x, a: bytes, b: bytes) -> bool:
    """Whether of two words with these vectors the first one looks for the second."""
    if len(a) != len(b):
        return len(a) > len(b)
    for c, d in zip(v, x, strict=True):
        if c != d:
            return d < c
    return a > b


def search(words, counts, spent, looks, level: int):
    """The words of one node against those that look for them: {word: (n, near words, best n, best word)}."""
    inside, found = [], {}
    for w, n, look in zip(words, counts, looks, strict=True):
        if not look:
            inside.append((vector(w), w, n))
    top = _trie(inside, level)

    def met(w, n, other, m):
        own = found.get(w)
        # the best: most occurrences, then the smaller word
        best = (m, other) if own is None or m > own[2] or (m == own[2] and other < own[3]) else own[2:]
        found[w] = (n, (own[1] if own else 0) + 1, *best)

    for w, n, s, look in zip(words, counts, spent, looks, strict=True):
        if look:
            v = vector(w)
            for x, other, m in _leaves(top, v, level, s):
                if 0 <= len(w) - len(other) <= 1 and one_apart(w, other) and _looks_for(v, x, w, other):
                    met(w, n, other, m)
                    met(other, m, w, n)
    return found


def _search(table: pa.Table, level: int) -> pa.Table:
    words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    found = search(words, *(table.column(c).to_pylist() for c in ("n", "spent", "looks")), level)
    rows = [(w.decode("latin-1"), n, k, m, x.decode("latin-1")) for w, (n, k, m, x) in found.items()]
    cols = zip(*rows, strict=True) if rows else [()] * 5
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [c.split()[0] for c in FOUND.split(", ")])


def _searched(rows: DataFrame, sizes: DataFrame, level: int) -> DataFrame:
    """Search the nodes of ``rows``. Words and visits beyond the bounds are dealt into parts, and
    every part of the words meets every part of the visits."""
    dealt = rows.join(sizes, "node")
    i = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    j = F.pmod(F.xxhash64("word", F.lit(1)), F.col("visit_parts")).cast("int")
    dealt = dealt.withColumns({
        "part": F.explode(F.when(F.col("looks"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(i)))}).withColumns({
            "visit": F.explode(F.when(F.col("looks"), F.array(j)).otherwise(F.sequence(F.lit(0), F.col("visit_parts") - 1)))})
    ship_code(rows.sparkSession)

    def _one(table: pa.Table) -> pa.Table:
        return _search(table, level)

    return dealt.select("word", "n", "spent", "looks", "node", "part", "visit").groupBy("node", "part", "visit").applyInArrow(_one, FOUND)


def near_words(words: DataFrame, crown: int = CROWN, node_size: int = NODE, visits: int = VISITS) -> DataFrame:
    """(word, n, n_near, best_n, best) of the words with near words."""
    level, found = crown, None
    rows = saved(in_arrow(words.select("word", "n"), _descend, NODES, 0, crown), "nodes")
    while True:
        sizes = rows.groupBy("node").agg(F.count_if(~F.col("looks")).alias("size"), F.count_if("looks").alias("visits")).where("size > 0 AND visits > 0")
        sizes = saved(sizes.select("node", "size", F.ceil(F.col("size") / F.lit(node_size)).cast("int").alias("parts"),
                                   F.ceil(F.col("visits") / F.lit(visits)).cast("int").alias("visit_parts")), "sizes")
        large = sizes.where(F.col("size") > node_size)
        over = level < GROUPS and not large.isEmpty()
        own = _searched(rows, sizes.where(F.col("size") <= node_size) if over else sizes, level)
        found = own if found is None else found.union(own)
        if not over:
            break
        rows = saved(in_arrow(rows.join(large.select("node"), "node", "left_semi").select("word", "n", "node", "spent", "looks"), _descend, NODES,
                              level, level + 1), "nodes")
        level += 1
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return (found.groupBy("word").agg(F.first("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): the last form of each word that has one, in as many rounds as
    the logarithm of the longest chain."""
    at = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        seen = Observation()
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        at = saved(step.observe(seen, F.count_if("moved").alias("moved")), "roots").drop("moved")
        if not seen.get["moved"]:
            return at


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n."""
    words = saved(vocabulary(docs, doc_id, text), "words")
    near = near_words(words).select("word", "n_near", "best_n", "best")
    fits = F.col("best_n") >= ratio * F.col("n")
    rows = saved(words.join(near, "word", "left").select(
        "word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best_n")).alias("form_n")), "variants")
    roots = _roots(rows.where("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
