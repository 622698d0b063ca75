"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts are sequences of plain words (A-Z lower-cased). A *window* is ``WINDOW`` consecutive words of
an item; an item with fewer words, but not none, is one window as a whole. The automaton holds all
substrings of all items. A document's words are streamed through it, which gives at every word
the length of the longest match that ends there; from ``WINDOW`` on, the last words are a window,
and the state that holds exactly these words knows the items. A short item is known by the state
that holds all of it. Between words that no item has side by side the longest match is one word,
so only stretches of known neighbours are walked; that test may let too much through, never too
little.

Items are cut into pieces that overlap by ``WINDOW - 1`` words and dealt into shards of about
``SHARD_WORDS`` words, so an automaton in a worker has a fixed size (about 80 bytes a word) whatever
the benchmark holds. Documents meet one shard after the other; with one shard - any benchmark of up
to a million words - they are read once and nothing is shuffled. With more, matches are a function
of the text and are joined to the rows by its hash, one row per different text.

``cleaned`` removes what exceeds the limits: matched spans (at least a window long) leave the text,
and documents with more than ``MAX_SHARE`` of their words matched leave altogether.

Null and empty texts have no words and no matches; items without words have no windows. A null
item id counts as the empty id; rows with one item id are one item. Repeated rows give repeated
results. Without items, or without documents, nothing matches. Other columns are kept by ``cleaned``
and not read by ``matches``.
"""

from __future__ import annotations

import hashlib
import itertools
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_arrow, saved
from .plain_words import in_parts, places, raw_texts, words

WINDOW = 10
SHARD_WORDS = 1_000_000
PIECE_WORDS = 4096
MAX_SHARE = 0.5
FOUND = "n_words long, longest long, first array<int>, last array<int>, items array<string>"


class Automaton:
    """Suffix automaton of several sequences of word numbers. Most states have one successor, which
    lies in two arrays; the others' are in ``more``."""

    def __init__(self):
        self.length, self.link = array("i", [0]), array("i", [-1])
        self.word, self.next, self.more = array("i", [-1]), array("i", [-1]), {}

    def step(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.next[state]
        other = self.more.get(state)
        return other.get(word, -1) if other else -1

    def _put(self, state: int, word: int, to: int) -> None:
        if self.word[state] in (-1, word):
            self.word[state], self.next[state] = word, to
        else:
            self.more.setdefault(state, {})[word] = to

    def _state(self, length: int, link: int, like: int = -1) -> int:
        self.length.append(length)
        self.link.append(link)
        self.word.append(-1 if like < 0 else self.word[like])
        self.next.append(-1 if like < 0 else self.next[like])
        if like in self.more:
            self.more[len(self.link) - 1] = dict(self.more[like])
        return len(self.link) - 1

    def _split(self, state: int, word: int, to: int) -> int:
        """The state of the strings of ``state`` and the word, where ``to`` also holds longer ones."""
        if self.length[to] == self.length[state] + 1:
            return to
        own = self._state(self.length[state] + 1, self.link[to], like=to)
        self.link[to] = own
        while state >= 0 and self.step(state, word) == to:
            self._put(state, word, own)
            state = self.link[state]
        return own

    def add(self, sequence) -> None:
        last = 0
        for word in sequence:
            known = self.step(last, word)
            if known >= 0:
                last = self._split(last, word, known)
                continue
            at, new = last, self._state(self.length[last] + 1, 0)
            while at >= 0 and (known := self.step(at, word)) < 0:
                self._put(at, word, new)
                at = self.link[at]
            if at >= 0:
                self.link[new] = self._split(at, word, known)
            last = new

    def walk(self, sequence):
        """Per word: the state and the length of the longest match that ends there."""
        state, n = 0, 0
        for word in sequence:
            while (to := self.step(state, word)) < 0 and state:
                state = self.link[state]
                n = self.length[state]
            if to >= 0:
                state, n = to, n + 1
            yield state, n


class Items:
    """The automaton of some pieces (item id, words), and which items its states stand for."""

    def __init__(self, pieces: list[tuple[str, bytes]], window: int = WINDOW):
        self.window, self.auto, self.numbers = window, Automaton(), {}
        sequences = [(item, [self.numbers.setdefault(w, len(self.numbers) + 1) for w in text.split()]) for item, text in pieces]
        for _, s in sequences:
            self.auto.add(s)
        length, link = self.auto.length, self.auto.link
        # the state of a match's last `window` words, for each state that has so many
        self.whole = np.full(len(length), -1, np.int32)
        for v in np.argsort(np.frombuffer(length, np.int32), kind="stable").tolist():
            if length[v] >= window:
                self.whole[v] = self.whole[link[v]] if length[link[v]] >= window else v
        self.holders: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        pairs, self.least = set(), window
        for item, s in sequences:
            pairs.update(zip(s[:-1], s[1:], strict=True))
            for v, n in self.auto.walk(s):
                if n >= window:
                    self.holders.setdefault(int(self.whole[v]), set()).add(item)
            if len(s) < window:
                self.short.setdefault(v, {}).setdefault(len(s), set()).add(item)
                self.least = min(self.least, len(s))
        # next state with short items on the way to the root
        self.marked = self.short and self._marked()
        bits = max(12, (16 * len(pairs)).bit_length())
        self.shift, self.pairs = np.uint64(64 - bits), np.zeros(1 << bits, bool)
        if pairs:
            a, b = np.array(list(pairs), np.uint64).T
            self.pairs[self._code(a, b)] = True

    def _marked(self):
        found = array("i", [-1] * len(self.auto.link))
        for v in np.argsort(np.frombuffer(self.auto.length, np.int32), kind="stable").tolist():
            found[v] = v if v in self.short else found[self.auto.link[v]] if v else -1
        return found

    def _code(self, a, b):
        return (a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xD6E8FEB86659FD93) >> self.shift

    def _stretches(self, n: np.ndarray) -> list[tuple[int, int]]:
        """Where a match of the shortest window may lie."""
        if len(n) < self.least:
            return []
        good = n > 0 if self.least == 1 else self.pairs[self._code(n[:-1], n[1:])]
        need = max(1, self.least - 1)
        if np.count_nonzero(good) < need:
            return []
        edge = np.flatnonzero(np.diff(np.concatenate(([False], good, [False]))))
        first, last = edge[::2], edge[1::2]
        long = last - first >= need
        return list(zip(first[long].tolist(), (last[long] + (self.least > 1)).tolist(), strict=True))

    def find(self, text: list[bytes]) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Longest match, maximal runs of words in windows, and the items of these windows."""
        longest, runs, items = 0, [], set()
        numbers = np.fromiter(map(self.numbers.get, text, itertools.repeat(0)), np.uint64, len(text))
        for start, end in self._stretches(numbers):
            at = start
            for state, n in self.auto.walk(numbers[start:end].tolist()):
                at += 1
                size = 0
                if n >= self.window:
                    size = self.window
                    items |= self.holders[int(self.whole[state])]
                if self.marked:
                    v = self.marked[state]
                    while v >= 0:
                        for k, own in self.short[v].items():
                            if k <= n:
                                size = max(size, k)
                                items |= own
                        v = self.marked[self.auto.link[v]] if v else -1
                longest = max(longest, n if size else 0)
                if size:
                    first = at - size
                    while runs and runs[-1][1] >= first:
                        first = min(first, runs.pop()[0])
                    runs.append((first, at))
        return longest, runs, items


def _pieces(batches, window, size):
    for b in in_parts(batches):
        rows = []
        for item, text in zip(b.column("item").to_pylist(), raw_texts(b, "text"), strict=True):
            w = words(text)
            starts = range(0, max(1, len(w) - window + 1), size) if w else ()
            rows += [(item, b" ".join(part), len(part)) for part in (w[s:s + size + window - 1] for s in starts)]
        item, text, n = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(text, pa.binary()), pa.array(n, pa.int64())],
                                         ["item", "words", "n"])


def shards(items: DataFrame, item_id: str, text: str, window: int = WINDOW, shard_words: int = SHARD_WORDS):
    """The items' pieces, shard by shard: at most about ``shard_words`` words at a time."""
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    pieces = saved(in_arrow(named, _pieces, "item string, words binary, n long", window, PIECE_WORDS).distinct(), "pieces")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    n = -(-total // shard_words)
    dealt = pieces.select("item", "words", F.pmod(F.xxhash64("item", "words"), F.lit(max(1, n))).alias("shard"))
    for k in range(n):
        yield sorted((r.item, bytes(r.words)) for r in dealt.where(F.col("shard") == k).collect())


_BUILT: dict[tuple, Items] = {}


def _items(key: tuple, pieces) -> Items:
    """One automaton per worker process, the last one used."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Items(pieces, key[1])
    return _BUILT[key]


def _key(pieces, window: int) -> tuple:
    return hashlib.sha256(repr(pieces).encode()).hexdigest(), window


def _match(batches, key, pieces, only):
    """Beside the other columns what the text matches; ``only``: rows with matches."""
    known = _items(key, pieces)
    for b in in_parts(batches):
        out = []
        for text in raw_texts(b, "text"):
            w = words(text)
            longest, runs, items = known.find(w)
            out.append((len(w), longest, [s for s, _ in runs], [e for _, e in runs], sorted(items)))
        cols, names = [c for c, k in zip(b.columns, b.schema.names, strict=True) if k != "text"], [k for k in b.schema.names if k != "text"]
        done = pa.RecordBatch.from_arrays([*cols, *_columns(out)], [*names, *[c.split()[0] for c in FOUND.split(", ")]])
        yield done.filter(pa.array([bool(x[2]) for x in out], pa.bool_())) if only else done


def _columns(rows):
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string())]
    return [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)]


def _unite(batches):
    """The runs of all shards as one list."""
    for b in in_parts(batches):
        out = []
        for text, longest, first, last, items in zip(raw_texts(b, "text"), *(b.column(c).to_pylist() for c in ("longest", "first", "last", "items")), strict=True):
            runs: list[tuple[int, int]] = []
            for s, e in sorted((s, e) for ss, ee in zip(first or (), last or (), strict=True) for s, e in zip(ss, ee, strict=True)):
                if runs and s <= runs[-1][1]:
                    s, e = runs[-1][0], max(e, runs.pop()[1])
                runs.append((s, e))
            out.append((len(words(text)), longest or 0, [s for s, _ in runs], [e for _, e in runs], sorted({x for own in items or () for x in own})))
        yield pa.RecordBatch.from_arrays([b.column("whole"), *_columns(out)], ["whole", *[c.split()[0] for c in FOUND.split(", ")]])


def _fields(schema: str, *before: T.StructField) -> T.StructType:
    return T.StructType([*before, *T._parse_datatype_string(schema).fields])


def _found(rows: DataFrame, items: DataFrame, item_id: str, item_text: str, window: int, shard_words: int) -> DataFrame:
    """``rows`` (whole, text) -> whole and FOUND."""
    parts = shards(items, item_id, item_text, window, shard_words)
    whole = rows.schema["whole"]
    one, two = next(parts, []), next(parts, None)
    if two is None:
        return in_arrow(rows.select("whole", "text"), _match, _fields(FOUND, whole), _key(one, window), one, False)
    keys = {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")}
    texts = rows.select("text", *[v.alias(k) for k, v in keys.items()])
    found = None
    for part in itertools.chain([one, two], parts):
        own = in_arrow(texts, _match, "h1 long, h2 long, " + FOUND, _key(part, window), part, True)
        # one row per different text and shard, whatever the number of copies
        own = saved(own.groupBy("h1", "h2").agg(*[F.first(c).alias(c) for c in ("longest", "first", "last", "items")]), "matches")
        found = own if found is None else found.union(own)
    merged = found.groupBy("h1", "h2").agg(F.max("longest").alias("longest"), *[F.collect_list(c).alias(c) for c in ("first", "last", "items")])
    joined = rows.withColumns(keys).join(merged, ["h1", "h2"], "left").select("whole", "text", "longest", "first", "last", "items")
    return in_arrow(joined, _unite, _fields(FOUND, whole))


def _rows(docs: DataFrame, text: str, *whole: str) -> DataFrame:
    return docs.select(F.struct(*whole).alias("whole"), F.col(text).alias("text"))


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
            item_text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, longest (longest match of the words in windows, 0 if there
    are none), first and last (start and end of the maximal runs of words in windows) and items."""
    found = _found(_rows(docs, text, doc_id), items, item_id, item_text, window, shard_words)
    return found.select(F.col("whole").getField(doc_id).alias("doc_id"), *[c.split()[0] for c in FOUND.split(", ")])


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.expr("aggregate(zip_with(last, first, (e, s) -> CAST(e - s AS BIGINT)), 0L, (a, n) -> a + n)")
    return matches(docs, items, **options).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("first") > 0).alias("contaminated"))


def _cut(batches):
    for b in in_parts(batches):
        out = []
        for text, first, last in zip(*(b.column(c).to_pylist() for c in ("text", "first", "last")), strict=True):
            if first:
                at = places(text)
                edges = [0, *[x for s, e in zip(first, last, strict=True) for x in (at[s][0], at[e - 1][1])], len(text)]
                text = "".join(text[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True))
            out.append(text)
        yield pa.RecordBatch.from_arrays([b.column("whole"), pa.array(out, pa.string())], ["whole", "text"])


def cleaned(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
            window: int = WINDOW, max_share: float = MAX_SHARE, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The rows and columns of ``docs`` without matched spans, and without documents of which more
    than ``max_share`` is matched."""
    found = _found(_rows(docs, text, "*"), items, item_id, item_text, window, shard_words)
    n_hit = F.expr("aggregate(zip_with(last, first, (e, s) -> CAST(e - s AS BIGINT)), 0L, (a, n) -> a + n)")
    left = found.where(n_hit <= F.lit(max_share) * F.col("n_words")).select("whole", F.col("whole").getField(text).alias("text"), "first", "last")
    done = in_arrow(left, _cut, T.StructType([found.schema["whole"], T.StructField("text", T.StringType())]))
    return done.select(*[F.col("text") if c == text else F.col("whole").getField(c).alias(c) for c in docs.columns])


def report_sql(window: int = WINDOW) -> str:
    """The rows of ``report`` in DuckDB SQL over ``documents`` and ``benchmark``
    whose ids are unique and not null."""
    def split(table, key):
        folded = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return (f"SELECT {key}, regexp_extract_all({folded}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}")

    return f"""
WITH b AS ({split('benchmark', 'item_id')}), d AS ({split('documents', 'doc_id')}),
bw AS (SELECT item_id, least(len(w), {window}) AS k, unnest(CASE WHEN len(w) < {window} THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - {window - 2}), lambda i: array_to_string(w[i:i + {window - 1}], ' ')) END) AS s
       FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
hits AS (SELECT doc_id, item_id, k, i FROM dw JOIN bw USING (k, s)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p
            FROM (SELECT DISTINCT doc_id, k, i FROM hits)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(named.s, '')) AS items_sha256, named.n IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""
