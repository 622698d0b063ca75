"""Benchmark decontamination, spelling variants and importance resampling against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from cumulus.llm import importance, plain_words, queries, suffix_automaton, variant_trie

SMALL = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def _plain(t):
    return WORD.findall((t or "").translate(FOLD))


def test_plain_words_are_the_stated_ones():
    rnd = random.Random(1)
    for _ in range(3000):
        t = "".join(rnd.choice("aZ09 \x00\x1f/:@[`{\x7f\x80é日😀\n\x85　_-") for _ in range(rnd.randrange(30)))
        assert [w.decode() for w in plain_words.words(t.encode())] == _plain(t)
        assert [t[s:e].translate(FOLD) for s, e in plain_words.places(t)] == _plain(t)


# ---- op11 ----

def _hits(docs, items, window=10):
    """doc id -> (n_words, hit positions, item ids) by comparing every window with every place."""
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = _plain(t)
        k = min(window, len(w))
        for s in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[s:s + k]), set()).add("" if i is None else str(i))
    out = {}
    for i, t in docs:
        w, hit, found = _plain(t), set(), set()
        for k in {len(x) for x in windows}:
            for s in range(len(w) - k + 1):
                own = windows.get(tuple(w[s:s + k]))
                if own:
                    hit.update(range(s, s + k))
                    found |= own
        out[i] = (len(w), hit, found)
    return out


def _corpus(seed, n_docs=120, n_items=25, short=True):
    rnd = random.Random(seed)
    vocab = ["A", "b", "Ab", "é", "c9", "日本"]  # few words: many repeated and overlapping windows
    def seq(n):
        return [rnd.choice(vocab) for _ in range(n)]
    items = [(i, rnd.choice([" ", ", "]).join(seq(rnd.randrange(4 if short else 10, 40)))) for i in range(n_items)]
    items += [(100, items[3][1]), (101, ""), (102, None), (5, items[5][1] + " Ab é extra"), (None, "only here " * 6)]
    items += [(103, "Z one"), (104, "lonely")] if short else []
    docs = []
    for i in range(n_docs):
        w = seq(rnd.randrange(0, 60))
        if rnd.random() < 0.5:
            t = _plain(rnd.choice(items)[1])
            w[len(w) // 2:len(w) // 2] = t[rnd.randrange(3):]
        docs.append((i, "-".join(w)))
    return docs + [(1000, None), (1001, ""), (1002, " only HERE" * 7), (1003, "z ONE lonely x")], items


@pytest.mark.parametrize(("seed", "short", "shard"), [(1, True, 10 ** 6), (2, False, 10 ** 6), (3, True, 150), (4, False, 200)])
def test_contamination_equals_all_windows(spark, monkeypatch, seed, short, shard):
    monkeypatch.setattr(suffix_automaton, "PIECE_WORDS", 12)  # long items come in pieces
    docs, items = _corpus(seed, short=short)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = _hits(docs, items)
    rows = suffix_automaton.report(d, b, shard_words=shard).collect()
    assert len(rows) == len(docs) and sum(r.contaminated for r in rows) > 20
    for r in rows:
        n, hit, found = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, len(hit), len(found), bool(hit)), r
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def test_contamination_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    want = con.execute(suffix_automaton.report_sql()).df().sort_values("doc_id").reset_index(drop=True)
    got = queries.op11_suffix_automaton(spark, "/root/testdata/sf0.01").toPandas().sort_values("doc_id").reset_index(drop=True)
    assert want.contaminated.sum() > 5
    for c in want.columns:
        assert got[c].tolist() == want[c].tolist(), c


def test_longest_match_of_the_automaton():
    rnd = random.Random(3)
    auto, seqs = suffix_automaton.Automaton(), [[rnd.randrange(1, 4) for _ in range(rnd.randrange(1, 30))] for _ in range(12)]
    for s in seqs:
        auto.add(s)
    known = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    text = [rnd.randrange(1, 5) for _ in range(500)]
    for i, (_, n) in enumerate(auto.walk(text)):
        assert n == max((k for k in range(i + 2) if tuple(text[i + 1 - k:i + 1]) in known), default=0)


def test_spans_leave_the_text_and_drowned_documents_go(spark):
    item = "The quick brown fox jumps over the lazy dog near a river"
    rows = [(1, "Intro, words. " + item + "! Tail of this text that is long enough to stay here, so it is kept.", "x"),
            (2, item, "x"), (3, "nothing of that kind", None), (4, None, "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, items string")
    b = spark.createDataFrame([(7, item.upper())], "item_id long, text string")
    for shard in (10 ** 6, 1):
        out = {r.doc_id: r for r in suffix_automaton.cleaned(d, b, shard_words=shard).collect()}
        assert out[1].text == "Intro, words. ! Tail of this text that is long enough to stay here, so it is kept."
        assert set(out) == {1, 3, 4} and out[3].text == rows[2][1] and out[4].text is None and out[1].items == "x"
    assert suffix_automaton.cleaned(d, b.limit(0)).count() == 4


# ---- op12 ----

def _vocabulary(rows):
    total = Counter()
    for i, t in rows:
        for m in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = m.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def _apart(a, b):
    if len(a) < len(b):
        a, b = b, a
    if a == b or len(a) - len(b) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def _variants(words):
    near = {w: [x for x in words if _apart(w, x)] for w in words}
    best = {w: min(v, key=lambda x: (-words[x], x)) for w, v in near.items() if v}
    form = {w: x for w, x in best.items() if words[x] >= 5 * words[w]}
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None)
    return out


def _spellings(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choices("abetÀé÷", k=rnd.randrange(5, 9))) for _ in range(40)]
    base += ["aabbab", "ababab", "bbaaab", "abba÷a", "chainx", "chainxy", "chainxyz"]
    text = []
    for w in base:
        for _ in range(rnd.choice([1, 3, 6, 40])):
            text.append(w)
            k = rnd.randrange(len(w))
            if rnd.random() < 0.6:
                text += [rnd.choice([w[:k] + w[k + 1:], w[:k] + rnd.choice("abÿ") + w[k:], w[:k] + "t" + w[k + 1:]])] * rnd.choice([1, 5, 7])
    text += ["chainx"] * 5 + ["chainxy"] * 40 + ["chainxyz"] * 400
    rnd.shuffle(text)
    rows = [(i, rnd.choice([" ", "×", "1", "日"]).join(x.upper() if rnd.random() < 0.1 and x.isascii() else x for x in text[k:k + 9]))
            for i, k in enumerate(range(0, len(text), 9))]
    return rows + [(None, "nulled word " * 8), (9001, None), (9002, "")]


@pytest.mark.parametrize("bounds", [(3, 20_000, 100_000), (2, 5, 100_000), (1, 3, 4), (variant_trie.GROUPS, 2, 3)])
def test_variants_equal_all_pairs(spark, monkeypatch, bounds):
    for name, v in zip(("CROWN", "NODE", "VISITS"), bounds, strict=True):
        monkeypatch.setattr(variant_trie, name, v)
    near = variant_trie.near_words
    monkeypatch.setattr(variant_trie, "near_words", lambda w: near(w, *bounds))
    rows = _spellings(sum(bounds))
    words = _vocabulary(rows)
    got = variant_trie.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = _variants(words)
    assert sum(v[3] > 0 for v in want.values()) > 20 and len({v[1] for v in want.values()}) < len(want)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want and len(got) == len(want)


def test_variants_of_the_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    want = _variants(_vocabulary(rows))
    got = queries.op12_variant_trie(spark, SMALL).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want and len(got) == len(want)


def test_chains_of_forms_end_at_the_last(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w5"), ("y", "z")]
    got = {r.word: r.root for r in variant_trie._roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert got == {**{f"w{i}": "w37" for i in range(37)}, "x": "w37", "y": "z"}


def test_one_apart_is_the_stated_distance():
    rnd = random.Random(6)
    for _ in range(5000):
        a, b = (bytes(rnd.choices(b"ab", k=rnd.randrange(0, 6))) for _ in range(2))
        if len(a) >= len(b):
            assert variant_trie.one_apart(a, b) == _apart(a, b)


# ---- op13 ----

def _features(t):
    w = _plain(t)
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def _drawn(rows, target, percent=5):
    s, t = Counter(x for _, d in rows for x in _features(d)), Counter(x for d in target for x in _features(d))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (S + 10_000) / ((s[k] + 1) * (T + 10_000)))) for k in range(10_000)]
    out = []
    for i, d in rows:
        f = _features(d)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(_plain(d))])
    fit = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for k, r in enumerate(fit[:percent * len(fit) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def _order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_buckets_of_joined_words_are_those_of_the_strings():
    rnd = random.Random(4)
    for n in (0, 1, 2, 3, 50):
        w = ["".join(rnd.choices("abé日9", k=rnd.choice([1, 3, 20, 64, 65, 300]))) for _ in range(n)]
        assert importance.buckets([x.encode() for x in w]).tolist() == _features(" ".join(w))


def test_resampling_equals_the_definition(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rnd.choices(vocab[:50] if i % 7 == 0 else vocab, k=rnd.randrange(0, 80)))) for i in range(900)]
    rows += [(None, " ".join(vocab[:30])), (950, None), (951, ""), (3, "x " * 25), (3, "x " * 25), (3, "x " * 25)]
    target = [" ".join(rnd.choices(vocab[:50], k=30)) for _ in range(40)] + [None]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    t = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    got = [tuple(r) for r in importance.report(d, t).collect()]
    want = _drawn(rows, target)
    assert sum(r[4] is not None for r in want) > 30
    assert _order(got) == _order(want)
    wide = d.withColumns({"rank": d.doc_id * 2, "weight": d.doc_id * 0})
    out = importance.resampled(wide, t, percent=5)
    assert out.columns == wide.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(r[0] for r in want if r[4] is not None)


def test_resampling_of_the_small_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert _order(tuple(r) for r in queries.op13_importance_resampling(spark, SMALL).collect()) == _order(_drawn(docs, target))


@pytest.mark.parametrize("shape", ["random", "ascending", "uneven", "ties"])
def test_cutoff_is_exact_with_few_keys_left_at_any_time(spark, monkeypatch, shape):
    monkeypatch.setattr(importance, "BLOCK", 13)
    rnd = random.Random(9)
    n = 1500
    a = {"random": [rnd.randrange(10 ** 9) for _ in range(n)], "ascending": list(range(n)), "uneven": [i if i < 900 else 5 for i in range(n)], "ties": [1] * n}[shape]
    rows = [(x, x % 3, i) for i, x in enumerate(a)]
    d = spark.createDataFrame(rows, "a long, b long, c long").repartitionByRange(6, "c" if shape != "uneven" else "a")
    rows.sort()
    for k in (1, 2, 700, 1499, 1500):
        assert importance.cutoff(d, k, finish=1) == rows[k - 1]
    assert importance.cutoff(d, 0) is None and importance.cutoff(d, 1501) is None and importance.cutoff(d.limit(0), 1) is None


def test_ranks_follow_the_order_over_partitions(spark):
    rows = [(1, 1, i) for i in range(300)] + [(i, 0, 1000 + i) for i in range(50)]
    got = [(r.rank, (r.a, r.b, r.c)) for r in importance.ranked(spark.createDataFrame(rows, "a long, b long, c long")).collect()]
    assert sorted(got) == [(k + 1, r) for k, r in enumerate(sorted(rows))]


def test_medians_discard_a_part_in_every_round():
    keys = [(x, 0, 0) for x in range(9)]
    assert importance._weighted_median(keys, [1] * 9) == (4, 0, 0)
    assert importance._weighted_median(keys, [100, *[1] * 8]) == (0, 0, 0)
    assert importance._weighted_median([], []) is None
    a = np.array([3, 1, 2]), np.array([0, 0, 0]), np.array([0, 1, 2])
    assert importance._median(*a) == (2, 0, 2)
