"""Every operator and pipeline stage on awkward tables: nulls in any column, empty and very long
texts, ties and repeated rows, an empty table, extra columns whose names clash with results."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cumulus.llm import (
    chosen_path,
    chunk_dedup,
    importance,
    line_quality,
    packing,
    piece_codec,
    piecewise_hash,
    ppm_language,
    secret_scan,
    suffix_automaton,
    suffix_dedup,
    token_store,
    variant_trie,
)
from cumulus.llm.queries import BYTE_BPE, PIECE_BPE
from cumulus.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, k string, part double"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def _long(k):
    words = WORDS.split()
    return " ".join(f"{words[(i * i + k) % 20]}{(i * 7919 + k) % 1013}" for i in range(20_000))


ROWS = [
    (1, "", "en", "a", 0, "x", "y", 1.0),
    (2, None, None, None, None, None, None, None),
    (None, "no id here " * 30, "en", "a", 1, None, None, None),
    (3, _long(3), "en", "a", 2, "x", None, 0.0),
    (4, _long(4), "de", None, 3, None, "z", 0.5),
    (5, "tie " + _long(5)[:900], "en", "b", 4, "x", "y", 1.0),
    (5, "tie " + _long(5)[:900], "en", "b", 4, "x", "y", 1.0),
    (5, "other text, same id " + _long(6)[:700], "fr", "b", 4, "x", "y", 1.0),
    (6, "   \n\t \n", "en", "a", 5, "", "", 0.0),
    (7, "é日本 😀 \u0000 ▁", "ja", "b", 6, "", "", 0.0),
    (8, "password = hunter2hunter2\n\n\n", "en", "b", 7, "", "", 0.0),
    (-9, "tie " + _long(5)[:900], None, "b", 8, "", "", 0.0),
]


@pytest.fixture(scope="module")
def messy(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _store(docs):
    path = scratch_path(docs.sparkSession, "store")
    token_store.write(docs, path, BYTE_BPE)
    return token_store.read(docs.sparkSession, path)


OPERATORS = {
    "secret_scan": lambda d: secret_scan.scan(d, secret_scan.train(d)),
    "piece_codec": lambda d: piece_codec.digests(d, PIECE_BPE),
    "chunk_dedup": lambda d: chunk_dedup.without_repeats(d.select("doc_id", "text"), with_figures=True),
    "line_quality": line_quality.assess,
    "suffix_dedup": suffix_dedup.remove_repeats,
    "ppm_language": lambda d: ppm_language.predict(d, ppm_language.train(d)),
    "chosen_path": chosen_path.report,
    "token_store": _store,
    "piecewise_hash": piecewise_hash.compare,
    "suffix_automaton": lambda d: suffix_automaton.report(d, d.select("doc_id", "text"), item_id="doc_id"),
    "importance": lambda d: importance.report(d, d.select("text")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_messy_rows_give_one_result_each(messy, name):
    out = OPERATORS[name](messy)
    got = sorted(r.doc_id if r.doc_id is not None else -100 for r in out.select("doc_id").collect())
    assert got == sorted(-100 if r[0] is None else r[0] for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_gives_no_rows(empty, name):
    assert OPERATORS[name](empty).collect() == []


def test_variants_of_messy_and_empty_tables(messy, empty):
    assert variant_trie.variants(empty).collect() == []
    rows = {r.word: r for r in variant_trie.variants(messy).collect()}
    assert rows["lambda"].n >= 5 and rows["lambda"].n_near == 0 and rows["lambda"].root == "lambda"


def test_no_items_and_no_target(messy, empty):
    assert not any(r.contaminated for r in suffix_automaton.report(messy, empty, item_id="doc_id").collect())
    assert importance.report(messy, empty).count() == len(ROWS)
    assert importance.resampled(messy, empty, percent=100).columns == messy.columns


def test_packing_covers_messy_rows(messy, empty):
    assert packing.pack(empty, BYTE_BPE).collect() == []
    pieces = packing.pack(messy, BYTE_BPE).collect()
    assert sum(p.start == 0 for p in pieces) == len(ROWS)
    at = 0
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.sequence_id * 2048 + p.offset == at
        at += p.length


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_messy_and_empty_tables(spark, messy, empty, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, messy, "")
    rows = out.collect()
    assert stage(spark, empty, "").collect() == []
    if name != "packing":
        assert out.columns == messy.columns
        assert {r.doc_id for r in rows} <= {r[0] for r in ROWS}
    if name in ("substring_dedup", "secret_scans"):  # these keep every row
        assert len(rows) == len(ROWS)


def test_repeated_rows_have_equal_results(messy):
    for name in ("secret_scan", "piece_codec", "line_quality", "suffix_dedup", "chosen_path"):
        rows = OPERATORS[name](messy).where("doc_id = 5").collect()
        assert len(rows) == 3 and len(set(rows)) <= 2, name  # two equal rows and one of another text


def test_ties_of_ids_take_nothing_from_each_other(messy):
    done = {r.doc_id: r for r in suffix_dedup.remove_repeats(messy.where("doc_id = 5")).collect()}
    assert done[5].n_removed == 0
    # the copy with the smaller id takes all of its text
    both = suffix_dedup.remove_repeats(messy.where("doc_id IN (5, -9)")).where("doc_id = 5").collect()
    assert sorted(r.n_bytes - r.n_removed for r in both)[:2] == [0, 0]


def test_copies_meet_the_smallest_id(messy):
    rows = chosen_path.report(messy.where(F.col("doc_id").isin(5, -9))).collect()
    assert {r.component_id for r in rows if r.doc_id == -9} == {-9}
    assert not all(r.kept for r in rows)
