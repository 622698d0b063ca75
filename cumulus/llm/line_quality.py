"""Quality rules from cross-document line frequency, in DataFrame functions only.

Lines are normalised (A-Z lower-cased, white space squeezed) and hashed. Per host a line's
documents are counted distinct, where documents with the same text are one: copies of one text do
not make its lines boilerplate, however many there are, while every line of a footer between
different texts counts for each. The host's documents are counted in the same way. A line above the
host's limit - more than ``line_share`` of the host's documents and at least ``min_docs`` - is removed, and
a document is rejected as depleted when less than ``keep_share`` of its words is left. Documents
that fail the base rules (under 50 words, or over half of the words in repeated 3-word windows) are
rejected too.

A removed line leaves the document's text in ``filtered``; line breaks around it go with it.

Words are runs without space, tab, line feed, vertical tab, form feed or carriage return. Null
text has no words (so it fails). A null host is a host of its own. Repeated rows give repeated
results. Columns of the input other than ``doc_id``, ``text`` and ``host`` are not read by
``assess``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.compute_once import compute_once
from .common import saved

LINE_SHARE = 0.02
MIN_DOCS = 5
KEEP_SHARE = 0.3
MIN_WORDS = 50

_SPACE = r"[\\x20\\x09-\\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(expr: str) -> str:
    return f"filter(split({expr}, '{_SPACE}'), w -> w != '')"


def _base_columns(df: DataFrame, with_marks: bool = False) -> DataFrame:
    """Adds the four base measures; each costly array is computed once per row. ``with_marks`` adds the
    lines with a word as hashes of their normal form, with their words."""
    text = F.col("text")
    df = compute_once(df, {"words": F.expr(_words("text"))})
    # 3-word windows sorted by content: equal ones are neighbours
    df = compute_once(df.withColumn("n_words", F.size("words").cast("long")), {"windows": F.expr(
        "sort_array(transform(slice(words, 1, greatest(n_words - 2, 0)), (w, i) -> "
        "struct(concat_ws(' ', w, words[i + 1], words[i + 2]) AS k, i AS i)))")},
        keep=[*[c for c in df.columns if c != "words"], "n_words"])
    # positions of the windows found twice or more, in text order
    df = compute_once(df, {"hits": F.expr(
        "sort_array(transform(filter(windows, (x, j) -> x.k = try_element_at(windows, j + 2).k "
        "OR (j > 0 AND x.k = try_element_at(windows, greatest(j, 1)).k)), x -> x.i))")},
        keep=[c for c in df.columns if c != "windows"])
    covered = F.expr("aggregate(transform(hits, (p, j) -> least(3, coalesce(try_element_at(hits, j + 2) - p, 3))), "
                     "0L, (a, x) -> a + x)")
    lines = "filter(split(text, '\\n', -1), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    df = compute_once(df, {"lines": F.expr(lines)})
    return df.select(
        *[c for c in df.columns if c not in ("text", "hits", "lines")],
        F.char_length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"), *([F.expr(_MARKS).alias("marks")] if with_marks else []))


def _keyed(docs: DataFrame, host: str) -> DataFrame:
    df = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                     F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")).alias("host"))
    return df.withColumn("text_key", F.xxhash64("host", "text"))


_NORM = (f"trim(regexp_replace(translate(l, '{_UPPER}', '{_LOWER}'), '{_SPACE}', ' '))")
_MARKS = (f"transform(transform(lines, l -> {_NORM}), l -> struct(xxhash64(l) AS line, "
          "length(l) - length(replace(l, ' ', '')) + 1 AS line_words))")


def _line_rows(keyed: DataFrame) -> DataFrame:
    """One row per line with a word: hash of the normalised line, its words and its place among such
    lines."""
    df = compute_once(keyed, {"norm": F.expr(
        f"transform(filter(split(text, '\\n', -1), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]'), l -> {_NORM})")},
        keep=["doc_id", "text_key", "host"])
    return df.select("doc_id", "text_key", "host", F.expr(
        "inline(transform(norm, (l, i) -> struct(xxhash64(l) AS line, length(l) - length(replace(l, ' ', '')) + 1 AS line_words, i AS place)))"))


def common_lines(keyed: DataFrame, lines: DataFrame, line_share: float, min_docs: int) -> DataFrame:
    """(host, line) above the host's limit, counted by different texts. All counts are partial
    aggregates first, so a hot host or line costs a row per task; what is joined are counted lines
    and one row per host."""
    return _above(lines.groupBy("host", "line", "text_key").agg(F.count("*").alias("n")),
                  keyed.groupBy("host", "text_key").agg(F.count("*").alias("n")), line_share, min_docs)


def _above(counted: DataFrame, documents: DataFrame, line_share: float, min_docs: int) -> DataFrame:
    per_line = counted.groupBy("host", "line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs)
    hosts = documents.groupBy("host").agg(F.count("*").alias("host_docs"))
    return (per_line.join(hosts, "host").where(F.col("n_docs") > F.lit(line_share) * F.col("host_docs"))
            .select("host", "line"))


def _removed(lines: DataFrame, common: DataFrame) -> DataFrame:
    """Per text that has common lines: their words and hashes."""
    return (lines.join(common, ["host", "line"], "left_semi")
            .groupBy("doc_id", "text_key", "line", "place").agg(F.max("line_words").alias("line_words"))
            .groupBy("doc_id", "text_key").agg(F.sum("line_words").alias("n_common"),
                                               F.collect_set("line").alias("common")))


def _joined(left: DataFrame, removed: DataFrame) -> DataFrame:
    r = removed.withColumnsRenamed({"doc_id": "r_doc_id", "text_key": "r_text_key"})
    on = left["doc_id"].eqNullSafe(r["r_doc_id"]) & (left["text_key"] == r["r_text_key"])
    return left.join(r, on, "left").drop("r_doc_id", "r_text_key")


def _verdict(keep_share: float):
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    depleted = (F.col("n_words") - F.col("n_common_words")) < F.lit(keep_share) * F.col("n_words")
    return failed.alias("base_failed"), (~failed & ~depleted).alias("kept")


def assess(docs: DataFrame, host: str = "source", line_share: float = LINE_SHARE, min_docs: int = MIN_DOCS,
           keep_share: float = KEEP_SHARE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, the base measures, base_failed, kept, and the words in
    common lines (``n_common_words``). The texts are read once: measures and line hashes go to shared storage
    under a number for each row, and everything after that works on these."""
    keyed = _keyed(docs, host).withColumn("row", F.monotonically_increasing_id())
    rows = saved(_base_columns(keyed, with_marks=True), "lines")
    lines = rows.select("row", "text_key", "host", F.inline("marks"))
    common = common_lines(rows, lines, line_share, min_docs)
    removed = lines.join(common, ["host", "line"], "left_semi").groupBy("row").agg(F.sum("line_words").alias("n_common"))
    out = rows.join(removed, "row", "left").withColumn("n_common_words", F.coalesce("n_common", F.lit(0)).cast("long"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      *_verdict(keep_share), "n_common_words")


def filtered(docs: DataFrame, host: str = "source", line_share: float = LINE_SHARE, min_docs: int = MIN_DOCS,
             keep_share: float = KEEP_SHARE) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; common lines leave ``text``."""
    keyed = _keyed(docs, host)
    lines = _line_rows(keyed)
    removed = _removed(lines, common_lines(keyed, lines, line_share, min_docs))
    rows = docs.select(F.struct("*").alias("whole"), F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")).alias("host"))
    rows = rows.withColumn("text_key", F.xxhash64("host", "text")).drop("host")
    out = _joined(_base_columns(rows), removed)
    out = out.withColumn("n_common_words", F.coalesce("n_common", F.lit(0)).cast("long"))
    out = out.where(_verdict(keep_share)[1])
    rest = (f"array_join(filter(split(whole.text, '\\n', -1), "
            f"l -> NOT array_contains(common, xxhash64({_NORM}))), '\n')")
    text = F.when(F.col("common").isNull(), F.col("whole.text")).otherwise(F.expr(rest))
    return out.select(*[text.alias(c) if c == "text" else F.col("whole").getField(c).alias(c) for c in docs.columns])


def assess_sql(line_share: float = LINE_SHARE, min_docs: int = MIN_DOCS, keep_share: float = KEEP_SHARE) -> str:
    """The same rows in DuckDB SQL over a table ``documents`` whose doc_id is unique."""
    space = r"[\x20\x09-\x0D]+"
    norm = f"trim(regexp_replace(translate(l, '{_UPPER}', '{_LOWER}'), '{space}', ' ', 'g'))"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS key, coalesce('=' || source, '') AS host FROM documents),
w AS (SELECT doc_id, list_filter(string_split_regex(text, '{space}'), lambda w: w <> '') AS words FROM d),
p AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT doc_id, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS k FROM p
      WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
h AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM g WHERE k IS NOT NULL)
      WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT i + s) AS n FROM h, (VALUES (0), (1), (2)) v(s) GROUP BY doc_id),
s AS (SELECT doc_id, key, host, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
      FROM d),
l AS (SELECT doc_id, key, host, unnest(lines) AS l FROM s),
n AS (SELECT doc_id, key, host, {norm} AS line FROM l),
t AS (SELECT host, count(DISTINCT key) AS host_docs FROM d GROUP BY host),
b AS (SELECT host, line FROM (SELECT host, line, count(DISTINCT key) AS n_docs FROM n GROUP BY host, line)
      JOIN t USING (host) WHERE n_docs >= {min_docs} AND n_docs > {line_share} * host_docs),
x AS (SELECT doc_id, sum(length(line) - length(replace(line, ' ', '')) + 1) AS n_common
      FROM n SEMI JOIN b USING (host, line) GROUP BY doc_id),
e AS (SELECT d.doc_id, len(words) AS n_words,
        length(regexp_replace(text, '{space}', '', 'g')) AS word_chars,
        length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(r.n, 0) AS n_repeat_words, CAST(coalesce(n_common, 0) AS BIGINT) AS n_common_words
      FROM d JOIN w USING (doc_id) JOIN s USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN x USING (doc_id))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)
  AND NOT (n_words - n_common_words < {keep_share} * n_words) AS kept
FROM e"""
