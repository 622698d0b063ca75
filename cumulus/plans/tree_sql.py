"""Regression trees grown in SQL: the checks of the tree models on settings that SQL can solve.

A table holds all rows with a ``kind`` ('train' rows are learnt from, the others only predicted). A
level gives each node the split with the largest variance reduction: of every feature, the
thresholds half-way between neighbouring values. The first feature and the smallest threshold win a
tie. Boosting fits each further tree to twice the residuals and adds a tenth of it.
"""

from __future__ import annotations


def _impurity(n: str, s: str, q: str) -> str:
    return f"(({q}) - ({s}) * ({s}) / ({n})) / ({n})"


def _level(p: str, k: int, label: str, features: list[str]) -> list[str]:
    rows, node = f"{p}{k}", f"{p}_node"
    values = "\n  UNION ALL ".join(
        f"SELECT {node} AS node, {i} AS f, {f} AS v, COUNT(*) AS n, SUM({label}) AS s, SUM({label} * {label}) AS q "
        f"FROM {rows} WHERE kind = 'train' GROUP BY 1, 2, 3" for i, f in enumerate(features))
    gain = (f"{_impurity('tn', 'ts', 'tq')} - ln / tn * {_impurity('ln', 'ls', 'lq')} "
            f"- (tn - ln) / tn * {_impurity('tn - ln', 'ts - ls', 'tq - lq')}")
    value = "CASE b.f " + " ".join(f"WHEN {i} THEN r.{f}" for i, f in enumerate(features)) + " END"
    return [
        f"{rows}_v AS ({values})",
        f"""{rows}_c AS (SELECT node, f, v, LEAD(v) OVER o AS nv, SUM(n) OVER o AS ln, SUM(s) OVER o AS ls, SUM(q) OVER o AS lq,
    SUM(n) OVER t AS tn, SUM(s) OVER t AS ts, SUM(q) OVER t AS tq FROM {rows}_v
    WINDOW o AS (PARTITION BY node, f ORDER BY v ROWS UNBOUNDED PRECEDING), t AS (PARTITION BY node, f))""",
        f"{rows}_g AS (SELECT node, f, (v + nv) / 2 AS t, tn, {gain} AS g FROM {rows}_c WHERE nv IS NOT NULL)",
        f"""{rows}_b AS MATERIALIZED (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY node ORDER BY g DESC, f, t) AS r
    FROM {rows}_g) WHERE r = 1 AND g > 0)""",
        f"""{p}{k + 1} AS MATERIALIZED (SELECT r.* REPLACE (CASE WHEN b.f IS NULL THEN r.{node} WHEN {value} <= b.t THEN 2 * r.{node}
    ELSE 2 * r.{node} + 1 END AS {node}) FROM {rows} r LEFT JOIN {rows}_b b ON b.node = r.{node})""",
    ]


def tree(p: str, rows: str, label: str, depth: int, features: list[str]) -> list[str]:
    """CTEs that grow one tree on ``rows``: ``{p}_out`` are the rows with the prediction ``{p}``, and
    ``{p}_gains`` (f, w) the gains of its splits weighted by rows, by the feature's number."""
    out = [f"{p}0 AS MATERIALIZED (SELECT *, 1 AS {p}_node FROM {rows})"]
    for k in range(depth):
        out += _level(p, k, label, features)
    out.append(f"{p}_leaf AS (SELECT {p}_node, AVG({label}) AS {p} FROM {p}{depth} WHERE kind = 'train' GROUP BY 1)")
    out.append(f"{p}_out AS MATERIALIZED (SELECT r.*, l.{p} FROM {p}{depth} r JOIN {p}_leaf l USING ({p}_node))")
    all_splits = " UNION ALL ".join(f"SELECT f, g * tn AS w FROM {p}{k}_b" for k in range(depth))
    out.append(f"{p}_gains AS (SELECT f, SUM(w) AS w FROM ({all_splits}) GROUP BY f)")
    return out


def boosted(p: str, rows: str, label: str, depth: int, features: list[str], step: float = 0.1) -> list[str]:
    """Two rounds of boosting: ``{p}_out`` has the prediction ``{p}``, ``{p}_gains`` both trees' gains."""
    one, two = f"{p}a", f"{p}b"
    return [*tree(one, rows, label, depth, features),
            f"{p}_rest AS (SELECT *, 2 * ({label} - {one}) AS {p}_residual FROM {one}_out)",
            *tree(two, f"{p}_rest", f"{p}_residual", depth, features),
            f"{p}_out AS MATERIALIZED (SELECT *, {one} + {step} * {two} AS {p} FROM {two}_out)",
            f"{p}_gains AS (SELECT f, SUM(w) AS w FROM (SELECT * FROM {one}_gains UNION ALL SELECT * FROM {two}_gains) GROUP BY f)"]


def importance(p: str, features: list[str]) -> str:
    """(feature, importance): each feature's share of all gains."""
    names = ", ".join(f"({i}, '{f}')" for i, f in enumerate(features))
    return (f"SELECT n.feature, COALESCE(g.w, 0) / (SELECT SUM(w) FROM {p}_gains) AS importance "
            f"FROM (VALUES {names}) n(f, feature) LEFT JOIN {p}_gains g USING (f)")
