"""Dimension joins. No side is counted or forced to be broadcast: the planner, and AQE from
real sizes at run time, choose between a broadcast and a shuffle join by bytes.

Fact-side inputs of :func:`attach_names` are already aggregated per location, so no raw fact
row moves for it. Joins of raw facts with a large dimension can be salted (:func:`salted`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ids that are split at most; of N rows any further id holds at most N / MAX_HOT.
MAX_HOT = 1000
SALT, PARTS = "_cumulus_salt", "_cumulus_parts"


def hot_ids(facts: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """(key, parts): ids with more than ``hot_rows`` rows, and into how many parts to split each;
    ``MAX_HOT`` rows at most. Only the key column is read, and counted in the tasks first."""
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.where(F.col("_n") > hot_rows).orderBy(F.col("_n").desc(), key).limit(MAX_HOT)
    return top.select(key, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias(PARTS))


def salted(facts: DataFrame, dim: DataFrame, key: str, hot_rows: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of an equi-join on ``key``, and the columns to join on instead, such that no id sends
    more than about ``hot_rows`` facts to one task.

    The facts of a hot id are dealt into parts by a hash of the whole row, so a task that runs again
    deals alike, and the id's rows of the dimension are repeated for each part. Every other id has
    the one part 0. A fact meets each of its dimension rows exactly once, as without salt."""
    hot = F.broadcast(hot_ids(facts, key, hot_rows))  # MAX_HOT rows at most
    part = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.col(PARTS)).cast("int")
    left = facts.join(hot, key, "left").withColumn(SALT, F.coalesce(part, F.lit(0))).drop(PARTS)
    each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(PARTS), F.lit(1)) - 1))
    right = dim.join(hot, key, "left").select(*dim.columns, each.alias(SALT))
    return left, right, [key, SALT]


def dedup_locations(locations: DataFrame, key: str = "location_id",
                    order_col: str | None = None) -> DataFrame:
    """One row per id. With ``order_col`` the row with the highest value wins (a file line
    number gives 'last duplicate wins'); without it any one row is kept.

    Written as an aggregate (``max_by``), not a window: map-side partial aggregation keeps
    one candidate per id per task, so an id with a huge run of copies never lands whole in
    one task."""
    locations = locations.where(F.col(key).isNotNull())
    if order_col is None:
        return locations.dropDuplicates([key])
    others = [c for c in locations.columns if c not in (key, order_col)]
    best = F.max_by(F.struct(*[F.col(c) for c in others]), F.col(order_col)).alias("_best")
    return locations.groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in others])


def attach_names(agg: DataFrame, locations: DataFrame, how: str = "inner",
                 default: str | None = None, key: str = "location_id",
                 name_col: str = "city_name") -> DataFrame:
    """Join per-location aggregates to the dimension.

    ``how="inner"`` keeps only known locations (NULL ids never match);
    ``how="left"`` keeps all and fills ``default`` for unknown ids.
    """
    dim = locations.select(key, name_col).where(F.col(key).isNotNull())
    out = agg.join(dim, key, how)
    if default is not None:
        out = out.withColumn(name_col, F.coalesce(F.col(name_col), F.lit(default)))
    return out


def known_locations(facts: DataFrame, locations: DataFrame, key: str = "location_id",
                    hot_rows: int | None = None) -> DataFrame:
    """Existence filter: fact rows whose id is in the dimension. ``hot_rows`` splits ids with more
    rows than that, for a dimension that is too large to broadcast."""
    ids = locations.select(key).where(F.col(key).isNotNull())
    if hot_rows is None:
        return facts.join(ids, key, "left_semi")
    left, right, on = salted(facts, ids, key, hot_rows)
    return left.join(right, on, "left_semi").select(*facts.columns)
