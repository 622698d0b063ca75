"""Statistics: correlation screening, feature summary, simple regression, evaluation,
deterministic train/test split. Every function is one aggregate pass (map-side partial
aggregation, one tiny shuffle), never a job per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .climate import with_obs_date

ET0 = "et0_fao_evapotranspiration"
# --- fixed values: the modelling features (source column -> model name) ------------------
MODEL_FEATURES = {
    "precipitation_hours": "precipitation_hours",
    "sunshine_duration": "sunshine_duration",
    "wind_speed_10m_max": "wind_speed",
}
MODEL_LABEL = "et0"


def numeric_columns(df: DataFrame, exact: bool = False) -> list[str]:
    """Numeric columns of a frame. ``exact=True`` keeps only ``double`` and ``int``
    (bigint and float excluded), otherwise every numeric type."""
    out = []
    for f in df.schema.fields:
        if exact:
            if f.dataType.simpleString() in ("double", "int"):
                out.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            out.append(f.name)
    return out


def with_calendar(facts: DataFrame, date_mode: str = "lenient") -> DataFrame:
    d = with_obs_date(facts, date_mode)
    return d.withColumns({"month": F.month("obs_date"), "year": F.year("obs_date")})


def correlations(df: DataFrame, target: str = ET0, features: list[str] | None = None,
                 nulls: str = "skip", digits: int = 6) -> DataFrame:
    """Pearson correlation of every feature with ``target`` in a single aggregate, returned
    long (feature, correlation_with_et0) and ordered by correlation descending.

    Pairs with a NULL on either side are left out (``nulls="skip"``) or NULL counts as 0 (``"zero"``);
    a column that is constant over its pairs gives NULL. Every row is read once and never repeated:
    rows are grouped by which features they lack, so that within a group all features share the
    sums of the target, and plain sums are all there is to add up. They are taken of differences from
    some value of the table, which keeps their digits where a mean is large against the spread."""
    feats = [c for c in (features or numeric_columns(df)) if c != target]
    if nulls not in ("skip", "zero"):
        raise ValueError(f"unknown nulls mode {nulls!r}")
    names = [f"x{i}" for i in range(len(feats))]
    quoted = [c.replace("`", "``") for c in (target, *feats)]
    values = [f"CAST(`{c}` AS DOUBLE)" for c in quoted]
    if nulls == "zero":
        values = [f"COALESCE({v}, 0D)" for v in values]
    pairs = df.selectExpr(*[f"{v} AS {n}" for v, n in zip(values, ["y", *names], strict=True)]).where("y IS NOT NULL")
    some = pairs.limit(1000).selectExpr("struct(" + ", ".join(f"COALESCE(any_value({n}, true), 0D) AS {n}" for n in ("y", *names)) + ") AS base")
    masks = {f"mask{i // 60}": " | ".join(f"IF({n} IS NULL, {1 << k}L, 0L)" for k, n in enumerate(names[i:i + 60])) for i in range(0, len(names), 60)}
    shifted = pairs.withColumn("base", some.scalar()).selectExpr(*[f"{n} - base.{n} AS {n}" for n in ("y", *names)])
    sums = [f"SUM({e}) AS {n}" for x in names for e, n in ((x, x), (f"{x} * {x}", f"{x}x"), (f"{x} * y", f"{x}y"))]
    per_mask = shifted.selectExpr("*", *[f"{v} AS {k}" for k, v in masks.items()]).groupBy(*masks).agg(
        *map(F.expr, ["COUNT(*) AS n", "SUM(y) AS y", "SUM(y * y) AS yy", *sums]))
    wide = per_mask.agg(*[F.expr(f"{_pearson(x, f'mask{i // 60} & {1 << i % 60}L = 0')} AS {x}") for i, x in enumerate(names)])
    rows = [F.struct(F.lit(c).alias("feature"), F.round(x, digits).alias("correlation_with_et0")) for c, x in zip(feats, names, strict=True)]
    out = wide.select(F.inline(F.array(*rows)))
    return out.orderBy(F.col("correlation_with_et0").desc_nulls_last(), F.col("feature"))


def _pearson(x: str, has_x: str) -> str:
    """The coefficient from the sums of the groups of rows that have ``x``. A spread below the
    rounding error of the sums is none."""
    n, y, yy = (f"CAST(SUM(IF({has_x}, {c}, NULL)) AS DOUBLE)" for c in ("n", "y", "yy"))
    sx, sxx, sxy = (f"SUM({c})" for c in (x, f"{x}x", f"{x}y"))
    vx, vy = f"({n} * {sxx} - {sx} * {sx})", f"({n} * {yy} - {y} * {y})"
    return (f"IF({vx} > 1e-12D * {n} * {sxx} AND {vy} > 1e-12D * {n} * {yy}, "
            f"GREATEST(-1D, LEAST(1D, TRY_DIVIDE({n} * {sxy} - {sx} * {y}, SQRT({vx}) * SQRT({vy})))), NULL)")


def et0_correlations(facts: DataFrame, date_mode: str = "lenient", exact_types: bool = False,
                     nulls: str = "skip") -> DataFrame:
    df = with_calendar(facts, date_mode)
    return correlations(df, ET0, numeric_columns(df, exact_types), nulls)


def modelling_set(facts: DataFrame, month: int = 5, date_mode: str = "lenient",
                  keep_split_key: bool = False) -> DataFrame:
    """Rows of one calendar month, the three features and the label as doubles, no NULLs.

    ``split_bucket`` (0..99) is a pure function of (location, date), so the split does not
    depend on partition layout or task retries; a NULL location counts as -1, so every row has one."""
    if "month" in facts.columns:  # stored by the ingest, which sorts by it: skips row groups
        facts = facts.where(F.col("month") == month)
    d = with_obs_date(facts, date_mode).where(F.month("obs_date") == month)
    cols = [F.col(src).cast("double").alias(dst) for src, dst in MODEL_FEATURES.items()]
    cols.append(F.col(ET0).cast("double").alias(MODEL_LABEL))
    if keep_split_key:
        cols.append(F.pmod(F.datediff("obs_date", F.lit("1970-01-01").cast("date")) * 31
                           + F.coalesce(F.col("location_id"), F.lit(-1)), F.lit(100)).alias("split_bucket"))
    return d.select(*cols).na.drop(subset=list(MODEL_FEATURES.values()) + [MODEL_LABEL])


def deterministic_split(df: DataFrame, train_pct: int = 80, method: str = "keyed",
                        seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train/test split. ``keyed`` (default) uses ``split_bucket`` and is the same on any
    layout or retry; ``random`` is ``randomSplit`` with a seed, which depends on how the
    input is partitioned."""
    if method == "random":
        train, test = df.randomSplit([train_pct / 100, 1 - train_pct / 100], seed)
        return train, test
    train = df.where(F.col("split_bucket") < train_pct)
    test = df.where(F.col("split_bucket") >= train_pct)
    return train, test


def split_summary(df: DataFrame, train_pct: int = 80) -> DataFrame:
    return (df.groupBy((F.col("split_bucket") < train_pct).alias("is_train"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(MODEL_LABEL), 6).alias("mean_et0")))


def feature_summary(df: DataFrame, columns: list[str] | None = None, digits: int = 6) -> DataFrame:
    """count / mean / sample stddev / min / max per column, typed (not strings), one pass."""
    cols = columns or [c for c in df.columns if c != "split_bucket"]
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__count"), F.round(F.avg(c), digits).alias(f"{c}__mean"),
                 F.round(F.stddev_samp(c), digits).alias(f"{c}__stddev"),
                 F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("feature"),
                     *[F.col(f"{c}__{s}").alias(s) for s in ("count", "mean", "stddev", "min", "max")])
            for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def simple_regression(df: DataFrame, y: str = ET0, x: str = "sunshine_duration",
                      digits: int = 6) -> DataFrame:
    return df.agg(F.round(F.regr_slope(y, x), digits).alias("slope"),
                  F.round(F.regr_intercept(y, x), digits).alias("intercept"),
                  F.round(F.regr_r2(y, x), digits).alias("r2"),
                  F.regr_count(y, x).alias("n"))


def regression_metrics(df: DataFrame, label: str = MODEL_LABEL, prediction: str = "prediction",
                       digits: int | None = 6) -> DataFrame:
    """RMSE and R^2 (1 - SSres/SStot) of a prediction column, in one aggregate."""
    y, p = F.col(label), F.col(prediction)
    n = F.count(F.lit(1))
    mse = F.avg((y - p) * (y - p))
    # 1 - SSres/SStot with both divided by n; var_pop merges stably across partitions
    rmse = F.sqrt(mse)
    r2 = 1 - F.try_divide(mse, F.var_pop(y))
    if digits is not None:
        rmse, r2 = F.round(rmse, digits), F.round(r2, digits)
    return df.agg(rmse.alias("rmse"), r2.alias("r2"), n.alias("n"))


def fitted_line_metrics(df: DataFrame, y: str = MODEL_LABEL, x: str = "sunshine_duration",
                        digits: int = 6) -> DataFrame:
    """RMSE and R^2 of the least-squares line of ``y`` on ``x`` in ONE aggregate pass.

    For the OLS line the residual sum of squares is ``Syy - Sxy^2 / Sxx``, so with
    population moments RMSE = sqrt(var(y) - cov(x, y)^2 / var(x)) and R^2 = cov^2 / (var(x)
    var(y)); no coefficients travel to the driver and the data is read once. Pairs with a
    NULL side are skipped, as by the regression aggregates."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xx, yy = F.when(both, F.col(x)).cast("double"), F.when(both, F.col(y)).cast("double")
    cov, vx, vy = F.covar_pop(xx, yy), F.var_pop(xx), F.var_pop(yy)
    rmse = F.sqrt(F.greatest(vy - F.try_divide(cov * cov, vx), F.lit(0.0)))
    r2 = F.try_divide(cov * cov, vx * vy)
    return df.agg(F.round(rmse, digits).alias("rmse"), F.round(r2, digits).alias("r2"),
                  F.count_if(both).alias("n"))


def mean_conditions(df: DataFrame, value_col: str = "prediction",
                    value_alias: str = "avg_predicted_et0") -> DataFrame:
    """Global (ungrouped) rounded means of the features and one value column."""
    return df.agg(F.round(F.avg("precipitation_hours"), 2).alias("avg_required_precip"),
                  F.round(F.avg("sunshine_duration"), 2).alias("avg_required_sunshine"),
                  F.round(F.avg("wind_speed"), 2).alias("avg_required_wind"),
                  F.round(F.avg(value_col), 2).alias(value_alias))
