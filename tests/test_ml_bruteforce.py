"""Linear regression (default parameters = ordinary least squares) against numpy on the
smallest tables: same coefficients, same test-split RMSE and R^2."""
import numpy as np
import pytest

from cumulus.operators import ml, stats
from cumulus.plans.observations import observations

SF = "/root/testdata/sf0.001"


def test_linear_regression_matches_least_squares(spark):
    rows = stats.modelling_set(observations(spark, SF), keep_split_key=True)
    fitted = ml.fit_models(rows, ("lr",))
    model = fitted.models["lr"]
    data = np.array([tuple(r) for r in rows.select(*ml.FEATURE_NAMES, "et0", "split_bucket").collect()],
                    dtype=float)
    train, test = data[data[:, 4] < 80], data[data[:, 4] >= 80]
    x = np.column_stack([train[:, :3], np.ones(len(train))])
    coef, *_ = np.linalg.lstsq(x, train[:, 3], rcond=None)
    assert np.allclose(model.coefficients.toArray(), coef[:3], rtol=1e-6, atol=1e-9)
    assert model.intercept == pytest.approx(coef[3], rel=1e-6, abs=1e-9)
    pred = test[:, :3] @ coef[:3] + coef[3]
    rmse = float(np.sqrt(np.mean((test[:, 3] - pred) ** 2)))
    r2 = 1 - np.sum((test[:, 3] - pred) ** 2) / np.sum((test[:, 3] - test[:, 3].mean()) ** 2)
    got_rmse, got_r2 = fitted.metrics["lr"]
    assert got_rmse == pytest.approx(rmse, rel=1e-6)
    assert got_r2 == pytest.approx(r2, rel=1e-6, abs=1e-9)


def test_metrics_aggregate_matches_evaluator(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (3.0, 3.5), (4.0, 3.0)], "et0 double, prediction double")
    r = stats.regression_metrics(df).first()
    y, p = np.array([1, 2, 3, 4.0]), np.array([1.5, 1.5, 3.5, 3.0])
    assert r.rmse == pytest.approx(round(float(np.sqrt(np.mean((y - p) ** 2))), 6))
    assert r.r2 == pytest.approx(round(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2), 6))


def test_models_learn_a_known_relation(spark):
    """With ET0 replaced by a known function of the three features (plus a small
    deterministic wobble), every model recovers it - the pipeline learns; the near-zero R2
    on the plain binding comes from its unrelated ET0, not from the code."""
    from pyspark.sql import functions as F

    rows = stats.modelling_set(observations(spark, SF), keep_split_key=True)
    known = rows.withColumn(
        "et0", 0.4 * F.col("precipitation_hours") + F.col("sunshine_duration") / 8000
        + 0.3 * F.col("wind_speed") + (F.col("split_bucket") % 7) / 100)
    fitted = ml.fit_models(known)
    r2 = {k: v[1] for k, v in fitted.metrics.items()}
    assert r2["lr"] > 0.99
    assert r2["rf"] > 0.8
    assert r2["gbt"] > 0.9
