"""ET0 regression with Spark ML: feature assembly, linear regression, random forest,
gradient-boosted trees, evaluation, model comparison, feature importances, scenario
scoring and the mean conditions of low predicted ET0.

Training is distributed by Spark ML. The modelling rows (three features, label, split key) are read
from the facts once and stored as a narrow table; the training split is persisted from there (memory
and disk, so a lost executor reads only its blocks again) around the fits and released afterwards. All
models predict the test split side by side, and one aggregate gives every metric.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, stored
from .stats import MODEL_FEATURES, MODEL_LABEL, deterministic_split, mean_conditions

FEATURE_NAMES = list(MODEL_FEATURES.values())
SEED = 42


def assemble(df: DataFrame, features: list[str] = FEATURE_NAMES) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features").transform(df)


def complete(df: DataFrame, features: list[str] = FEATURE_NAMES) -> Column:
    """Whether a row has all features (a location without readings has none)."""
    ok = F.lit(True)
    for f in features:
        ok = ok & F.col(f).isNotNull() & ~F.isnan(f)
    return ok


def linear_regression(**kw) -> LinearRegression:
    return LinearRegression(labelCol=MODEL_LABEL, featuresCol="features", **kw)


def random_forest(num_trees: int = 50, seed: int = SEED, **kw) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=MODEL_LABEL, featuresCol="features", numTrees=num_trees, seed=seed, **kw)


def gradient_boosted_trees(max_iter: int = 100, max_depth: int = 5, seed: int = SEED,
                           **kw) -> GBTRegressor:
    # boosting checkpoints what it carries from round to round every 10 rounds into the shared
    # folder, so a long run does not rebuild a 100-step lineage after a loss
    return GBTRegressor(labelCol=MODEL_LABEL, featuresCol="features", maxIter=max_iter,
                        maxDepth=max_depth, seed=seed, checkpointInterval=10, **kw)


def _column(name: str) -> str:
    return f"prediction_{name}"


def evaluate(predictions: DataFrame, columns: dict[str, str], label: str = MODEL_LABEL) -> dict[str, tuple[float, float]]:
    """name -> (RMSE, R^2) of several prediction columns, in one aggregate pass."""
    y, aggs = F.col(label), []
    for name, c in columns.items():
        mse = F.avg((y - F.col(c)) * (y - F.col(c)))
        aggs += [F.sqrt(mse).alias(f"{name}_rmse"), (1 - F.try_divide(mse, F.var_pop(y))).alias(f"{name}_r2")]
    row = predictions.agg(*aggs).first()
    return {name: (row[f"{name}_rmse"], row[f"{name}_r2"]) for name in columns}


@dataclass
class FittedModels:
    models: dict            # name -> fitted model
    scored: DataFrame       # test split with one prediction column per model

    @property
    def metrics(self) -> dict:
        """name -> (rmse, r2), computed when asked for."""
        return evaluate(self.scored, {k: _column(k) for k in self.models})

    @property
    def predictions(self) -> dict:
        """name -> test split with that model's ``prediction``."""
        return {k: self.scored.withColumn("prediction", F.col(_column(k))) for k in self.models}


def fit_models(modelling: DataFrame, which: tuple[str, ...] = ("lr", "rf", "gbt"),
               forest: dict | None = None, boosting: dict | None = None,
               train_pct: int = 80) -> FittedModels:
    """Fit the requested models on the deterministic training split and score the test split;
    ``forest`` and ``boosting`` are parameters of these learners."""
    shared_dir(modelling.sparkSession)  # where boosting checkpoints
    rows = assemble(stored(modelling, "modelling"))
    train, test = deterministic_split(rows, train_pct)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    estimators = {
        "lr": linear_regression,
        "rf": lambda: random_forest(**(forest or {})),
        "gbt": lambda: gradient_boosted_trees(**(boosting or {})),
    }
    models = {}
    try:
        for name in which:
            models[name] = estimators[name]().fit(train).setPredictionCol(_column(name))
            test = models[name].transform(test)
    finally:
        train.unpersist()
    return FittedModels(models, test)


# --- fixed values: display names of the compared models ----------------------------------
MODEL_TITLES = {"lr": "Linear Regression", "rf": "Random Forest", "gbt": "Gradient Boosted Trees"}


def comparison_table(spark: SparkSession, fitted: FittedModels) -> DataFrame:
    """(Model, RMSE, R2) - a handful of scalars, built on the driver."""
    rows = [(MODEL_TITLES[k], float(r), float(q)) for k, (r, q) in fitted.metrics.items()]
    return spark.createDataFrame(rows, "Model string, RMSE double, R2 double")


def feature_importances(spark: SparkSession, model, features: list[str] = FEATURE_NAMES) -> DataFrame:
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(features, map(float, imp))), "feature string, importance double")


def score(model, scenarios: DataFrame) -> DataFrame:
    """Predicted ET0 for each scenario row (feature columns by name); a scenario that lacks a
    feature stays, with a NULL prediction."""
    ok = complete(scenarios)
    scored = model.transform(assemble(scenarios.where(ok))).drop("features")
    scored = scored.withColumnRenamed(model.getPredictionCol(), "prediction")
    return scored.unionByName(scenarios.where(~ok), allowMissingColumns=True)


def location_scenarios(facts_month: DataFrame) -> DataFrame:
    """One scenario per location: its mean conditions in the modelling month."""
    return (facts_month.groupBy("location_id")
            .agg(*[F.avg(c).alias(c) for c in FEATURE_NAMES]))


def low_et0_conditions(predictions: DataFrame, threshold: float = 1.5) -> DataFrame:
    """Mean conditions of the test rows whose predicted ET0 is below ``threshold``."""
    return mean_conditions(predictions.where(F.col("prediction") < threshold))
