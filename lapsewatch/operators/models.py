"""Training and scoring as Spark ML jobs."""

from __future__ import annotations

import inspect
import json
import random
from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.writers import materialise

VECTOR = "features"


def with_estimator(cols: Sequence[str], estimator: Estimator) -> Pipeline:
    """Assemble the feature columns and put an estimator behind them."""
    return Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol=VECTOR, handleInvalid="keep"), estimator])


def logistic(label: str, c: float = 1.0, penalty: str = "l2", max_iter: int = 100, weight_sum: float = 1.0,
             weight: str = "weight") -> LogisticRegression:
    """l1 or l2 logistic regression with strength 1 / (C * sum of weights), on unscaled inputs."""
    return LogisticRegression(
        featuresCol=VECTOR, labelCol=label, weightCol=weight, maxIter=max_iter, standardization=False,
        regParam=1.0 / (c * weight_sum), elasticNetParam=1.0 if penalty == "l1" else 0.0)


def forest(label: str, trees: int = 100, depth: int = 10, min_leaf: int = 1, features: str = "sqrt",
           bootstrap: bool = True, seed: int = 42, weight: str = "weight") -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=VECTOR, labelCol=label, weightCol=weight, numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_leaf, featureSubsetStrategy=features, bootstrap=bootstrap, seed=seed)


def boosted(label: str, rounds: int = 100, depth: int = 6, eta: float = 0.1, subsample: float = 1.0,
            min_leaf: int = 1, features: float = 1.0, min_gain: float = 0.0, seed: int = 42,
            weight: str = "weight") -> GBTClassifier:
    """Boosted trees; ``features`` is the share of columns each tree node may use, ``min_gain`` the least gain of a split."""
    return GBTClassifier(
        featuresCol=VECTOR, labelCol=label, weightCol=weight, maxIter=rounds, maxDepth=depth, stepSize=eta,
        subsamplingRate=subsample, minInstancesPerNode=min_leaf, featureSubsetStrategy=str(features), minInfoGain=min_gain, seed=seed)


def fit_lr(train: DataFrame, cols: Sequence[str], label: str = "is_churn", **params) -> PipelineModel:
    """Balanced logistic regression; ``train`` carries the row weights."""
    total = train.agg(F.sum(params.get("weight", "weight"))).first()[0] or 1.0
    return with_estimator(cols, logistic(label, weight_sum=total, **params)).fit(train)


def fit_rf(train: DataFrame, cols: Sequence[str], label: str = "is_churn", **params) -> PipelineModel:
    """Random forest; each row's node in every tree is kept between the levels, so a level moves rows one step instead of down from the root."""
    return with_estimator(cols, forest(label, **params).setCacheNodeIds(True)).fit(train)


def fit_gbt(train: DataFrame, cols: Sequence[str], label: str = "is_churn", validation: DataFrame | None = None,
            tolerance: float = 1e-3, **params) -> PipelineModel:
    """Boosted trees. With ``validation`` rows, boosting stops in the round after which their loss no longer falls by ``tolerance``.

    The validation rows pass through the fit beside the training rows, marked, and never shape a tree; their weights
    should follow the training rows.
    """
    estimator = boosted(label, **params)
    if validation is not None:
        estimator = estimator.setValidationIndicatorCol("_validation")
        estimator.set(estimator.validationTol, tolerance)
        train = train.withColumn("_validation", F.lit(False)).unionByName(validation.withColumn("_validation", F.lit(True)))
    return with_estimator(cols, estimator).fit(train)


def loss_by_round(model: PipelineModel, df: DataFrame, label: str = "is_churn") -> DataFrame:
    """Mean log loss after each boosting round: round, loss. One row per tree."""
    ready = model.stages[0].transform(df.withColumn(label, F.col(label).cast("double")))
    losses = model.stages[-1].evaluateEachIteration(ready)
    return df.sparkSession.createDataFrame(list(enumerate(map(float, losses), 1)), "round int, loss double")


# The ranges of the random searches, parameter name -> draw from a random generator.
LR_SPACE: dict[str, Callable] = {
    "c": lambda r: r.uniform(0.01, 10.01), "penalty": lambda r: r.choice(["l1", "l2"]),
    "max_iter": lambda r: r.choice([1000, 2000]),
}
RF_SPACE: dict[str, Callable] = {
    "trees": lambda r: r.randrange(100, 300), "depth": lambda r: r.choice([5, 10, 15, 20]),
    "min_leaf": lambda r: r.randrange(1, 10), "features": lambda r: r.choice(["sqrt", "log2", "all"]),
    "bootstrap": lambda r: r.choice([True, False]),
}
GBT_SPACE: dict[str, Callable] = {
    "depth": lambda r: r.randrange(3, 10), "eta": lambda r: r.uniform(0.01, 0.31),
    "rounds": lambda r: r.randrange(100, 300), "subsample": lambda r: r.uniform(0.6, 1.0),
    "min_leaf": lambda r: r.randrange(1, 10), "features": lambda r: r.uniform(0.6, 1.0),
    "min_gain": lambda r: r.uniform(0.0, 0.5),
}


def draw_params(space: dict[str, Callable], n_iter: int, seed: int = 42) -> list[dict]:
    """Seeded random parameter sets."""
    rng = random.Random(seed)
    return [{k: draw(rng) for k, draw in space.items()} for _ in range(n_iter)]


def random_search(
    train: DataFrame, cols: Sequence[str], build: Callable[..., Estimator], candidates: Sequence[dict], folds: int,
    label: str = "is_churn", fold_col: str = "fold", parallelism: int = 4,
) -> CrossValidatorModel:
    """Cross-validated exact AUC for each candidate on given folds; the best is refitted on all rows of ``train``.

    Builders that scale their penalty by the sum of the row weights are given that of ``train``. The assembled rows are
    written first: a fit makes hundreds of passes, and the tasks of a pass then follow the size of the rows instead of the
    shuffle partitions that dealt the folds.
    """
    assembler = VectorAssembler(inputCols=list(cols), outputCol=VECTOR, handleInvalid="keep")
    ready = materialise(assembler.transform(train).drop(*cols))
    fixed = {}
    if "weight_sum" in inspect.signature(build).parameters:
        fixed["weight_sum"] = ready.agg(F.sum("weight")).first()[0] or 1.0
    # the estimator of each candidate supplies the parameter values of one grid entry
    est = build(label)
    grid = []
    for params in candidates:
        made = build(label, **params, **fixed)
        grid.append({est.getParam(p.name): v for p, v in made.extractParamMap().items() if made.isSet(p)})
    cv = CrossValidator(
        estimator=est, estimatorParamMaps=grid, numFolds=folds, foldCol=fold_col, parallelism=parallelism,
        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0))
    return cv.fit(ready)


def cv_results(spark: SparkSession, model: CrossValidatorModel, candidates: Sequence[dict]) -> DataFrame:
    """One row per candidate: parameters, mean and std of the fold scores, rank."""
    rows = [(i, json.dumps(p, sort_keys=True), float(m), float(s))
            for i, (p, m, s) in enumerate(zip(candidates, model.avgMetrics, model.stdMetrics))]
    df = spark.createDataFrame(rows, "candidate int, params string, mean_score double, std_score double")
    # one row per candidate, a handful
    best_first = Window.partitionBy(F.lit(0)).orderBy(F.desc("mean_score"))
    return df.withColumn("rank_score", F.rank().over(best_first))


def importances(spark: SparkSession, model: PipelineModel, cols: Sequence[str]) -> DataFrame:
    """Feature weight table: coefficients of a linear model, importances of a tree model."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    values = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
    rows = [(c, float(v)) for c, v in zip(cols, values.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")


def top_features(table: DataFrame, k: int = 20) -> DataFrame:
    """The k features of greatest absolute weight."""
    return table.withColumn("abs_importance", F.abs("importance")).orderBy(
        F.desc("abs_importance"), "feature").limit(k)


def score(model: PipelineModel, df: DataFrame, name: str, key: str = "msno") -> DataFrame:
    """Churn probability per (entity, snapshot_date); any number of dates in one job."""
    out = model.transform(df)
    proba = vector_to_array("probability")[1]
    return out.select(key, "snapshot_date", proba.alias("churn_proba"), F.lit(name).alias("model_file"))


def linear_score(coefs: dict[str, float], intercept: float = 0.0) -> Column:
    """Logistic of a weighted sum of columns."""
    z = F.lit(float(intercept))
    for c, w in coefs.items():
        z = z + F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(float(w))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score_linear(df: DataFrame, coefs: dict[str, float], intercept: float = 0.0, key: str = "msno",
                 name: str = "linear") -> DataFrame:
    return df.select(key, "snapshot_date", linear_score(coefs, intercept).alias("churn_proba"),
                     F.lit(name).alias("model_file"))


def compare(metrics: dict[str, DataFrame]) -> DataFrame:
    """Metric tables of several models, one under the other."""
    out = None
    for name, df in metrics.items():
        tagged = df.withColumn("model", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def best_model(comparison: DataFrame, split: str = "test", metric: str = "roc_auc") -> DataFrame:
    return comparison.where(F.col("split") == split).agg(
        F.max_by("model", metric).alias("best_model"), F.max(metric).alias(metric))
