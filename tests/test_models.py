import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from lapsewatch.catalog import base
from lapsewatch.catalog import models as catalog_models
from lapsewatch.operators import models, prep, splits
from lapsewatch.plans import medallion, training
from helpers import day


def separable(spark, n=400):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        y = i % 4 == 0
        rows.append((f"u{i}", day("2024-01-01"), int(y), "train" if i % 3 else "test", rng.gauss(2.0 if y else 0.0, 1), rng.random()))
    df = spark.createDataFrame(rows, "msno string, snapshot_date date, is_churn int, split string, x double, noise double")
    return prep.class_weights(df, "is_churn")


def test_models_learn_and_compare(spark, tmp_path):
    df = separable(spark).cache()
    train = df.where("split = 'train'")
    cols = ["x", "noise"]
    fitted = {
        "lr": models.fit_lr(train, cols, max_iter=30), "rf": models.fit_rf(train, cols, trees=10, depth=4),
        "gbt": models.fit_gbt(train, cols, rounds=5, depth=3),
    }
    table = models.compare({k: training.evaluate_model(m, df, k) for k, m in fitted.items()})
    aucs = {(r.model, r.split): r.roc_auc for r in table.collect()}
    assert len(aucs) == 6 and min(aucs.values()) > 0.8
    assert models.best_model(table).first().roc_auc == max(v for (_, s), v in aucs.items() if s == "test")
    for m in fitted.values():
        assert models.top_features(models.importances(spark, m, cols), 1).first().feature == "x"
    fitted["rf"].write().overwrite().save(str(tmp_path / "rf"))
    scored = models.score(PipelineModel.load(str(tmp_path / "rf")), df, "rf")
    assert scored.columns == ["msno", "snapshot_date", "churn_proba", "model_file"] and scored.count() == df.count()


def test_search_on_given_folds(spark):
    df = splits.assign_folds(separable(spark), "is_churn", 3).cache()
    space = {"c": models.LR_SPACE["c"], "penalty": models.LR_SPACE["penalty"]}
    candidates = models.draw_params(space, 2, seed=5)
    assert candidates == models.draw_params(space, 2, seed=5)
    found = models.random_search(df, ["x", "noise"], models.logistic, candidates, 3)
    res = models.cv_results(spark, found, candidates).orderBy("rank_score").collect()
    assert len(res) == 2 and res[0].rank_score == 1 and res[0].mean_score > 0.8
    regs = {m[found.getEstimator().getParam("regParam")] for m in found.getEstimatorParamMaps()}
    assert len(regs) == 2


@pytest.mark.parametrize("penalty", ["l1", "l2"])
def test_search_uses_the_penalty_of_fit_lr(spark, penalty):
    df = splits.assign_folds(separable(spark), "is_churn", 3).cache()
    found = models.random_search(df, ["x", "noise"], models.logistic, [{"c": 1.0, "penalty": penalty, "max_iter": 200}], 3)
    alone = models.fit_lr(df, ["x", "noise"], c=1.0, penalty=penalty, max_iter=200).stages[-1]
    assert abs(found.bestModel.coefficients[0] - alone.coefficients[0]) < 1e-6 and alone.coefficients[0] > 1
    assert abs(found.bestModel.intercept - alone.intercept) < 1e-6


def test_linear_scores(spark):
    df = spark.createDataFrame([("a", day("2024-01-01"), 0.0, None), ("b", day("2024-01-01"), 2.0, 1.0)],
                               "msno string, snapshot_date date, x double, y double")
    out = {r.msno: r.churn_proba for r in models.score_linear(df, {"x": 1.0, "y": 5.0}, -2.0).collect()}
    assert abs(out["a"] - 0.1192029) < 1e-6 and out["b"] > 0.99


def test_search_passes_follow_the_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(models.CrossValidator, "fit", lambda self, rows: seen.append(rows.where("fold <> 0").cache().rdd.getNumPartitions()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = splits.assign_folds(separable(spark), "is_churn", 3)
        models.random_search(df, ["x", "noise"], models.logistic, [{"c": 1.0}], 3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.catalog.clearCache()
    assert seen[0] <= 8


def test_a_forest_keeps_the_nodes_of_its_rows(spark):
    df, cols = separable(spark).cache(), ["x", "noise"]
    kept = models.fit_rf(df, cols, trees=5, depth=6)
    plain = models.with_estimator(cols, models.forest("is_churn", trees=5, depth=6)).fit(df)
    assert kept.stages[-1].getCacheNodeIds() and not plain.stages[-1].getCacheNodeIds()
    grown = [m.stages[-1].toDebugString.split("\n", 1)[1] for m in (kept, plain)]
    assert grown[0] == grown[1] and "Tree 4" in grown[0]


def test_each_row_is_scored_once(spark):
    df, seen = separable(spark).cache(), spark.sparkContext.accumulator(0)

    class Counting:
        def transform(self, rows):
            def scored(x):
                seen.add(1)
                p = 1 / (1 + 2.718281828 ** (1 - x))
                return Vectors.dense(1 - p, p)

            return rows.withColumn("probability", F.udf(scored, VectorUDT())("x"))

    table = {r.split: r for r in training.evaluate_model(Counting(), df, "m").collect()}
    assert seen.value == df.count() and set(table) == {"train", "test"}
    assert min(r.roc_auc for r in table.values()) > 0.8 and {r.model for r in table.values()} == {"m"}


def test_labelled_rows_come_from_stored_members(spark, monkeypatch):
    given = []

    def store(snaps, members, txn, logs, *span, daily):
        given.extend(members.inputFiles())
        return snaps

    monkeypatch.setattr(medallion, "feature_store", store)
    assert catalog_models.labelled(base.Tables(spark, "/root/testdata/sf0.001")).columns == ["msno", "snapshot_date", "is_churn", "split"]
    assert given and not any("events" in f for f in given)
