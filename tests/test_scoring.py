import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lapsewatch.operators import models, prep
from lapsewatch.plans import scoring, training
from helpers import day


def features(spark, n, seed, date="2024-01-01"):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        values = [None if rng.random() < 0.1 else rng.random() * 10 for _ in prep.FEATURES]
        values[1], values[2] = rng.choice([3, 7, 9, None]), rng.choice([1, 4, None])
        rows.append((f"u{i}", day(date), "train" if i % 3 else "test", *values, int((values[3] or 0) + rng.random() * 4 > 6)))
    kind = "msno string, snapshot_date date, split string, " + ", ".join(
        f"{c} {'int' if c in prep.CATEGORICAL else 'double'}" for c in prep.FEATURES) + ", is_churn int"
    return spark.createDataFrame(rows, kind)


def test_saved_pipeline_scores_as_the_fitted_one(spark, tmp_path):
    df = features(spark, 300, 1)
    model, ready = training.train_linear(df, max_iter=20)
    training.whole(model, ready).write().save(f"{tmp_path}/model")
    loaded = PipelineModel.load(f"{tmp_path}/model")
    want = {r.msno: r.churn_proba for r in models.score(model, ready.transform(df), "lr").collect()}
    for session in (spark, spark.newSession()):
        rows = session.createDataFrame(df.collect(), df.schema)
        got = {r.msno: r.churn_proba for r in models.score(loaded, rows, "lr").collect()}
        assert got.keys() == want.keys() and all(got[u] == pytest.approx(want[u], abs=1e-12) for u in want)
    unseen = df.limit(1).withColumn("registered_via", F.lit(99))
    assert models.score(loaded, unseen, "lr").first().churn_proba is not None


def test_stages_equal_columns(spark):
    rows = [("it's", 1.0, None), ("b\\c", 3.0, 2.0), (None, 5.0, 4.0)]
    df = spark.createDataFrame(rows, "c string, x double, y double")
    hot, scale = prep.OneHot.fit(df, ["c"]), prep.Scaler.fit(df, ["x"])
    for a, b in ((prep.fill_stage(["x", "y"]).transform(df), prep.missing_flag_fill(df, ["x", "y"])),
                 (hot.stage().transform(df), hot.transform(df)), (scale.stage().transform(df), scale.transform(df))):
        assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))


def test_score_and_monitor(spark, tmp_path):
    train = features(spark, 300, 2)
    model, ready = training.train_linear(train, max_iter=20)
    training.whole(model, ready).write().save(f"{tmp_path}/model")
    for date, n in (("2024-02-01", 80), ("2024-02-02", 90), ("2024-02-02", 90)):
        day_rows = features(spark, n, 3, date)
        table = day_rows.withColumnsRenamed({c: f"{c}_oh" for c in prep.CATEGORICAL})
        labels = day_rows.where("msno <> 'u1'").select("msno", "snapshot_date", "is_churn")
        report = scoring.score_and_monitor(table, f"{tmp_path}/model", "lr", str(tmp_path), date, ("2024-02-01", "2024-02-01"), labels)
    assert spark.read.parquet(f"{tmp_path}/predictions").count() == 170
    values = {(r["section"], r["metric"]): r["value"] for r in report.collect()}
    assert values["baseline_summary", "count"] == 80 and values["current_summary", "count"] == 90
    assert values["label_metrics", "matched"] == 89 and values["label_metrics", "unmatched"] == 1
    assert values["label_metrics", "roc_auc"] > 0.6
    first = report.first()
    assert (first.model_file, first.snapshot_date, first.baseline_start) == ("lr", day("2024-02-02"), day("2024-02-01"))


def test_boosting_stops_on_validation_rows(spark):
    df = features(spark, 240, 4).na.fill(0).withColumn("weight", F.lit(1.0)).cache()
    train, val = (df.where(F.col("split") == s) for s in ("train", "test"))
    cols = ["sum_secs_w30", "active_days_w30", "complete_rate_w30"]
    short, long = (models.fit_gbt(train, cols, validation=val, rounds=n, depth=4, eta=0.5) for n in (25, 40))
    trees = short.stages[-1].getNumTrees
    assert trees < 25 and trees == long.stages[-1].getNumTrees  # more rounds change nothing
    a, b = (models.score(m, val, "gbt").orderBy("msno").collect() for m in (short, long))
    assert a == b
    loss = models.loss_by_round(short, val).collect()
    assert [r["round"] for r in loss] == list(range(1, trees + 1))
