"""Training and scoring. Results depend on the optimiser, so there is no SQL for them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import models, monitor, prep, splits
from ..plans import medallion, scoring, training
from ..sources.writers import materialise, shared_folder
from .base import query

TREE = [*prep.FEATURES, "missing_any"]
# Candidates of the two searches; the parameter ranges are those of ``operators.models``.
LR_CANDIDATES, RF_CANDIDATES = 10, 3


def labelled(t):
    """Gold features with labels, written once: fitting reads them many times. The last six days are val, test and oot, two each."""
    # shares and attributes read the members three times, and filters on their parsed dates would reach the events
    feats = medallion.feature_store(t.f_snap, materialise(t.f_members), t.f_txn, t.f_logs, *t.span, daily=True)
    d = F.col("snapshot_date")
    until = lambda days: d <= F.date_sub(F.lit(t.span[1]).cast("date"), days)
    tag = F.when(until(6), "train").when(until(4), "val").when(until(2), "test").otherwise("oot")
    return materialise(splits.training_set(feats, t.f_label).withColumn("split", tag))


def filled(data):
    return prep.missing_flag_fill(data, prep.FEATURES)


def tree_train(data):
    """Training rows with weights that are balanced over these rows alone."""
    return prep.class_weights(filled(data.where("split = 'train'")), "is_churn")


@query("T1 E1 E3 E5 E7 T5")
def train_lr(t):
    data = labelled(t)
    model, ready = training.train_linear(data, c=1.0, max_iter=50)
    return training.evaluate_model(model, ready.transform(data), "lr")


@query("T2 T5")
def train_rf(t):
    data = labelled(t)
    return training.evaluate_model(models.fit_rf(tree_train(data), TREE), filled(data), "rf")


@query("T3 E8 T5")
def train_gbt(t):
    data = labelled(t)
    rows = {split: filled(data.where(F.col("split") == split)) for split in ("train", "val")}
    train, val = (prep.with_pos_weight(rows[split], "is_churn", like=rows["train"]) for split in ("train", "val"))
    return training.evaluate_model(models.fit_gbt(train, TREE, validation=val), filled(data), "gbt")


@query("T4 T11 M6")
def random_search(t):
    data = splits.assign_folds(tree_train(labelled(t)), "is_churn", 3)
    candidates = models.draw_params(models.RF_SPACE, RF_CANDIDATES)
    found = models.random_search(data, TREE, models.forest, candidates, 3)
    return models.cv_results(t.spark, found, candidates)


@query("T4 T11 M6")
def random_search_lr(t):
    train = labelled(t).where("split = 'train'")
    ready = training.LinearPrep.fit(train)
    data = splits.assign_folds(materialise(prep.class_weights(ready.transform(train), "is_churn")), "is_churn", 3)
    candidates = models.draw_params(models.LR_SPACE, LR_CANDIDATES)
    found = models.random_search(data, ready.columns, models.logistic, candidates, 3)
    return models.cv_results(t.spark, found, candidates)


@query("T6 K3")
def importances(t):
    model = models.fit_rf(tree_train(labelled(t)), TREE)
    return models.top_features(models.importances(t.spark, model, TREE), 20)


@query("T6 K3")
def coefficients(t):
    model, ready = training.train_linear(labelled(t), c=1.0, penalty="l1", max_iter=50)
    return models.top_features(models.importances(t.spark, model, ready.columns), 20)


@query("T7 K4 T5")
def compare_models(t):
    data = labelled(t)
    train, every = tree_train(data), filled(data)
    scored = {
        "rf": training.evaluate_model(models.fit_rf(train, TREE), every, "rf"),
        "gbt": training.evaluate_model(models.fit_gbt(train, TREE), every, "gbt"),
    }
    return models.best_model(models.compare(scored))


@query("T8 T10")
def score_snapshots(t):
    data = labelled(t)
    model, ready = training.train_linear(data, max_iter=20)
    return models.score(model, ready.transform(data), "lr")


@query("Q11 T8")
def monitor_scores(t):
    data = labelled(t)
    model, ready = training.train_linear(data, max_iter=20)
    scored = models.score(model, ready.transform(data), "lr")
    late = F.col("snapshot_date") > F.date_sub(F.lit(t.span[1]).cast("date"), 9)
    base, cur = scored.where(~late), scored.where(late)
    return monitor.monitor(base, cur, "churn_proba", t.f_label)


@query("T8 I3 Q11 Q12 S11")
def score_and_monitor(t):
    """Stored pipeline, inference tables of two dates, predictions, score counts, and the report of the second date."""
    out, dates = shared_folder(t.spark), ("2024-01-20", "2024-01-21")
    model, ready = training.train_linear(labelled(t), max_iter=20)
    training.whole(model, ready).write().save(f"{out}/model")
    known = materialise(t.f_members)
    for date in dates:
        features = medallion.extend_inference(known, t.f_txn, t.f_logs, out, date)
        labels = t.f_label.where(F.col("snapshot_date") == F.lit(date).cast("date"))
        report = scoring.score_and_monitor(features, f"{out}/model", "lr", out, date, (dates[0], dates[0]), labels)
    return report
