"""From a feature table to predictions and their report."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ..operators import models, score_counts
from ..operators.monitor import read_predictions, score_vs_label
from ..operators.prep import CATEGORICAL, FEATURES
from ..sources.writers import write_predictions


def for_scoring(features: DataFrame) -> DataFrame:
    """Entity, date and model features of an inference table, whose category codes carry the suffix ``_oh``.

    Codes that the model has not seen in training are all zeros after its one-hot stage.
    """
    have = set(features.columns)
    renamed = {f"{c}_oh": c for c in CATEGORICAL if c not in have}
    return features.withColumnsRenamed(renamed).select("msno", "snapshot_date", *FEATURES)


def score_and_monitor(
    features: DataFrame, model_path: str, name: str, out: str, date: str, baseline: tuple[str, str],
    labels: DataFrame | None = None, label: str = "is_churn",
) -> DataFrame:
    """Score one date with a saved pipeline, store predictions and score counts, and report on it.

    ``features`` holds the rows of ``date``. The prediction table (``predictions``, by model and date) and the count table
    (``score_counts``) lie under ``out``; a rerun replaces its date in both. The report compares the date with the
    counts of ``baseline`` dates and has the model, the date and the baseline in its rows.
    """
    spark = features.sparkSession
    scored = models.score(PipelineModel.load(model_path), for_scoring(features), name)
    write_predictions(scored, f"{out}/predictions")
    preds = read_predictions(spark, f"{out}/predictions", name, date)
    if labels is not None:
        preds = score_vs_label(preds, labels, label)
        score_counts.write_counts(preds, f"{out}/score_counts", label="label", matched="matched")
    else:
        score_counts.write_counts(preds, f"{out}/score_counts")
    return score_counts.monitor_counts(spark, f"{out}/score_counts", name, date, baseline, labels is not None)
