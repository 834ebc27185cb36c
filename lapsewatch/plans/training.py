"""Gold tables to fitted models and scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import models
from ..operators.monitor import evaluate
from ..operators.prep import CATEGORICAL, FEATURES, OneHot, Scaler, class_weights, fill_stage, missing_flag_fill
from ..operators.splits import temporal_split, training_set
from ..sources.writers import materialise


@dataclass
class LinearPrep:
    """One-hot and scaling fitted on the training split, reused unchanged for scoring."""

    one_hot: OneHot
    scaler: Scaler
    columns: list[str]

    @classmethod
    def fit(cls, train: DataFrame) -> LinearPrep:
        filled = missing_flag_fill(train, FEATURES)
        one_hot = OneHot.fit(filled, CATEGORICAL)
        columns = [c for c in FEATURES if c not in CATEGORICAL] + ["missing_any"] + one_hot.columns()
        return cls(one_hot, Scaler.fit(one_hot.transform(filled), columns), columns)

    def stages(self) -> list[Transformer]:
        """The preparation as stages of a pipeline that can be saved."""
        return [fill_stage(FEATURES), self.one_hot.stage(), self.scaler.stage()]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.scaler.transform(self.one_hot.transform(missing_flag_fill(df, FEATURES)))


def prepare(features: DataFrame, labels: DataFrame, train_date: str, **months) -> DataFrame:
    """Labelled features with their temporal split."""
    return temporal_split(training_set(features, labels), train_date, **months)


def train_linear(data: DataFrame, label: str = "is_churn", **params) -> tuple[PipelineModel, LinearPrep]:
    train = data.where(F.col("split") == "train")
    prep = LinearPrep.fit(train)
    ready = class_weights(prep.transform(train), label)
    return models.fit_lr(ready, prep.columns, label, **params), prep


def whole(model: PipelineModel, prep: LinearPrep) -> PipelineModel:
    """Preparation and model as one pipeline: it takes feature rows and can be saved and loaded as one."""
    return PipelineModel(stages=[*prep.stages(), *model.stages])


def evaluate_model(model: PipelineModel, data: DataFrame, name: str, label: str = "is_churn") -> DataFrame:
    """Metrics of one model on every split. The scores are written, because all metrics read them: each row is scored once."""
    scored = materialise(model.transform(data).select(
        "split", label, models.vector_to_array("probability")[1].alias("churn_proba")))
    return evaluate(scored, "churn_proba", label).withColumn("model", F.lit(name))
