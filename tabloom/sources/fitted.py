"""Load what ``sinks.fitted`` has saved."""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel

MODEL_CLASSES = {
    "lr": LogisticRegressionModel,
    "gbt": GBTClassificationModel,
    "rf": RandomForestClassificationModel,
}


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_model(kind: str, path: str) -> Model:
    """A fitted classifier; ``kind`` is ``"lr"``, ``"gbt"`` or ``"rf"``."""
    return MODEL_CLASSES[kind].load(path)
