"""Save fitted pipelines and models, replacing earlier ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Model, PipelineModel


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def save_models(models: Mapping[str, Model], paths: Mapping[str, str]) -> None:
    """Save every model that has a path under its name; a model without one is an error."""
    missing = sorted(set(models) - set(paths))
    if missing:
        raise ValueError(f"no path to save these models to: {missing}")
    for name, model in models.items():
        model.write().overwrite().save(paths[name])
