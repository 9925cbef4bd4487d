"""Fitted classifier persistence."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str, overwrite: bool = True) -> None:
    writer = model.write()
    if overwrite:
        writer = writer.overwrite()
    writer.save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
