"""Saved models."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from ..operators.features import with_profile


def load_model(path: str) -> PipelineModel:
    """A saved pipeline, with the name of its preparation if that is beside it.
    ``PipelineModel.load`` alone gives a model that scores the same."""
    model = PipelineModel.load(path)
    try:
        saved = SparkSession.getActiveSession().read.text(f"{path}/profile").first()
    except AnalysisException:  # saved without a profile
        return model
    return with_profile(model, saved["value"])
