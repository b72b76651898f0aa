"""Fit one of the models on a fold's model table and report on every role."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillcast.operators.additive_model import AdditiveModel, AdditiveSpec, fit_additive
from tillcast.operators.collinear import dependent_columns
from tillcast.operators.encoders import training
from tillcast.operators.metrics import evaluate
from tillcast.operators.ordinal_model import OrdinalModel, OrdinalSpec, fit_ordinal

# The model names of the configuration; an unknown name means the first one.
ADDITIVE, ORDINAL = "ebm", "ordered_model"


@dataclass(frozen=True)
class ModelSpec:
    name: str = ADDITIVE
    additive: AdditiveSpec = AdditiveSpec()
    ordinal: OrdinalSpec = OrdinalSpec()


def fit_model(
    table: DataFrame, features: list[str], labels: list[str], spec: ModelSpec = ModelSpec()
) -> AdditiveModel | OrdinalModel:
    """Learn from the training rows of ``table``, the staged model table of one fold.

    An ordinal model has its thresholds for a constant; features that contain another one, or each other, leave its weights
    undetermined. Such a fit goes on, and a warning names them.
    """
    rows = training(table)
    if spec.name == ORDINAL:
        dependent = dependent_columns(rows, features)
        if dependent:
            warnings.warn(f"features that depend on others or on a constant: {', '.join(dependent)}", stacklevel=2)
        return fit_ordinal(rows, features, labels, spec.ordinal)
    return fit_additive(rows, features, labels, spec.additive)


def report(model: AdditiveModel | OrdinalModel, table: DataFrame) -> DataFrame:
    """Metrics of training, validation and testing with the same code, one row each."""
    return evaluate(model.transform(table), ["split_approach", "fold", "role"])
