"""Retail demand features, datasets, models and batch scoring as Spark DataFrame operators."""

__version__ = "0.1.0"
