"""Column-name rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalise_name(name):
    """``' Date #$Q('`` becomes ``'date_q'``; anything but text passes through."""
    if not isinstance(name, str):
        return name
    return re.sub(r"[^a-zA-Z0-9_]", "", name.lower().strip().replace(" ", "_"))


def clean_feature_name(name: str) -> str:
    """Name of an extracted window feature without quotes, brackets and doubled underscores."""
    kept = re.sub(r"[^a-zA-Z0-9_,]", "", name)
    return kept.replace("__", "_").replace(",", "_")


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_name(c) for c in df.columns])


def normalised_text(column: Column | str) -> Column:
    """The same rule applied to the values of a text column."""
    text = F.replace(F.trim(F.lower(F.col(column) if isinstance(column, str) else column)), F.lit(" "), F.lit("_"))
    return F.regexp_replace(text, "[^a-zA-Z0-9_]", "")
