"""Column rules that turn a value into a label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DEFAULTS, SEVERE_HEART_RATE, Params


def band(col: Column, edges: Sequence, labels: Sequence[str], null_as_last: bool = False) -> Column:
    """Label of the half-open band ``[edges[i-1], edges[i])`` that holds ``col``.

    A null value has a null label; ``null_as_last`` gives it the last one.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("band needs one label more than edges")
    out = F.when(col < edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:-1]):
        out = out.when(col < edge, label)
    if null_as_last:
        return out.otherwise(labels[-1])
    return out.when(col.isNotNull(), labels[-1])


def age_band(col: Column, params: Params = DEFAULTS) -> Column:
    return band(col, params.age_edges, params.age_labels, params.null_age_as_last)


def risk_band(col: Column, params: Params = DEFAULTS) -> Column:
    score = F.coalesce(col, F.lit(0)) if params.null_risk_as_low else col
    return band(score, params.risk_edges, params.risk_labels)


def gender_label(col: Column) -> Column:
    """``Male`` for M; every other value, null included, is ``Female``."""
    return F.when(col == "M", "Male").otherwise("Female")


def heart_rate_severity(col: Column) -> Column:
    """``High`` above 120 beats; a missing heart rate counts as 0, so ``Medium``."""
    return F.when(F.coalesce(col, F.lit(0)) > SEVERE_HEART_RATE, "High").otherwise("Medium")
