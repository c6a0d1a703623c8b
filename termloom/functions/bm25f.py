"""The ranking formula, as column arithmetic.

For a term ``t`` and a document ``d``, over the fields ``f`` of ``d`` in which
``t`` occurs (only those)::

    x_f        = weight_f * tf_f
    L          = sum_f weight_f * len_f
    s_f        = x_f * (k1_f + 1)
                 / (k1_f * ((1 - b_f) + b_f * L / (weight_f * mean_len_f) + x_f))
    score(t,d) = N / df(t) * sum_f s_f

Two things differ from the textbook on purpose: ``k1`` multiplies the whole
divisor, and the inverse document frequency is the plain ratio, no logarithm.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

LENGTH_NORMS = ("mean", "off")


@dataclass(frozen=True)
class FieldParams:
    """Tuning of one field. All three values are required."""

    weight: float
    k1: float
    b: float

    def __post_init__(self) -> None:
        for name in ("weight", "k1"):
            value = getattr(self, name)
            if not (math.isfinite(value) and value > 0):
                raise ValueError(f"{name} must be a positive number, got {value!r}")
        if not 0.0 <= self.b <= 1.0:
            raise ValueError(f"b must lie between 0 and 1, got {self.b!r}")


def field_params(
    weights: Mapping[str, float], k1: Mapping[str, float], b: Mapping[str, float]
) -> dict[str, FieldParams]:
    """Combine three per-field maps, which must cover the same fields."""
    names = set(weights) | set(k1) | set(b)
    for label, given in (("weights", weights), ("k1", k1), ("b", b)):
        missing = sorted(names - set(given))
        if missing:
            raise ValueError(f"{label} has no value for the fields {missing}")
    return {
        name: FieldParams(float(weights[name]), float(k1[name]), float(b[name]))
        for name in sorted(names)
    }


def check_length_norm(length_norm: str) -> None:
    if length_norm not in LENGTH_NORMS:
        raise ValueError(f"length_norm must be one of {LENGTH_NORMS}, got {length_norm!r}")


def saturation(
    tf: Column,
    weighted_len: Column,
    mean_len: Column,
    params: FieldParams,
    length_norm: str = "mean",
) -> Column:
    """``s_f`` of one field. ``length_norm="off"`` takes ``L / mean`` as 0."""
    x = F.lit(params.weight) * tf
    relative_len = F.lit(0.0)
    if length_norm == "mean":
        relative_len = weighted_len / (F.lit(params.weight) * mean_len)
    divisor = F.lit(params.k1) * (
        F.lit(1.0 - params.b) + F.lit(params.b) * relative_len + x
    )
    return x * F.lit(params.k1 + 1.0) / divisor


def inverse_document_frequency(n_docs: Column, df: Column) -> Column:
    return n_docs.cast("double") / df.cast("double")
