"""Distance weights.  Only ratios of sums are used, so none is normalised."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

METHODS = ("gaussian", "inverse_distance", "linear", "equal")


def distance_weight(dist: Column, method: str, sigma_km: float, radius_km: float) -> Column:
    if method == "gaussian":
        return F.exp(-(dist * dist) / F.lit(2.0 * sigma_km * sigma_km))
    if method == "inverse_distance":
        near = F.greatest(dist, F.lit(1e-6))
        return F.lit(1.0) / (near * near)
    if method == "linear":
        return F.greatest(F.lit(0.0), F.lit(1.0) - dist / F.lit(float(radius_km)))
    if method == "equal":
        return F.lit(1.0)
    raise ValueError(f"unknown distance weighting {method!r}; use one of {', '.join(METHODS)}")


def array_weight(method: str, sigma_km: float, radius_km: float) -> Callable:
    """``distance_weight`` for arrays inside a task; it travels there whole."""
    if method not in METHODS:
        raise ValueError(f"unknown distance weighting {method!r}; use one of {', '.join(METHODS)}")

    def weight(dist):
        import numpy as np

        if method == "gaussian":
            return np.exp(-(dist * dist) / (2.0 * sigma_km * sigma_km))
        if method == "inverse_distance":
            near = np.maximum(dist, 1e-6)
            return 1.0 / (near * near)
        if method == "linear":
            return np.maximum(0.0, 1.0 - dist / radius_km)
        return np.ones(len(dist))

    return weight
