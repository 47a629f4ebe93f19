"""Carry-over weights and saturation curves as column expressions."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def geometric_weights(decay_rate: float = 0.7, max_lag: int = 10) -> list[float]:
    """1, d, d^2, ... over ``max_lag`` rows; the current row always counts."""
    return [decay_rate**lag for lag in range(max(1, max_lag))]


def weibull_weights(shape: float = 2.0, scale: float = 7.0, max_lag: int = 30) -> list[float]:
    """Weibull density at lags 0..max_lag-1, scaled to sum to 1.

    A shape below 1 has no finite density at lag 0, so it is refused, and so are lags that
    end before the density starts (a shape above 1 with lag 0 alone).
    """
    if shape < 1:
        raise ValueError("weibull carry-over needs shape >= 1")
    ratios = [lag / scale for lag in range(max_lag)]
    density = [(shape / scale) * r ** (shape - 1) * math.exp(-(r**shape)) for r in ratios]
    total = sum(density)
    if total <= 0:
        raise ValueError("weibull carry-over needs more lags for this shape")
    return [d / total for d in density]


def adstock_weights(kind: str = "geometric", **params: float) -> list[float]:
    if kind == "weibull":
        return weibull_weights(**params)
    return geometric_weights(**params)


def channel_weights(params: Mapping) -> list[float]:
    """The weights of one channel, from its parameter mapping."""
    if params.get("adstock_type") == "weibull":
        return weibull_weights(
            params.get("shape", 2.0), params.get("scale", 7.0), params.get("max_lag", 30)
        )
    return geometric_weights(params.get("decay_rate", 0.7), params.get("max_lag", 10))


def carry_over(col: Column, weights: Sequence[float], window: WindowSpec) -> Column:
    """sum over l of weights[l] * (value l rows earlier); rows before the start count 0.

    Every lag shares the same window, so any number of channels costs one
    exchange, one sort and one Window node.
    """
    value = F.coalesce(col.cast("double"), F.lit(0.0))
    total = value * float(weights[0])
    for lag, weight in enumerate(weights):
        if lag and weight:
            total = total + F.lag(value, lag, 0.0).over(window) * float(weight)
    return total


def saturate(col: Column, kind: str = "hill", k: float | Column = 0.5, S: float | Column = 10000) -> Column:
    """Diminishing returns: hill, exp or logistic; any other kind leaves ``col`` as is.

    ``k`` and ``S`` of hill and exp must be positive. Spend below 0 counts as 0 there.
    """
    if kind in ("hill", "exp") and any(not isinstance(v, Column) and v <= 0 for v in (k, S)):
        raise ValueError(f"{kind} needs k and S above 0")
    k = k if isinstance(k, Column) else F.lit(float(k))
    S = S if isinstance(S, Column) else F.lit(float(S))
    if kind in ("hill", "exp"):
        col = F.greatest(col.cast("double"), F.lit(0.0))
    if kind == "hill":
        powered = F.pow(col, k)
        return powered / (powered + F.pow(S, k))
    if kind == "exp":
        return F.lit(1.0) - F.exp(-k * col / S)
    if kind == "logistic":
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-k * (col - S)))
    return col


def saturate_channel(col: Column, params: Mapping) -> Column:
    return saturate(
        col, params.get("saturation_type", "hill"), params.get("k", 0.5), params.get("S", 10000)
    )
