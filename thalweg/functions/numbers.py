"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value):
    return F.col(value) if isinstance(value, str) else value


def numeric_or_null(text) -> Column:
    """A double, or NULL where the text is no number (NaN counts as no number)."""
    value = F.trim(_col(text)).try_cast("double")
    return F.when(~F.isnan(value), value)


def nan_to_null(value) -> Column:
    value = _col(value)
    return F.when(~F.isnan(value), value)


def sigmoid_weight(x, threshold, plateau=None, steepness: float = 2.0) -> Column:
    """Logistic step at ``threshold``; exactly 1 from ``plateau`` on."""
    x, threshold = _col(x), _col(threshold)
    curve = 1.0 / (1.0 + F.exp(-F.lit(steepness) * (x - threshold)))
    if plateau is None:
        return curve
    return F.when(x >= _col(plateau), F.lit(1.0)).otherwise(curve)


def level_weight(x, moderate, high) -> Column:
    """Error weight by water level: 1, rising by 4 around ``moderate``, by 5 more from ``high`` on."""
    x, high = _col(x), _col(high)
    return 1.0 + 4.0 * sigmoid_weight(x, moderate, high) + F.when(x >= high, F.lit(5.0)).otherwise(F.lit(0.0))


def pearson(a, b) -> Column:
    """Sample correlation over the rows where both are present; NULL where either is constant."""
    a, b = _col(a), _col(b)
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))
