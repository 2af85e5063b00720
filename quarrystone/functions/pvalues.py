"""Tail probabilities of Student's t and the chi-square distribution.

Spark has no such functions, so they are pandas UDFs: small numpy kernels over
the continued fractions of the incomplete beta and gamma functions.  They run on
result rows (one per test), never on the data.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Ship the kernels with the UDF, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TINY = 1e-300
_STEPS = 3000
# Beyond these parameters asymptotic forms are exact to about ten digits, and series grow long.
_LARGE_GAMMA, _LARGE_DOF = 5e4, 1e6


def _log_gamma(a: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(v) for v in a])


def _lentz(first: np.ndarray, start: float, term) -> np.ndarray:
    """Modified Lentz evaluation of a continued fraction, element by element."""
    d = 1.0 / np.where(np.abs(first) < _TINY, _TINY, first)
    c = np.full_like(d, start)
    total = d.copy()
    for step in range(1, _STEPS):
        change = np.ones_like(d)
        for numerator, denominator in term(step):
            d = denominator + numerator * d
            d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
            c = denominator + numerator / c
            c = np.where(np.abs(c) < _TINY, _TINY, c)
            change = c * d
            total = total * change
        if np.all(np.abs(change - 1.0) < 1e-15):
            return total
    raise ArithmeticError("A continued fraction did not converge")


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function I_x(a, b)."""
    mirrored = x > (a + 1) / (a + b + 2)
    p, q = np.where(mirrored, b, a), np.where(mirrored, a, b)
    z = np.where(mirrored, 1 - x, x)

    def term(m):
        even = m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))
        return ((even, 1.0), (odd, 1.0))

    fraction = _lentz(1 - (p + q) * z / (p + 1), 1.0, term)
    with np.errstate(divide="ignore"):
        log_front = (
            _log_gamma(p + q) - _log_gamma(p) - _log_gamma(q)
            + p * np.log(z) + q * np.log1p(-z)
        )
    result = np.exp(log_front) * fraction / p
    return np.where(mirrored, 1 - result, result)


def _erfc(x: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(v) for v in x])


def _large_gamma(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Q(a, x) for large a: the uniform expansion around the normal tail, with its first correction."""
    delta = (x - a) / a
    eta = np.sign(delta) * np.sqrt(np.maximum(2 * (delta - np.log1p(delta)), 0))
    near = np.abs(delta) < 1e-4
    with np.errstate(divide="ignore", invalid="ignore"):
        correction = np.where(near, -1 / 3 + eta / 12, 1 / delta - 1 / eta)
    return 0.5 * _erfc(eta * np.sqrt(a / 2)) + np.exp(-a * eta * eta / 2) / np.sqrt(2 * np.pi * a) * correction


def upper_gamma(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised upper incomplete gamma function Q(a, x)."""
    result, large = np.empty_like(a), a > _LARGE_GAMMA
    result[large] = np.clip(_large_gamma(a[large], np.maximum(x[large], 1e-300)), 0, 1)
    if not large.all():
        result[~large] = _small_gamma(a[~large], x[~large])
    return result


def _small_gamma(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        log_front = a * np.log(x) - x - _log_gamma(a)
    by_series = x < a + 1
    term = 1.0 / a
    series = term.copy()
    for step in range(1, _STEPS):
        term = term * np.where(by_series, x, 0.0) / (a + step)
        series = series + term
        if np.all(term <= series * 1e-16):
            break
    else:
        raise ArithmeticError("A series did not converge")
    start = np.where(by_series, a + 2, x) + 1 - a
    fraction = _lentz(start, 1.0 / _TINY, lambda i: ((-i * (i - a), start + 2 * i),))
    front = np.exp(log_front)
    return np.where(by_series, 1 - front * series, front * fraction)


def _over_valid(kernel, *inputs: pd.Series) -> pd.Series:
    """Apply a kernel where every input is a number; missing elsewhere."""
    frame = pd.concat(inputs, axis=1).astype(float)
    valid = frame.notna().all(axis=1)
    result = pd.Series(np.nan, index=frame.index)
    if valid.any():
        result[valid] = kernel(*[frame.loc[valid].iloc[:, i].to_numpy() for i in range(frame.shape[1])])
    return result.astype(object).where(result.notna(), None)


def _t_two_sided(t: np.ndarray, dof: np.ndarray) -> np.ndarray:
    # For many degrees of freedom the normal tail of a corrected statistic.
    large = dof > _LARGE_DOF
    corrected = np.abs(t) * (1 - 1 / (4 * dof)) / np.sqrt(1 + t * t / (2 * dof))
    result = _erfc(corrected / math.sqrt(2))
    if not large.all():
        few, d = t[~large], dof[~large]
        result[~large] = incomplete_beta(d / 2, np.full_like(d, 0.5), d / (d + few * few))
    return result


def _chi_square_tail(chi2: np.ndarray, dof: np.ndarray) -> np.ndarray:
    safe = np.maximum(dof, 1.0)
    tail = upper_gamma(safe / 2, np.maximum(chi2, 0.0) / 2)
    return np.where((dof <= 0) | (chi2 <= 0), 1.0, tail)


@F.pandas_udf(DoubleType())
def t_two_sided(t: pd.Series, dof: pd.Series) -> pd.Series:
    """Two-sided p-value of a t statistic."""
    return _over_valid(_t_two_sided, t, dof)


@F.pandas_udf(DoubleType())
def chi_square_tail(chi2: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper-tail p-value of a chi-square statistic."""
    return _over_valid(_chi_square_tail, chi2, dof)
