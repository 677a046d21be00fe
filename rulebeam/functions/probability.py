"""Exact probabilities as column expressions, right for counts of any size.

Differences of log-gamma lose all digits at large counts, so log probabilities are put together
from the error of Stirling's formula and deviances (saddle-point form); no large terms cancel.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_LOG_2PI = 0.5 * math.log(2 * math.pi)


def stirling_error(n: Column) -> Column:
    """log(n!) less Stirling's formula for it, n >= 1."""
    small = (F.log(F.factorial(F.least(n, F.lit(20.0)).cast("int")).cast("double"))
             - (n + 0.5) * F.log(n) + n - HALF_LOG_2PI)
    nn = n * n
    large = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / nn) / nn) / nn) / n
    return F.when(n <= 20, small).otherwise(large)


def deviance(x: Column, mean: Column) -> Column:
    """x log(x / mean) + mean - x, x > 0; by its series where x is near the mean."""
    v = (x - mean) / (x + mean)
    vv = v * v
    series = F.lit(1 / 19)
    for j in range(8, 0, -1):
        series = series * vv + F.lit(1 / (2 * j + 1))
    return (F.when(F.abs(x - mean) < 0.1 * (x + mean), (x - mean) * v + 2 * x * v * vv * series)
            .otherwise(x * F.log(x / mean) + mean - x))


def _sum(values: Column, term) -> Column:
    """Sum of ``term`` over an array; the expression is built once, however often it is used."""
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + term(v))


def _signed(sign: float, **values: Column) -> Column:
    return F.struct(F.lit(sign).alias("sign"), *[v.alias(k) for k, v in values.items()])


def log_binomial(x: Column, n: Column, p: Column, q: Column) -> Column:
    """Log probability of x successes in n trials; q = 1 - p is given, so that neither is rounded."""
    errors = F.array(_signed(1.0, n=n), _signed(-1.0, n=x), _signed(-1.0, n=n - x))
    away = F.array(_signed(-1.0, x=x, mean=n * p), _signed(-1.0, x=n - x, mean=n * q))
    inner = (_sum(errors, lambda v: v["sign"] * stirling_error(v["n"]))
             + _sum(away, lambda v: v["sign"] * deviance(v["x"], v["mean"]))
             - HALF_LOG_2PI - 0.5 * (F.log(x) + F.log1p(-x / n)))
    return (F.when(n == 0, F.lit(0.0)).when(x == 0, n * F.log1p(-p)).when(x == n, n * F.log(p)).otherwise(inner))


def log_hypergeometric(k: Column, n: Column, p_total: Column, n_total: Column) -> Column:
    """Log probability that n rows drawn of n_total hold k of the p_total positive ones (all doubles)."""
    p, q = n / n_total, (n_total - n) / n_total
    parts = F.array(_signed(1.0, x=k, n=p_total, p=p, q=q), _signed(1.0, x=n - k, n=n_total - p_total, p=p, q=q),
                    _signed(-1.0, x=n, n=n_total, p=p, q=q))
    return _sum(parts, lambda v: v["sign"] * log_binomial(v["x"], v["n"], v["p"], v["q"]))
