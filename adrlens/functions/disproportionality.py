"""Disproportionality measures of a 2x2 table, as column expressions.

a: cases with drug and event, b: drug only, c: event only, d: neither.  Each function
returns (estimate, lower 95% bound, upper 95% bound); all are null where a cell that
the formula divides by is not positive.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

Z95 = 1.96  # fixed value


def _log_interval(estimate: Column, variance: Column) -> tuple[Column, Column, Column]:
    log, margin = F.log(estimate), F.lit(Z95) * F.sqrt(variance)
    return estimate, F.exp(log - margin), F.exp(log + margin)


def _inverse(x: Column) -> Column:
    return F.try_divide(F.lit(1.0), x)


def _doubles(*cells: Column) -> list[Column]:
    return [x.cast("double") for x in cells]


def reporting_odds_ratio(a: Column, b: Column, c: Column, d: Column):
    ok = F.least(a, b, c, d) > 0
    a, b, c, d = _doubles(a, b, c, d)
    return _log_interval(F.when(ok, F.try_divide(a * d, b * c)),
                         _inverse(a) + _inverse(b) + _inverse(c) + _inverse(d))


def proportional_reporting_ratio(a: Column, b: Column, c: Column, d: Column):
    ok = (F.least(a, c) > 0) & (F.least(b, d) >= 0)
    a, b, c, d = _doubles(a, b, c, d)
    ratio = F.when(ok, F.try_divide(F.try_divide(a, a + b), F.try_divide(c, c + d)))
    return _log_interval(ratio, _inverse(a) - _inverse(a + b) + _inverse(c) - _inverse(c + d))


def information_component(a: Column, b: Column, c: Column, d: Column):
    ok = a > 0
    a, b, c, d = _doubles(a, b, c, d)
    expected = F.try_divide((a + b) * (a + c), a + b + c + d)
    ic = F.log2(F.when(ok, F.try_divide(a, expected)))
    margin = F.lit(Z95) * F.sqrt(_inverse(a))
    return ic, ic - margin, ic + margin
