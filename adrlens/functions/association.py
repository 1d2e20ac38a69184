"""Two-group comparison measures and chart classes, as column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed values.
MIN_COUNT_FOR_TEST = 5
SIGNIFICANCE_LEVEL = 0.05
FOLD_CHANGE = 2.0

POSITIVE_INFINITY = float("inf")


def proportion(count: Column, total: Column) -> Column:
    return F.try_divide(count.cast("double"), total.cast("double"))


def risk_ratio(p1: Column, p2: Column) -> Column:
    return F.when(p2 > 0, F.try_divide(p1, p2))


def yates_chi2(count1: Column, total1: Column, count2: Column, total2: Column) -> Column:
    """Chi-squared of the 2x2 table with continuity correction.

    The correction is at most the distance to the expected count.  Null when a count is
    below five or a margin of the table is empty.
    """
    k1, n1, k2, n2 = (x.cast("double") for x in (count1, total1, count2, total2))
    n, hits = n1 + n2, k1 + k2
    distance = F.abs(k1 - F.try_divide(n1 * hits, n))
    corrected = distance - F.least(F.lit(0.5), distance)
    chi2 = F.try_divide(corrected * corrected * n * n * n, n1 * n2 * hits * (n - hits))
    return F.when((count1 >= MIN_COUNT_FOR_TEST) & (count2 >= MIN_COUNT_FOR_TEST), chi2)


# Rational approximations of the error function (Cody 1969) on three ranges of
# its argument, numerators and denominators from the highest power on.
SMALL, LARGE = 0.46875, 4.0
ERF_SMALL = ((0.185777706184603153, 3.16112374387056560, 113.864154151050156, 377.485237685302021,
              3209.37758913846947),
             (1.0, 23.6012909523441209, 244.024637934444173, 1282.61652607737228, 2844.23683343917062))
ERFC_MIDDLE = ((2.15311535474403846e-8, 0.564188496988670089, 8.88314979438837594, 66.1191906371416295,
                298.635138197400131, 881.952221241769090, 1712.04761263407058, 2051.07837782607147,
                1230.33935479799725),
               (1.0, 15.7449261107098347, 117.693950891312499, 537.181101862009858, 1621.38957456669019,
                3290.79923573345963, 4362.61909014324716, 3439.36767414372164, 1230.33935480374942))
ERFC_LARGE = ((0.0163153871373020978, 0.305326634961232344, 0.360344899949804439, 0.125781726111229246,
               0.0160837851487422766, 0.000658749161529837803),
              (1.0, 2.56852019228982242, 1.87295284992346725, 0.527905102951428412, 0.0605183413124413191,
               0.00233520497626869185))


def _polynomial(x: Column, factors: Sequence[float]) -> Column:
    return reduce(lambda value, factor: value * x + F.lit(factor), factors[1:], F.lit(factors[0]))


def _quotient(x: Column, parts: tuple[Sequence[float], Sequence[float]]) -> Column:
    return _polynomial(x, parts[0]) / _polynomial(x, parts[1])


def chi2_p_value(chi2: Column) -> Column:
    """Upper tail of the chi-squared distribution with one degree of freedom: erfc(sqrt(chi2 / 2))."""
    square = chi2 / 2
    x = F.sqrt(square)
    inverse = 1 / square
    large = (1 / math.sqrt(math.pi) - inverse * _quotient(inverse, ERFC_LARGE)) / x
    return (F.when(x <= SMALL, 1 - x * _quotient(square, ERF_SMALL))
            .when(x <= LARGE, F.exp(-square) * _quotient(x, ERFC_MIDDLE))
            .when(chi2.isNotNull(), F.exp(-square) * large))


def log2_or_infinity(ratio: Column) -> Column:
    """log2, with -infinity at zero (the SQL function gives null there)."""
    return F.when(ratio == 0, F.lit(-POSITIVE_INFINITY)).otherwise(F.log2(ratio))


def negative_log10(p: Column) -> Column:
    return F.when(p == 0, F.lit(POSITIVE_INFINITY)).otherwise(-F.log10(p))


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != POSITIVE_INFINITY)


def volcano_class(log2_rr: Column, p_value: Column) -> Column:
    bound = math.log2(FOLD_CHANGE)
    return (F.when(p_value >= SIGNIFICANCE_LEVEL, "not_significant")
            .when(log2_rr > bound, "enriched_mono")
            .when(log2_rr < -bound, "enriched_coinfection")
            .otherwise("significant_small"))
