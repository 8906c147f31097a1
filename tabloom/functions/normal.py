"""Normal distribution function as a column expression.

Spark SQL has no error function. The rational approximations of W. J. Cody, "Rational
Chebyshev approximations for the error function", Math. Comp. 23 (1969), are accurate to
double precision and need only arithmetic and ``exp``, so nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Numerator and denominator coefficients, lowest power first.
ERF_SMALL = (
    (3.20937758913846947e03, 3.77485237685302021e02, 1.13864154151050156e02, 3.16112374387056560e00, 1.85777706184603153e-1),
    (2.84423683343917062e03, 1.28261652607737228e03, 2.44024637934444173e02, 2.36012909523441209e01, 1.0),
)
ERFC_MIDDLE = (
    (
        1.23033935479799725e03, 2.05107837782607147e03, 1.71204761263407058e03, 8.81952221241769090e02, 2.98635138197400131e02,
        6.61191906371416295e01, 8.88314979438837594e00, 5.64188496988670089e-1, 2.15311535474403846e-8,
    ),
    (
        1.23033935480374942e03, 3.43936767414372164e03, 4.36261909014324716e03, 3.29079923573345963e03, 1.62138957456669019e03,
        5.37181101862009858e02, 1.17693950891312499e02, 1.57449261107098347e01, 1.0,
    ),
)
ERFC_LARGE = (
    (6.58749161529837803e-4, 1.60837851487422766e-2, 1.25781726111229246e-1, 3.60344899949804439e-1, 3.05326634961232344e-1, 1.63153871373020978e-2),
    (2.33520497626869185e-3, 6.05183413124413191e-2, 5.27905102951428412e-1, 1.87295284992346725e00, 2.56852019228982242e00, 1.0),
)
ERF_SMALL_LIMIT = 0.46875
ERFC_MIDDLE_LIMIT = 4.0
TAIL_CAP = 40.0
INVERSE_SQRT_PI = 5.6418958354775628695e-1
INVERSE_SQRT_TWO = 7.0710678118654752440e-1


def _polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    result = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        result = result * x + F.lit(c)
    return result


def _ratio(x: Column, pair: tuple[Sequence[float], Sequence[float]]) -> Column:
    return _polynomial(x, pair[0]) / _polynomial(x, pair[1])


def normal_cdf(value: Column, mean: Column | float = 0.0, sd: Column | float = 1.0) -> Column:
    """P(X <= value) for a normal X; null where ``sd`` is zero or an argument is null.

    Written so that each approximation occurs once: the generated Java method stays below the
    size above which the JVM no longer compiles it. The absolute error is below 1e-15.
    """
    mean = mean if isinstance(mean, Column) else F.lit(float(mean))
    sd = sd if isinstance(sd, Column) else F.lit(float(sd))
    x = (value - mean) / F.nullif(sd, F.lit(0.0)) * F.lit(INVERSE_SQRT_TWO)
    # Nothing is left of the tail at the cap, and powers of it stay finite.
    size = F.when(x.isNotNull(), F.least(F.abs(x), F.lit(TAIL_CAP)))
    square = size * size
    # The third approximation is a ratio in 1/square; both sides are multiplied by square**5.
    large = (F.lit(INVERSE_SQRT_PI) - _ratio(square, tuple(c[::-1] for c in ERFC_LARGE)) / square) / size
    tail = F.exp(-square) * F.when(size <= ERFC_MIDDLE_LIMIT, _ratio(size, ERFC_MIDDLE)).otherwise(large)
    return F.when(size <= ERF_SMALL_LIMIT, F.lit(0.5) + F.lit(0.5) * x * _ratio(square, ERF_SMALL)).otherwise(
        F.lit(0.5) + F.signum(x) * (F.lit(0.5) - F.lit(0.5) * tail)
    )
