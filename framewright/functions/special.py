"""Tail probabilities of test statistics, one number at a time. They are applied to result rows, of which there are as many as columns tested."""

from __future__ import annotations

from math import exp, inf, isnan, lgamma, log, log1p, nan

from pyspark.sql import Column, functions as F

TINY, STEPS = 1e-300, 10_000


def _fraction(terms) -> float:
    """b0 + a1 / (b1 + a2 / (b2 + ...)) of pairs (a, b), by Lentz's method; the first pair is (any, b0)."""
    _, b = next(terms)
    value = c = b or TINY
    d = 0.0
    for _, (a, b) in zip(range(STEPS), terms):
        d = 1.0 / ((b + a * d) or TINY)
        c = (b + a / c) or TINY
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def gamma_tail(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0:
        return 1.0
    front = exp(a * log(x) - x - lgamma(a))
    if x < a + 1:  # 1 - P(a, x), by its series
        term = total = 1.0 / a
        n = a
        for _ in range(STEPS):
            n += 1
            term *= x / n
            total += term
            if term < total * 1e-16:
                break
        return max(0.0, 1.0 - front * total)

    def terms():
        yield 0.0, x + 1 - a
        i = 1
        while True:
            yield -i * (i - a), x + 2 * i + 1 - a
            i += 1

    return front / _fraction(terms())


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_share(b, a, 1 - x)

    def terms():
        yield 0.0, 1.0
        m = 0
        while True:
            yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
            m += 1
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log1p(-x)) / a
    return front / _fraction(terms())


def chi2_tail(x: float | None, dof: float | None) -> float | None:
    """Probability of a chi² of ``x`` or more; NaN without degrees of freedom."""
    if x is None or dof is None:
        return None
    return nan if isnan(x) or dof <= 0 else gamma_tail(dof / 2, x / 2)


def f_tail(x: float | None, above: float | None, below: float | None) -> float | None:
    """Probability of an F of ``x`` or more with (above, below) degrees of freedom; NaN without them."""
    if x is None or above is None or below is None:
        return None
    if isnan(x) or above <= 0 or below <= 0:
        return nan
    return 0.0 if x == inf else beta_share(below / 2, above / 2, below / (below + above * x))


def chi2_p(x: Column, dof: Column) -> Column:
    return F.udf(chi2_tail, "double")(x.cast("double"), dof.cast("double"))


def f_p(x: Column, above: Column, below: Column) -> Column:
    return F.udf(f_tail, "double")(x.cast("double"), above.cast("double"), below.cast("double"))
