"""Tail of Student's t distribution, for the Grubbs critical value."""

from __future__ import annotations

import math

# Above this many degrees of freedom a normal approximation is used; its relative error is below 1e-8 there.
NORMAL_FROM = 100_000.0


def upper_tail(t: float, df: float) -> float:
    """P(T > t) for t >= 0."""
    if math.isinf(t):
        return 0.0
    if df > NORMAL_FROM:
        # Wallace's transform to a standard normal deviate
        z = (8 * df + 1) / (8 * df + 3) * math.sqrt(df * math.log1p(t * t / df))
        return 0.5 * math.erfc(z / math.sqrt(2.0))
    return 0.5 * _beta_ratio(df / 2.0, 0.5, df / (df + t * t), t * t / (df + t * t))


def _beta_ratio(a: float, b: float, x: float, rest: float) -> float:
    """Regularised incomplete beta function at x, with rest = 1 - x given for accuracy."""
    if rest <= 0.0:
        return 1.0
    if x <= 0.0:
        return 0.0
    log_front = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                 + a * math.log(x) + b * math.log(rest))
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _fraction(b, a, rest) / b


def _fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, evaluated front to back."""
    tiny = 1e-300
    value, num, den = 1.0, 1.0, 0.0
    for step in range(1, 100_000):
        m = step // 2
        if step % 2:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        den = 1.0 / ((1.0 + term * den) or tiny)
        num = (1.0 + term / num) or tiny
        value *= num * den
        if abs(num * den - 1.0) < 1e-15:
            break
    return 1.0 / value
