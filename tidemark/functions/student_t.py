"""Two-sided p-value of Student's t, by the continued fraction of the incomplete beta function.

Applied to one-row results only.
"""

from __future__ import annotations

import math


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz evaluation)."""
    floor = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > floor else floor)
    value = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > floor else floor)
            c = 1.0 + term / c
            c = c if abs(c) > floor else floor
            step = c * d
            value *= step
        if abs(step - 1.0) < 1e-15:
            return value
    raise ArithmeticError(f"the fraction did not converge for a={a}, b={b}, x={x}")


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0 or x >= 1.0:
        return min(max(x, 0.0), 1.0)
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    front = math.exp(log_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def _as_normal(t: float, degrees: float) -> float:
    """Normal deviate with the same tail as ``t``, an expansion for many degrees of freedom."""
    a = degrees - 0.5
    b = 48.0 * a * a
    y = math.sqrt(a * math.log1p(t * t / degrees))
    fifth = (4 * y**7 + 33 * y**5 + 240 * y**3 + 855 * y) / (10 * b * (b + 0.8 * y**4 + 100))
    return y + (y**3 + 3 * y) / b - fifth


def two_sided_p(t: float | None, degrees: float | None) -> float | None:
    """Chance of a value at least as far from 0 as ``t``. Beyond ten thousand degrees of freedom the expansion is exact
    to the last digits, while the fraction would cancel and converge slowly."""
    if t is None or degrees is None or math.isnan(t) or math.isnan(degrees):
        return None
    if degrees > 1e4 and t * t < degrees:
        return math.erfc(_as_normal(abs(t), degrees) / math.sqrt(2.0))
    return incomplete_beta(degrees / 2.0, 0.5, degrees / (degrees + t * t))
