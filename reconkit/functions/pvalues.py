"""Tail probabilities for test statistics; called once per test, never per row."""

from __future__ import annotations

import math


def normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated forwards."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1 - (a + b) * x / (a + 1), tiny)
    h = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / (1 + num * d or tiny)
            c = 1 + num / c or tiny
            h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return h


def beta_cdf(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    front = math.exp(log_front)
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def t_two_sided(t: float, df: float) -> float:
    return beta_cdf(df / (df + t * t), df / 2, 0.5)


def t_quantile(p: float, df: float) -> float:
    """Upper quantile (p > 0.5) by bisection."""
    low, high = 0.0, 1e6
    for _ in range(200):
        mid = (low + high) / 2
        if 1 - t_two_sided(mid, df) / 2 < p:
            low = mid
        else:
            high = mid
    return (low + high) / 2


def f_sf(f: float, df1: float, df2: float) -> float:
    return beta_cdf(df2 / (df2 + df1 * f), df2 / 2, df1 / 2)


def kolmogorov_sf(x: float) -> float:
    """Asymptotic two-sided Kolmogorov tail."""
    if x < 0.2:
        return 1.0
    total = sum((-1) ** (k - 1) * math.exp(-2 * (k * x) ** 2) for k in range(1, 101))
    return min(1.0, max(0.0, 2 * total))


# Sizes up to which the exact laws are used.
EXACT_KS_CELLS = 10_000  # n1 * n2
EXACT_MW_SIDE, EXACT_MW_CELLS = 8, 10_000  # the smaller side, n1 * n2


def ks_exact_sf(n1: int, n2: int, d: float) -> float:
    """P(D >= d) of the two-sided two-sample statistic, by walks over the (n1, n2) grid.

    All orders of the pooled values are equally likely, so one is a walk that steps to
    either side with the share that is left there.  What leaves the band |i/n1 - j/n2| < d
    is added up, so small probabilities stay accurate.
    """
    limit = round(d * n1 * n2)  # distances are multiples of 1 / (n1 n2)
    if limit <= 0:
        return 1.0
    inside, out = {0: 1.0}, 0.0  # steps to the first side so far -> probability
    for s in range(n1 + n2):
        after: dict[int, float] = {}
        for i, p in inside.items():
            left = n1 + n2 - s
            for to, share in ((i + 1, (n1 - i) / left), (i, (n2 - s + i) / left)):
                if not share:
                    continue
                if abs(to * n2 - (s + 1 - to) * n1) >= limit:
                    out += p * share
                else:
                    after[to] = after.get(to, 0.0) + p * share
        inside = after
    return min(1.0, out)


def rank_set_counts(m: int, n: int) -> list[int]:
    """For each U from 0 to m n, how many of the choices of m among m + n ranks give it.

    These are the partitions of U into at most m parts of at most n, whose counts are the
    coefficients of a product of (1 - x^(n + i)) / (1 - x^i).
    """
    counts = [1] + [0] * (m * n)
    for i in range(1, m + 1):
        for u in range(m * n, n + i - 1, -1):
            counts[u] -= counts[u - n - i]
        for u in range(i, m * n + 1):
            counts[u] += counts[u - i]
    return counts


def mw_exact_two_sided(n1: int, n2: int, u: float) -> float:
    """Two-sided p-value of U without ties."""
    counts = rank_set_counts(min(n1, n2), max(n1, n2))
    larger = round(max(u, n1 * n2 - u))
    return min(1.0, 2 * sum(counts[larger:]) / sum(counts))
