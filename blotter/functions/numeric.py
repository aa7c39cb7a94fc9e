"""Numeric column expressions."""

from __future__ import annotations

import inspect
import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Terms of the series below; with |z| <= 8 the last term is far under 1e-17 of the sum.
_SERIES_TERMS = 150
_CLAMP = 8.0


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normal_cdf(x: Column | str, mean: float = 0.0, sd: float = 1.0) -> Column:
    """Normal distribution function with built-in expressions only.

    Phi(z) = 1/2 + phi(z) * sum_k z^(2k+1) / (2k+1)!!, summed with a
    higher-order ``aggregate`` (term_k = term_(k-1) * z^2 / (2k+1)); beyond
    |z| > 8 the value is 0 or 1 to double precision.  Meant for histograms
    (one evaluation per distinct value), not for every record.
    """
    if sd <= 0:
        raise ValueError("sd must be positive")
    z = (_c(x) - F.lit(float(mean))) / F.lit(float(sd))
    az, z2 = F.abs(z), z * z
    start = F.struct(az.alias("t"), az.alias("s"))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_SERIES_TERMS - 1)),
        start,
        lambda acc, k: F.struct(
            (acc["t"] * z2 / (F.lit(2.0) * k + F.lit(1.0))).alias("t"),
            (acc["s"] + acc["t"] * z2 / (F.lit(2.0) * k + F.lit(1.0))).alias("s"),
        ),
        lambda acc: acc["s"],
    )
    density = F.exp(-z2 / F.lit(2.0)) / F.lit(math.sqrt(2.0 * math.pi))
    return (
        F.when(z > _CLAMP, F.lit(1.0))
        .when(z < -_CLAMP, F.lit(0.0))
        .otherwise(F.lit(0.5) + F.signum(z) * density * series)
    )


# Terms of the band below: the next factor is 1/25!.
_BAND = 24


def kolmogorov_cdf(d: Column | str, n: Column | str) -> Column:
    """P(D_n < d), the exact distribution of the two-sided one-sample
    Kolmogorov-Smirnov statistic of ``n`` values, with built-in expressions only.

    With k = floor(n d) + 1 and h = k - n d it is an entry of the n-th power of a
    matrix of 2k - 1 rows (1/(i-j+1)!, with powers of h in the first column
    and the last row) times n!/n^n.  One row of the power is carried from step to
    step as an array: each entry is a sum over the band where 1/t! matters, and
    each step is scaled by its part of s!/s^s, so that no value leaves the range of
    a double.  The work is n * 2 n d * 24 products per row: meant for small n, one evaluation per test."""
    d, n = _c(d).cast("double"), _c(n).cast("long")
    k = (F.floor(n * d) + F.lit(1)).cast("int")
    m, h = F.lit(2) * k - F.lit(1), k - n * d
    inverse = F.array(*[F.lit(1.0 / math.factorial(t)) for t in range(_BAND + 1)])

    def power(t: Column) -> Column:
        return F.pow(h, t) * F.get(inverse, t)

    def step(v: Column, s: Column) -> Column:
        last = F.get(v, m - F.lit(1))
        # what the powers of h take from the first column, and give back in the corner
        first = F.aggregate(F.sequence(F.lit(1), F.least(F.lit(_BAND), m)), F.lit(0.0), lambda acc, t: acc + F.get(v, t - F.lit(1)) * power(t))
        corner = F.when(m <= _BAND, last * F.pow(F.greatest(F.lit(2.0) * h - F.lit(1.0), F.lit(0.0)), m) * F.get(inverse, m)).otherwise(F.lit(0.0))

        def entry(j: Column) -> Column:
            terms = F.sequence(F.greatest(F.lit(0), F.lit(2) - j), F.least(F.lit(_BAND), m - j + F.lit(1)))
            total = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + F.get(v, j - F.lit(2) + t) * F.get(inverse, t))
            from_last = F.when(m - j < _BAND, last * power(m - j + F.lit(1))).otherwise(F.lit(0.0))
            return total - from_last - F.when(j == 1, first - corner).otherwise(F.lit(0.0))

        scale = F.pow((s - F.lit(1)) / s, s - F.lit(1))
        return F.transform(F.sequence(F.lit(1), m), lambda j: entry(j) * scale)

    start = F.transform(F.sequence(F.lit(1), m), lambda j: F.when(j == k, F.lit(1.0)).otherwise(F.lit(0.0)))
    power_row = F.aggregate(F.sequence(F.lit(1).cast("long"), n), start, step, lambda v: F.get(v, k - F.lit(1)))
    inside = F.least(F.lit(1.0), F.greatest(F.lit(0.0), power_row))
    return F.when(n * d <= 0.5, F.lit(0.0)).when(d >= 1.0, F.lit(1.0)).otherwise(inside)


# --------------------------------------------------------------------------
# Distribution functions of parametric families (NULL gives NULL)
# --------------------------------------------------------------------------

# Longest series that a parameter may ask for, and the size at which its terms no longer count.
_MAX_TERMS, _NEGLIGIBLE = 20_000, 1e-18
# exp(-_EXPONENT) is nothing beside 1 in double precision.
_EXPONENT = 42.0


def _terms(ratio) -> int:
    """How many terms 1, ratio(1), ratio(1) ratio(2), ... count in their sum."""
    term = total = 1.0
    for k in range(1, _MAX_TERMS):
        term *= ratio(k)
        total += term
        if ratio(k) < 1 and term < _NEGLIGIBLE * total * (1 - ratio(k)):
            return k
    raise ValueError("these parameters need a series of more than 20,000 terms")


def _series(terms: int, ratio) -> Column:
    """1 + ratio(1) + ratio(1) ratio(2) + ... as one higher-order expression."""
    one = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def step(acc: Column, k: Column) -> Column:
        t = acc["t"] * ratio(k.cast("double"))
        return F.struct(t.alias("t"), (acc["s"] + t).alias("s"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(terms)), one, step, lambda acc: acc["s"])


def _not_below_0(x: Column | str) -> Column:
    return F.when(_c(x) <= 0, F.lit(0.0)).otherwise(_c(x))


def _positive(**params: float) -> None:
    for name, value in params.items():
        if not (0 < value < math.inf):
            raise ValueError(f"{name} must be positive and finite")


def incomplete_gamma(a: float, x: Column | str) -> Column:
    """The regularised lower incomplete gamma function P(a, x) for x >= 0:
    x^a e^-x / Gamma(a + 1) * (1 + x/(a+1) + x^2/((a+1)(a+2)) + ...).  All terms are
    positive, so nothing cancels.  From the x on where 1 - P(a, x) is below 1e-17
    the value is 1, which bounds the number of terms by ``a`` alone."""
    _positive(a=a)
    top = a + _EXPONENT
    while top - a - a * math.log(top / a) + math.log(a) * 0.5 < _EXPONENT:
        top *= 1.05
    x = _c(x)
    inner = F.least(x, F.lit(top))
    total = _series(_terms(lambda k: top / (a + k)), lambda k: inner / (k + F.lit(a)))
    value = F.exp(F.lit(a) * F.log(inner) - inner - F.lit(math.lgamma(a + 1.0))) * total
    return F.when(x <= 0, F.lit(0.0)).when(x >= top, F.lit(1.0)).when(x.isNotNull(), F.least(F.lit(1.0), value))


def incomplete_beta(a: float, b: float, x: Column | str) -> Column:
    """The regularised incomplete beta function I_x(a, b) for 0 <= x <= 1:
    x^a (1-x)^b / (a B(a, b)) * (1 + (a+b)/(a+1) x + (a+b)(a+b+1)/((a+1)(a+2)) x^2 + ...)
    up to x = (a+1)/(a+b+2), and 1 - I_(1-x)(b, a) beyond, so the series
    is never near its end of convergence unless a and b lie far apart."""
    _positive(a=a, b=b)
    x = _c(x)
    turn = (a + 1.0) / (a + b + 2.0)

    def lower(p: float, q: float, y: Column, most: float) -> Column:
        y = F.least(F.greatest(y, F.lit(0.0)), F.lit(most))
        total = _series(_terms(lambda k: most * (p + q + k - 1) / (p + k)), lambda k: y * (k + F.lit(p + q - 1.0)) / (k + F.lit(p)))
        scale = math.lgamma(p + q) - math.lgamma(p + 1.0) - math.lgamma(q)
        return F.when(y > 0, F.exp(F.lit(p) * F.log(y) + F.lit(q) * F.log1p(-y) + F.lit(scale)) * total).otherwise(F.lit(0.0))

    value = F.when(x <= turn, lower(a, b, x, turn)).otherwise(F.lit(1.0) - lower(b, a, F.lit(1.0) - x, 1.0 - turn))
    return F.when(x <= 0, F.lit(0.0)).when(x >= 1, F.lit(1.0)).when(x.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), value)))


def uniform_cdf(x: Column | str, low: float = 0.0, high: float = 1.0) -> Column:
    if not low < high:
        raise ValueError("low must be below high")
    x = _c(x)
    return F.when(x <= low, F.lit(0.0)).when(x >= high, F.lit(1.0)).otherwise((x - F.lit(low)) / F.lit(high - low))


def exponential_cdf(x: Column | str, rate: float = 1.0) -> Column:
    _positive(rate=rate)
    return -F.expm1(-F.lit(rate) * _not_below_0(x))


def weibull_cdf(x: Column | str, shape: float = 1.0, scale: float = 1.0) -> Column:
    _positive(shape=shape, scale=scale)
    return -F.expm1(-F.pow(_not_below_0(x) / F.lit(scale), F.lit(shape)))


def lognormal_cdf(x: Column | str, mu: float = 0.0, sigma: float = 1.0) -> Column:
    x = _c(x)
    return F.when(x <= 0, F.lit(0.0)).otherwise(normal_cdf(F.log(x), mu, sigma))


def gamma_cdf(x: Column | str, shape: float = 1.0, scale: float = 1.0) -> Column:
    _positive(scale=scale)
    return incomplete_gamma(shape, _not_below_0(x) / F.lit(scale))


def beta_cdf(x: Column | str, a: float = 1.0, b: float = 1.0, low: float = 0.0, high: float = 1.0) -> Column:
    """The beta distribution on ``low`` .. ``high``."""
    return incomplete_beta(a, b, uniform_cdf(x, low, high))


def student_cdf(x: Column | str, df: float = 1.0, mean: float = 0.0, scale: float = 1.0) -> Column:
    """Student's t, moved and scaled: half the incomplete beta function of df / (df + z^2) lies in each tail."""
    _positive(df=df, scale=scale)
    z = (_c(x) - F.lit(mean)) / F.lit(scale)
    inside = incomplete_beta(0.5, df / 2.0, z * z / (z * z + F.lit(df)))
    return F.lit(0.5) + F.signum(z) * inside / F.lit(2.0)


# Names of the distributions and their functions; the parameters are the arguments after the value.
DISTRIBUTIONS = {
    "norm": normal_cdf,
    "uniform": uniform_cdf,
    "exponential": exponential_cdf,
    "lognormal": lognormal_cdf,
    "weibull": weibull_cdf,
    "gamma": gamma_cdf,
    "beta": beta_cdf,
    "student": student_cdf,
}


def distribution_cdf(x: Column | str, dist: str = "norm", params: Sequence[float] = ()) -> Column:
    """The distribution function ``dist`` at ``x``; parameters left out keep their defaults."""
    if dist not in DISTRIBUTIONS:
        raise ValueError(f"unknown distribution {dist!r}; use one of {', '.join(DISTRIBUTIONS)}")
    cdf = DISTRIBUTIONS[dist]
    if len(params) >= len(inspect.signature(cdf).parameters):
        raise ValueError(f"{dist} has no {len(params)} parameters")
    return cdf(x, *[float(p) for p in params])
