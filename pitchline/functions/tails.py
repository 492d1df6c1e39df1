"""Distribution tails and special functions as native Column expressions.

Spark has no ``erf``, ``lgamma`` or distribution functions, and SciPy is not
used. Every tail here is one integral: in the logarithm (gamma), the logit
(beta) or the plain variable (normal) the density is log-concave, so from the
observed point away from the mode it falls faster and faster. The exponent of
that fall is written without differences of large numbers, the span in which
it matters is found by doubling, and a fixed Gauss-Legendre rule sums it, for
any degrees of freedom alike. The density at the point itself is a
saddle-point form (Stirling errors and deviances). All of it runs inside the
JVM on the one-row-per-test results. ``pitchline.plans.oracle_stats`` states
the same tails in SQL by other formulas.

Fixed values below are published numerical constants (Acklam's inverse-normal
rational fit, Stirling series).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Inverse normal CDF (Acklam): relative error < 1.15e-9.
ACKLAM_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
            1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
ACKLAM_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
            6.680131188771972e+01, -1.328068155288572e+01]
ACKLAM_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
ACKLAM_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
            3.754408661907416e+00]
ACKLAM_LOW = 0.02425

# Stirling series for ln Gamma(z): 1/12, -1/360, 1/1260, -1/1680, 1/1188, -691/360360, 1/156.
STIRLING = [1.0 / 12, -1.0 / 360, 1.0 / 1260, -1.0 / 1680, 1.0 / 1188, -691.0 / 360360, 1.0 / 156]
STIRLING_FROM = 10  # smaller arguments are shifted up by this

# Quadrature: panels of a Gauss-Legendre rule over the span in which the integrand falls to exp(-SPAN_DROP).
PANELS, PANEL_NODES, SPAN_DROP = 32, 16, 45.0
SPAN_START, SPAN_DOUBLINGS = 2.0 ** -28, 64
_X, _W = np.polynomial.legendre.leggauss(PANEL_NODES)
NODES = np.concatenate([(k + (_X + 1) / 2) / PANELS for k in range(PANELS)])
WEIGHTS = np.tile(_W / 2 / PANELS, PANELS)


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Keeps expression trees linear: without it every use of an argument
    would copy the argument's whole expression.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _horner(x: Column, coeffs: list[float]) -> Column:
    """coeffs[0] + coeffs[1]*x + ... (ascending powers)."""
    acc = F.lit(coeffs[-1])
    for c in reversed(coeffs[:-1]):
        acc = F.lit(c) + x * acc
    return acc


def _fall(exponent) -> Column:
    """Integral over u >= 0 of exp(exponent(u)), for a concave exponent that is 0 at 0 and never rises."""
    span = F.aggregate(F.sequence(F.lit(1), F.lit(SPAN_DOUBLINGS)), F.lit(SPAN_START),
                       lambda s, _: F.when(exponent(s) > -SPAN_DROP, s * 2).otherwise(s))
    return _let(span, lambda s: s * F.aggregate(
        F.zip_with(F.lit(NODES), F.lit(WEIGHTS), lambda t, w: w * F.exp(exponent(s * t))), F.lit(0.0), lambda a, v: a + v))


def _expm1_rest(z: Column) -> Column:
    """exp(z) - 1 - z."""
    series = z * z * _horner(z, [1.0 / math.factorial(k + 2) for k in range(15)])
    return F.when(F.abs(z) < 0.5, series).otherwise(F.expm1(z) - z)


def _log1p_rest(w: Column) -> Column:
    """w - ln(1 + w)."""
    r = w / (w + 2)
    series = w * r - r * r * r * _horner(r * r, [2.0 / (2 * j + 3) for j in range(10)])
    return F.when(F.abs(w) < 0.2, series).otherwise(w - F.log1p(w))


def erfc(x) -> Column:
    return F.lit(2.0) * norm_sf(_c(x).cast("double") * F.lit(math.sqrt(2.0)))


def norm_sf(z) -> Column:
    """Upper tail of the standard normal; the square of z is split, so that small tails keep their digits."""
    def body(z):
        m = F.abs(z)
        short = F.floor(m * 16) / 16  # its square is exact
        density = F.exp(-short * short / 2) * F.exp((short - m) * (short + m) / 2) / F.lit(math.sqrt(2 * math.pi))
        upper = F.when(m > 40, F.lit(0.0)).otherwise(density * _fall(lambda u: -u * (m + u / 2)))
        return F.when(F.isnan(z), z).when(z >= 0, upper).otherwise(F.lit(1.0) - upper)
    return _let(_c(z).cast("double"), body)


def norm_ppf(p) -> Column:
    """Inverse standard normal CDF (Acklam)."""
    return _let(_c(p).cast("double"), _norm_ppf)


def _norm_ppf(p: Column) -> Column:
    q_lo = F.sqrt(F.lit(-2.0) * F.log(p))
    lo = _horner(q_lo, ACKLAM_C[::-1]) / (F.lit(1.0) + q_lo * _horner(q_lo, ACKLAM_D[::-1]))
    q_hi = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - p))
    hi = -_horner(q_hi, ACKLAM_C[::-1]) / (F.lit(1.0) + q_hi * _horner(q_hi, ACKLAM_D[::-1]))
    q = p - F.lit(0.5)
    r = q * q
    mid = _horner(r, ACKLAM_A[::-1]) * q / (F.lit(1.0) + r * _horner(r, ACKLAM_B[::-1]))
    return (F.when(p < ACKLAM_LOW, lo).when(p > 1 - ACKLAM_LOW, hi).otherwise(mid))


def lgamma(x) -> Column:
    """ln Gamma(x) for x > 0."""
    return _let(_c(x).cast("double"), lambda x: (x - 0.5) * F.log(x) - x + F.lit(0.5 * math.log(2 * math.pi)) + _gamma_error(x))


def _gamma_error(a: Column) -> Column:
    """ln Gamma(a) minus Stirling's formula, a > 0."""
    def series(z):
        inv = F.lit(1.0) / z
        return inv * _horner(inv * inv, STIRLING)
    shifted = F.aggregate(F.sequence(F.lit(0), F.lit(STIRLING_FROM - 1)), series(a + F.lit(float(STIRLING_FROM))),
                          lambda s, k: s + (a + k + 0.5) * F.log1p(F.lit(1.0) / (a + k)) - 1)
    return F.when(a >= STIRLING_FROM, series(a)).otherwise(shifted)


def chi2_sf(x, df) -> Column:
    """Upper tail of chi-square, any df > 0: the regularised upper incomplete gamma at (df / 2, x / 2)."""
    args = F.struct((_c(x).cast("double") / 2).alias("x"), (_c(df).cast("double") / 2).alias("a"))
    return _let(args, lambda v: _gamma_sf(v["x"], v["a"]))


def _gamma_sf(x: Column, a: Column) -> Column:
    way = F.when(x >= a, F.lit(1.0)).otherwise(F.lit(-1.0))  # away from the mode of ln t

    def exponent(u):
        s = way * u
        return (a - x) * s - x * _expm1_rest(s)

    density = F.sqrt(a / F.lit(2 * math.pi)) * F.exp(-_gamma_error(a) - _deviance(a, x, a - x))
    tail = _let(density * _fall(exponent), lambda t: F.when(x >= a, t).otherwise(F.lit(1.0) - t))
    return (F.when(x.isNull() | a.isNull() | ~(a > 0), F.lit(None).cast("double")).when(F.isnan(x), x)
            .when(x <= 0, F.lit(1.0)).when(x == float("inf"), F.lit(0.0)).otherwise(tail))


def t_sf2(t, df) -> Column:
    """Two-sided tail P(|T| > |t|) for df > 0: I_x(df/2, 1/2) at x = df / (df + t^2).

    The upper tail itself, for every df: it stays positive for all finite t.
    """
    args = F.struct(_c(t).cast("double").alias("t"), _c(df).cast("double").alias("df"))

    def body(v):
        t, df = v["t"], v["df"]
        under = df + t * t
        return F.when(df > 0, inc_beta(df / under, df / 2, F.lit(0.5), t * t / under, df * (t * t - 1) / (under * 2)))
    return _let(args, body)


def f_sf(f, d1, d2) -> Column:
    """Upper tail of the F distribution: I_{d2/(d2+d1 f)}(d2/2, d1/2)."""
    args = F.struct(_c(f).cast("double").alias("f"), _c(d1).cast("double").alias("d1"),
                    _c(d2).cast("double").alias("d2"))

    def body(v):
        f, d1, d2 = v["f"], v["d1"], v["d2"]
        under = d2 + d1 * f
        return F.when(f <= 0, F.lit(1.0)).otherwise(
            inc_beta(d2 / under, d2 / 2, d1 / 2, d1 * f / under, d1 * (f - 1) / under * d2 / 2))
    return _let(args, body)


def inc_beta(x, a, b, rest=None, tilt=None) -> Column:
    """Regularised incomplete beta I_x(a, b) for a, b > 0.

    ``rest`` is 1 - x and ``tilt`` is a (1 - x) - b x where the caller knows
    them more exactly than their differences give.
    """
    x, a, b = (_c(c).cast("double") for c in (x, a, b))
    rest = F.lit(1.0) - x if rest is None else _c(rest).cast("double")
    tilt = a * rest - b * x if tilt is None else _c(tilt).cast("double")
    args = F.struct(x.alias("x"), rest.alias("y"), a.alias("a"), b.alias("b"), tilt.alias("tilt"))
    return _let(args, lambda v: _inc_beta(*(v[c] for c in ("x", "y", "a", "b", "tilt"))))


def _inc_beta(x: Column, y: Column, a: Column, b: Column, tilt: Column) -> Column:
    n = a + b
    by_y = y < x  # the exponent is written in the smaller of the two shares
    lower = tilt >= 0  # x lies below the mode of the logit: the left tail is the small one
    small = F.struct(F.when(by_y, y).otherwise(x).alias("p"), F.when(by_y, b).otherwise(a).alias("c"),
                     F.when(by_y, -tilt).otherwise(tilt).alias("d"),
                     F.when(by_y == lower, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("way"))

    def fall(v):
        p, c, d, way = v["p"], v["c"], v["d"], v["way"]

        def exponent(u):
            z = way * u
            w = p * F.expm1(z)
            return F.when(u < 0.3, d * z - n * p * _expm1_rest(z) + n * _log1p_rest(w)).otherwise(c * z - n * F.log1p(w))
        return _fall(exponent)

    density = F.sqrt(a / n * b / F.lit(2 * math.pi)) * F.exp(
        _gamma_error(n) - _gamma_error(a) - _gamma_error(b) - _deviance(a, n * x, tilt) - _deviance(b, n * y, -tilt))
    tail = _let(density * _let(small, fall), lambda t: F.when(lower, t).otherwise(F.lit(1.0) - t))
    return (F.when(x.isNull() | ~(a > 0) | ~(b > 0) | tilt.isNull(), F.lit(None).cast("double"))
            .when(F.isnan(x) | F.isnan(tilt), F.lit(float("nan")))
            .when(x <= 0, F.lit(0.0)).when(y <= 0, F.lit(1.0)).otherwise(tail))


# ln n! - n ln n + n for n = 0 .. 15.
FACTORIAL_REST = np.array([0.0] + [math.lgamma(n + 1) - n * math.log(n) + n for n in range(1, 16)])


def _factorial_rest(n: Column) -> Column:
    """ln n! - n ln n + n for whole n >= 0 (half the logarithm of 2 pi n, and Stirling's error)."""
    inv = F.lit(1.0) / F.greatest(n, F.lit(1.0))
    large = F.log(n * F.lit(2 * math.pi)) / 2 + inv * _horner(inv * inv, STIRLING)
    return F.when(n >= 16, large).otherwise(F.get(F.lit(FACTORIAL_REST), F.least(n, F.lit(15.0)).cast("int")))


def _deviance(x: Column, mean: Column, off: Column) -> Column:
    """x ln(x / mean) + mean - x, by its series where x is near the mean; ``off`` is x - mean."""
    def body(v):
        series = off * v + F.lit(2.0) * x * v * v * v * _horner(v * v, [1.0 / (2 * j + 3) for j in range(9)])
        return F.when(x <= 0, mean).when(F.abs(v) < 0.1, series).otherwise(x * F.log(x / mean) - off)
    return _let(F.try_divide(off, x + mean), body)


def log_hypergeometric(k, good, bad, drawn) -> Column:
    """ln P(k of ``good`` in ``drawn`` draws without replacement from good + bad), any size of the counts.

    The four cells of the table differ from their expected counts by one
    number, up to its sign. Their deviances carry the large part, and what is
    left of the factorials is small, so no large numbers are subtracted.
    """
    k, good, bad, drawn = (_c(c).cast("long") for c in (k, good, bad, drawn))
    total = good + bad
    rest = total - drawn
    wide = lambda c: c.cast("decimal(19,0)")
    n = total.cast("double")
    off = (wide(k) * wide(total) - wide(good) * wide(drawn)).cast("double") / n
    cell = lambda x, r, c, d: F.struct(x.cast("double").alias("x"), (r.cast("double") * (c / n)).alias("mean"), d.alias("off"))
    cells = F.array(cell(k, good, drawn, off), cell(good - k, good, rest, -off),
                    cell(drawn - k, bad, drawn, -off), cell(bad - drawn + k, bad, rest, off))
    rests = F.array(*[F.struct(F.lit(sign).alias("sign"), c.cast("double").alias("n")) for sign, c in (
        (1.0, good), (1.0, bad), (1.0, drawn), (1.0, rest), (-1.0, total), (-1.0, k), (-1.0, good - k), (-1.0, drawn - k),
        (-1.0, bad - drawn + k))])
    small = F.aggregate(rests, F.lit(0.0), lambda s, r: s + r["sign"] * _factorial_rest(r["n"]))
    return F.aggregate(cells, small, lambda s, c: s - _deviance(c["x"], c["mean"], c["off"]))
