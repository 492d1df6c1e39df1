"""SQL (DuckDB) statements of the statistics formulas, for the oracle queries.

Closed forms with ``lgamma`` stand in for the recursive products the Spark
side evaluates with ``aggregate``; both agree to ~1e-13 relative.
"""

from __future__ import annotations

import math

from pitchline.functions.tails import ACKLAM_A, ACKLAM_B, ACKLAM_C, ACKLAM_D, ACKLAM_LOW
from pitchline.operators.stats import (SW_AN, SW_AN1, SW_LARGE_MEAN, SW_LARGE_SD, SW_SMALL_GAMMA, SW_SMALL_MEAN,
                                       SW_SMALL_SD)


def d(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def horner(x: str, coeffs: list[float]) -> str:
    acc = d(coeffs[-1])
    for c in reversed(coeffs[:-1]):
        acc = f"({d(c)} + ({x}) * {acc})"
    return acc


def erfc(x: str) -> str:
    """Midpoint sum of the integral 2x/pi exp(-x^2) * int exp(-t^2) / (t^2 + x^2) dt with step 1/2, and the pole's part."""
    z = f"abs({x})"
    terms = f"list_sum(list_transform(range(0, 16), lambda k: exp(-pow((k + 0.5) / 2, 2)) / (pow((k + 0.5) / 2, 2) + {z} * {z})))"
    pole = f"(CASE WHEN {z} < 6 THEN 2.0 / (1.0 + exp(4.0 * pi() * {z})) ELSE 0.0 END)"
    ans = f"(exp(-{z} * {z}) * {z} / pi() * {terms} + {pole})"
    return f"(CASE WHEN ({x}) >= 0 THEN {ans} ELSE 2.0 - {ans} END)"


def norm_sf(z: str) -> str:
    return f"(0.5 * {erfc(f'({z}) / {d(math.sqrt(2.0))}')})"


def norm_ppf(p: str) -> str:
    qlo = f"sqrt(-2.0 * ln({p}))"
    lo = f"({horner(qlo, ACKLAM_C[::-1])} / (1.0 + {qlo} * {horner(qlo, ACKLAM_D[::-1])}))"
    qhi = f"sqrt(-2.0 * ln(1.0 - ({p})))"
    hi = f"(-{horner(qhi, ACKLAM_C[::-1])} / (1.0 + {qhi} * {horner(qhi, ACKLAM_D[::-1])}))"
    q = f"(({p}) - 0.5)"
    r = f"({q} * {q})"
    mid = f"({horner(r, ACKLAM_A[::-1])} * {q} / (1.0 + {r} * {horner(r, ACKLAM_B[::-1])}))"
    return f"(CASE WHEN ({p}) < {ACKLAM_LOW} THEN {lo} WHEN ({p}) > {1 - ACKLAM_LOW} THEN {hi} ELSE {mid} END)"


def chi2_sf(x: str, df: str) -> str:
    half = f"(({x}) / 2.0)"
    even = (f"coalesce(list_sum(list_transform(range(0, CAST(({df}) / 2 AS BIGINT)), "
            f"lambda j: exp(j * ln({half}) - lgamma(j + 1) - {half}))), 0.0)")
    odd_terms = (f"coalesce(list_sum(list_transform(range(1, CAST((({df}) - 1) / 2 AS BIGINT) + 1), "
                 f"lambda j: exp((j - 1) * ln({x}) - {half} - (j * ln(2.0) + lgamma(j + 0.5) - lgamma(0.5))))), 0.0)")
    odd = f"({erfc(f'sqrt({half})')} + sqrt(2.0 * ({x}) / pi()) * {odd_terms})"
    return (f"(CASE WHEN ({x}) <= 0 THEN 1.0 WHEN CAST({df} AS BIGINT) % 2 = 0 THEN least(1.0, {even}) "
            f"ELSE least(1.0, {odd}) END)")


def t_sf2(t: str, df: str) -> str:
    """Two-sided t tail: the trigonometric sums for |t| < 1, the power series of the upper tail beyond.

    The series x^(df/2) sqrt(1 - x) / (df/2 B(df/2, 1/2)) * sum_j prod_i<=j (df/2 + i - 1/2) / (df/2 + i) x^j at
    x = df / (df + t^2) has only positive terms, so small tails keep their digits.
    """
    at = f"abs({t})"
    nu = f"CAST({df} AS DOUBLE)"
    theta = f"atan({at} / sqrt({nu}))"
    x = f"({nu} / ({nu} + {at} * {at}))"
    y = f"({at} * {at} / ({nu} + {at} * {at}))"
    even_sum = (f"coalesce(list_sum(list_transform(range(1, CAST({df} AS BIGINT) // 2), "
                f"lambda j: exp(lgamma(j + 0.5) - lgamma(0.5) - lgamma(j + 1) + j * ln({x})))), 0.0)")
    odd_sum = (f"coalesce(list_sum(list_transform(range(1, (CAST({df} AS BIGINT) - 3) // 2 + 1), "
               f"lambda j: exp(lgamma(j + 1) + lgamma(1.5) - lgamma(j + 1.5) + j * ln({x})))), 0.0)")
    a_even = f"(sin({theta}) * (1.0 + {even_sum}))"
    a_odd = f"((2.0 / pi()) * ({theta} + sin({theta}) * cos({theta}) * (1.0 + {odd_sum})))"
    h = f"({nu} / 2.0)"
    terms = (f"list_sum(list_transform(range(0, CAST(ceil(45.0 / {y}) AS BIGINT)), lambda j: "
             f"exp(lgamma({h} + j + 0.5) - lgamma({h} + 0.5) - lgamma({h} + j + 1) + lgamma({h} + 1) + j * ln({x}))))")
    upper = (f"exp({h} * ln({x}) + 0.5 * ln({y}) + lgamma({h} + 0.5) - lgamma({h} + 1) - lgamma(0.5)) * {terms}")
    return (f"(CASE WHEN {at} >= 1 THEN {upper} "
            f"WHEN CAST({df} AS BIGINT) = 1 THEN 1.0 - (2.0 / pi()) * {theta} "
            f"WHEN CAST({df} AS BIGINT) % 2 = 0 THEN 1.0 - {a_even} ELSE 1.0 - {a_odd} END)")


def f_sf_even_d1(f: str, d1: str, d2: str) -> str:
    """F upper tail for even numerator df: finite sum of the incomplete beta."""
    x = f"(CAST({d2} AS DOUBLE) / (CAST({d2} AS DOUBLE) + CAST({d1} AS DOUBLE) * ({f})))"
    a = f"(CAST({d2} AS DOUBLE) / 2.0)"
    s = (f"list_sum(list_transform(range(0, CAST({d1} AS BIGINT) // 2), "
         f"lambda j: exp(lgamma({a} + j) - lgamma({a}) - lgamma(j + 1) + {a} * ln({x}) + j * ln(1.0 - {x}))))")
    return f"(CASE WHEN ({f}) <= 0 THEN 1.0 ELSE {s} END)"


def rnd(expr: str, scale: int = 8) -> str:
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,18)), {scale}) AS DOUBLE)"


def poly(x: str, coeffs: list[float]) -> str:
    return horner(x, coeffs)


def shapiro_sql(source: str, group: str, value: str) -> str:
    """Shapiro-Wilk per group for n >= 3 (p up to n = 5000) with the moment test's p, ordered by a window."""
    u = "(1.0 / sqrt(CAST(n AS DOUBLE)))"
    a_n = f"(m_n / sqrt(msq) + {poly(u, SW_AN)})"
    a_n1 = f"(m_n1 / sqrt(msq) + {poly(u, SW_AN1)})"
    nd = "CAST(n AS DOUBLE)"
    y = "ln(1.0 - w)"
    gamma = poly(nd, SW_SMALL_GAMMA)
    z_small = f"((-ln({gamma} - {y}) - {poly(nd, SW_SMALL_MEAN)}) / exp({poly(nd, SW_SMALL_SD)}))"
    z_large = f"(({y} - {poly(f'ln({nd})', SW_LARGE_MEAN)}) / exp({poly(f'ln({nd})', SW_LARGE_SD)}))"
    p3 = f"greatest(0.0, {d(6.0 / 3.141592653589793)} * (asin(sqrt(w)) - asin(sqrt(0.75))))"
    return f"""
sw_x AS (SELECT {group} AS g, CAST({value} AS DOUBLE) AS x FROM {source} WHERE {value} IS NOT NULL),
sw_sizes AS (SELECT g, COUNT(*) AS n, AVG(x) AS xbar FROM sw_x GROUP BY g),
sw_r AS (SELECT x.g, x.x, s.n, s.xbar, ROW_NUMBER() OVER (PARTITION BY x.g ORDER BY x.x) AS i
         FROM sw_x x JOIN sw_sizes s ON s.g = x.g WHERE s.n >= 3),
sw_m AS (SELECT *, {norm_ppf('(i - 0.375) / (CAST(n AS DOUBLE) + 0.25)')} AS m FROM sw_r),
sw_w AS (SELECT *, SUM(m * m) OVER (PARTITION BY g) AS msq,
                MAX(CASE WHEN i = n THEN m END) OVER (PARTITION BY g) AS m_n,
                MAX(CASE WHEN i = n - 1 THEN m END) OVER (PARTITION BY g) AS m_n1 FROM sw_m),
sw_phi AS (SELECT *, CASE WHEN n > 5 THEN (msq - 2 * m_n * m_n - 2 * m_n1 * m_n1) / (1 - 2 * {a_n} * {a_n} - 2 * {a_n1} * {a_n1})
                          ELSE (msq - 2 * m_n * m_n) / (1 - 2 * {a_n} * {a_n}) END AS phi FROM sw_w),
sw_a AS (SELECT *, CASE WHEN n = 3 THEN CASE WHEN i = 1 THEN -sqrt(0.5) WHEN i = 3 THEN sqrt(0.5) ELSE 0.0 END
                        WHEN i = n THEN {a_n} WHEN i = 1 THEN -{a_n}
                        WHEN n > 5 AND i = n - 1 THEN {a_n1} WHEN n > 5 AND i = 2 THEN -{a_n1}
                        ELSE m / sqrt(phi) END AS a FROM sw_phi),
sw_agg AS (SELECT g, n, SUM(a * x) AS ax, SUM((x - xbar) * (x - xbar)) AS ss FROM sw_a GROUP BY g, n),
sw_mo AS (SELECT x.g, AVG(pow(x - xbar, 2)) AS m2, AVG(pow(x - xbar, 3)) AS m3, AVG(pow(x - xbar, 4)) AS m4
          FROM sw_x x JOIN sw_sizes s ON s.g = x.g GROUP BY x.g),
sw_jb AS (SELECT s.g, s.n, CASE WHEN m2 > 0 THEN exp(-n / 12.0 * (m3 * m3 / (m2 * m2 * m2) + pow(m4 / (m2 * m2) - 3, 2) / 4.0)) END
                 AS jb_p_value FROM sw_sizes s JOIN sw_mo mo ON mo.g = s.g),
sw_res AS (SELECT g, n, CASE WHEN ss > 0 THEN least(1.0, ax * ax / ss) END AS w FROM sw_agg),
sw_p AS (
  SELECT g, w,
         CASE WHEN w IS NULL OR n > 5000 THEN NULL WHEN w >= 1 THEN 1.0 WHEN n = 3 THEN {p3}
              WHEN n <= 11 THEN CASE WHEN {y} >= {gamma} THEN 0.0 ELSE {norm_sf(z_small)} END
              ELSE {norm_sf(z_large)} END AS p_value
  FROM sw_res
),
sw AS (SELECT j.g, j.n, p.w, p.p_value, j.jb_p_value FROM sw_jb j LEFT JOIN sw_p p ON p.g = j.g)"""
