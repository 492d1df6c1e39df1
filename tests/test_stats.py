"""Statistics against published constants and closed-form checks (FIXTURES section 4, case 9)."""

import math
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from pitchline.functions import tails as T
from pitchline.functions.columns import magnitude_label, significance_phrase
from pitchline.operators import stats as R


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


@pytest.mark.parametrize("col,expected,tol", [
    (lambda: T.chi2_sf(F.lit(20.872355), F.lit(5)), 0.000856293, 1e-8),
    (lambda: T.f_sf(F.lit(1.334856), F.lit(5), F.lit(202)), 0.250893, 1e-6),
    (lambda: T.t_sf2(F.lit(-0.475360 * math.sqrt(30 / (1 - 0.475360 ** 2))), F.lit(30)), 0.00596789, 5e-8),
    (lambda: T.t_sf2(F.lit(-0.606303 * math.sqrt(22 / (1 - 0.606303 ** 2))), F.lit(22)), 0.00168588, 5e-8),
    (lambda: T.norm_sf(F.lit(1.959963984540054)), 0.025, 2e-8),
    (lambda: T.lgamma(F.lit(0.5)), math.lgamma(0.5), 1e-12),
    (lambda: T.lgamma(F.lit(123.25)), math.lgamma(123.25), 1e-10),
    (lambda: T.chi2_sf(F.lit(3.0), F.lit(2)), math.exp(-1.5), 1e-14),
    (lambda: T.norm_ppf(F.lit(0.975)), 1.959963984540054, 1e-8),
    (lambda: T.inc_beta(F.lit(0.3), F.lit(2.0), F.lit(3.0)), 0.3483, 1e-12),
])
def test_tails_match_constants(spark, col, expected, tol):
    assert abs(_one(spark, col()) - expected) < tol


@pytest.mark.parametrize("t,df,expected", [
    (12.0, 200, 2.43e-25), (20.0, 60, 3.16e-28),  # to the digits printed in the round-1 review
])
def test_small_t_tails_are_positive_and_of_the_right_size(spark, t, df, expected):
    assert _one(spark, T.t_sf2(F.lit(t), F.lit(df))) == pytest.approx(expected, rel=0.05)


@pytest.mark.parametrize("t", [0.0, 1e-3, 0.5, 1.0, 2.5, 9.0, 60.0])
def test_t_tail_equals_its_closed_forms(spark, t):
    one = 1 - 2 / math.pi * math.atan(t) if t < 1 else 2 / math.pi * math.atan(1 / t)
    root = math.sqrt(2 + t * t)
    two = 2 / (root * (root + t))  # 1 - t / sqrt(2 + t^2) without cancellation
    assert _one(spark, T.t_sf2(F.lit(t), F.lit(1))) == pytest.approx(one, rel=1e-8)
    assert _one(spark, T.t_sf2(F.lit(t), F.lit(2))) == pytest.approx(two, rel=1e-8)


def _normal_tail(z):
    """Upper normal tail in decimals: the error series below 6, the continued fraction beyond."""
    x = z / Decimal(2).sqrt()
    pi = Decimal("3.14159265358979323846264338327950288419716939937510582097494459")
    if x < 6:
        term, total, k = x, x, 0
        while abs(term) > Decimal(10) ** -75:
            k += 1
            term = -term * x * x / k
            total += term / (2 * k + 1)
        return (1 - 2 / pi.sqrt() * total) / 2
    f = Decimal(0)
    for k in range(400, 0, -1):
        f = Decimal(k) / 2 / (x + f)
    return (-x * x).exp() / pi.sqrt() / (x + f) / 2


def _chi2_tail(x, df):
    x = Decimal(x)
    pi = Decimal("3.14159265358979323846264338327950288419716939937510582097494459")
    if df % 2 == 0:
        term = total = Decimal(1)
        for j in range(1, df // 2):
            term = term * x / 2 / j
            total += term
        return total * (-x / 2).exp()
    term, total = 1 / x, Decimal(0)
    for j in range(1, (df - 1) // 2 + 1):
        term = term * x / (2 * j - 1)
        total += term
    return 2 * _normal_tail(x.sqrt()) + (2 * x / pi).sqrt() * (-x / 2).exp() * total


def _f_tail(f, d1, d2):
    """Even d1 only."""
    x = Decimal(d2) / (Decimal(d2) + d1 * Decimal(f))
    term = total = Decimal(1)
    for j in range(1, d1 // 2):
        term = term * (Decimal(d2) / 2 + j - 1) / j * (1 - x)
        total += term
    return total * (x.ln() * d2 / 2).exp()


@pytest.fixture
def many_digits():
    with localcontext() as c:
        c.prec = 90
        yield


def _rel(got, exact):
    return abs(Decimal(got) / exact - 1)


@pytest.mark.parametrize("z", [0.0, 0.1, 1.0, 1.959963984540054, 2.5, 5.5, 8.3, 20.0, 37.5])
def test_normal_tail_to_the_last_digits(spark, many_digits, z):
    assert _rel(_one(spark, T.norm_sf(F.lit(z))), _normal_tail(Decimal(z))) < 3e-15
    assert _one(spark, T.norm_sf(F.lit(-z))) == pytest.approx(1 - float(_normal_tail(Decimal(z))), rel=1e-15)


@pytest.mark.parametrize("x,df", [(1700.0, 1001), (1700.0, 1000), (3000.0, 2501), (0.001, 1), (40.0, 1), (5.0, 3), (900.0, 1001),
                                  (600.0, 999), (3.0, 2), (100_000.0, 100_001), (104_000.0, 100_000)])
def test_chi_square_tail_for_odd_and_even_df(spark, many_digits, x, df):
    assert _rel(_one(spark, T.chi2_sf(F.lit(x), F.lit(df))), _chi2_tail(x, df)) < 1e-12


@pytest.mark.parametrize("f,d1,d2", [(1.0, 2, 10 ** 12), (3.0, 2, 7), (1.334856, 4, 203), (2.5, 10, 10 ** 6), (1.01, 20_000, 30_001),
                                     (1.2, 1000, 5), (30.0, 2, 1), (0.2, 4, 3), (1.0, 1000, 10 ** 12)])
def test_f_tail_from_small_to_huge_df(spark, many_digits, f, d1, d2):
    assert _rel(_one(spark, T.f_sf(F.lit(f), F.lit(d1), F.lit(d2))), _f_tail(f, d1, d2)) < 1e-12


def test_tails_of_huge_df_go_to_their_limits(spark, many_digits):
    one = 10 ** 12
    # F(5, inf) is chi-square(5) / 5, T(inf) is the normal; the distances fall like 1 / df
    limit = _one(spark, T.chi2_sf(F.lit(5.0), F.lit(5)))
    assert _one(spark, T.f_sf(F.lit(1.0), F.lit(5), F.lit(one))) == pytest.approx(limit, rel=1e-11)
    assert _rel(_one(spark, T.t_sf2(F.lit(2.5), F.lit(one))), 2 * _normal_tail(Decimal(2.5))) < 5e-11
    # Wilson-Hilferty at df = 1e12, three deviations out
    x = one * (1 - 2 / (9 * one) + 3 * math.sqrt(2 / (9 * one))) ** 3
    assert _one(spark, T.chi2_sf(F.lit(x), F.lit(one))) == pytest.approx(float(_normal_tail(Decimal(3))), rel=1e-5)
    assert _one(spark, T.f_sf(F.lit(1.0), F.lit(one), F.lit(one))) == pytest.approx(0.5, rel=1e-12)


def test_tails_outside_their_range(spark):
    nan, inf = float("nan"), float("inf")
    assert math.isnan(_one(spark, T.chi2_sf(F.lit(nan), F.lit(5)))) and _one(spark, T.chi2_sf(F.lit(inf), F.lit(5))) == 0
    assert _one(spark, T.chi2_sf(F.lit(-1.0), F.lit(5))) == 1 and _one(spark, T.chi2_sf(F.lit(1.0), F.lit(0))) is None
    assert _one(spark, T.chi2_sf(F.lit(None).cast("double"), F.lit(5))) is None
    assert _one(spark, T.f_sf(F.lit(0.0), F.lit(3), F.lit(4))) == 1 and math.isnan(_one(spark, T.norm_sf(F.lit(nan))))
    assert _one(spark, T.norm_sf(F.lit(60.0))) == 0 and _one(spark, T.t_sf2(F.lit(0.0), F.lit(9))) == 1


def test_kruskal_over_two_thousand_groups(spark):
    """Groups that differ strongly have a tiny p, whether their number is odd or even; equal ones have p near 1."""
    for k in (2000, 2001):
        far = spark.range(3 * k).select((F.col("id") % k).alias("g"), (F.col("id") % k + F.col("id") / (10.0 * k)).alias("v"))
        r = R.kruskal(far, "g", "v").first()
        assert r.k == k and r.p_value < 1e-200
        mild = spark.range(3 * k).select((F.col("id") % k).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(1000)) + F.col("id") % k * 1000 / k).alias("v"))
        assert 0 < R.kruskal(mild, "g", "v").first().p_value < 1e-3
        near = spark.range(3 * k).select((F.col("id") % k).alias("g"), F.floor(F.col("id") / k).cast("double").alias("v"))
        assert R.kruskal(near, "g", "v").first().p_value == pytest.approx(1.0)


def test_t_tail_goes_to_the_normal_tail_without_a_step(spark):
    for df in (99_999, 100_000, 100_001, 10_000_000_000):
        assert _one(spark, T.t_sf2(F.lit(2.5), F.lit(df))) == pytest.approx(math.erfc(2.5 / math.sqrt(2)), rel=1e-3)


def test_hypergeometric_log_probability_is_exact_for_large_counts(spark):
    from fractions import Fraction
    for k, good, bad, drawn in ((13, 80, 90, 37), (0, 5, 7, 3), (3, 3, 9, 3), (5_100, 10_000, 12_000, 11_000)):
        exact = Fraction(math.comb(good, k) * math.comb(bad, drawn - k), math.comb(good + bad, drawn))
        got = _one(spark, T.log_hypergeometric(F.lit(k), F.lit(good), F.lit(bad), F.lit(drawn)))
        log = math.log(exact.numerator) - math.log(exact.denominator) if exact.numerator.bit_length() < 900 else (
            math.log(exact.numerator >> 2000) + 2000 * math.log(2) - math.log(exact.denominator >> 2000) - 2000 * math.log(2))
        assert got == pytest.approx(log, abs=1e-9)
    # symmetric cells of huge tables have one probability
    n = 10 ** 11
    a = _one(spark, T.log_hypergeometric(F.lit(n // 2 + 1), F.lit(n), F.lit(n), F.lit(n)))
    b = _one(spark, T.log_hypergeometric(F.lit(n // 2 - 1), F.lit(n), F.lit(n), F.lit(n)))
    assert abs(a - b) < 1e-9


def test_kruskal_keeps_its_digits_for_large_counts(spark):
    """Two groups whose mean ranks differ by a hair: H from the counts in exact arithmetic."""
    from fractions import Fraction
    c = 10 ** 7
    hist = spark.createDataFrame([("a", 1.0, c), ("a", 2.0, c + 1), ("b", 1.0, c), ("b", 2.0, c - 1)], "g string, v double, c long")
    ties = [2 * c, 2 * c]
    n = 4 * c
    rank = [Fraction(2 * c + 1, 2), 2 * c + Fraction(2 * c + 1, 2)]
    mean = Fraction(n + 1, 2)
    q = sum(size * (Fraction(lo * rank[0] + hi * rank[1], size) - mean) ** 2
            for lo, hi, size in ((c, c + 1, 2 * c + 1), (c, c - 1, 2 * c - 1)))
    h = Fraction(12, n * (n + 1)) * q / (1 - Fraction(sum(t ** 3 - t for t in ties), n ** 3 - n))
    assert R.kruskal(None, "g", "v", hist=hist).first().h == pytest.approx(float(h), rel=1e-6)


def test_shapiro_wilk_above_the_published_range_has_w_and_the_moment_p(spark):
    from statistics import NormalDist
    n = 6_000
    scores = [NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    df = spark.createDataFrame([(1, v) for v in scores] + [(2, v ** 3) for v in scores], "g int, v double")
    r = {x.g: x for x in R.shapiro_wilk(df, "v", ["g"]).collect()}
    assert r[1].w > 0.9995 and r[2].w < 0.8 and r[1].n == n
    assert r[1].p_value is None and r[2].p_value is None
    assert r[1].jb_p_value > 0.5 and r[2].jb_p_value < 1e-12


def test_shapiro_wilk_reference_sample(spark):
    vals = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    df = spark.createDataFrame([(1, float(v)) for v in vals] + [(2, 1.0), (2, 2.0), (3, 5.0), (3, 5.0), (3, 5.0)],
                               "g int, v double")
    r = {x.g: x for x in R.shapiro_wilk(df, "v", ["g"]).collect()}
    assert abs(r[1].w - 0.788815) < 1e-6 and abs(r[1].p_value - 0.0067038) < 1e-6
    assert r[2].w is None and r[2].n == 2          # n < 3: not defined
    assert r[3].w is None and r[3].p_value is None  # constant group: NULL, not an error


def test_fisher_published_table(spark):
    t = spark.createDataFrame([(13, 67, 24, 66)], "a long, b long, c long, d long")
    r = R.fisher_exact(R.with_expected(t)).first()
    assert abs(r.odds_ratio - 0.533582) < 1e-6 and abs(r.p_value - 0.135927) < 1e-6
    assert abs(R.with_expected(t).first().min_expected - 17.41176) < 1e-5
    h = _one(spark, R.cohens_h(F.lit(13 / 80), F.lit(24 / 90)))
    assert abs(h - (-0.255447)) < 1e-6


def test_mann_whitney_ties_and_continuity(spark):
    x = [1, 2, 2, 3, 3, 3, 4, 5, 5, 9]
    y = [2, 3, 4, 4, 6, 6, 7, 8, 8, 8, 10]
    df = spark.createDataFrame([(True, float(v)) for v in x] + [(False, float(v)) for v in y], "g boolean, v double")
    r = R.mann_whitney(df, F.col("g"), "v").first()
    # hand computation: pooled mid-ranks, U1 = R1 - n1(n1+1)/2
    pooled = sorted(x + y)
    rank = {v: (pooled.index(v) + 1 + len(pooled) - pooled[::-1].index(v)) / 2 for v in set(pooled)}
    u1 = sum(rank[v] for v in x) - len(x) * (len(x) + 1) / 2
    assert r.u == u1 and r.n1 == 10 and r.n2 == 11
    ties = sum(pooled.count(v) ** 3 - pooled.count(v) for v in set(pooled))
    n = 21
    var = 10 * 11 / 12 * ((n + 1) - ties / (n * (n - 1)))
    z = (max(u1, 110 - u1) - 55 - 0.5) / math.sqrt(var)
    assert abs(r.p_value - math.erfc(z / math.sqrt(2))) < 1e-6
    assert abs(r.rank_biserial - (1 - 2 * u1 / 110)) < 1e-12


def test_kruskal_and_levene_small(spark):
    data = {"a": [1.0, 2.0, 2.0, 3.0], "b": [2.0, 4.0, 4.0, 5.0, 7.0], "c": [9.0]}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g string, v double")
    k = R.kruskal(df, "g", "v").first()
    allv = sorted(v for vs in data.values() for v in vs)
    rank = {v: (allv.index(v) + 1 + len(allv) - allv[::-1].index(v)) / 2 for v in set(allv)}
    n = len(allv)
    h = 12 / (n * (n + 1)) * sum(sum(rank[v] for v in vs) ** 2 / len(vs) for vs in data.values()) - 3 * (n + 1)
    h /= 1 - sum(allv.count(v) ** 3 - allv.count(v) for v in set(allv)) / (n ** 3 - n)
    assert abs(k.h - h) < 1e-9 and k.k == 3
    lv = R.levene(df, "g", "v").first()
    assert lv.k == 3 and lv.n == 10 and 0 <= lv.p_value <= 1


def test_spearman_constant_group_is_null(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (1, 2.0, 5.0), (1, 3.0, 5.0), (2, 1.0, 1.0), (2, 2.0, 3.0), (2, 3.0, 2.0)],
                               "y int, x double, f double")
    r = {x.y: x for x in R.spearman(df, ["y"], "x", "f").collect()}
    assert r[1].rho is None and r[1].p_value is None
    assert abs(r[2].rho - 0.5) < 1e-12


def test_rank_histogram_heavy_ties_many_partitions(spark):
    df = spark.createDataFrame([(float(v % 3),) for v in range(300)], "v double")
    h = {r.v: r.rank for r in R.rank_histogram(df, "v", num_partitions=7).collect()}
    assert h == {0.0: 50.5, 1.0: 150.5, 2.0: 250.5}


def test_labels_and_phrases(spark):
    df = spark.createDataFrame([(0.1,), (0.0999,), (-0.5,), (0.3,), (None,)], "e double")
    got = [r.m for r in df.select(magnitude_label("e", (0.1, 0.3, 0.5)).alias("m")).collect()]
    assert got == ["small", "negligible", "large", "medium", None]
    ph = spark.createDataFrame([(0.05,), (0.0499,)], "p double").select(significance_phrase("p").alias("s")).collect()
    assert ph[0].s.startswith("not statistically significant") and "(p=0.0499)" in ph[1].s


def test_fisher_support_split_across_chunks(spark, monkeypatch):
    t = spark.createDataFrame([(90000, 70000, 60000, 40000)], "a long, b long, c long, d long")
    chunked = R.fisher_exact(t).first()
    monkeypatch.setattr(R, "FISHER_CHUNK", 1 << 18)
    whole = R.fisher_exact(t).first()
    assert abs(chunked.p_value - whole.p_value) < 1e-12 and chunked.odds_ratio == whole.odds_ratio


def test_fisher_equals_the_whole_support_in_exact_arithmetic(spark):
    from fractions import Fraction
    tables = [(13, 67, 24, 66), (0, 5, 7, 3), (5, 0, 0, 5), (1, 0, 0, 1), (0, 0, 3, 4), (40, 3, 2, 50), (3, 3, 3, 3), (100, 200, 210, 90), (0, 9, 0, 4), (2, 8, 9, 1)]
    df = spark.createDataFrame(tables, "a long, b long, c long, d long")
    got = {(r.a, r.b, r.c, r.d): r.p_value for r in R.fisher_exact(df).collect()}
    for a, b, c, d in tables:
        n, r1, c1 = a + b + c + d, a + b, a + c
        pmf = {k: Fraction(math.comb(r1, k) * math.comb(n - r1, c1 - k), math.comb(n, c1)) for k in range(max(0, r1 + c1 - n), min(r1, c1) + 1)}
        p = sum(v for v in pmf.values() if v <= pmf[a] * (1 + Fraction(1, 10 ** 7)))
        assert got[a, b, c, d] == pytest.approx(float(p), rel=1e-11), (a, b, c, d)


def test_fisher_of_huge_cells_does_not_walk_the_support(spark):
    """Cells of 1e10: near the normal tail of the standardised difference; a symmetric table has p = 1."""
    n = 10 ** 10
    shift = 2 * 10 ** 5
    df = spark.createDataFrame([(n, n, n, n), (n + shift, n - shift, n - shift, n + shift)], "a long, b long, c long, d long")
    got = {r.a: r.p_value for r in R.fisher_exact(df).collect()}
    z = (shift - 0.5) / math.sqrt((2 * n) ** 4 / ((4 * n) ** 2 * (4 * n - 1)))
    assert got[n] == pytest.approx(1.0, abs=1e-6) and got[n + shift] == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-3)


def test_shapiro_scores_are_spread_over_tasks(spark, monkeypatch):
    df = spark.range(900).select(F.lit("a").alias("g"), (F.col("id") % 3 + F.col("id") % 7).cast("double").alias("v"))
    whole = R.shapiro_wilk(df, "v", ["g"]).collect()[0]
    monkeypatch.setattr(R, "ORDER_CHUNK", 16)
    cut = R.shapiro_wilk(df, "v", ["g"])
    # a fixed number of tasks: adaptive plans join small partitions of any other shuffle
    assert "REPARTITION_BY_NUM" in cut._jdf.queryExecution().executedPlan().toString()
    cut = cut.collect()[0]
    assert cut.n == whole.n == 900 and abs(cut.w - whole.w) < 1e-12 and abs(cut.p_value - whole.p_value) < 1e-9


def test_validation_builds_the_upset_table_once(spark, sf_dir, monkeypatch):
    from pitchline.plans import q_stats as QS
    names = []
    kept = QS.written
    monkeypatch.setattr(QS, "written", lambda df, name: names.append(name) or kept(df, name))
    rows = QS.validation_results(spark, sf_dir).collect()
    assert names == ["upset-table"] and [r.row_id for r in sorted(rows)][:3] == [1, 2, 3]
