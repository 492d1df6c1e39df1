"""Queries for the statistics operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchline.functions import tails
from pitchline.functions.columns import magnitude_label, round_half_up, safe_ratio, significance_phrase
from pitchline.operators import marts
from pitchline.operators import stats as R
from pitchline.plans import contests as C
from pitchline.plans import oracle as O
from pitchline.plans import oracle_stats as OS
from pitchline.plans.q_marts import UPSET_CLASSIFIED
from pitchline.plans.registry import current_cohort, query
from pitchline.session import scratch_path, written
from pitchline.sources import files as S

DIGITS = 8


def rs(c: Column | str, digits: int = DIGITS) -> Column:
    """Round to significant digits (same rule as the SQL oracle): neither large statistics nor small p-values get lost."""
    c = F.col(c) if isinstance(c, str) else c
    c = c.cast("double")
    return F.when(c.isNotNull(), F.format_string(f"%.{digits - 1}e", c).cast("double"))


def q(expr: str, digits: int = DIGITS) -> str:
    return f"CAST(printf('%.{digits - 1}e', CAST(({expr}) AS DOUBLE)) AS DOUBLE)"


# R0 ------------------------------------------------------------------------------

@query("mid_ranks", f"""
SELECT l_quantity, COUNT(*) AS n,
       {q('CAST(SUM(COUNT(*)) OVER (ORDER BY l_quantity) AS DOUBLE) - (COUNT(*) - 1) / 2.0')} AS mid_rank
FROM lineitem GROUP BY l_quantity""")
def mid_ranks(spark, sf_dir):
    h = R.rank_histogram(C.table(spark, sf_dir, "lineitem"), "l_quantity")
    return h.select("l_quantity", F.col("t").alias("n"), rs("rank").alias("mid_rank"))


# R1, R2 ----------------------------------------------------------------------------

def _abs_diff(spark, sf_dir) -> DataFrame:
    m = C.contests(spark, sf_dir)
    return m.select("cohort", F.abs(F.col("home_score") - F.col("away_score")).alias("abs_diff"))


def mann_whitney_frame(spark, sf_dir) -> DataFrame:
    d = _abs_diff(spark, sf_dir)
    return R.mann_whitney(d, F.col("cohort") == current_cohort(spark, sf_dir), "abs_diff")


MWU_SQL = O.with_(O.CONTESTS) + f"""
, d AS (SELECT ABS(home_score - away_score) AS v, cohort = {O.CURRENT} AS g1 FROM contests),
h AS (SELECT v, COUNT(*) AS t, SUM(CASE WHEN g1 THEN 1 ELSE 0 END) AS c1 FROM d GROUP BY v),
r AS (SELECT v, t, c1, CAST(SUM(t) OVER (ORDER BY v) AS DOUBLE) - (t - 1) / 2.0 AS rank FROM h),
s AS (SELECT CAST(SUM(c1) AS BIGINT) AS n1, CAST(SUM(t) AS BIGINT) AS n, SUM(c1 * rank) AS r1,
             SUM(pow(CAST(t AS DOUBLE), 3) - t) AS tie FROM r),
u AS (SELECT n1, n - n1 AS n2, r1 - CAST(n1 AS DOUBLE) * (CAST(n1 AS DOUBLE) + 1) / 2 AS u,
             CAST(n AS DOUBLE) AS nn, tie FROM s),
z AS (SELECT *, (greatest(u, CAST(n1 AS DOUBLE) * n2 - u) - CAST(n1 AS DOUBLE) * n2 / 2 - 0.5)
               / sqrt(CAST(n1 AS DOUBLE) * n2 / 12 * ((nn + 1) - tie / (nn * (nn - 1)))) AS z FROM u)"""


@query("mann_whitney", MWU_SQL + f"""
SELECT n1, n2, u, {q('z')} AS z, {q('least(1.0, 2.0 * ' + OS.norm_sf('z') + ')')} AS p_value,
       {q('1.0 - 2.0 * u / (CAST(n1 AS DOUBLE) * n2)')} AS rank_biserial
FROM z""")
def mann_whitney(spark, sf_dir):
    r = mann_whitney_frame(spark, sf_dir)
    return r.select("n1", "n2", "u", rs("z").alias("z"), rs("p_value").alias("p_value"),
                    rs("rank_biserial").alias("rank_biserial"))


# R3, R4 ------------------------------------------------------------------------------

@query("normality", "WITH " + OS.shapiro_sql("part", "p_brand", "p_retailprice") + f"""
SELECT g AS p_brand, n, {q('w')} AS w, {q('p_value')} AS p_value, {q('jb_p_value')} AS jb_p_value FROM sw""")
def normality(spark, sf_dir):
    r = R.shapiro_wilk(C.table(spark, sf_dir, "part"), "p_retailprice", ["p_brand"])
    return r.select("p_brand", "n", rs("w").alias("w"), rs("p_value").alias("p_value"),
                    rs("jb_p_value").alias("jb_p_value"))


@query("normality_fallback", f"""
WITH x AS (SELECT l_returnflag, l_extendedprice AS v FROM lineitem),
m AS (SELECT l_returnflag, AVG(v) AS mu FROM x GROUP BY 1),
mo AS (SELECT x.l_returnflag, COUNT(*) AS n, AVG(pow(v - mu, 2)) AS m2, AVG(pow(v - mu, 3)) AS m3,
              AVG(pow(v - mu, 4)) AS m4 FROM x JOIN m USING (l_returnflag) GROUP BY 1),
s AS (SELECT l_returnflag, n, m3 / pow(m2, 1.5) AS sk, m4 / (m2 * m2) - 3.0 AS ku FROM mo)
SELECT l_returnflag, n, {q('sk', 6)} AS skewness, {q('ku', 6)} AS excess_kurtosis,
       {q('n / 6.0 * (sk * sk + ku * ku / 4.0)', 4)} AS jb,
       {q('exp(-(n / 6.0 * (sk * sk + ku * ku / 4.0)) / 2.0)')} AS p_value
FROM s""")
def normality_fallback(spark, sf_dir):
    r = R.jarque_bera(C.table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return r.select("l_returnflag", "n", rs("skewness", 6).alias("skewness"),
                    rs("excess_kurtosis", 6).alias("excess_kurtosis"), rs("jb", 4).alias("jb"),
                    rs("p_value").alias("p_value"))


# R5, R6, R7 ---------------------------------------------------------------------------

def upset_table(spark, sf_dir) -> DataFrame:
    """2x2: rows current cohort / earlier cohorts; columns upset / not upset (decisive only)."""
    c = marts.classify_upsets(C.contests(spark, sf_dir), C.ranking_bridge(spark, sf_dir))
    decisive = c.where(~F.col("is_draw"))
    return R.contingency(decisive, F.col("cohort") == current_cohort(spark, sf_dir), F.col("is_upset"))


UPSET_TABLE_SQL = UPSET_CLASSIFIED + f"""
, tab AS (
  SELECT CAST(SUM(CASE WHEN g AND is_upset THEN 1 ELSE 0 END) AS BIGINT) AS a,
         CAST(SUM(CASE WHEN g AND NOT is_upset THEN 1 ELSE 0 END) AS BIGINT) AS b,
         CAST(SUM(CASE WHEN NOT g AND is_upset THEN 1 ELSE 0 END) AS BIGINT) AS c,
         CAST(SUM(CASE WHEN NOT g AND NOT is_upset THEN 1 ELSE 0 END) AS BIGINT) AS d
  FROM (SELECT *, cohort = {O.CURRENT} AS g FROM classified WHERE NOT is_draw) x
)"""


@query("expected_cells", UPSET_TABLE_SQL + f"""
SELECT a, b, c, d, {q('''least(CAST(a + b AS DOUBLE) * (a + c) / (a + b + c + d), CAST(a + b AS DOUBLE) * (b + d) / (a + b + c + d),
                               CAST(c + d AS DOUBLE) * (a + c) / (a + b + c + d), CAST(c + d AS DOUBLE) * (b + d) / (a + b + c + d))''', 6)} AS min_expected
FROM tab""")
def expected_cells(spark, sf_dir):
    t = upset_table(spark, sf_dir)
    return t.select("a", "b", "c", "d", rs("min_expected", 6).alias("min_expected"))


def _lchoose(n: str, k: str) -> str:
    return f"(lgamma(({n}) + 1) - lgamma(({k}) + 1) - lgamma(({n}) - ({k}) + 1))"


@query("fisher", UPSET_TABLE_SQL + f"""
, base AS (SELECT a, b, c, d, a + b AS r1, a + c AS c1, a + b + c + d AS nn FROM tab),
sup AS (SELECT base.*, k FROM base, LATERAL (SELECT unnest(generate_series(greatest(0, r1 + c1 - nn), least(r1, c1))) AS k)),
lp AS (SELECT *, {_lchoose('r1', 'k')} + {_lchoose('nn - r1', 'c1 - k')} - {_lchoose('nn', 'c1')} AS lp,
              {_lchoose('r1', 'a')} + {_lchoose('nn - r1', 'c1 - a')} - {_lchoose('nn', 'c1')} AS lobs FROM sup)
SELECT a, b, c, d, {q('CAST(a * d AS DOUBLE) / NULLIF(CAST(b * c AS DOUBLE), 0)')} AS odds_ratio,
       {q('least(1.0, SUM(CASE WHEN lp <= lobs + ln(1 + 1e-7) THEN exp(lp) ELSE 0.0 END))')} AS p_value
FROM lp GROUP BY a, b, c, d""")
def fisher(spark, sf_dir):
    r = R.fisher_exact(upset_table(spark, sf_dir))
    return r.select("a", "b", "c", "d", rs("odds_ratio").alias("odds_ratio"), rs("p_value").alias("p_value"))


@query("cohens_h", UPSET_TABLE_SQL + f"""
SELECT {q('CAST(a AS DOUBLE) / (a + b)')} AS p_current, {q('CAST(c AS DOUBLE) / (c + d)')} AS p_earlier,
       {q('2.0 * asin(sqrt(CAST(a AS DOUBLE) / NULLIF(CAST(a + b AS DOUBLE), 0))) - 2.0 * asin(sqrt(CAST(c AS DOUBLE) / NULLIF(CAST(c + d AS DOUBLE), 0)))')} AS cohens_h
FROM tab""")
def cohens_h(spark, sf_dir):
    t = upset_table(spark, sf_dir)
    p1, p2 = safe_ratio("a", F.col("a") + F.col("b")), safe_ratio("c", F.col("c") + F.col("d"))
    return t.select(rs(p1).alias("p_current"), rs(p2).alias("p_earlier"), rs(R.cohens_h(p1, p2)).alias("cohens_h"))


# R8, R9, R10 ---------------------------------------------------------------------------

def region_goal_diff(spark, sf_dir) -> DataFrame:
    """Per team-match goal difference with the team's confederation, current cohort only."""
    tm = marts.unpivot_roles(C.contests(spark, sf_dir).where(F.col("cohort") == current_cohort(spark, sf_dir)))
    return (tm.join(C.teams(spark, sf_dir), "team_id")
            .select("confederation_name", (F.col("goals_for") - F.col("goals_against")).alias("goal_diff")))


REGION_DIFF_SQL = O.with_(O.CONTESTS, O.TEAMS, O.UNPIVOT) + f"""
, x AS (SELECT t.confederation_name AS g, CAST(goals_for - goals_against AS DOUBLE) AS v
        FROM team_matches tm JOIN teams t ON t.team_id = tm.team_id WHERE tm.cohort = {O.CURRENT})"""


LEVENE_SQL = REGION_DIFF_SQL + """
, med AS (SELECT g, median(v) AS md FROM x GROUP BY g),
z AS (SELECT x.g, abs(v - md) AS z FROM x JOIN med USING (g)),
gm AS (SELECT g, COUNT(*) AS ng, AVG(z) AS zg FROM z GROUP BY g),
tot AS (SELECT COUNT(*) AS k, SUM(ng) AS n, SUM(ng * zg) / SUM(ng) AS zbar FROM gm),
ssb AS (SELECT SUM(ng * (zg - zbar) * (zg - zbar)) AS ssb FROM gm, tot),
ssw AS (SELECT SUM((z - zg) * (z - zg)) AS ssw FROM z JOIN gm USING (g)),
f AS (SELECT CAST(k AS BIGINT) AS k, CAST(n AS BIGINT) AS n,
             (CAST(n AS DOUBLE) - k) / (CAST(k AS DOUBLE) - 1) * ssb / ssw AS f FROM tot, ssb, ssw)"""


@query("levene", LEVENE_SQL + f"""
SELECT k, n, {q('f')} AS f, {q(OS.f_sf_even_d1('f', 'k - 1', 'n - k'))} AS p_value FROM f""")
def levene(spark, sf_dir):
    r = R.levene(region_goal_diff(spark, sf_dir), "confederation_name", "goal_diff")
    return r.select("k", "n", rs("f").alias("f"), rs("p_value").alias("p_value"))


KRUSKAL_SQL = REGION_DIFF_SQL + f"""
, h AS (SELECT v, COUNT(*) AS t FROM x GROUP BY v),
r AS (SELECT v, t, CAST(SUM(t) OVER (ORDER BY v) AS DOUBLE) - (t - 1) / 2.0 AS rank FROM h),
per AS (SELECT g, v, COUNT(*) AS c FROM x GROUP BY g, v),
rs AS (SELECT g, SUM(c) AS ng, SUM(c * rank) AS rg FROM per JOIN r USING (v) GROUP BY g),
sz AS (SELECT COUNT(*) AS k, SUM(ng) AS n FROM rs),
s AS (SELECT k, n, SUM(ng * pow(rg / ng - (CAST(n AS DOUBLE) + 1) / 2, 2)) AS q FROM rs, sz GROUP BY k, n),
tie AS (SELECT SUM(pow(CAST(t AS DOUBLE), 3) - t) AS tie FROM r),
hh AS (SELECT CAST(k AS BIGINT) AS k, CAST(n AS BIGINT) AS n,
              (12.0 / (CAST(n AS DOUBLE) * (n + 1)) * q)
              / (1.0 - tie / (CAST(n AS DOUBLE) * n * n - n)) AS h FROM s, tie)"""


@query("kruskal", KRUSKAL_SQL + f"""
SELECT k, n, {q('h')} AS h, {q(OS.chi2_sf('h', 'k - 1'))} AS p_value,
       {q('(h - k + 1) / (CAST(n AS DOUBLE) - k)')} AS epsilon_squared FROM hh""")
def kruskal(spark, sf_dir):
    r = R.kruskal(region_goal_diff(spark, sf_dir), "confederation_name", "goal_diff")
    return r.select("k", "n", rs("h").alias("h"), rs("p_value").alias("p_value"),
                    rs("epsilon_squared").alias("epsilon_squared"))


# R11 --------------------------------------------------------------------------------------

def spearman_input(spark, sf_dir) -> DataFrame:
    e = marts.expected_vs_actual(C.contests_staged(spark, sf_dir), C.ranking_bridge(spark, sf_dir),
                                 C.teams(spark, sf_dir), current_cohort(spark, sf_dir))
    finish = F.when(F.col("actual_finish_method") == "stage_order", F.col("furthest_stage_order")) \
        .otherwise(F.col("matches_played"))
    return e.select("tournament_year", "actual_finish_method", "fifa_ranking", finish.cast("double").alias("finish"))


def spearman_frame(spark, sf_dir) -> DataFrame:
    return R.spearman(spearman_input(spark, sf_dir), ["tournament_year"], "fifa_ranking", "finish")


SPEARMAN_SQL = O.with_(O.CONTESTS, O.STAGES, O.TEAMS, O.RANKING) + f"""
, staged AS (SELECT m.*, s.stage_order FROM contests m LEFT JOIN stages s ON s.stage_name = m.stage_name)
, tm AS (SELECT cohort, home_team_id AS team_id, stage_order FROM staged
         UNION ALL SELECT cohort, away_team_id, stage_order FROM staged)
, fin AS (SELECT cohort, team_id, COUNT(*) AS matches_played, MAX(stage_order) AS furthest FROM tm GROUP BY 1, 2)
, e AS (SELECT f.cohort AS y, CAST(r.fifa_ranking AS DOUBLE) AS x,
               CAST(CASE WHEN f.cohort = {O.CURRENT} THEN f.furthest ELSE f.matches_played END AS DOUBLE) AS v
        FROM fin f JOIN ranking r ON r.team_id = f.team_id AND r.cohort = f.cohort
        JOIN teams t ON t.team_id = f.team_id WHERE r.fifa_ranking IS NOT NULL)
, rk AS (SELECT y, rank() OVER (PARTITION BY y ORDER BY x) + (COUNT(*) OVER (PARTITION BY y, x) - 1) / 2.0 AS rx,
                rank() OVER (PARTITION BY y ORDER BY v) + (COUNT(*) OVER (PARTITION BY y, v) - 1) / 2.0 AS ry FROM e)
, s AS (SELECT y, COUNT(*) AS n, CASE WHEN var_pop(rx) > 0 AND var_pop(ry) > 0 THEN corr(rx, ry) END AS rho
         FROM rk GROUP BY y)
, t AS (SELECT *, rho * sqrt((CAST(n AS DOUBLE) - 2) / greatest(0.0, 1.0 - rho * rho)) AS tt FROM s)"""


@query("spearman", SPEARMAN_SQL + f"""
SELECT y AS tournament_year, n, {q('rho')} AS rho,
       {q('CASE WHEN n <= 2 THEN NULL WHEN abs(rho) >= 1 THEN 0.0 ELSE ' + OS.t_sf2('tt', 'n - 2') + ' END')} AS p_value
FROM t""")
def spearman(spark, sf_dir):
    r = spearman_frame(spark, sf_dir)
    return r.select("tournament_year", "n", rs("rho").alias("rho"), rs("p_value").alias("p_value"))


# R15 ---------------------------------------------------------------------------------------

def _grid(spark, sf_dir) -> DataFrame:
    """Tail arguments derived from the data: one row per distinct l_quantity."""
    qv = C.table(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("int").alias("qty")).distinct()
    return qv.select("qty", (F.col("qty") / F.lit(5.0)).alias("x"), (F.col("qty") % 7 + 1).alias("df"),
                     (F.lit(2) * (F.col("qty") % 3 + 1)).alias("d1"), (F.col("qty") + 1).alias("d2"))


@query("tail_probabilities", f"""
WITH g AS (SELECT DISTINCT CAST(l_quantity AS INTEGER) AS qty FROM lineitem),
a AS (SELECT qty, qty / 5.0 AS x, qty % 7 + 1 AS df, 2 * (qty % 3 + 1) AS d1, qty + 1 AS d2,
             1000 + 3 * qty AS wide, CAST((1000 + 3 * qty) * (1.0 + qty / 60.0) AS DOUBLE) AS far FROM g)
SELECT qty, {q(OS.norm_sf('x'))} AS norm_sf, {q(OS.chi2_sf('x', 'df'))} AS chi2_sf,
       {q(OS.t_sf2('x', 'df'))} AS t_sf2, {q(OS.f_sf_even_d1('x', 'd1', 'd2'))} AS f_sf,
       {q(OS.chi2_sf('far', 'wide'))} AS chi2_sf_wide
FROM a""")
def tail_probabilities(spark, sf_dir):
    g = _grid(spark, sf_dir)
    return g.select("qty", rs(tails.norm_sf(F.col("x"))).alias("norm_sf"),
                    rs(tails.chi2_sf(F.col("x"), F.col("df"))).alias("chi2_sf"),
                    rs(tails.t_sf2(F.col("x"), F.col("df"))).alias("t_sf2"),
                    rs(tails.f_sf(F.col("x"), F.col("d1"), F.col("d2"))).alias("f_sf"),
                    rs(tails.chi2_sf((F.lit(1000) + F.col("qty") * 3) * (F.lit(1.0) + F.col("qty") / F.lit(60.0)),
                                     F.lit(1000) + F.col("qty") * 3)).alias("chi2_sf_wide"))


# R12-R14, S7 --------------------------------------------------------------------------------

def validation_results(spark, sf_dir) -> DataFrame:
    """One row per test, numbers and labels built from the row itself; written by S7."""
    with C.landed_contests(spark, sf_dir):
        return _validation_results(spark, sf_dir)


def _fmt4(c: str) -> Column:
    """p printed with 4 decimals after half-up rounding (identical text in every engine)."""
    return F.format_string("%.4f", round_half_up(c, 4))


def _shown(c: str) -> Column:
    return F.when(F.col(c).isNull(), "none").otherwise(_fmt4(c))


# Texts of the direction of an effect where no two values are compared.
NO_DIRECTION, SAME_WAY, OTHER_WAY = "no direction", "finish rises with the ranking number", "finish falls with the ranking number"


def _direction(what: str, now: Column, before: Column) -> Column:
    """Which of two means or shares is larger, with both."""
    shown = lambda c: F.format_string("%.4f", round_half_up(c, 4))
    where = F.when(now > before, "higher in the current cohort").when(now < before, "lower in the current cohort").otherwise("equal")
    return F.when(now.isNull() | before.isNull(), NO_DIRECTION).otherwise(
        F.concat(F.lit(f"{what} "), where, F.lit(" ("), shown(now), F.lit(" against "), shown(before), F.lit(")")))


def _validation_results(spark, sf_dir) -> DataFrame:
    cur = current_cohort(spark, sf_dir)
    normal = R.shapiro_wilk(_abs_diff(spark, sf_dir).withColumn("g", F.col("cohort") == cur), "abs_diff", ["g"])
    pick = [F.max(F.when(F.col("g") == side, F.col(c))).alias(f"{c}_{name}")
            for side, name in ((True, "cur"), (False, "old")) for c in ("w", "p_value", "jb_p_value")]
    rejected = F.least(*[F.coalesce(f"p_value_{g}", f"jb_p_value_{g}") for g in ("cur", "old")]) < R.SIGNIFICANCE_ALPHA
    mw_check = F.concat(
        F.lit("Shapiro-Wilk W "), _shown("w_cur"), F.lit(" and "), _shown("w_old"), F.lit(", p "), _shown("p_value_cur"),
        F.lit(" and "), _shown("p_value_old"), F.lit("; moment test p "), _shown("jb_p_value_cur"), F.lit(" and "),
        _shown("jb_p_value_old"), F.when(rejected, F.lit("; not normal")).otherwise(F.lit("; normality not rejected")))
    side = F.when(F.col("cohort") == cur, F.col("abs_diff"))
    means = _abs_diff(spark, sf_dir).agg(F.avg(side).alias("m_cur"), F.avg(F.when(side.isNull(), F.col("abs_diff"))).alias("m_old"))
    mw = mann_whitney_frame(spark, sf_dir).crossJoin(normal.agg(*pick)).crossJoin(means).select(
        _direction("mean gap", F.col("m_cur"), F.col("m_old")).alias("direction"), F.lit(1).alias("row_id"), mw_check.alias("assumption_check"), *_names("balance"),
        F.concat(F.lit("n_current="), F.col("n1").cast("string"), F.lit(", n_earlier="),
                 F.col("n2").cast("string")).alias("sample_sizes"),
        F.col("u").alias("statistic"), "p_value", F.col("rank_biserial").alias("effect_size"))
    t = written(upset_table(spark, sf_dir), "upset-table")  # read by the test and by its check
    fe = R.fisher_exact(t).crossJoin(t.select("min_expected"))
    p1, p2 = safe_ratio("a", F.col("a") + F.col("b")), safe_ratio("c", F.col("c") + F.col("d"))
    fi_check = F.concat(F.lit("smallest expected cell "), F.format_string("%.1f", round_half_up("min_expected", 1)),
                        F.when(F.col("min_expected") < 5, F.lit("; too small for chi-square"))
                        .otherwise(F.lit("; large enough for chi-square")))
    fi = fe.select(
        _direction("upset share", p1, p2).alias("direction"), F.lit(2).alias("row_id"), fi_check.alias("assumption_check"), *_names("upsets"),
        F.concat(F.lit("decisive_current="), (F.col("a") + F.col("b")).cast("string"), F.lit(", decisive_earlier="),
                 (F.col("c") + F.col("d")).cast("string")).alias("sample_sizes"),
        F.col("odds_ratio").alias("statistic"), "p_value", R.cohens_h(p1, p2).alias("effect_size"))
    diffs = region_goal_diff(spark, sf_dir)
    hist = R.value_histogram(diffs, "confederation_name", "goal_diff")  # one histogram for both tests
    lev = R.levene(diffs, "confederation_name", "goal_diff", hist=hist).select(F.col("p_value").alias("levene_p"))
    kw = R.kruskal(diffs, "confederation_name", "goal_diff", hist=hist).crossJoin(lev).select(
        F.lit(NO_DIRECTION).alias("direction"), F.lit(3).alias("row_id"),
        F.concat(F.lit("equal spread: Levene p "), _shown("levene_p")).alias("assumption_check"),
        *_names("regions"),
        F.concat(F.lit("k="), F.col("k").cast("string"), F.lit(", n="), F.col("n").cast("string")).alias("sample_sizes"),
        F.col("h").alias("statistic"), "p_value", F.col("epsilon_squared").alias("effect_size"))
    year = F.col("tournament_year").cast("string")
    # one row per year: a window over results, not over data
    sp = spearman_frame(spark, sf_dir).select(
        (F.lit(3) + F.row_number().over(Window.orderBy("tournament_year"))).cast("int").alias("row_id"),
        F.when(F.col("rho") > 0, SAME_WAY).when(F.col("rho") < 0, OTHER_WAY).otherwise(NO_DIRECTION).alias("direction"),
        F.lit("ranks only, nothing assumed").alias("assumption_check"), *_names("finish", year),
        F.concat(F.lit("n="), F.col("n").cast("string")).alias("sample_sizes"),
        F.col("rho").alias("statistic"), "p_value", F.col("rho").alias("effect_size"))
    allr = mw.unionByName(fi).unionByName(kw).unionByName(sp)
    mag = None
    for t3 in TESTS.values():
        here = F.col("effect_size_metric") == t3["metric"]
        lab = magnitude_label("effect_size", t3["thresholds"])
        mag = F.when(here, lab) if mag is None else mag.when(here, lab)
    effect = F.concat(mag, F.lit(" effect ("), F.col("effect_size_metric"), F.lit(" "),
                      F.format_string("%.3f", round_half_up("effect_size", 3)), F.lit("), "))
    phrase = significance_phrase("p_value", R.SIGNIFICANCE_ALPHA)
    out = allr.select(
        "row_id", "metric_name", "hypothesis", "comparison", "test_used", "assumption_check", "sample_sizes",
        rs("statistic", 6).alias("statistic"), rs("p_value", 6).alias("p_value"),
        rs("effect_size", 6).alias("effect_size"), "effect_size_metric", mag.alias("magnitude"),
        (F.col("p_value") < R.SIGNIFICANCE_ALPHA).alias("significant"), phrase.alias("significance"),
        "direction",
        F.concat(F.coalesce(effect, F.lit("effect undefined, ")), phrase, F.lit("; "), F.col("direction")).alias("interpretation"))
    return S.write_results(out, scratch_path(spark, "statistical-validation"))


# One entry per test: the texts of the result table (R14) and the bounds of the effect labels.
TESTS = {
    "balance": {"name": "Competitive Balance", "test": "Mann-Whitney U (two-sided)",
                "hypothesis": "score gaps have one distribution in the current and the earlier cohorts",
                "comparison": "absolute score gap, current cohort against all earlier ones",
                "metric": "rank-biserial correlation", "thresholds": R.RANK_BISERIAL_THRESHOLDS},
    "upsets": {"name": "Upset Rate", "test": "Fisher's exact test (two-sided)",
               "hypothesis": "a decisive contest is as likely to be an upset in the current cohort as before",
               "comparison": "upsets among decisive contests, current cohort against all earlier ones",
               "metric": "Cohen's h", "thresholds": R.COHENS_H_THRESHOLDS},
    "regions": {"name": "Confederation Performance", "test": "Kruskal-Wallis H",
                "hypothesis": "score differences have one distribution in all confederations",
                "comparison": "score difference per team and contest between confederations, current cohort",
                "metric": "epsilon-squared", "thresholds": R.EPSILON_SQUARED_THRESHOLDS},
    "finish": {"name": "Expected-vs-Actual Performance", "test": "Spearman rank correlation",
               "hypothesis": "ranking and finish are unrelated",
               "comparison": "ranking before against finish in the cohort",
               "metric": "Spearman's rho", "thresholds": R.SPEARMAN_RHO_THRESHOLDS},
}


def _names(key: str, suffix: Column | None = None) -> list[Column]:
    t = TESTS[key]
    name = F.lit(t["name"]) if suffix is None else F.concat(F.lit(t["name"] + " "), suffix)
    return [name.alias("metric_name"), F.lit(t["hypothesis"]).alias("hypothesis"),
            F.lit(t["comparison"]).alias("comparison"), F.lit(t["test"]).alias("test_used"),
            F.lit(t["metric"]).alias("effect_size_metric")]


def _names_sql(key: str, suffix: str = "") -> str:
    t = {k: str(v).replace("'", "''") for k, v in TESTS[key].items()}
    name = f"'{t['name']}'" if not suffix else f"'{t['name']} ' || {suffix}"
    return (f"{name} AS metric_name, '{t['hypothesis']}' AS hypothesis, '{t['comparison']}' AS comparison, "
            f"'{t['test']}' AS test_used, '{t['metric']}' AS effect_size_metric")


def _f(p: str, d: int = 4) -> str:
    return f"printf('%.{d}f', CAST(ROUND(CAST(({p}) AS DECIMAL(38,9)), {d}) AS DOUBLE))"


GAP_NORMALITY_SQL = (O.with_(O.CONTESTS) + f"""
, gaps AS (SELECT ABS(home_score - away_score) AS v, cohort = {O.CURRENT} AS side FROM contests),
""" + OS.shapiro_sql("gaps", "side", "v") + """
SELECT MAX(CASE WHEN g THEN w END) AS w_cur, MAX(CASE WHEN NOT g THEN w END) AS w_old,
       MAX(CASE WHEN g THEN p_value END) AS p_cur, MAX(CASE WHEN NOT g THEN p_value END) AS p_old,
       MAX(CASE WHEN g THEN jb_p_value END) AS jb_cur, MAX(CASE WHEN NOT g THEN jb_p_value END) AS jb_old FROM sw""")


def _sig(p: str) -> str:
    """R13 phrase in SQL: strict p < alpha; p shown with 4 decimals after half-up rounding."""
    shown = f"printf('%.4f', CAST(ROUND(CAST(({p}) AS DECIMAL(38,9)), 4) AS DOUBLE))"
    a = R.SIGNIFICANCE_ALPHA
    return (f"CASE WHEN ({p}) IS NULL THEN 'p undefined' "
            f"WHEN ({p}) < {a} THEN 'statistically significant at alpha={a} (p=' || {shown} || ')' "
            f"ELSE 'not statistically significant at alpha={a} (p=' || {shown} || ')' END")


def _direction_sql(what: str, now: str, before: str) -> str:
    return (f"CASE WHEN ({now}) IS NULL OR ({before}) IS NULL THEN '{NO_DIRECTION}' ELSE '{what} ' || CASE WHEN ({now}) > ({before}) "
            f"THEN 'higher in the current cohort' WHEN ({now}) < ({before}) THEN 'lower in the current cohort' ELSE 'equal' END "
            f"|| ' (' || {_f(now)} || ' against ' || {_f(before)} || ')' END")


def _validation_sql() -> str:
    """The five tests as (row_id, texts, raw numbers); labels and phrases are then built once, over all rows."""
    shown = lambda c: f"coalesce({_f(c)}, 'none')"
    rows = [
        f"""SELECT 1 AS row_id, {_names_sql('balance')},
       'n_current=' || CAST(n1 AS VARCHAR) || ', n_earlier=' || CAST(n2 AS VARCHAR) AS sample_sizes,
       u AS st, least(1.0, 2.0 * {OS.norm_sf('z')}) AS p, 1.0 - 2.0 * u / (CAST(n1 AS DOUBLE) * n2) AS e,
       'Shapiro-Wilk W ' || {shown('w_cur')} || ' and ' || {shown('w_old')} || ', p ' || {shown('p_cur')} || ' and '
       || {shown('p_old')} || '; moment test p ' || {shown('jb_cur')} || ' and ' || {shown('jb_old')}
       || CASE WHEN least(coalesce(p_cur, jb_cur), coalesce(p_old, jb_old)) < {R.SIGNIFICANCE_ALPHA}
               THEN '; not normal' ELSE '; normality not rejected' END AS assumption_check,
       {_direction_sql('mean gap', 'm_cur', 'm_old')} AS direction
FROM ({MWU_SQL} SELECT * FROM z) mwq CROSS JOIN ({GAP_NORMALITY_SQL}) nq
CROSS JOIN ({MWU_SQL} SELECT AVG(v) FILTER (WHERE g1) AS m_cur, AVG(v) FILTER (WHERE NOT g1) AS m_old FROM d) gq""",
        f"""SELECT 2, {_names_sql('upsets')},
       'decisive_current=' || CAST(a + b AS VARCHAR) || ', decisive_earlier=' || CAST(c + d AS VARCHAR),
       odds_ratio, p_value,
       2.0 * asin(sqrt(CAST(a AS DOUBLE) / (a + b))) - 2.0 * asin(sqrt(CAST(c AS DOUBLE) / (c + d))),
       'smallest expected cell ' || {_f('least(a + b, c + d) * CAST(least(a + c, b + d) AS DOUBLE) / (a + b + c + d)', 1)}
       || CASE WHEN least(a + b, c + d) * CAST(least(a + c, b + d) AS DOUBLE) / (a + b + c + d) < 5
               THEN '; too small for chi-square' ELSE '; large enough for chi-square' END,
       {_direction_sql('upset share', 'CAST(a AS DOUBLE) / (a + b)', 'CAST(c AS DOUBLE) / (c + d)')}
FROM ({_FISHER_RAW}) fq""",
        f"""SELECT 3, {_names_sql('regions')}, 'k=' || CAST(k AS VARCHAR) || ', n=' || CAST(n AS VARCHAR), h,
       {OS.chi2_sf('h', 'k - 1')}, (h - k + 1) / (CAST(n AS DOUBLE) - k), 'equal spread: Levene p ' || {shown('levene_p')}, '{NO_DIRECTION}'
FROM ({KRUSKAL_SQL} SELECT k, n, h FROM hh) kq
CROSS JOIN ({LEVENE_SQL} SELECT {OS.f_sf_even_d1('f', 'k - 1', 'n - k')} AS levene_p FROM f) lq""",
        f"""SELECT CAST(3 + ROW_NUMBER() OVER (ORDER BY y) AS INTEGER), {_names_sql('finish', 'CAST(y AS VARCHAR)')},
       'n=' || CAST(n AS VARCHAR), rho,
       CASE WHEN n <= 2 THEN NULL WHEN abs(rho) >= 1 THEN 0.0 ELSE {OS.t_sf2('tt', 'n - 2')} END, rho,
       'ranks only, nothing assumed', CASE WHEN rho > 0 THEN '{SAME_WAY}' WHEN rho < 0 THEN '{OTHER_WAY}' ELSE '{NO_DIRECTION}' END
FROM ({SPEARMAN_SQL} SELECT y, n, rho, tt FROM t) sq"""]
    bounds = " ".join(f"WHEN effect_size_metric = '{t['metric'].replace(chr(39), chr(39) * 2)}' THEN "
                      f"[{', '.join(map(str, t['thresholds']))}]" for t in TESTS.values())
    union = "\nUNION ALL\n".join(rows)
    return f"""
WITH results AS ({union}),
labelled AS (SELECT *, CASE WHEN e IS NULL THEN NULL
                            ELSE ['negligible', 'small', 'medium', 'large'][1 + len(list_filter(CASE {bounds} END, lambda b: abs(e) >= b))]
                       END AS label, {_sig('p')} AS phrase FROM results)
SELECT row_id, metric_name, hypothesis, comparison, test_used, assumption_check, sample_sizes, {q('st', 6)} AS statistic,
       {q('p', 6)} AS p_value, {q('e', 6)} AS effect_size, effect_size_metric, label AS magnitude,
       p < {R.SIGNIFICANCE_ALPHA} AS significant, phrase AS significance, direction,
       coalesce(label || ' effect (' || effect_size_metric || ' ' || {_f('e', 3)} || '), ', 'effect undefined, ')
       || phrase || '; ' || direction AS interpretation
FROM labelled"""


_FISHER_RAW = UPSET_TABLE_SQL + f"""
, base AS (SELECT a, b, c, d, a + b AS r1, a + c AS c1, a + b + c + d AS nn FROM tab),
sup AS (SELECT base.*, k FROM base, LATERAL (SELECT unnest(generate_series(greatest(0, r1 + c1 - nn), least(r1, c1))) AS k)),
lp AS (SELECT *, {_lchoose('r1', 'k')} + {_lchoose('nn - r1', 'c1 - k')} - {_lchoose('nn', 'c1')} AS lp,
              {_lchoose('r1', 'a')} + {_lchoose('nn - r1', 'c1 - a')} - {_lchoose('nn', 'c1')} AS lobs FROM sup)
SELECT a, b, c, d, CAST(a * d AS DOUBLE) / NULLIF(CAST(b * c AS DOUBLE), 0) AS odds_ratio,
       least(1.0, SUM(CASE WHEN lp <= lobs + ln(1 + 1e-7) THEN exp(lp) ELSE 0.0 END)) AS p_value
FROM lp GROUP BY a, b, c, d"""

query("validation_results", _validation_sql())(validation_results)
