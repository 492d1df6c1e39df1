"""Distribution-free statistics as distributed jobs.

Rank tests never sort the data into one task: values are reduced to a
histogram (one row per distinct value, per group when needed), mid-ranks
come from a range-partitioned running count over that histogram (R0), and
rank sums are weighted sums over it. Only one row per test reaches the tail
functions, which are native Column expressions (``functions.tails``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.functions import tails
from pitchline.functions.columns import broadcast_if_small, count_if
from pitchline.operators.keys import running_total
from pitchline.session import cut_lineage, default_partitions

RANK_BISERIAL_THRESHOLDS = (0.1, 0.3, 0.5)
COHENS_H_THRESHOLDS = (0.2, 0.5, 0.8)
EPSILON_SQUARED_THRESHOLDS = (0.01, 0.06, 0.14)
SPEARMAN_RHO_THRESHOLDS = (0.1, 0.3, 0.5)
SIGNIFICANCE_ALPHA = 0.05

# Royston (1995) Shapiro-Wilk approximation: coefficient polynomials in
# u = 1/sqrt(n) for the two largest weights, and the p-value transforms.
SW_AN = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
SW_AN1 = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
SW_SMALL_GAMMA = [-2.273, 0.459]
SW_SMALL_MEAN = [0.5440, -0.39978, 0.025054, -0.0006714]
SW_SMALL_SD = [1.3822, -0.77857, 0.062767, -0.0020322]
SW_LARGE_MEAN = [-1.5861, -0.31082, -0.083751, 0.0038915]
SW_LARGE_SD = [-0.4803, -0.082676, 0.0030302]
SW_MIN_N, SW_MAX_N = 3, 5000  # W needs SW_MIN_N values; the p transform is published up to SW_MAX_N
FISHER_CHUNK = 1 << 12  # support values per row of a tail
FISHER_DROP = 1e-18  # a tail's terms below this share of its first one are not summed
ORDER_CHUNK = 1 << 16  # order indices of one value per task slice


def _poly(x: Column, coeffs: list[float]) -> Column:
    acc = F.lit(coeffs[-1])
    for c in reversed(coeffs[:-1]):
        acc = F.lit(c) + x * acc
    return acc


# R0 -----------------------------------------------------------------------------

def rank_histogram(df: DataFrame, value: str, by: Sequence[str] = (), weights: dict[str, Column] | None = None,
                   num_partitions: int | None = None) -> DataFrame:
    """One row per distinct (by..., value): t = ties, rank = mid-rank, plus weighted counts.

    rank = cum - (t - 1) / 2, where cum is the running count in value order.
    ``weights`` adds per-value conditional counts (e.g. rows of group 1).
    """
    by = list(by)
    extra = [F.sum(w.cast("long")).alias(n) for n, w in (weights or {}).items()]
    hist = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("t"), *extra)
    cum = running_total(hist, value, "t", by, out_col="cum", num_partitions=num_partitions)
    return cum.withColumn("rank", F.col("cum") - (F.col("t") - 1) / F.lit(2.0))


def mid_ranks(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "rank",
              num_partitions: int | None = None) -> DataFrame:
    """R0 per row: attach the mid-rank of ``value`` (within ``by``) to every row."""
    h = rank_histogram(df, value, by, num_partitions=num_partitions).select(*by, value, F.col("rank").alias(out))
    return df.join(broadcast_if_small(h), [*by, value], "left")


# R1, R2, R12, R13 ----------------------------------------------------------------

def mann_whitney(df: DataFrame, group: Column, value: str) -> DataFrame:
    """Two-sided Mann-Whitney U (tie + continuity corrected normal tail).

    ``group`` is a boolean column: true rows form the first sample. Returns one
    row: n1, n2, u (first sample's U), z, p_value, rank_biserial.
    """
    h = rank_histogram(df.select(F.col(value).alias("v"), group.alias("_g1")), "v",
                       weights={"c1": F.col("_g1")})
    s = h.agg(F.sum("c1").alias("n1"), F.sum("t").alias("n"), F.sum(F.col("c1") * F.col("rank")).alias("r1"),
              F.sum(F.pow(F.col("t").cast("double"), 3) - F.col("t")).alias("tie"))
    n1, n = F.col("n1").cast("double"), F.col("n").cast("double")
    n2 = n - n1
    u1 = F.col("r1") - n1 * (n1 + 1) / 2
    s = s.select(F.col("n1").cast("long").alias("n1"), (F.col("n") - F.col("n1")).cast("long").alias("n2"),
                 u1.alias("u"), n.alias("_n"), F.col("tie"))
    n1, n2, n = F.col("n1").cast("double"), F.col("n2").cast("double"), F.col("_n")
    var = n1 * n2 / 12 * ((n + 1) - F.col("tie") / (n * (n - 1)))
    umax = F.greatest(F.col("u"), n1 * n2 - F.col("u"))
    s = s.withColumn("z", (umax - n1 * n2 / 2 - 0.5) / F.sqrt(var))
    p = F.least(F.lit(1.0), F.lit(2.0) * tails.norm_sf(F.col("z")))
    return s.select("n1", "n2", "u", "z", p.alias("p_value"),
                    (F.lit(1.0) - F.lit(2.0) * F.col("u") / (n1 * n2)).alias("rank_biserial"))


# R3, R4 -----------------------------------------------------------------------------

def shapiro_wilk(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Shapiro-Wilk W and p per group (Royston 1995), with R4's p beside it.

    W is computed for every n >= 3: the order index comes from the distributed
    running count over the value histogram, so no task orders a group. p is
    NULL above the published range (``SW_MAX_N``); ``jb_p_value`` (R4) is
    there for any n. W is NULL for n < 3 and for constant groups.
    """
    by = list(by)
    x = df.select(*by, F.col(value).cast("double").alias("x")).where(F.col("x").isNotNull())
    # the histogram has every moment that is needed, so the rows are read once
    hist = cut_lineage(rank_histogram(x, "x", by).select(*by, "x", "t", "cum"))
    mean = hist.groupBy(*by).agg(F.sum("t").alias("n"), (F.sum(F.col("x") * F.col("t")) / F.sum("t")).alias("xbar"))
    rows = hist.join(broadcast_if_small(mean), by)
    away = F.col("x") - F.col("xbar")
    moments = rows.groupBy(*by, "n").agg(*[F.sum(F.col("t") * F.pow(away, F.lit(k))).alias(f"_s{k}") for k in (2, 3, 4)])
    # one row per order index; a hot value is cut into chunks that are spread over the tasks (a fixed number of
    # them: the chunks are a few bytes before they are unfolded, and adaptive plans would join them all into one task)
    first = F.col("cum") - F.col("t") + 1
    chunks = (rows.where(F.col("n") >= SW_MIN_N).select(*by, "n", "x", "cum", F.explode(F.sequence(first, F.col("cum"), F.lit(ORDER_CHUNK).cast("long")))
                          .alias("_from")).repartition(default_partitions(df.sparkSession), *by, "_from"))
    i = F.col("i")
    scores = (chunks.select(*by, "n", "x", F.explode(F.sequence(
        F.col("_from"), F.least(F.col("_from") + ORDER_CHUNK - 1, F.col("cum")))).alias("i"))
        .withColumn("m", tails.norm_ppf((i - 0.375) / (F.col("n") + 0.25))))
    at = lambda c, k: F.max(F.when(i == k, F.col(c)))
    inner = (i > 2) & (i < F.col("n") - 1)
    g = scores.groupBy(*by, "n").agg(
        F.sum(F.col("m") * F.col("m")).alias("msq"),
        F.sum(F.when(inner, F.col("m") * F.col("x")).otherwise(0.0)).alias("_mid"),
        at("x", F.lit(1)).alias("x1"), at("x", F.lit(2)).alias("x2"), at("x", F.col("n") - 1).alias("xp"),
        at("x", F.col("n")).alias("xn"), at("m", F.col("n")).alias("m_n"), at("m", F.col("n") - 1).alias("m_n1"))
    nd = F.col("n").cast("double")
    u = F.lit(1.0) / F.sqrt(nd)
    # the two largest weights (symmetric to the two smallest); the rest are the scores over sqrt(phi)
    g = (g.withColumn("a_n", F.when(F.col("n") == 3, F.lit(0.5 ** 0.5))
                      .otherwise(F.col("m_n") / F.sqrt("msq") + _poly(u, SW_AN)))
         .withColumn("a_n1", F.col("m_n1") / F.sqrt("msq") + _poly(u, SW_AN1)))
    big = F.col("n") > 5
    phi = F.when(big, (F.col("msq") - 2 * F.col("m_n") ** 2 - 2 * F.col("m_n1") ** 2)
                 / (1 - 2 * F.col("a_n") ** 2 - 2 * F.col("a_n1") ** 2)).otherwise(
        (F.col("msq") - 2 * F.col("m_n") ** 2) / (1 - 2 * F.col("a_n") ** 2))
    ends = F.col("a_n") * (F.col("xn") - F.col("x1"))
    second = F.when(big, F.col("a_n1")).otherwise(F.col("m_n1") / F.sqrt(phi)) * (F.col("xp") - F.col("x2"))
    ax = (F.when(F.col("n") == 3, ends)
          .when(F.col("n") == 4, ends + second)
          .otherwise(ends + second + F.col("_mid") / F.sqrt(phi)))
    g = g.select(*by, ax.alias("_ax"))
    out = moments.join(g, by, "left").withColumn(
        "w", F.least(F.lit(1.0), F.try_divide(F.col("_ax") * F.col("_ax"), F.col("_s2"))))
    out = out.withColumn("w", F.when((F.col("_s2") > 0) & F.col("_ax").isNotNull(), F.col("w")))
    y = F.log(F.lit(1.0) - F.col("w"))
    gamma = _poly(nd, SW_SMALL_GAMMA)
    z_small = (-F.log(gamma - y) - _poly(nd, SW_SMALL_MEAN)) / F.exp(_poly(nd, SW_SMALL_SD))
    ln_n = F.log(nd)
    z_large = (y - _poly(ln_n, SW_LARGE_MEAN)) / F.exp(_poly(ln_n, SW_LARGE_SD))
    p3 = F.greatest(F.lit(0.0), F.lit(6.0 / 3.141592653589793) * (F.asin(F.sqrt("w")) - F.asin(F.sqrt(F.lit(0.75)))))
    p = (F.when(F.col("w").isNull() | (F.col("n") > SW_MAX_N), F.lit(None).cast("double"))
         .when(F.col("w") >= 1, F.lit(1.0))
         .when(F.col("n") == 3, p3)
         .when(F.col("n") <= 11, F.when(y >= gamma, F.lit(0.0)).otherwise(tails.norm_sf(z_small)))
         .otherwise(tails.norm_sf(z_large)))
    m2, m3, m4 = (F.col(f"_s{k}") / nd for k in (2, 3, 4))
    jb = nd / 6.0 * (F.try_divide(m3 * m3, m2 * m2 * m2) + F.pow(F.try_divide(m4, m2 * m2) - 3, F.lit(2)) / 4.0)
    return out.select(*by, "n", "w", p.alias("p_value"), F.exp(-jb / 2.0).alias("jb_p_value"))


def jarque_bera(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Moment normality test for any n: JB = n/6 (S^2 + K^2/4), p = exp(-JB/2).

    Population (biased) skewness and excess kurtosis, as Spark's built-ins.
    """
    by = list(by)
    g = df.groupBy(*by) if by else df.groupBy()
    s = g.agg(F.count(F.col(value)).alias("n"), F.skewness(value).alias("skewness"),
              F.kurtosis(value).alias("excess_kurtosis"))
    jb = F.col("n") / 6.0 * (F.col("skewness") ** 2 + F.col("excess_kurtosis") ** 2 / 4.0)
    return s.select(*by, "n", "skewness", "excess_kurtosis", jb.alias("jb"), F.exp(-jb / 2.0).alias("p_value"))


# R5, R6, R7 ------------------------------------------------------------------------

def contingency(df: DataFrame, group: Column, flag: Column) -> DataFrame:
    """2x2 counts [[a, b], [c, d]] (rows: group true/false, cols: flag true/false),
    expected counts under independence and the smallest one."""
    t = df.agg(count_if(group & flag).alias("a"), count_if(group & ~flag).alias("b"),
               count_if(~group & flag).alias("c"), count_if(~group & ~flag).alias("d"))
    return with_expected(t)


def with_expected(t: DataFrame) -> DataFrame:
    a, b, c, d = (F.col(k).cast("double") for k in "abcd")
    n = a + b + c + d
    e = [(a + b) * (a + c) / n, (a + b) * (b + d) / n, (c + d) * (a + c) / n, (c + d) * (b + d) / n]
    return t.select("a", "b", "c", "d", F.least(*e).alias("min_expected"))


def fisher_exact(table: DataFrame) -> DataFrame:
    """Two-sided Fisher exact test per 2x2 row (a, b, c, d).

    p sums the probabilities pmf <= pmf(observed)*(1+1e-7). The support is
    unimodal, so those are two tails: one starts at the observed cell, the
    other where bisection finds the first value across the mode that is as
    unlikely. Each tail is summed outwards from there until its terms fall
    below ``FISHER_DROP`` of its first one, so the work follows the spread of
    the distribution and never the size of the support. A tail is cut into
    chunks that are spread over the tasks; each starts from a saddle-point
    form in log space.
    """
    a, b, c, d = (F.col(k) for k in "abcd")
    base = table.select("a", "b", "c", "d", (a + b).alias("r1"), (a + c).alias("c1"), (a + b + c + d).alias("nn"))
    r1, c1, nn = F.col("r1"), F.col("c1"), F.col("nn")
    low, high = F.greatest(F.lit(0), r1 + c1 - nn).cast("long"), F.least(r1, c1).cast("long")
    mode = F.floor((r1 + 1).cast("double") * ((c1 + 1).cast("double") / (nn + 2).cast("double"))).cast("long")
    # one row per tail: its j-th value is mode + j to the right, mode - 1 - j to the left, 0 <= j < room
    base = base.withColumn("mode", F.least(high, F.greatest(low, mode)))
    mode = F.col("mode")
    sides = F.explode(F.array(F.struct(F.lit(1).alias("way"), mode.alias("first"), (high - mode + 1).alias("room")),
                              F.struct(F.lit(-1).alias("way"), (mode - 1).alias("first"), (mode - low).alias("room")))).alias("s")

    def log_pmf(k):
        return tails.log_hypergeometric(k, r1, nn - r1, c1)

    def search(start, room, bound):
        """Smallest j from ``start`` on whose log pmf is at most ``bound``; ``room`` if none (it falls with j)."""
        half = lambda s: F.floor((s["x"] + s["y"]) / 2).cast("long")
        pair = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(64)), pair(start, room), lambda s, _: F.when(s["x"] >= s["y"], s).otherwise(
            F.when(log_pmf(F.col("first") + F.col("way") * half(s)) <= bound, pair(s["x"], half(s))).otherwise(pair(half(s) + 1, s["y"]))),
            lambda s: s["y"])

    base = cut_lineage(base.select("a", "b", "c", "d", "r1", "c1", "nn", (log_pmf(a) + F.log1p(F.lit(1e-7))).alias("bound"), sides)
                       .select("a", "b", "c", "d", "r1", "c1", "nn", "bound", "s.*"))
    # where each tail gets unlikely enough, and where its terms end
    base = cut_lineage(base.withColumn("from", search(F.lit(0).cast("long"), F.col("room"), F.col("bound")))
                       .where(F.col("from") < F.col("room")))
    drop = F.log(F.lit(FISHER_DROP))
    first_term = cut_lineage(base.withColumn("end", log_pmf(F.col("first") + F.col("way") * F.col("from")) + drop))
    ends = cut_lineage(first_term.withColumn("to", search(F.col("from"), F.col("room"), F.col("end"))))
    at = lambda j: F.col("first") + F.col("way") * j
    last = F.least(F.col("to"), F.col("room") - 1)
    ends = ends.select("a", "b", "c", "d", "r1", "c1", "nn", F.least(at(F.col("from")), at(last)).alias("x"),
                       F.greatest(at(F.col("from")), at(last)).alias("y"))
    starts = (ends.select("*", F.explode(F.sequence(F.col("x"), F.col("y"), F.lit(FISHER_CHUNK).cast("long"))).alias("_k0"))
              .repartition("_k0"))
    # inside a chunk each term is the one before times the ratio of neighbours, from an exact first term
    top = F.least(F.col("_k0") + FISHER_CHUNK - 1, F.col("y"))
    steps = F.when(top > F.col("_k0"), F.sequence(F.col("_k0"), top - 1)).otherwise(F.array().cast("array<bigint>"))

    def ratio(k):
        k = k.cast("double")
        return (r1 - k) / (k + 1) * ((c1 - k) / (nn - r1 - c1 + k + 1))

    total = F.aggregate(steps, F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")), lambda s, k: F.struct(
        (s["term"] * ratio(k)).alias("term"), (s["sum"] + s["term"] * ratio(k)).alias("sum")), lambda s: s["sum"])
    res = starts.groupBy("a", "b", "c", "d").agg(F.sum(F.exp(log_pmf(F.col("_k0"))) * total).alias("_p"))
    exact = lambda x, y: (F.col(x).cast("decimal(19,0)") * F.col(y).cast("decimal(19,0)")).cast("double")
    odds = F.try_divide(exact("a", "d"), exact("b", "c"))
    return res.select("a", "b", "c", "d", odds.alias("odds_ratio"), F.when(F.col("_p") > 1, F.lit(1.0)).otherwise(F.col("_p")).alias("p_value"))


def cohens_h(p1, p2) -> Column:
    """2 asin sqrt(p1) - 2 asin sqrt(p2)."""
    c1 = p1 if isinstance(p1, Column) else F.col(p1)
    c2 = p2 if isinstance(p2, Column) else F.col(p2)
    return F.lit(2.0) * F.asin(F.sqrt(c1)) - F.lit(2.0) * F.asin(F.sqrt(c2))


# R8 ---------------------------------------------------------------------------------

def group_histogram(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, c): one pass over the rows with map-side partial counts,
    landed once in the shared folder so every later step reads the histogram,
    not the rows."""
    h = (df.where(F.col(value).isNotNull()).groupBy(group, value)
         .agg(F.count(F.lit(1)).alias("c")))
    return cut_lineage(h)


def group_medians(hist: DataFrame, group: str, value: str, count: str = "c") -> DataFrame:
    """Exact median per group from a written (group, value, count) histogram (no group held in one task)."""
    cum = running_total(hist.select(group, value, F.col(count).alias("t")), value, "t", [group], out_col="cum", written=True)
    n = cum.groupBy(group).agg(F.sum("t").alias("n"))
    lo_pos = F.floor((F.col("n") + 1) / 2)
    hi_pos = F.ceil((F.col("n") + 1) / 2)
    j = cum.join(broadcast_if_small(n), group)
    # the value covering position p is the one with cum - t < p <= cum
    covers = lambda pos: (F.col("cum") - F.col("t") < pos) & (pos <= F.col("cum"))
    return j.groupBy(group).agg(
        ((F.max(F.when(covers(lo_pos), F.col(value).cast("double")))
          + F.max(F.when(covers(hi_pos), F.col(value).cast("double")))) / 2).alias("median"))


def value_histogram(df: DataFrame, group: str, value: str) -> DataFrame:
    """The (group, v, c) histogram Levene and Kruskal read; build once to share it."""
    return group_histogram(df.select(group, F.col(value).cast("double").alias("v")), group, "v")


def levene(df: DataFrame, group: str, value: str, hist: DataFrame | None = None) -> DataFrame:
    """Levene's test centred on the median (Brown-Forsythe); one row: k, n, f, p_value.

    Runs on the (group, value) histogram: |x - median| depends only on the
    pair, so every sum is a count-weighted sum over distinct pairs.
    """
    per = hist if hist is not None else value_histogram(df, group, value)
    med = group_medians(per, group, "v")
    z = (per.join(broadcast_if_small(med), group)
         .select(group, "c", F.abs(F.col("v") - F.col("median")).alias("z")))
    gm = z.groupBy(group).agg(F.sum("c").alias("ng"), (F.sum(F.col("c") * F.col("z")) / F.sum("c")).alias("zg"))
    within = (z.join(broadcast_if_small(gm), group)
              .agg(F.sum(F.col("c") * (F.col("z") - F.col("zg")) ** 2).alias("ssw")))
    tot = gm.agg(F.count(F.lit(1)).alias("k"), F.sum("ng").alias("n"),
                 (F.sum(F.col("ng") * F.col("zg")) / F.sum("ng")).alias("zbar"))
    between = (gm.crossJoin(F.broadcast(tot))
               .agg(F.first("k").alias("k"), F.first("n").alias("n"),
                    F.sum(F.col("ng") * (F.col("zg") - F.col("zbar")) ** 2).alias("ssb")))
    r = between.crossJoin(within)
    k, n = F.col("k").cast("double"), F.col("n").cast("double")
    # the statistic is a column before the tail reads it (keeps the tail's expression small)
    r = r.withColumn("f", (n - k) / (k - 1) * F.col("ssb") / F.col("ssw"))
    return r.select(F.col("k").cast("long").alias("k"), F.col("n").cast("long").alias("n"), "f",
                    tails.f_sf(F.col("f"), k - 1, n - k).alias("p_value"))


# R9, R10 --------------------------------------------------------------------------------

def kruskal(df: DataFrame, group: str, value: str, hist: DataFrame | None = None) -> DataFrame:
    """Kruskal-Wallis H (tie corrected), chi-square p with k-1 df, epsilon-squared.

    Rank sums come from the (group, value) histogram and the pooled mid-ranks.
    """
    per = hist if hist is not None else value_histogram(df, group, value)
    pooled = per.groupBy("v").agg(F.sum("c").alias("t"))
    ranks = running_total(pooled, "v", "t", out_col="cum").withColumn(
        "rank", F.col("cum") - (F.col("t") - 1) / F.lit(2.0))
    j = per.join(broadcast_if_small(ranks.select("v", "rank")), "v")
    rs = j.groupBy(group).agg(F.sum("c").alias("ng"), F.sum(F.col("c") * F.col("rank")).alias("rg"))
    # distances of the groups' mean ranks from the overall mean rank: no difference of sums of size n^3
    size = rs.agg(F.count(F.lit(1)).alias("k"), F.sum("ng").alias("n"))
    off = F.col("rg") / F.col("ng") - (F.col("n") + 1) / F.lit(2.0)
    s = rs.crossJoin(F.broadcast(size)).groupBy("k", "n").agg(F.sum(F.col("ng") * off * off).alias("q"))
    tie = ranks.agg(F.sum(F.pow(F.col("t").cast("double"), 3) - F.col("t")).alias("tie"))
    s = s.crossJoin(tie)
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    h0 = F.lit(12.0) / (n * (n + 1)) * F.col("q")
    s = s.withColumn("h", h0 / (F.lit(1.0) - F.col("tie") / (n * n * n - n)))
    h = F.col("h")
    return s.select(F.col("k").cast("long").alias("k"), F.col("n").cast("long").alias("n"), "h",
                    tails.chi2_sf(h, F.col("k") - 1).alias("p_value"),
                    ((h - k + 1) / (n - k)).alias("epsilon_squared"))


# R11 ----------------------------------------------------------------------------------

def spearman(df: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """Spearman rho per group = Pearson correlation of mid-ranks within the group;
    p from the t statistic with n - 2 df."""
    by = list(by)
    # three consumers (two rank histograms and the paired ranks): land the pairs once
    base = cut_lineage(df.select(*by, F.col(x).alias("_x"), F.col(y).alias("_y")).where(
        F.col("_x").isNotNull() & F.col("_y").isNotNull()))
    rx = rank_histogram(base, "_x", by).select(*by, "_x", F.col("rank").alias("rx"))
    ry = rank_histogram(base, "_y", by).select(*by, "_y", F.col("rank").alias("ry"))
    ranked = base.join(rx, [*by, "_x"]).join(ry, [*by, "_y"])
    # Pearson correlation of the ranks; NULL (not an error) for a constant group
    s = ranked.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.covar_pop("rx", "ry").alias("_cov"),
                                F.var_pop("rx").alias("_vx"), F.var_pop("ry").alias("_vy"))
    s = s.withColumn("rho", F.try_divide(F.col("_cov"), F.sqrt(F.col("_vx") * F.col("_vy"))))
    n = F.col("n").cast("double")
    rho = F.col("rho")
    s = s.withColumn("_t", rho * F.sqrt((n - 2) / F.greatest(F.lit(0.0), F.lit(1.0) - rho * rho)))
    p = F.when(F.abs(rho) >= 1, F.lit(0.0)).otherwise(tails.t_sf2(F.col("_t"), F.col("n") - 2))
    return s.select(*by, "n", "rho", F.when(F.col("n") > 2, p).alias("p_value"))
