"""Semantic layer: named measures, calendar, and the visual-shaped queries.

Measures are AVERAGE or SUM of one mart column evaluated per filter context
(``groupBy``) or as a grand total. Averages of already-rounded per-cohort
values are kept as the reference model defines them (an unweighted mean of
ratios); ``weighted`` gives the count-weighted form next to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed measure catalogue: name -> (mart, aggregation, column).
MEASURES: dict[str, tuple[str, str, str]] = {
    "Avg Abs Goal Diff": ("competitive_balance", "avg", "avg_abs_goal_diff"),
    "Blowout Rate %": ("competitive_balance", "avg", "blowout_rate_pct"),
    "Win Rate": ("confederation_performance", "avg", "win_rate"),
    "Avg Goal Diff (Confederation)": ("confederation_performance", "avg", "avg_goal_diff"),
    "Matches Played (Confederation)": ("confederation_performance", "sum", "matches_played"),
    "Avg FIFA Ranking (Group)": ("group_difficulty", "avg", "avg_fifa_ranking"),
    "Teams Counted": ("group_difficulty", "sum", "teams_counted"),
    "Teams In Group": ("group_difficulty", "sum", "teams_in_group"),
    "Avg Distance Km": ("travel_rest", "avg", "distance_km"),
    "Avg Rest Days": ("travel_rest", "avg", "rest_days"),
    "Team Count": ("format_comparison", "avg", "team_count"),
    "Match Count": ("format_comparison", "sum", "match_count"),
    "Avg Goals per Match": ("format_comparison", "avg", "avg_goals_per_match"),
    "Pct One Goal Margin": ("format_comparison", "avg", "pct_one_goal_margin"),
    "Pct Drawn After ET": ("format_comparison", "avg", "pct_drawn_after_et"),
    "Shootout Decided Matches": ("format_comparison", "sum", "shootout_decided_matches"),
    "Upset Rate %": ("upset_rate", "avg", "upset_rate_pct"),
    "Draw Rate %": ("upset_rate", "avg", "draw_rate_pct"),
    "Eligible Match Count": ("upset_rate", "sum", "eligible_match_count"),
    "Decisive Match Count": ("upset_rate", "sum", "decisive_match_count"),
}


def measure_column(name: str) -> Column:
    _, agg, col = MEASURES[name]
    c = F.avg(col) if agg == "avg" else F.sum(col)
    return c.alias(name)


def measure(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Evaluate measures per group of ``by`` (or as totals when empty)."""
    cols = [measure_column(n) for n in names]
    return df.groupBy(*by).agg(*cols) if by else df.agg(*cols)


def weighted(df: DataFrame, ratio_col: str, weight_col: str, by: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """The count-weighted alternative to an average of ratios."""
    w = (F.sum(F.col(ratio_col) * F.col(weight_col)) / F.sum(weight_col)).alias(out or f"weighted_{ratio_col}")
    return df.groupBy(*by).agg(w) if by else df.agg(w)


def calendar(df: DataFrame, date_col: str) -> DataFrame:
    """B2: every day from 1 Jan of the first year to 31 Dec of the last year in ``date_col``."""
    span = df.agg(F.min(F.year(date_col)).alias("y0"), F.max(F.year(date_col)).alias("y1"))
    days = span.select(F.explode(F.sequence(F.make_date("y0", F.lit(1), F.lit(1)),
                                            F.make_date("y1", F.lit(12), F.lit(31)))).alias("Date"))
    d = F.col("Date")
    qn = ((F.month(d) + 2) / 3).cast("int")
    return days.select("Date", F.year(d).alias("Year"), F.month(d).alias("MonthNo"),
                       F.date_format(d, "MMMM").alias("Month"), qn.alias("QuarterNo"),
                       F.concat(F.lit("Qtr "), qn.cast("string")).alias("Quarter"), F.dayofmonth(d).alias("Day"))


def calendar_join(df: DataFrame, date_col: str, cal: DataFrame, prefix: str = "") -> DataFrame:
    """Join on the date part of ``date_col`` (timestamps included); one role per call."""
    c = cal.select(*[F.col(x).alias(prefix + x) for x in cal.columns])
    return df.join(c, F.to_date(F.col(date_col)) == F.col(prefix + "Date"))


def category_measure(df: DataFrame, category: str, names: Sequence[str], descending: bool = True) -> DataFrame:
    """One category, one or more measures, ordered by the first measure."""
    m = measure(df, names, [category])
    first = F.col(names[0])
    return m.orderBy(first.desc_nulls_last() if descending else first.asc_nulls_last(), category)


def series_measure(df: DataFrame, category: str, series: str, names: Sequence[str]) -> DataFrame:
    """Category x series grid of measures."""
    return measure(df, names, [category, series])


def value_histogram(df: DataFrame, value: str) -> DataFrame:
    """The value as category; SUM of the same value per bar, and the count."""
    return (df.where(F.col(value).isNotNull()).groupBy(value)
            .agg(F.sum(value).alias(f"sum_{value}"), F.count(F.lit(1)).alias("rows")))


def entity_scatter(df: DataFrame, entity: str, sums: Sequence[str], firsts: Sequence[str] = ()) -> DataFrame:
    """Per entity, SUM of the plotted values and the first (min) label."""
    return df.groupBy(entity).agg(*[F.sum(c).alias(f"sum_{c}") for c in sums],
                                  *[F.min(c).alias(f"first_{c}") for c in firsts])
