"""Comparison marts over a contest fact.

Input ``matches`` columns: cohort, home_team_id, away_team_id, home_score,
away_score and, where needed, stage_order, went_to_so, match_date, venue_id.
Scores are full time + extra time: a shootout match is a draw everywhere.

Marts aggregate before they join names on, so the joins run on one row per
group instead of one per contest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.functions.columns import (count_if, geo_distance_km, pct, rest_days,
                                         round_half_up)
from pitchline.operators.sequence import lag_within


def unpivot_roles(matches: DataFrame, keep: list[str] | None = None,
                  extra: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """A1: one row per team per match, for/against swapped on the away side.

    A single scan (``inline`` of a two-element array), not a self-union.
    ``extra`` maps output name -> (home column, away column).
    """
    keep = keep or ["cohort"]
    extra = extra or {}
    home = [F.lit("home").alias("role"), F.col("home_team_id").alias("team_id"),
            F.col("home_score").alias("goals_for"), F.col("away_score").alias("goals_against")]
    away = [F.lit("away").alias("role"), F.col("away_team_id").alias("team_id"),
            F.col("away_score").alias("goals_for"), F.col("home_score").alias("goals_against")]
    for name, (h, a) in extra.items():
        home.append(F.col(h).alias(name))
        away.append(F.col(a).alias(name))
    return matches.select(*keep, F.inline(F.array(F.struct(*home), F.struct(*away))))


def _goal_diff() -> Column:
    return F.col("home_score") - F.col("away_score")


def format_comparison(matches: DataFrame, cohorts: DataFrame) -> DataFrame:
    """A2: per cohort: matches, avg total goals, % one-goal margin, % drawn, shootouts."""
    agg = matches.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("match_count"),
        F.avg(F.col("home_score") + F.col("away_score")).alias("_avg_goals"),
        count_if(F.abs(_goal_diff()) == 1).alias("_one_goal"),
        count_if(_goal_diff() == 0).alias("_drawn"),
        count_if(F.col("went_to_so")).alias("shootout_decided_matches"),
    )
    return (agg.join(cohorts, "cohort")
            .select(F.col("cohort").alias("tournament_year"), "team_count", "format_label",
                    "match_count",
                    round_half_up("_avg_goals", 2).alias("avg_goals_per_match"),
                    pct("_one_goal", "match_count", 1).alias("pct_one_goal_margin"),
                    pct("_drawn", "match_count", 1).alias("pct_drawn_after_et"),
                    "shootout_decided_matches"))


def competitive_balance(matches: DataFrame, cohorts: DataFrame) -> DataFrame:
    """A3: per cohort: avg |goal difference| and % of matches won by 3+."""
    agg = matches.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("match_count"),
        F.avg(F.abs(_goal_diff())).alias("_abs"),
        count_if(F.abs(_goal_diff()) >= 3).alias("_blowouts"),
    )
    return (agg.join(cohorts, "cohort")
            .select(F.col("cohort").alias("tournament_year"), "team_count", "format_label",
                    "match_count",
                    round_half_up("_abs", 2).alias("avg_abs_goal_diff"),
                    pct("_blowouts", "match_count", 1).alias("blowout_rate_pct")))


def group_difficulty(teams: DataFrame, ranking: DataFrame, cohort: Column | int) -> DataFrame:
    """A4: per group: members, members with a ranking, avg ranking (1 dp) in ``cohort``.

    Members without a ranking stay in ``teams_in_group`` and drop out of the
    average, so the two counts must be read together.
    """
    cohort_c = cohort if isinstance(cohort, Column) else F.lit(cohort)
    r = ranking.where(F.col("cohort") == cohort_c).select("team_id", "fifa_ranking")
    return (teams.where(F.col("group_id").isNotNull())
            .join(r, "team_id", "left")
            .groupBy("group_id", "group_letter")
            .agg(F.count("team_id").alias("teams_in_group"),
                 F.count("fifa_ranking").alias("teams_counted"),
                 round_half_up(F.avg("fifa_ranking"), 1).alias("avg_fifa_ranking")))


def classify_upsets(matches: DataFrame, ranking: DataFrame) -> DataFrame:
    """Eligible matches (both sides ranked) with is_draw / is_upset flags.

    Equal rankings are never an upset; the larger ranking number is the
    weaker side.
    """
    r = ranking.where(F.col("fifa_ranking").isNotNull())
    hr = r.select(F.col("team_id").alias("home_team_id"), "cohort",
                  F.col("fifa_ranking").alias("home_ranking"))
    ar = r.select(F.col("team_id").alias("away_team_id"), "cohort",
                  F.col("fifa_ranking").alias("away_ranking"))
    e = matches.join(hr, ["home_team_id", "cohort"]).join(ar, ["away_team_id", "cohort"])
    hs, as_ = F.col("home_score"), F.col("away_score")
    hk, ak = F.col("home_ranking"), F.col("away_ranking")
    return e.select("*", (hs == as_).alias("is_draw"),
                    (((hs > as_) & (hk > ak)) | ((as_ > hs) & (ak > hk))).alias("is_upset"))


def upset_rate(matches: DataFrame, ranking: DataFrame) -> DataFrame:
    """A5: per cohort: eligible, draws, decisive, upsets, upset % of decisive, draw % of eligible."""
    c = classify_upsets(matches, ranking)
    agg = c.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("eligible_match_count"),
        count_if(F.col("is_draw")).alias("draw_count"),
        count_if(~F.col("is_draw") & F.col("is_upset")).alias("upset_count"),
    )
    decisive = F.col("eligible_match_count") - F.col("draw_count")
    return agg.select(
        F.col("cohort").alias("tournament_year"), "eligible_match_count", "draw_count",
        decisive.alias("decisive_match_count"), "upset_count",
        pct("upset_count", decisive, 1).alias("upset_rate_pct"),
        pct("draw_count", "eligible_match_count", 1).alias("draw_rate_pct"))


def confederation_performance(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """Per (cohort, confederation): team-matches, win rate (draw = 0.5), avg goal diff."""
    tm = unpivot_roles(matches)
    gf, ga = F.col("goals_for"), F.col("goals_against")
    scored = tm.select("cohort", "team_id", (gf - ga).alias("goal_diff"),
                       F.when(gf > ga, 1.0).when(gf == ga, 0.5).otherwise(0.0).alias("win_eq"))
    # aggregate per team first (bounded by teams x cohorts), then attach names
    per_team = scored.groupBy("cohort", "team_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("win_eq").alias("_w"), F.sum("goal_diff").alias("_gd"))
    agg = (per_team.join(teams, "team_id")
           .groupBy("cohort", "confederation_name")
           .agg(F.sum("_n").alias("matches_played"), F.sum("_w").alias("_w"), F.sum("_gd").alias("_gd")))
    return agg.select(F.col("cohort").alias("tournament_year"), "confederation_name", "matches_played",
                      round_half_up(F.col("_w") / F.col("matches_played"), 3).alias("win_rate"),
                      round_half_up(F.col("_gd") / F.col("matches_played"), 2).alias("avg_goal_diff"))


def expected_vs_actual(matches: DataFrame, ranking: DataFrame, teams: DataFrame,
                       current_cohort: Column | int) -> DataFrame:
    """Per (cohort, team): matches played, furthest stage, ranking, method label.

    Unranked teams are dropped (no expected side to compare).
    """
    cur = current_cohort if isinstance(current_cohort, Column) else F.lit(current_cohort)
    tm = unpivot_roles(matches, keep=["cohort", "stage_order"])
    finish = tm.groupBy("cohort", "team_id").agg(
        F.count(F.lit(1)).alias("matches_played"),
        F.max("stage_order").alias("furthest_stage_order"))
    r = ranking.where(F.col("fifa_ranking").isNotNull()).select("team_id", "cohort", "fifa_ranking")
    return (finish.join(r, ["team_id", "cohort"]).join(teams.select("team_id", "team_name"), "team_id")
            .select(F.col("cohort").alias("tournament_year"), "team_name", "fifa_ranking",
                    "matches_played", "furthest_stage_order",
                    F.when(F.col("cohort") == cur, "stage_order")
                    .otherwise("match_count_proxy").alias("actual_finish_method")))


def travel_rest(visits: DataFrame, venues: DataFrame) -> DataFrame:
    """Previous match per (team, cohort) by (date, match id); distance and rest.

    The LAG sees every match; rows without a venue are dropped afterwards;
    the first match of a team in a cohort has NULL previous columns.
    """
    seq = lag_within(visits, ["team_id", "cohort"], ["match_date", "match_id"],
                     ["match_id", "match_date", "venue_id"])
    v = venues.select("venue_id", "latitude", "longitude")
    pv = venues.select(F.col("venue_id").alias("previous_venue_id"),
                       F.col("latitude").alias("_plat"), F.col("longitude").alias("_plon"))
    out = seq.join(v, "venue_id").join(pv, "previous_venue_id", "left")
    dist = F.when(F.col("previous_venue_id").isNull(), F.lit(None).cast("double")).otherwise(
        geo_distance_km("latitude", "longitude", "_plat", "_plon"))
    return out.select(
        "team_id", "match_id", "match_date", "venue_id",
        "previous_match_id", "previous_venue_id", "previous_match_date",
        round_half_up(dist, 3).alias("distance_km"),
        rest_days("previous_match_date", "match_date").alias("rest_days"))


def consumer_query(published: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """BI-shaped read of a published mart (select + order)."""
    return published.select(*columns).orderBy(*[F.col(c).asc_nulls_last() for c in order])
