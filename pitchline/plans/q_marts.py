"""Queries over the comparison marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitchline.operators import marts
from pitchline.operators.quality import range_report
from pitchline.plans import contests as C
from pitchline.plans import oracle as O
from pitchline.plans.registry import ORACLE, cohorts, current_cohort, query



@query("unpivot_roles", O.with_(O.CONTESTS, O.UNPIVOT) +
       "SELECT cohort, role, team_id, goals_for, goals_against FROM team_matches")
def q_unpivot_roles(spark, sf_dir):
    return marts.unpivot_roles(C.contests(spark, sf_dir))


@query("format_comparison", O.with_(O.CONTESTS, O.COHORTS) + f"""
SELECT m.cohort AS tournament_year, c.team_count, c.format_label,
       COUNT(*) AS match_count,
       {O.rnd('AVG(m.home_score + m.away_score)', 2)} AS avg_goals_per_match,
       {O.pct(O.count_if('ABS(m.home_score - m.away_score) = 1'), 'COUNT(*)')} AS pct_one_goal_margin,
       {O.pct(O.count_if('m.home_score = m.away_score'), 'COUNT(*)')} AS pct_drawn_after_et,
       {O.count_if('m.went_to_so')} AS shootout_decided_matches
FROM contests m JOIN cohorts c ON c.cohort = m.cohort
GROUP BY m.cohort, c.team_count, c.format_label""")
def q_format_comparison(spark, sf_dir):
    return marts.format_comparison(C.contests(spark, sf_dir), cohorts(spark, sf_dir))


@query("competitive_balance", O.with_(O.CONTESTS, O.COHORTS) + f"""
SELECT m.cohort AS tournament_year, c.team_count, c.format_label,
       COUNT(*) AS match_count,
       {O.rnd('AVG(ABS(m.home_score - m.away_score))', 2)} AS avg_abs_goal_diff,
       {O.pct(O.count_if('ABS(m.home_score - m.away_score) >= 3'), 'COUNT(*)')} AS blowout_rate_pct
FROM contests m JOIN cohorts c ON c.cohort = m.cohort
GROUP BY m.cohort, c.team_count, c.format_label""")
def q_competitive_balance(spark, sf_dir):
    return marts.competitive_balance(C.contests(spark, sf_dir), cohorts(spark, sf_dir))


@query("group_difficulty", O.with_(O.TEAMS, O.RANKING) + f"""
SELECT t.group_id, t.group_letter,
       COUNT(t.team_id) AS teams_in_group,
       COUNT(r.fifa_ranking) AS teams_counted,
       {O.rnd('AVG(r.fifa_ranking)', 1)} AS avg_fifa_ranking
FROM teams t
LEFT JOIN ranking r ON r.team_id = t.team_id AND r.cohort = {O.CURRENT}
GROUP BY t.group_id, t.group_letter""")
def q_group_difficulty(spark, sf_dir):
    return marts.group_difficulty(C.teams(spark, sf_dir), C.ranking_bridge(spark, sf_dir),
                                  current_cohort(spark, sf_dir))


# A contest between ranked teams is an upset if the score margin and the gap in rank point the same way (the winner
# had the larger rank number).
UPSET_CLASSIFIED = O.with_(O.CONTESTS, O.RANKING) + """
, duels AS (
  SELECT c.cohort, c.home_score - c.away_score AS margin,
         (SELECT fifa_ranking FROM ranking r WHERE r.team_id = c.home_team_id AND r.cohort = c.cohort)
         - (SELECT fifa_ranking FROM ranking r WHERE r.team_id = c.away_team_id AND r.cohort = c.cohort) AS gap
  FROM contests c
), classified AS (SELECT cohort, margin = 0 AS is_draw, margin * gap > 0 AS is_upset FROM duels WHERE gap IS NOT NULL)"""


@query("upset_rate", UPSET_CLASSIFIED + f"""
SELECT cohort AS tournament_year, COUNT(*) AS eligible_match_count, COUNT(*) FILTER (WHERE is_draw) AS draw_count,
       COUNT(*) FILTER (WHERE NOT is_draw) AS decisive_match_count, COUNT(*) FILTER (WHERE is_upset) AS upset_count,
       {O.pct('COUNT(*) FILTER (WHERE is_upset)', 'COUNT(*) FILTER (WHERE NOT is_draw)')} AS upset_rate_pct,
       {O.pct('COUNT(*) FILTER (WHERE is_draw)', 'COUNT(*)')} AS draw_rate_pct
FROM classified GROUP BY cohort""")
def q_upset_rate(spark, sf_dir):
    return marts.upset_rate(C.contests(spark, sf_dir), C.ranking_bridge(spark, sf_dir))


@query("confederation_performance", O.with_(O.CONTESTS, O.TEAMS, O.UNPIVOT) + f"""
SELECT tm.cohort AS tournament_year, t.confederation_name,
       COUNT(*) AS matches_played,
       {O.rnd('SUM(CASE WHEN goals_for > goals_against THEN 1.0 WHEN goals_for = goals_against THEN 0.5 ELSE 0.0 END) / COUNT(*)', 3)} AS win_rate,
       {O.rnd('CAST(SUM(goals_for - goals_against) AS DOUBLE) / COUNT(*)', 2)} AS avg_goal_diff
FROM team_matches tm JOIN teams t ON t.team_id = tm.team_id
GROUP BY tm.cohort, t.confederation_name""")
def q_confederation_performance(spark, sf_dir):
    return marts.confederation_performance(C.contests(spark, sf_dir), C.teams(spark, sf_dir))


@query("expected_vs_actual", O.with_(O.CONTESTS, O.STAGES, O.TEAMS, O.RANKING) + f"""
, staged AS (SELECT m.*, s.stage_order FROM contests m LEFT JOIN stages s ON s.stage_name = m.stage_name)
, tm AS (SELECT cohort, home_team_id AS team_id, stage_order FROM staged
         UNION ALL SELECT cohort, away_team_id, stage_order FROM staged)
, finish AS (SELECT cohort, team_id, COUNT(*) AS matches_played, MAX(stage_order) AS furthest_stage_order
             FROM tm GROUP BY cohort, team_id)
SELECT f.cohort AS tournament_year, t.team_name, r.fifa_ranking, f.matches_played, f.furthest_stage_order,
       CASE WHEN f.cohort = {O.CURRENT} THEN 'stage_order' ELSE 'match_count_proxy' END AS actual_finish_method
FROM finish f
JOIN ranking r ON r.team_id = f.team_id AND r.cohort = f.cohort
JOIN teams t ON t.team_id = f.team_id
WHERE r.fifa_ranking IS NOT NULL""")
def q_expected_vs_actual(spark, sf_dir):
    return marts.expected_vs_actual(C.contests_staged(spark, sf_dir), C.ranking_bridge(spark, sf_dir),
                                    C.teams(spark, sf_dir), current_cohort(spark, sf_dir))


@query("travel_rest", O.with_(O.VISITS, O.VENUES) + f"""
, seq AS (
  SELECT *, LAG(match_id) OVER w AS previous_match_id, LAG(match_date) OVER w AS previous_match_date,
         LAG(venue_id) OVER w AS previous_venue_id
  FROM visits WINDOW w AS (PARTITION BY team_id, cohort ORDER BY match_date, match_id)
)
SELECT s.team_id, s.match_id, s.match_date, s.venue_id, s.previous_match_id, s.previous_venue_id,
       s.previous_match_date,
       {O.rnd('CASE WHEN s.previous_venue_id IS NULL THEN NULL ELSE ' + O.haversine_km('v.latitude', 'v.longitude', 'pv.latitude', 'pv.longitude') + ' END', 3)} AS distance_km,
       CAST(date_diff('day', s.previous_match_date, s.match_date) AS INTEGER) AS rest_days
FROM seq s JOIN venues v ON v.venue_id = s.venue_id
LEFT JOIN venues pv ON pv.venue_id = s.previous_venue_id""")
def q_travel_rest(spark, sf_dir):
    return marts.travel_rest(C.order_visits(spark, sf_dir), C.venues(spark, sf_dir))


# V12 over the travel mart ----------------------------------------------------------

def _invariants_sql() -> str:
    from pitchline.plans.registry import ORACLE
    t = f"({ORACLE['travel_rest']})"
    return O.with_(O.VENUES) + f"""
SELECT 'previous match without rest days' AS invariant,
       CAST(COUNT(*) FILTER (WHERE previous_match_id IS NOT NULL AND rest_days IS NULL) AS BIGINT) AS violations,
       COUNT(*) FILTER (WHERE previous_match_id IS NOT NULL AND rest_days IS NULL) = 0 AS passed FROM {t} a
UNION ALL
SELECT 'previous venue without distance',
       CAST(COUNT(*) FILTER (WHERE previous_venue_id IS NOT NULL AND distance_km IS NULL) AS BIGINT),
       COUNT(*) FILTER (WHERE previous_venue_id IS NOT NULL AND distance_km IS NULL) = 0 FROM {t} b
UNION ALL
SELECT 'venue without coordinates', CAST(COUNT(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL) AS BIGINT),
       COUNT(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL) = 0 FROM venues"""


@query("post_build_invariants", _invariants_sql())
def q_post_build_invariants(spark, sf_dir):
    """A row with a previous match must have a rest gap, a row with a previous
    venue must have a distance, and every venue must have coordinates."""
    from pitchline.operators.quality import assert_zero
    t = q_travel_rest(spark, sf_dir)
    v = C.venues(spark, sf_dir)
    return assert_zero([
        ("previous match without rest days", t, F.col("previous_match_id").isNotNull() & F.col("rest_days").isNull()),
        ("previous venue without distance", t, F.col("previous_venue_id").isNotNull() & F.col("distance_km").isNull()),
        ("venue without coordinates", v, F.col("latitude").isNull() | F.col("longitude").isNull()),
    ])


# V12's report over A8-A10 -----------------------------------------------------------------

@query("travel_ranges", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS measure, MIN(CAST({c} AS DOUBLE)) AS smallest, MAX(CAST({c} AS DOUBLE)) AS largest,
       COUNT(*) - COUNT({c}) AS missing, COUNT(*) FILTER (WHERE {c} < 0) AS negative FROM ({ORACLE['travel_rest']}) t""" for c in ("distance_km", "rest_days")))
def q_travel_ranges(spark, sf_dir):
    return range_report(q_travel_rest(spark, sf_dir), ["distance_km", "rest_days"])
