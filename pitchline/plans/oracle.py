"""SQL text shared by the oracle queries (DuckDB dialect, ANSI where possible).

These strings re-state each query independently of the DataFrame code, over
the same parquet tables, so the two can be compared value by value.
"""

from __future__ import annotations


def rnd(expr: str, scale: int) -> str:
    """Half-away-from-zero rounding through DECIMAL(38,9), as double."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,9)), {scale}) AS DOUBLE)"


def ratio(num: str, den: str) -> str:
    return f"(CAST(({num}) AS DOUBLE) / NULLIF(CAST(({den}) AS DOUBLE), 0))"


def pct(num: str, den: str, scale: int = 1) -> str:
    return rnd(f"100.0 * {ratio(num, den)}", scale)


def count_if(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    p1, p2 = f"radians({lat1})", f"radians({lat2})"
    dphi = f"({p2} - {p1})"
    dl = f"(radians({lon2}) - radians({lon1}))"
    a = f"(pow(sin({dphi} / 2), 2) + cos({p1}) * cos({p2}) * pow(sin({dl} / 2), 2))"
    return f"((2 * 6371008.8) * asin(CASE WHEN sqrt({a}) > 1.0 THEN 1.0 ELSE sqrt({a}) END) / 1000.0)"


CONTESTS = """
contests AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
         CAST(year(o.o_orderdate) AS INTEGER) AS cohort,
         CAST(o.o_orderdate AS DATE) AS match_date,
         CAST(c.c_nationkey AS BIGINT) AS home_team_id,
         CAST(s.s_nationkey AS BIGINT) AS away_team_id,
         CAST(l.l_quantity AS INTEGER) AS home_score,
         CAST(p.p_size AS INTEGER) AS away_score,
         o.o_orderpriority AS stage_name,
         CAST(s.s_nationkey AS BIGINT) AS venue_id,
         l.l_returnflag = 'R' AS went_to_so
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

STAGES = """
stages AS (
  SELECT * FROM (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3),
                        ('4-NOT SPECIFIED', 4), ('5-LOW', 5)) t(stage_name, stage_order)
)"""

TEAMS = """
teams AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS team_id, n.n_name AS team_name,
         CAST(n.n_nationkey % 6 + 1 AS BIGINT) AS group_id,
         chr(CAST(65 + n.n_nationkey % 6 AS INTEGER)) AS group_letter,
         CAST(n.n_regionkey AS BIGINT) AS confederation_id, r.r_name AS confederation_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

VENUES = """
venues AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS venue_id, n.n_name AS city, r.r_name AS country,
         CAST(-60.0 AS DOUBLE) + CAST(5.0 AS DOUBLE) * n.n_nationkey AS latitude,
         CAST(-170.0 AS DOUBLE) + CAST(14.0 AS DOUBLE) * n.n_nationkey AS longitude
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

RANKING = """
spend AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS cohort, CAST(c.c_nationkey AS BIGINT) AS team_id,
         SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS spend
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2
),
ranking AS (
  SELECT team_id, cohort,
         CAST(rank() OVER (PARTITION BY cohort ORDER BY spend DESC) AS INTEGER) AS fifa_ranking,
         make_date(cohort, 1, 1) AS ranking_as_of_date
  FROM spend
)"""

CURRENT = "(SELECT CAST(max(year(o_orderdate)) AS INTEGER) FROM orders)"

COHORTS = """
cohorts AS (
  SELECT cohort, CAST(COUNT(DISTINCT team) AS BIGINT) AS team_count,
         CAST(COUNT(DISTINCT team) AS VARCHAR) || '-team' AS format_label
  FROM (SELECT cohort, home_team_id AS team FROM contests
        UNION ALL SELECT cohort, away_team_id FROM contests) u
  GROUP BY cohort
)"""

VISITS = """
visit_venue AS (
  SELECT l.l_orderkey, MIN(CAST(s.s_nationkey AS BIGINT)) AS venue_id
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY l.l_orderkey
),
visits AS (
  SELECT o.o_custkey AS team_id, o.o_orderkey AS match_id,
         CAST(year(o.o_orderdate) AS INTEGER) AS cohort, CAST(o.o_orderdate AS DATE) AS match_date,
         v.venue_id
  FROM orders o LEFT JOIN visit_venue v ON o.o_orderkey = v.l_orderkey
)"""

UNPIVOT = """
team_matches AS (
  SELECT cohort, side.role AS role, side.team_id AS team_id, side.own AS goals_for, side.other AS goals_against
  FROM (SELECT cohort, unnest([
          {'role': 'home', 'team_id': home_team_id, 'own': home_score, 'other': away_score},
          {'role': 'away', 'team_id': away_team_id, 'own': away_score, 'other': home_score}]) AS side
        FROM contests) both_sides
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"
