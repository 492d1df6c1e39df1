"""Queries for loads (S1-S8), transforms (T1-T7) and the dimensional build."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.operators import dimensions as D
from pitchline.operators import quality as Q
from pitchline.operators import transform as T
from pitchline.operators.keys import append_keys, assign_keys
from pitchline.plans import contests as C
from pitchline.plans import oracle as O
from pitchline.plans.registry import query
from pitchline.session import scratch_path, written
from pitchline.sources import files as S

# Fixed parameters of the registered queries.
YEAR_SET = (1995, 1997)
FROM_DATE = "1997-01-01"
# (window name, first day, last day), inclusive, non-overlapping.
DATE_WINDOWS = [("early", "1990-01-01", "1996-12-31"),
                ("middle", "1997-01-01", "1999-06-30"),
                ("late", "1999-07-01", "2010-12-31")]
SEGMENT_ALIASES = {"HOUSEHOLD": "HOME"}
PRIORITY_ALIASES = {"4-NOT SPECIFIED": "5-LOW"}

NATION_SCHEMA = "n_nationkey int, n_name string, n_regionkey int"


# S1, S2, S6 -------------------------------------------------------------------

@query("csv_roundtrip_scan", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_roundtrip_scan(spark, sf_dir):
    path = scratch_path(spark, "nation-csv")
    S.write_sorted_csv(C.table(spark, sf_dir, "nation"), ["n_nationkey"], path)
    return S.read_csv(spark, path, NATION_SCHEMA)


# S3 ---------------------------------------------------------------------------

@query("load_log", """
SELECT 'supplier' AS target_table, 'supplier.parquet' AS source_file, COUNT(*) AS rows_loaded FROM supplier""")
def load_log(spark, sf_dir):
    _, log = S.load_with_log(C.table(spark, sf_dir, "supplier"), scratch_path(spark, "supplier"),
                             "supplier", "supplier.parquet", log_path=scratch_path(spark, "load-log"))
    return log.select("target_table", "source_file", "rows_loaded")


# S4, S5 -----------------------------------------------------------------------

@query("align_schema_union", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL
SELECT c_custkey, c_name, c_nationkey, CAST(NULL AS DOUBLE), c_mktsegment FROM customer""")
def align_schema_union(spark, sf_dir):
    c = C.table(spark, sf_dir, "customer")
    older = S.align_schema(c.drop("c_acctbal"), c.schema)
    return c.unionByName(older)


@query("source_contract", """
SELECT 'region' AS source, TRUE AS header_ok, (SELECT COUNT(*) FROM region) AS row_count,
       5 AS min_rows, (SELECT COUNT(*) FROM region) >= 5 AS passed
UNION ALL SELECT 'nation, wrong header', FALSE, (SELECT COUNT(*) FROM nation), 5, FALSE
UNION ALL SELECT 'nation, too few rows', TRUE, (SELECT COUNT(*) FROM nation), 1000, (SELECT COUNT(*) FROM nation) >= 1000""")
def source_contract(spark, sf_dir):
    """S5 on a source that fulfils its contract, one with another header and one with too few rows."""
    nation = C.table(spark, sf_dir, "nation")
    return (S.assert_source(C.table(spark, sf_dir, "region"), "region", ["r_regionkey", "r_name"], 5)
            .unionByName(S.assert_source(nation, "nation, wrong header", nation.columns[::-1], 5))
            .unionByName(S.assert_source(nation, "nation, too few rows", nation.columns, 1000)))


# T1, T2, T6 -------------------------------------------------------------------

@query("filter_year_set", f"""
SELECT o_orderkey AS order_id, CAST(year(o_orderdate) AS INTEGER) AS order_year,
       CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS amount
FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) IN {YEAR_SET}""")
def filter_year_set(spark, sf_dir):
    o = T.filter_years(C.table(spark, sf_dir, "orders"), F.col("o_orderpriority") == "1-URGENT",
                       "o_orderdate", YEAR_SET)
    return T.project(o, [("order_id", "o_orderkey"), ("order_year", F.year("o_orderdate")),
                         ("order_date", F.to_date("o_orderdate")), ("amount", "o_totalprice")])


@query("filter_from_date", f"""
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '{FROM_DATE} 00:00:00'""")
def filter_from_date(spark, sf_dir):
    o = T.filter_from_date(C.table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "F", "o_orderdate", FROM_DATE)
    return o.select("o_orderkey", "o_custkey", "o_orderdate")


# T3, T5 -----------------------------------------------------------------------

_WIN_VALUES = ", ".join(f"('{n}', DATE '{a}', DATE '{b}')" for n, a, b in DATE_WINDOWS)


@query("interval_lookup", f"""
WITH w AS (SELECT * FROM (VALUES {_WIN_VALUES}) t(window_name, window_start, window_end))
SELECT o.o_orderkey, w.window_name, w.window_name <> 'early' AS is_after_early
FROM orders o JOIN w ON CAST(o.o_orderdate AS DATE) BETWEEN w.window_start AND w.window_end""")
def interval_lookup(spark, sf_dir):
    wins = spark.createDataFrame(DATE_WINDOWS, "window_name string, s string, e string").select(
        "window_name", F.to_date("s").alias("window_start"), F.to_date("e").alias("window_end"))
    o = T.interval_lookup(C.table(spark, sf_dir, "orders"), "o_orderdate", wins)
    o = T.derive_flag(o, "is_after_early", F.col("window_name") != "early")
    return o.select("o_orderkey", "window_name", "is_after_early")


# T4, T7 -----------------------------------------------------------------------

@query("conditional_lookup", """
SELECT c.c_custkey, CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'HOME' ELSE c.c_mktsegment END AS c_mktsegment,
       CASE WHEN c.c_mktsegment = 'BUILDING' THEN n.n_name END AS nation_name
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def conditional_lookup(spark, sf_dir):
    c = C.table(spark, sf_dir, "customer")
    c = T.lookup_when(c, F.col("c_mktsegment") == "BUILDING", C.table(spark, sf_dir, "nation"),
                      "c_nationkey", "n_nationkey", "n_name", "nation_name")
    c = T.normalize_values(c, "c_mktsegment", SEGMENT_ALIASES)
    return c.select("c_custkey", "c_mktsegment", "nation_name")


# K1, K2 -----------------------------------------------------------------------

def _part_keys(spark, sf_dir):
    return assign_keys(C.table(spark, sf_dir, "part").select("p_partkey", "p_brand"), ["p_brand", "p_partkey"], "id")


@query("surrogate_keys", """
SELECT p_partkey, p_brand, CAST(ROW_NUMBER() OVER (ORDER BY p_brand, p_partkey) AS BIGINT) AS id FROM part""")
def surrogate_keys(spark, sf_dir):
    return _part_keys(spark, sf_dir)


@query("append_keys", """
SELECT o_orderkey, CAST((SELECT COUNT(*) FROM part) + ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS id
FROM orders""")
def append_keys_q(spark, sf_dir):
    o = C.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return append_keys(o, _part_keys(spark, sf_dir), ["o_orderdate", "o_orderkey"], "id").select("o_orderkey", "id")


# D1 ---------------------------------------------------------------------------

def _year_ranges(df: DataFrame, date_col: str, year_col: str = "cohort") -> DataFrame:
    return df.groupBy(year_col).agg(F.min(F.to_date(date_col)).alias("min_date"),
                                    F.max(F.to_date(date_col)).alias("max_date"))


DATE_DIM_SQL = """
ranges AS (SELECT year(o_orderdate) AS y, CAST(MIN(o_orderdate) AS DATE) AS a, CAST(MAX(o_orderdate) AS DATE) AS b
           FROM orders GROUP BY 1),
days AS (SELECT DISTINCT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS full_date FROM ranges),
date_dim AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY full_date) AS BIGINT) AS date_id, full_date,
         CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month,
         CAST(day(full_date) AS INTEGER) AS day, strftime(full_date, '%a') AS day_of_week
  FROM days)"""


@query("date_dimension", "WITH " + DATE_DIM_SQL + "\nSELECT * FROM date_dim")
def date_dimension(spark, sf_dir):
    o = C.table(spark, sf_dir, "orders").withColumn("cohort", F.year("o_orderdate"))
    return D.date_dimension(_year_ranges(o, "o_orderdate"))


# D2, D3, D4 --------------------------------------------------------------------

@query("dim_distinct", """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY p_brand) AS BIGINT) AS brand_id, p_brand
FROM (SELECT DISTINCT p_brand FROM part) t""")
def dim_distinct(spark, sf_dir):
    return D.distinct_dimension(C.table(spark, sf_dir, "part"), ["p_brand"], "brand_id")


@query("dim_ordered", O.with_(O.STAGES) + """
SELECT CAST(s.stage_order AS BIGINT) AS stage_id, o.o_orderpriority AS stage_name, s.stage_order,
       MIN(CAST(o.o_orderdate AS DATE)) AS date_window_start, MAX(CAST(o.o_orderdate AS DATE)) AS date_window_end
FROM orders o JOIN stages s ON s.stage_name = o.o_orderpriority
GROUP BY s.stage_order, o.o_orderpriority""")
def dim_ordered(spark, sf_dir):
    return D.ordered_dimension(C.table(spark, sf_dir, "orders"), "o_orderpriority", C.stages(spark),
                               "stage_name", "stage_order", "o_orderdate", "stage_id")


@query("dim_canonical", """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY o_orderpriority, o_orderstatus) AS BIGINT) AS priority_id,
       o_orderpriority, o_orderstatus, CAST(NULL AS VARCHAR) AS label
FROM (SELECT DISTINCT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '5-LOW' ELSE o_orderpriority END AS o_orderpriority,
             o_orderstatus FROM orders) t""")
def dim_canonical(spark, sf_dir):
    return D.canonical_dimension(C.table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"],
                                 PRIORITY_ALIASES, "o_orderpriority", "priority_id", {"label": "string"})


# D5, D6 -----------------------------------------------------------------------

def _named(spark, sf_dir, tbl, key):
    n = C.table(spark, sf_dir, "nation")
    return C.table(spark, sf_dir, tbl).join(n, F.col(key) == n.n_nationkey).select(F.col("n_name").alias("name"))


@query("dim_entity", """
WITH names AS (
  SELECT n.n_name AS team_name FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
  UNION
  SELECT n.n_name FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
),
cw1 AS (SELECT DISTINCT n.n_name, r.r_name FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
        WHERE n.n_regionkey <> 2),
cw2 AS (SELECT DISTINCT n.n_name, r.r_name FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey),
members AS (SELECT n_name, chr(CAST(65 + n_nationkey % 6 AS INTEGER)) AS g FROM nation),
gdim AS (SELECT g, CAST(ROW_NUMBER() OVER (ORDER BY g) AS BIGINT) AS group_id FROM (SELECT DISTINCT g FROM members) t)
SELECT x.team_name, COALESCE(cw1.r_name, cw2.r_name) AS attribute, gdim.group_id,
       CAST(ROW_NUMBER() OVER (ORDER BY x.team_name) AS BIGINT) AS team_id
FROM names x
LEFT JOIN cw1 ON cw1.n_name = x.team_name
LEFT JOIN cw2 ON cw2.n_name = x.team_name
LEFT JOIN members m ON m.n_name = x.team_name
LEFT JOIN gdim ON gdim.g = m.g""")
def dim_entity(spark, sf_dir):
    n = C.table(spark, sf_dir, "nation")
    r = C.table(spark, sf_dir, "region")
    nr = n.join(r, n.n_regionkey == r.r_regionkey)
    members = n.select("n_name", F.char(F.lit(65) + F.col("n_nationkey") % 6).alias("g"))
    gdim = D.distinct_dimension(members, ["g"], "group_id")
    return D.entity_dimension(
        [(_named(spark, sf_dir, "customer", "c_nationkey"), "name"),
         (_named(spark, sf_dir, "supplier", "s_nationkey"), "name")],
        "team_id", "team_name",
        crosswalks=[(nr.where(F.col("n_regionkey") != 2), "n_name", "r_name"), (nr, "n_name", "r_name")],
        group_dim=(members, gdim, "n_name", "g", "group_id"))


@query("dim_cohort", O.with_(O.CONTESTS, O.COHORTS) + """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY cohort) AS BIGINT) AS tournament_id, cohort, team_count, format_label
FROM cohorts""")
def dim_cohort(spark, sf_dir):
    return D.cohort_dimension(C.contests(spark, sf_dir))


# D7, D8, D10, D11 ----------------------------------------------------------------

def _raw_matches(spark, sf_dir) -> DataFrame:
    """Contests with natural names, the shape a landing table has."""
    t = C.teams(spark, sf_dir)
    v = C.venues(spark, sf_dir)
    m = C.contests(spark, sf_dir)
    return (m.join(t.select(F.col("team_id").alias("home_team_id"), F.col("team_name").alias("home_team")), "home_team_id")
            .join(t.select(F.col("team_id").alias("away_team_id"), F.col("team_name").alias("away_team")), "away_team_id")
            .join(v.select("venue_id", F.col("city").alias("venue_city"), F.col("country").alias("venue_country")),
                  "venue_id")
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.col("cohort").alias("tournament_year"), "match_date", "home_team", "away_team",
                    "home_score", "away_score", F.col("stage_name").alias("stage"), "venue_city", "venue_country",
                    "went_to_so"))


NATURAL_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# lineitem keys can repeat: the score joins the shootout key, and the order
# ends with every remaining fact column (rows tied on all of them are identical)
# (with the cohort, so a filter on it prunes both sides of the join)
SHOOTOUT_KEY = ["tournament_year", *NATURAL_KEY, "home_score"]
FACT_ORDER = ["match_date", "home_team", "away_team", *NATURAL_KEY, "home_score", "away_score"]
FACT_HIST_ORDER = ["tournament_year", *FACT_ORDER]


def _core_dims(spark, sf_dir):
    """The landing table (contests with names, written once to the shared folder)
    and the dimensions built from it; every fact query builds them once."""
    raw = written(_raw_matches(spark, sf_dir), "matches")
    # dimensions are written as tables: their file sizes give the optimizer
    # real statistics, so the fact joins broadcast them (size-checked)
    # instead of shuffling the fact once per dimension
    dates = S.load_table(D.date_dimension(_year_ranges(raw, "match_date", "tournament_year")),
                         scratch_path(spark, "dim_date"))
    tours = S.load_table(D.cohort_dimension(raw, "tournament_year", roles=("home_team", "away_team")),
                         scratch_path(spark, "dim_tournament"))
    stage_dim = S.load_table(D.ordered_dimension(raw, "stage", C.stages(spark), "stage_name", "stage_order",
                                                 "match_date", "stage_id"), scratch_path(spark, "dim_stage"))
    return raw, dates, tours, stage_dim


def _shootouts(raw: DataFrame) -> DataFrame:
    """Shootout side table, one row per key (a left join to it cannot fan out)."""
    return raw.where("went_to_so").select(
        *SHOOTOUT_KEY, F.when(F.col("home_score") >= F.col("away_score"), F.col("home_team"))
        .otherwise(F.col("away_team")).alias("winner")).distinct()


def _fact_current(spark, sf_dir, core):
    raw, dates, tours, stage_dim = core
    cur = raw.select(F.max("tournament_year")).scalar()
    return D.build_fact(raw.where(F.col("tournament_year") == cur).drop("went_to_so"),
                        date_dim=dates, team_dim=C.teams(spark, sf_dir), tournament_dim=tours,
                        order_cols=FACT_ORDER, stage_dim=stage_dim, venue_dim=C.venues(spark, sf_dir),
                        shootouts=_shootouts(raw.where(F.col("tournament_year") == cur)), shootout_keys=SHOOTOUT_KEY)


def _fact_full(spark, sf_dir, core):
    raw, dates, tours, _ = core
    cur = raw.select(F.max("tournament_year")).scalar()
    # written once: the keys of the older rows continue after its largest, and the result reads it again
    current = S.load_table(_fact_current(spark, sf_dir, core), scratch_path(spark, "fact-current"))
    hist = D.build_fact(raw.where(F.col("tournament_year") < cur).drop("went_to_so", "stage", "venue_city",
                                                                         "venue_country"),
                        date_dim=dates, team_dim=C.teams(spark, sf_dir), tournament_dim=tours,
                        order_cols=FACT_HIST_ORDER,
                        shootouts=_shootouts(raw.where(F.col("tournament_year") < cur)), shootout_keys=SHOOTOUT_KEY,
                        existing=current)
    return current.unionByName(hist)


CONTEST_COLUMNS = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, cohort, match_date, home_team_id, away_team_id, home_score, "
                   "away_score, stage_name, venue_id, went_to_so")


@query("bucketed_contests", O.with_(O.CONTESTS) + f"\nSELECT {CONTEST_COLUMNS} FROM contests")
def bucketed_contests(spark, sf_dir):
    """S2's layout in use: lineitem and orders meet without an exchange of either."""
    return C.bucketed_contests(spark, sf_dir).select(*CONTEST_COLUMNS.split(", "))


FACT_SQL = O.with_(O.CONTESTS, O.TEAMS, O.VENUES, O.STAGES, O.COHORTS) + """
, raw AS (
  SELECT m.*, m.cohort AS tournament_year, ht.team_name AS home_team, awt.team_name AS away_team,
         v.city AS venue_city, v.country AS venue_country
  FROM contests m JOIN teams ht ON ht.team_id = m.home_team_id JOIN teams awt ON awt.team_id = m.away_team_id
  JOIN venues v ON v.venue_id = m.venue_id
),
ranges AS (SELECT tournament_year, MIN(match_date) AS a, MAX(match_date) AS b FROM raw GROUP BY 1),
days AS (SELECT DISTINCT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS full_date FROM ranges),
date_dim AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY full_date) AS BIGINT) AS date_id, full_date FROM days),
tours AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY cohort) AS BIGINT) AS tournament_id, cohort AS tournament_year FROM cohorts),
cur AS (SELECT MAX(tournament_year) AS y FROM raw),
so AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, home_score,
              CASE WHEN home_score >= away_score THEN home_team ELSE away_team END AS winner
       FROM raw WHERE went_to_so),
resolved AS (
  SELECT r.*, d.date_id, t.tournament_id, ht.team_id AS home_id, awt.team_id AS away_id, so.winner,
         sw.team_id AS so_winner_id
  FROM raw r JOIN date_dim d ON d.full_date = r.match_date
  JOIN tours t ON t.tournament_year = r.tournament_year
  JOIN teams ht ON ht.team_name = r.home_team JOIN teams awt ON awt.team_name = r.away_team
  LEFT JOIN so ON so.l_orderkey = r.l_orderkey AND so.l_linenumber = r.l_linenumber
              AND so.l_partkey = r.l_partkey AND so.l_suppkey = r.l_suppkey AND so.home_score = r.home_score
  LEFT JOIN teams sw ON sw.team_name = so.winner
),
fact_cur AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY match_date, home_team, away_team, l_orderkey, l_linenumber, l_partkey, l_suppkey, home_score, away_score) AS BIGINT) AS match_id,
         tournament_id, date_id, CAST(s.stage_order AS BIGINT) AS stage_id, v.venue_id, home_id AS home_team_id,
         away_id AS away_team_id, home_score, away_score, CAST(NULL AS BOOLEAN) AS went_to_et,
         winner IS NOT NULL AS went_to_so, so_winner_id, CAST(NULL AS BOOLEAN) AS neutral_site
  FROM resolved x JOIN stages s ON s.stage_name = x.stage_name
  JOIN venues v ON v.city = x.venue_city AND v.country = x.venue_country
  WHERE x.tournament_year = (SELECT y FROM cur)
),
fact_hist AS (
  SELECT CAST((SELECT COALESCE(MAX(match_id), 0) FROM fact_cur)
              + ROW_NUMBER() OVER (ORDER BY tournament_year, match_date, home_team, away_team, l_orderkey, l_linenumber, l_partkey, l_suppkey, home_score, away_score) AS BIGINT) AS match_id,
         tournament_id, date_id, CAST(NULL AS BIGINT) AS stage_id, CAST(NULL AS BIGINT) AS venue_id,
         home_id AS home_team_id, away_id AS away_team_id, home_score, away_score, CAST(NULL AS BOOLEAN) AS went_to_et,
         winner IS NOT NULL AS went_to_so, so_winner_id, CAST(NULL AS BOOLEAN) AS neutral_site
  FROM resolved WHERE tournament_year < (SELECT y FROM cur)
)"""


@query("fact_star_join", FACT_SQL + "\nSELECT * FROM fact_cur")
def fact_star_join(spark, sf_dir):
    return _fact_current(spark, sf_dir, _core_dims(spark, sf_dir))


@query("fact_append_history", FACT_SQL + "\nSELECT * FROM fact_cur UNION ALL SELECT * FROM fact_hist")
def fact_append_history(spark, sf_dir):
    return _fact_full(spark, sf_dir, _core_dims(spark, sf_dir))


@query("natural_view", O.with_(O.CONTESTS, O.TEAMS, O.VENUES) + """
, cur AS (SELECT MAX(cohort) AS y FROM contests)
SELECT m.cohort AS tournament_year, m.match_date, ht.team_name AS home_team, awt.team_name AS away_team,
       m.home_score, m.away_score,
       CASE WHEN m.cohort = (SELECT y FROM cur) THEN m.stage_name END AS stage,
       CASE WHEN m.cohort = (SELECT y FROM cur) THEN v.city END AS venue_city,
       m.went_to_so,
       CASE WHEN m.went_to_so THEN CASE WHEN m.home_score >= m.away_score THEN ht.team_name ELSE awt.team_name END END AS so_winner
FROM contests m JOIN teams ht ON ht.team_id = m.home_team_id JOIN teams awt ON awt.team_id = m.away_team_id
JOIN venues v ON v.venue_id = m.venue_id""")
def natural_view(spark, sf_dir):
    core = _core_dims(spark, sf_dir)
    _, dates, tours, stage_dim = core
    return D.natural_view(_fact_full(spark, sf_dir, core), dates, tours, C.teams(spark, sf_dir), stage_dim,
                          C.venues(spark, sf_dir))


@query("snapshot_bridge", O.with_(O.CONTESTS, O.TEAMS, O.RANKING, O.COHORTS) + """
SELECT r.team_id, t.tournament_id, r.fifa_ranking, r.ranking_as_of_date
FROM ranking r JOIN (SELECT CAST(ROW_NUMBER() OVER (ORDER BY cohort) AS BIGINT) AS tournament_id, cohort FROM cohorts) t
  ON t.cohort = r.cohort""")
def snapshot_bridge(spark, sf_dir):
    teams = C.teams(spark, sf_dir)
    snap = (C.ranking_bridge(spark, sf_dir).join(teams.select("team_id", "team_name"), "team_id")
            .select(F.col("team_name").alias("team"), F.col("cohort").alias("tournament_year"),
                    "fifa_ranking", "ranking_as_of_date"))
    tours = D.cohort_dimension(C.contests(spark, sf_dir)).withColumnRenamed("cohort", "tournament_year")
    return D.snapshot_bridge(snap, teams, tours)


# D9 ---------------------------------------------------------------------------

@query("backfill_update", """
WITH src AS (
  SELECT CAST(s_nationkey AS BIGINT) AS venue_id,
         CAST(-60.0 AS DOUBLE) + CAST(5.0 AS DOUBLE) * s_nationkey AS latitude,
         CAST(-170.0 AS DOUBLE) + CAST(14.0 AS DOUBLE) * s_nationkey AS longitude
  FROM supplier
), agreed AS (SELECT venue_id, MIN(latitude) AS latitude, MIN(longitude) AS longitude FROM src
              GROUP BY venue_id HAVING COUNT(DISTINCT latitude) = 1 AND COUNT(DISTINCT longitude) = 1)
SELECT CAST(n.n_nationkey AS BIGINT) AS venue_id, n.n_name AS city, u.latitude, u.longitude
FROM nation n LEFT JOIN agreed u ON u.venue_id = n.n_nationkey""")
def backfill_update(spark, sf_dir):
    target = C.venues(spark, sf_dir).select(
        "venue_id", "city", F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"))
    k = F.col("s_nationkey")
    source = C.table(spark, sf_dir, "supplier").select(
        k.cast("long").alias("venue_id"), (F.lit(C.LAT_BASE) + F.lit(C.LAT_STEP) * k).alias("latitude"),
        (F.lit(C.LON_BASE) + F.lit(C.LON_STEP) * k).alias("longitude"))
    # every supplier is a source for its nation; they agree, so all nations are filled
    return D.backfill(target, source, ["venue_id"], ["latitude", "longitude"])


@query("backfill_conflicts", """
SELECT CAST(s_nationkey AS BIGINT) AS venue_id, 'source rows disagree' AS reason
FROM supplier GROUP BY s_nationkey HAVING COUNT(DISTINCT s_suppkey % 2) > 1""")
def backfill_conflicts(spark, sf_dir):
    """Sources that differ within a nation (by the parity of the supplier) are reported, not applied."""
    source = C.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("long").alias("venue_id"),
                                                       (F.col("s_suppkey") % 2).alias("latitude"))
    return D.backfill_conflicts(source, ["venue_id"], ["latitude"])


# S8 ---------------------------------------------------------------------------

@query("full_rebuild", FACT_SQL + """
SELECT 'dim_date' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM date_dim
UNION ALL SELECT 'dim_tournament', COUNT(*) FROM tours
UNION ALL SELECT 'dim_team', COUNT(*) FROM teams
UNION ALL SELECT 'fact_match', (SELECT COUNT(*) FROM fact_cur) + (SELECT COUNT(*) FROM fact_hist)""")
def full_rebuild(spark, sf_dir):
    core = _core_dims(spark, sf_dir)
    raw, dates, tours, _ = core
    root = scratch_path(spark, "rebuild")
    steps = [
        ("dim_date", lambda t: dates),
        ("dim_tournament", lambda t: tours),
        ("dim_team", lambda t: C.teams(spark, sf_dir)),
        ("fact_match", lambda t: _fact_full(spark, sf_dir, core), ["tournament_id"]),
    ]

    def checks(t):
        orphans = Q.orphan_counts(t["fact_match"], [
            ("date_id", "dim_date", t["dim_date"], "date_id", False),
            ("tournament_id", "dim_tournament", t["dim_tournament"], "tournament_id", False),
            ("home_team_id", "dim_team", t["dim_team"], "team_id", False),
            ("away_team_id", "dim_team", t["dim_team"], "team_id", False),
            ("so_winner_id", "dim_team", t["dim_team"], "team_id", True)])
        loss = Q.fact_loss(raw, t["fact_match"], "fact rows in = rows out")
        return (orphans.select(F.concat(F.lit("orphans in "), "fk_column").alias("check"), "passed")
                .unionByName(loss.select(F.col("invariant").alias("check"), "passed")))

    tables = S.rebuild(spark, root, steps, checks)
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out
