"""Marts and dimensional build on hand-made rows (FIXTURES section 4, cases 5-8)."""

import datetime as dt

from pyspark.sql import functions as F

from pitchline.functions.columns import geo_distance_km
from pitchline.operators import dimensions as D
from pitchline.operators import marts as A


def _m(spark, rows):
    return spark.createDataFrame(rows, "cohort int, home_team_id long, away_team_id long, home_score int, away_score int")


def test_upset_rate_eligibility_ties_and_all_draws(spark):
    ranking = spark.createDataFrame(
        [(1, 2026, 10), (2, 2026, 20), (3, 2026, None), (4, 2026, 20), (1, 2022, 5), (2, 2022, 6)],
        "team_id long, cohort int, fifa_ranking int")
    m = _m(spark, [(2026, 1, 2, 0, 1),   # weaker (20) beats stronger (10): upset
                   (2026, 2, 4, 1, 0),   # equal ranks: not an upset
                   (2026, 1, 3, 0, 1),   # team 3 unranked: not eligible
                   (2026, 1, 2, 2, 2),   # draw
                   (2022, 1, 2, 1, 1)])  # every 2022 match drawn
    r = {x.tournament_year: x for x in A.upset_rate(m, ranking).collect()}
    assert (r[2026].eligible_match_count, r[2026].draw_count, r[2026].upset_count) == (3, 1, 1)
    assert r[2026].upset_rate_pct == 50.0
    assert r[2022].decisive_match_count == 0 and r[2022].upset_rate_pct is None


def test_group_difficulty_counts_unranked(spark):
    teams = spark.createDataFrame([(1, 1, "A"), (2, 1, "A"), (3, 2, "B")], "team_id long, group_id long, group_letter string")
    ranking = spark.createDataFrame([(1, 2026, 10), (2, 2026, None), (3, 2026, 7)], "team_id long, cohort int, fifa_ranking int")
    r = {x.group_letter: x for x in A.group_difficulty(teams, ranking, 2026).collect()}
    assert (r["A"].teams_in_group, r["A"].teams_counted, r["A"].avg_fifa_ranking) == (2, 1, 10.0)


def test_rounding_half_away_from_zero(spark):
    m = _m(spark, [(1, 1, 2, 1, 0)] * 1 + [(1, 1, 2, 0, 0)] * 7)  # 1 of 8 by one goal = 12.5 %
    cohorts = spark.createDataFrame([(1, 2, "2-team")], "cohort int, team_count long, format_label string")
    m = m.withColumn("went_to_so", F.lit(False))
    r = A.format_comparison(m, cohorts).first()
    assert r.pct_one_goal_margin == 12.5 and r.avg_goals_per_match == 0.13


def test_travel_rest_lag_scoped_tiebreak_and_venue_gap(spark):
    rows = [
        (1, 10, 2026, dt.date(2026, 6, 1), 1), (1, 11, 2026, dt.date(2026, 6, 5), None),
        (1, 12, 2026, dt.date(2026, 6, 9), 2), (1, 13, 2026, dt.date(2026, 6, 9), 2),
        (1, 5, 2022, dt.date(2022, 12, 1), 1),  # other cohort: LAG must not cross
    ]
    visits = spark.createDataFrame(rows, "team_id long, match_id long, cohort int, match_date date, venue_id long")
    venues = spark.createDataFrame([(1, 10.0, 20.0), (2, 10.0, 20.0)], "venue_id long, latitude double, longitude double")
    out = {r.match_id: r for r in A.travel_rest(visits, venues).collect()}
    assert 11 not in out                       # no venue: dropped after the LAG
    assert out[10].previous_match_id is None and out[5].previous_match_id is None
    assert out[12].previous_match_id == 11 and out[12].distance_km is None and out[12].rest_days == 4
    assert out[13].previous_match_id == 12 and out[13].distance_km == 0.0 and out[13].rest_days == 0


def test_geo_distance_known_pair_and_null(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (1.0, 1.0, None, 1.0)], "a double, b double, c double, d double")
    r = df.select(geo_distance_km("a", "b", "c", "d").alias("km")).collect()
    assert abs(r[0].km - 111.19508) < 1e-3 and r[1].km is None


def test_date_dimension_no_cap_and_gaps(spark):
    ranges = spark.createDataFrame([(dt.date(2026, 1, 1), dt.date(2026, 3, 31)), (dt.date(2022, 11, 20), dt.date(2022, 11, 21))],
                                   "min_date date, max_date date")
    d = D.date_dimension(ranges).orderBy("date_id").collect()
    assert len(d) == 90 + 2 and d[0].full_date == dt.date(2022, 11, 20) and d[0].date_id == 1
    assert d[0].day_of_week == "Sun"


def test_build_fact_loses_unmatched_venue_and_alias(spark):
    raw = spark.createDataFrame(
        [(dt.date(2026, 6, 11), "A", "B", 1, 0, "G", "Dallas", "USA", 2026),
         (dt.date(2026, 6, 11), "B", "A", 2, 0, "G", "Nowhere", "USA", 2026)],
        "match_date date, home_team string, away_team string, home_score int, away_score int, stage string, "
        "venue_city string, venue_country string, tournament_year int")
    dates = spark.createDataFrame([(1, dt.date(2026, 6, 11))], "date_id long, full_date date")
    teams = spark.createDataFrame([(1, "A"), (2, "B")], "team_id long, team_name string")
    tours = spark.createDataFrame([(1, 2026)], "tournament_id long, tournament_year int")
    stages = spark.createDataFrame([(1, "G")], "stage_id long, stage_name string")
    venues = spark.createDataFrame([(1, "Arlington", "USA")], "venue_id long, city string, country string")
    f = D.build_fact(raw, date_dim=dates, team_dim=teams, tournament_dim=tours, order_cols=["match_date", "home_team"],
                     stage_dim=stages, venue_dim=venues, venue_mapping={"Dallas": "Arlington"})
    rows = f.collect()
    assert len(rows) == 1 and rows[0].venue_id == 1 and rows[0].match_id == 1


def test_backfill_idempotent_and_ambiguous_source(spark):
    tgt = spark.createDataFrame([(1, None), (2, None), (3, 5.0)], "k long, lat double")
    src = spark.createDataFrame([(1, 1.5), (2, 2.0), (2, 2.5)], "k long, lat double")
    once = D.backfill(tgt, src, ["k"], ["lat"])
    twice = D.backfill(once, src, ["k"], ["lat"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.k: r.lat for r in once.collect()} == {1: 1.5, 2: None, 3: 5.0}


def test_unpivot_single_scan(spark):
    m = _m(spark, [(1, 1, 2, 3, 1)])
    r = sorted((x.role, x.team_id, x.goals_for, x.goals_against) for x in A.unpivot_roles(m).collect())
    assert r == [("away", 2, 1, 3), ("home", 1, 3, 1)]
    plan = A.unpivot_roles(m)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "Generate" in plan


def test_landed_block_builds_ranking_cohorts_and_year_once(spark):
    import datetime as dt

    from pitchline.operators import marts
    from pitchline.plans import contests as C
    from pitchline.plans.registry import cohorts, current_cohort
    from pitchline.session import scratch_path
    root = scratch_path(spark, "small-tables")
    day = lambda y: dt.datetime(y, 5, 1)
    tables = {
        "customer": ("c_custkey long, c_nationkey int", [(1, 0), (2, 1), (3, None), (4, 2)]),
        "supplier": ("s_suppkey long, s_nationkey int", [(1, 0), (2, 1), (3, 2)]),
        "part": ("p_partkey long, p_size int", [(1, 5), (2, 9)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string, o_totalprice double",
                   [(1, 1, day(1994), "5-LOW", 10.0), (2, 2, day(1994), "5-LOW", 10.0), (3, 3, day(1995), "2-HIGH", 7.0),
                    (4, 4, day(1995), "2-HIGH", None), (5, 1, day(1995), "2-HIGH", 3.0), (5, 2, day(1995), "2-HIGH", 4.0),
                    (6, 1, None, "2-HIGH", 4.0)]),
        "lineitem": ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string",
                     [(o, n, 1 + n % 2, 1 + (o + n) % 3, float(o + n), "R" if n else None) for o in range(1, 7) for n in range(3)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")

    def results():
        return [sorted(map(str, f.collect())) for f in (
            C.ranking_bridge(spark, root), cohorts(spark, root), spark.range(1).select(current_cohort(spark, root)),
            marts.upset_rate(C.contests(spark, root), C.ranking_bridge(spark, root)))]

    plain = results()
    with C.landed_contests(spark, root):
        assert results() == plain
        for frame, name in ((C.ranking_bridge(spark, root), "ranking"), (cohorts(spark, root), "cohorts")):
            files = frame.inputFiles()
            assert files and all(f"/{name}-" in f for f in files)
        upsets = marts.classify_upsets(C.contests(spark, root), C.ranking_bridge(spark, root))
        assert upsets._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 2
