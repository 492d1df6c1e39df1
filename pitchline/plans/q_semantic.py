"""Queries for the semantic layer (B1-B8), publishing (H1) and the consumer read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.functions.columns import round_half_up
from pitchline.operators import semantic as B
from pitchline.operators.marts import consumer_query
from pitchline.plans import contests as C
from pitchline.plans import oracle as O
from pitchline.plans import q_marts as M
from pitchline.plans import q_stats as QS
from pitchline.plans.registry import ORACLE, query
from pitchline.session import scratch_path
from pitchline.sources import publish as P

MEASURE_SCALE = 6
# Published marts (allow-list): the BI layer sees these names and nothing else.
PUBLISHED = ["format_comparison", "competitive_balance", "group_difficulty", "upset_rate",
             "confederation_performance", "expected_vs_actual", "travel_rest", "statistical_validation"]
# Query whose oracle states a mart, where the names differ.
MART_QUERY = {"statistical_validation": "validation_results"}


def _mart_sql(name: str) -> str:
    return f"({ORACLE[MART_QUERY.get(name, name)]})"


def _rounded(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[round_half_up(F.col(f"`{c}`"), MEASURE_SCALE).alias(c) if c in names else F.col(f"`{c}`")
                       for c in df.columns])


def _m(name: str) -> str:
    """SQL text of one measure over its mart alias."""
    _, agg, col = B.MEASURES[name]
    return f"{'AVG' if agg == 'avg' else 'SUM'}({col})"


def _sql_measures(names: list[str]) -> str:
    out = []
    for n in names:
        _, agg, _ = B.MEASURES[n]
        e = _m(n)
        out.append((O.rnd(e, MEASURE_SCALE) if agg == "avg" else f"CAST({e} AS BIGINT)") + f' AS "{n}"')
    return ", ".join(out)


def _spark_measures(df: DataFrame, names: list[str], by: list[str]) -> DataFrame:
    m = B.measure(df, names, by)
    avg_names = [n for n in names if B.MEASURES[n][1] == "avg"]
    sums = [n for n in names if B.MEASURES[n][1] == "sum"]
    m = _rounded(m, avg_names)
    return m.select(*[F.col(f"`{c}`").cast("long").alias(c) if c in sums else F.col(f"`{c}`") for c in m.columns])


FORMAT_MEASURES = ["Team Count", "Match Count", "Avg Goals per Match", "Pct One Goal Margin",
                   "Pct Drawn After ET", "Shootout Decided Matches"]
UPSET_MEASURES = ["Upset Rate %", "Draw Rate %", "Eligible Match Count", "Decisive Match Count"]
BALANCE_MEASURES = ["Avg Abs Goal Diff", "Blowout Rate %"]
CONF_MEASURES = ["Win Rate", "Avg Goal Diff (Confederation)", "Matches Played (Confederation)"]
GROUP_MEASURES = ["Avg FIFA Ranking (Group)", "Teams Counted", "Teams In Group"]
TRAVEL_MEASURES = ["Avg Distance Km", "Avg Rest Days"]


# B1, B8 ----------------------------------------------------------------------------

@query("measures_by_year", f"""
SELECT f.tournament_year, {', '.join(f'f."{n}"' for n in FORMAT_MEASURES)},
       {', '.join(f'u."{n}"' for n in UPSET_MEASURES)}, {', '.join(f'b."{n}"' for n in BALANCE_MEASURES)}
FROM (SELECT tournament_year, {_sql_measures(FORMAT_MEASURES)} FROM {_mart_sql('format_comparison')} m GROUP BY 1) f
JOIN (SELECT tournament_year, {_sql_measures(UPSET_MEASURES)} FROM {_mart_sql('upset_rate')} m GROUP BY 1) u USING (tournament_year)
JOIN (SELECT tournament_year, {_sql_measures(BALANCE_MEASURES)} FROM {_mart_sql('competitive_balance')} m GROUP BY 1) b USING (tournament_year)""")
def measures_by_year(spark, sf_dir):
    with C.landed_contests(spark, sf_dir):
        return _measures_by_year(spark, sf_dir)


def _measures_by_year(spark, sf_dir):
    f = _spark_measures(M.q_format_comparison(spark, sf_dir), FORMAT_MEASURES, ["tournament_year"])
    u = _spark_measures(M.q_upset_rate(spark, sf_dir), UPSET_MEASURES, ["tournament_year"])
    b = _spark_measures(M.q_competitive_balance(spark, sf_dir), BALANCE_MEASURES, ["tournament_year"])
    return f.join(u, "tournament_year").join(b, "tournament_year")


@query("measures_total", f"""
SELECT * FROM (SELECT {_sql_measures(UPSET_MEASURES)} FROM {_mart_sql('upset_rate')} m)
CROSS JOIN (SELECT {_sql_measures(GROUP_MEASURES)} FROM {_mart_sql('group_difficulty')} m)
CROSS JOIN (SELECT {_sql_measures(TRAVEL_MEASURES)} FROM {_mart_sql('travel_rest')} m)""")
def measures_total(spark, sf_dir):
    with C.landed_contests(spark, sf_dir):
        return _measures_total(spark, sf_dir)


def _measures_total(spark, sf_dir):
    u = _spark_measures(M.q_upset_rate(spark, sf_dir), UPSET_MEASURES, [])
    g = _spark_measures(M.q_group_difficulty(spark, sf_dir), GROUP_MEASURES, [])
    t = _spark_measures(M.q_travel_rest(spark, sf_dir), TRAVEL_MEASURES, [])
    return u.crossJoin(g).crossJoin(t)  # one row each


# B2, B3 -----------------------------------------------------------------------------

CAL_SQL = """
cal AS (
  SELECT CAST(d AS DATE) AS "Date", CAST(year(d) AS INTEGER) AS "Year", CAST(month(d) AS INTEGER) AS "MonthNo",
         monthname(d) AS "Month", CAST((month(d) + 2) // 3 AS INTEGER) AS "QuarterNo",
         'Qtr ' || CAST((month(d) + 2) // 3 AS VARCHAR) AS "Quarter", CAST(day(d) AS INTEGER) AS "Day"
  FROM (SELECT unnest(generate_series(make_date(CAST(min(year({col})) AS BIGINT), 1, 1),
                                      make_date(CAST(max(year({col})) AS BIGINT), 12, 31), INTERVAL 1 DAY)) AS d
        FROM {src}) s
)"""


@query("calendar_table", "WITH " + CAL_SQL.format(col="ts", src="events") + "\nSELECT * FROM cal")
def calendar_table(spark, sf_dir):
    return B.calendar(C.table(spark, sf_dir, "events"), "ts")


@query("calendar_join", "WITH " + CAL_SQL.format(
    col="d", src="(SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem) u") + """
, o AS (SELECT c."Year", c."Quarter", COUNT(*) AS orders FROM orders JOIN cal c ON c."Date" = CAST(o_orderdate AS DATE) GROUP BY 1, 2)
, s AS (SELECT c."Year", c."Quarter", COUNT(*) AS lines_shipped FROM lineitem JOIN cal c ON c."Date" = CAST(l_shipdate AS DATE) GROUP BY 1, 2)
SELECT COALESCE(o."Year", s."Year") AS "Year", COALESCE(o."Quarter", s."Quarter") AS "Quarter",
       CAST(COALESCE(o.orders, 0) AS BIGINT) AS orders, CAST(COALESCE(s.lines_shipped, 0) AS BIGINT) AS lines_shipped
FROM o FULL OUTER JOIN s ON o."Year" = s."Year" AND o."Quarter" = s."Quarter\"""")
def calendar_join(spark, sf_dir):
    o = C.table(spark, sf_dir, "orders")
    li = C.table(spark, sf_dir, "lineitem")
    dates = o.select(F.col("o_orderdate").alias("d")).unionByName(li.select(F.col("l_shipdate").alias("d")))
    cal = B.calendar(dates, "d")
    by_order = (B.calendar_join(o, "o_orderdate", cal).groupBy("Year", "Quarter")
                .agg(F.count(F.lit(1)).alias("orders")))
    by_ship = (B.calendar_join(li, "l_shipdate", cal).groupBy("Year", "Quarter")
               .agg(F.count(F.lit(1)).alias("lines_shipped")))
    return (by_order.join(by_ship, ["Year", "Quarter"], "full_outer")
            .select("Year", "Quarter", F.coalesce("orders", F.lit(0)).alias("orders"),
                    F.coalesce("lines_shipped", F.lit(0)).alias("lines_shipped")))


# B4-B7 --------------------------------------------------------------------------------

@query("category_measure", f"""
SELECT tournament_year, {_sql_measures(["Upset Rate %", "Draw Rate %"])} FROM {_mart_sql('upset_rate')} m GROUP BY 1""")
def category_measure(spark, sf_dir):
    m = B.category_measure(M.q_upset_rate(spark, sf_dir), "tournament_year", ["Upset Rate %", "Draw Rate %"])
    return _rounded(m, ["Upset Rate %", "Draw Rate %"])


@query("series_measure", f"""
SELECT confederation_name, tournament_year, {_sql_measures(CONF_MEASURES)}
FROM {_mart_sql('confederation_performance')} m GROUP BY 1, 2""")
def series_measure(spark, sf_dir):
    return _spark_measures(M.q_confederation_performance(spark, sf_dir), CONF_MEASURES,
                           ["confederation_name", "tournament_year"])


@query("value_histogram", f"""
SELECT rest_days, CAST(SUM(rest_days) AS BIGINT) AS sum_rest_days, COUNT(*) AS rows
FROM {_mart_sql('travel_rest')} m WHERE rest_days IS NOT NULL GROUP BY 1""")
def value_histogram(spark, sf_dir):
    return B.value_histogram(M.q_travel_rest(spark, sf_dir), "rest_days")


@query("entity_scatter", f"""
SELECT team_id, {O.rnd('SUM(distance_km)', 3)} AS sum_distance_km, CAST(SUM(rest_days) AS BIGINT) AS sum_rest_days
FROM {_mart_sql('travel_rest')} m GROUP BY 1""")
def entity_scatter(spark, sf_dir):
    s = B.entity_scatter(M.q_travel_rest(spark, sf_dir), "team_id", ["distance_km", "rest_days"])
    return s.select("team_id", round_half_up("sum_distance_km", 3).alias("sum_distance_km"), "sum_rest_days")


@query("entity_scatter_finish", f"""
SELECT team_name, CAST(SUM(fifa_ranking) AS BIGINT) AS sum_fifa_ranking,
       CAST(SUM(furthest_stage_order) AS BIGINT) AS sum_furthest_stage_order,
       MIN(actual_finish_method) AS first_actual_finish_method
FROM {_mart_sql('expected_vs_actual')} m GROUP BY 1""")
def entity_scatter_finish(spark, sf_dir):
    return B.entity_scatter(M.q_expected_vs_actual(spark, sf_dir), "team_name",
                            ["fifa_ranking", "furthest_stage_order"], ["actual_finish_method"])


# H1, A11 --------------------------------------------------------------------------------

def _publish(spark, sf_dir) -> str:
    root = scratch_path(spark, "published")
    marts = {
        "format_comparison": lambda: M.q_format_comparison(spark, sf_dir),
        "competitive_balance": lambda: M.q_competitive_balance(spark, sf_dir),
        "group_difficulty": lambda: M.q_group_difficulty(spark, sf_dir),
        "upset_rate": lambda: M.q_upset_rate(spark, sf_dir),
        "confederation_performance": lambda: M.q_confederation_performance(spark, sf_dir),
        "expected_vs_actual": lambda: M.q_expected_vs_actual(spark, sf_dir),
        "travel_rest": lambda: M.q_travel_rest(spark, sf_dir),
        "statistical_validation": lambda: QS.validation_results(spark, sf_dir),
        "unpivot_roles": lambda: M.q_unpivot_roles(spark, sf_dir),  # not allow-listed: never written
    }
    with C.landed_contests(spark, sf_dir):
        P.publish(marts, PUBLISHED, root)
    return root


@query("publish_allowlist", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS view_name, COUNT(*) AS row_count FROM {_mart_sql(n)} m" for n in PUBLISHED))
def publish_allowlist(spark, sf_dir):
    root = _publish(spark, sf_dir)
    return P.publish_report(spark, root, PUBLISHED)


#: Raw tables and an unlisted mart: none may be readable under the publish root.
WITHHELD = ["lineitem", "orders", "customer", "supplier", "events", "unpivot_roles"]


@query("publish_access", "SELECT * FROM (VALUES ('upset_rate', TRUE), " + ", ".join(f"('{n}', FALSE)" for n in WITHHELD)
       + ") t(name, reachable) WHERE (SELECT COUNT(*) FROM lineitem) > 0")
def q_publish_access(spark, sf_dir):
    """The consumer's side: the published mart is there, nothing raw and nothing unlisted is."""
    root = scratch_path(spark, "published")
    marts = {"upset_rate": lambda: M.q_upset_rate(spark, sf_dir), "unpivot_roles": lambda: M.q_unpivot_roles(spark, sf_dir)}
    P.publish(marts, ["upset_rate"], root)
    return P.access_report(spark, root, ["upset_rate", *WITHHELD])


@query("consumer_query", f"""
SELECT tournament_year, eligible_match_count, upset_count, upset_rate_pct FROM {_mart_sql('upset_rate')} m""")
def q_consumer_query(spark, sf_dir):
    root = scratch_path(spark, "published")
    P.publish({"upset_rate": lambda: M.q_upset_rate(spark, sf_dir)}, ["upset_rate"], root)
    return consumer_query(P.read_published(spark, root, "upset_rate"),
                          ["tournament_year", "eligible_match_count", "upset_count", "upset_rate_pct"],
                          ["tournament_year"])
