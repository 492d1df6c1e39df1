"""Queries for the data-quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitchline.operators import quality as Q
from pitchline.plans import contests as C
from pitchline.plans import oracle as O
from pitchline.plans.registry import ORACLE, query
from pitchline.session import scratch_path

# Fixed parameters of the registered checks.
QTY_RANGE = (1, 45)
EVENT_WINDOW = ("2024-01-05", "2024-01-25")
CONTEST_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


# V1 ---------------------------------------------------------------------------

def dup_keys(spark, sf_dir):
    return Q.find_duplicates(C.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


query("dup_keys", """
SELECT l_orderkey, l_linenumber, 'duplicate key (l_orderkey+l_linenumber)' AS detail
FROM lineitem QUALIFY COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""")(dup_keys)


# V2 ---------------------------------------------------------------------------

def _group_lookup(spark, sf_dir):
    # group 'F' is unknown to the lookup: exercises the missed-lookup path
    return C.teams(spark, sf_dir).select("team_id", F.nullif("group_letter", F.lit("F")).alias("group_letter"))


def _mismatch(null_safe):
    def fn(spark, sf_dir):
        m = C.contests(spark, sf_dir).withColumn(
            "row_group", F.char(F.lit(65) + F.col("l_linenumber") % 6))
        return Q.find_mismatches(m, _group_lookup(spark, sf_dir), "home_team_id", "away_team_id", "team_id",
                                 "group_letter", "row_group", CONTEST_KEYS,
                                 cond=F.col("stage_name") == "1-URGENT", null_safe=null_safe)
    return fn


def _mismatch_sql(null_safe):
    """Rows of the stage whose own group is not both teams' group; teams without a known group are NULL."""
    letter = "chr(CAST(65 + l_linenumber % 6 AS INTEGER))"
    agrees = (f"(home IS NOT DISTINCT FROM {letter} AND away IS NOT DISTINCT FROM {letter})" if null_safe
              else f"(home = away AND away = {letter})")
    return O.with_(O.CONTESTS, O.TEAMS) + f"""
, known AS (SELECT team_id, group_letter FROM teams WHERE group_letter <> 'F'),
sides AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                 (SELECT group_letter FROM known WHERE team_id = home_team_id) AS home,
                 (SELECT group_letter FROM known WHERE team_id = away_team_id) AS away
          FROM contests WHERE stage_name = '1-URGENT')
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       'group: expected ' || {letter} || ', found ' || COALESCE(home, 'none') || ' / ' || COALESCE(away, 'none') AS detail
FROM sides WHERE NOT {agrees}"""


query("attr_mismatch", _mismatch_sql(False))(_mismatch(False))
query("attr_mismatch_nullsafe", _mismatch_sql(True))(_mismatch(True))


# V3 ---------------------------------------------------------------------------

def missing_members(spark, sf_dir):
    return Q.find_missing(C.table(spark, sf_dir, "orders"), ["o_orderkey"],
                          C.table(spark, sf_dir, "lineitem"), "l_orderkey", ["o_orderkey"])


query("missing_members", """
SELECT o.o_orderkey, 'value not found in roster' AS detail FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")(missing_members)


def missing_members_null_roster(spark, sf_dir):
    o = C.table(spark, sf_dir, "orders")
    l = C.table(spark, sf_dir, "lineitem")
    # orders without lines give NULL roster entries (left join): NOT IN reports nothing
    roster = o.join(l, o.o_orderkey == l.l_orderkey, "left").select("l_orderkey")
    return Q.find_missing(o, ["o_orderkey"], roster, "l_orderkey", ["o_orderkey"], null_aware=True)


query("missing_members_null_roster", """
SELECT o_orderkey, 'value not found in roster' AS detail FROM orders
WHERE o_orderkey NOT IN (SELECT l.l_orderkey FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey)
""")(missing_members_null_roster)


def missing_members_null_aware(spark, sf_dir):
    """The same check on a roster without NULLs (lines that were returned): now it reports."""
    roster = C.table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    return Q.find_missing(C.table(spark, sf_dir, "orders"), ["o_orderkey"], roster, "l_orderkey", ["o_orderkey"],
                          null_aware=True)


query("missing_members_null_aware", """
SELECT o_orderkey, 'value not found in roster' AS detail FROM orders
EXCEPT SELECT l_orderkey, 'value not found in roster' FROM lineitem WHERE l_returnflag = 'R'
""")(missing_members_null_aware)


# V4, V5 -----------------------------------------------------------------------

def out_of_range(spark, sf_dir):
    return Q.find_out_of_range(C.table(spark, sf_dir, "lineitem"), ["l_quantity", "l_linenumber"],
                               QTY_RANGE[0], QTY_RANGE[1], ["l_orderkey", "l_partkey", "l_suppkey"])


query("out_of_range", f"""
SELECT l_orderkey, l_partkey, l_suppkey,
       'invalid value:' || ' l_quantity=' || COALESCE(CAST(l_quantity AS VARCHAR), 'NULL')
       || ' l_linenumber=' || COALESCE(CAST(l_linenumber AS VARCHAR), 'NULL') AS detail
FROM lineitem
WHERE l_quantity < {QTY_RANGE[0]} OR l_quantity > {QTY_RANGE[1]}
   OR l_linenumber < {QTY_RANGE[0]} OR l_linenumber > {QTY_RANGE[1]}""")(out_of_range)


def outside_window(spark, sf_dir):
    return Q.find_outside_window(C.table(spark, sf_dir, "events"), "ts", *EVENT_WINDOW, ["event_id"])


query("outside_window", f"""
SELECT event_id, 'ts outside the window {EVENT_WINDOW[0]} to {EVENT_WINDOW[1]}' AS detail FROM events
WHERE NOT (CAST(ts AS DATE) BETWEEN DATE '{EVENT_WINDOW[0]}' AND DATE '{EVENT_WINDOW[1]}')""")(outside_window)


# V6 ---------------------------------------------------------------------------

def expected_counts(spark, sf_dir):
    """Orders per status, expected from the second table: the orders that lineitem knows."""
    orders = C.table(spark, sf_dir, "orders")
    known = C.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    exp = (orders.join(known, "o_orderkey").groupBy(F.col("o_orderstatus").alias("category"))
           .agg(F.count(F.lit(1)).alias("expected_count")))
    return Q.compare_counts(orders, "o_orderstatus", exp)


query("expected_counts", """
WITH per AS (SELECT o_orderstatus AS category, COUNT(*) AS actual_count,
                    COUNT(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS expected_count
             FROM orders GROUP BY o_orderstatus)
SELECT category, expected_count, actual_count,
       'o_orderstatus=' || COALESCE(category, 'NULL') || ' expected=' || CAST(expected_count AS VARCHAR)
       || ' actual=' || CAST(actual_count AS VARCHAR) AS detail
FROM per WHERE expected_count <> actual_count""")(expected_counts)


# V7-V9 ------------------------------------------------------------------------

def _runs(spark, sf_dir):
    """(findings, checks) per table; each table is scanned once for all its checks."""
    lineitem, orders, events = (C.table(spark, sf_dir, t) for t in ("lineitem", "orders", "events"))
    plans = [("lineitem", lineitem, [
                 Q.duplicate_check("dup_keys", ["l_orderkey", "l_linenumber"]),
                 Q.range_check("out_of_range", ["l_quantity", "l_linenumber"], *QTY_RANGE, ["l_orderkey", "l_partkey", "l_suppkey"])]),
             ("orders", orders, [Q.missing_check("missing_members", ["o_orderkey"], lineitem, "l_orderkey", ["o_orderkey"])]),
             ("events", events, [Q.window_check("outside_window", "ts", *EVENT_WINDOW, ["event_id"])])]
    return [(Q.run_checks(df, table, checks), checks) for table, df, checks in plans]


def rejects_union(spark, sf_dir):
    """Read back from the table that the run appended its rejects to."""
    runs = [found for found, _ in _runs(spark, sf_dir)]
    return Q.rejects_of(runs, sink=scratch_path(spark, "rejects")).drop("run_id", "rejected_at")


_CHECK_META = [("dup_keys", "lineitem", ["l_orderkey", "l_linenumber"]),
               ("missing_members", "orders", ["o_orderkey"]),
               ("out_of_range", "lineitem", ["l_orderkey", "l_partkey", "l_suppkey"]),
               ("outside_window", "events", ["event_id"])]


def _rejects_sql():
    parts = []
    for name, table, keys in _CHECK_META:
        key = ", ".join(f"COALESCE(CAST({k} AS VARCHAR), 'NULL')" for k in keys)
        parts.append(f"SELECT '{name}' AS check_name, '{table}' AS table_name, concat_ws('|', {key}) AS record_key,"
                     f" detail FROM ({ORACLE[name]}) x")
    return "\nUNION ALL\n".join(parts)


query("rejects_union", _rejects_sql())(rejects_union)


def quality_summary(spark, sf_dir):
    orders = C.table(spark, sf_dir, "orders")
    guards = None
    for name, columns in (("column_guard", ["o_comment", "o_clerk"]), ("column_guard_hit", ["O_ORDERSTATUS"])):
        part = Q.assert_absent(spark, orders, columns, "orders").agg(F.count(F.lit(1)).alias("rows_failed")).select(
            F.lit(name).alias("check_name"), F.lit("orders").alias("table_name"), "rows_failed")
        guards = part if guards is None else guards.unionByName(part)
    return Q.summary_of(_runs(spark, sf_dir), guards, sink=scratch_path(spark, "check-summary")).drop("run_id", "checked_at")


def _summary_sql():
    parts = []
    for name, table, _ in _CHECK_META:
        parts.append(f"""SELECT '{name}' AS check_name, '{table}' AS table_name,
       (SELECT COUNT(*) FROM {table}) AS rows_checked, f.n AS rows_failed, f.n = 0 AS passed,
       CASE WHEN f.n > 0 THEN CAST(f.n AS VARCHAR) || ' failing rows' END AS notes
FROM (SELECT COUNT(*) AS n FROM ({ORACLE[name]}) x) f""")
    parts.append("SELECT 'column_guard', 'orders', COUNT(*), CAST(0 AS BIGINT), TRUE, CAST(NULL AS VARCHAR) FROM orders")
    parts.append("SELECT 'column_guard_hit', 'orders', COUNT(*), CAST(1 AS BIGINT), FALSE, '1 failing rows' FROM orders")
    return "\nUNION ALL\n".join(parts)


query("quality_summary", _summary_sql())(quality_summary)


# V10, V11, V12 ------------------------------------------------------------------

def reconcile_counts(spark, sf_dir):
    o = C.table(spark, sf_dir, "orders")
    l = C.table(spark, sf_dir, "lineitem")
    return Q.reconcile([("orders", o, o.where(F.col("o_orderstatus") != "P")), ("lineitem", l, l)])


query("reconcile_counts", """
SELECT 'orders' AS table_name, (SELECT COUNT(*) FROM orders) AS source_rows,
       (SELECT COUNT(*) FROM orders WHERE o_orderstatus <> 'P') AS target_rows,
       (SELECT COUNT(*) FROM orders) = (SELECT COUNT(*) FROM orders WHERE o_orderstatus <> 'P') AS passed
UNION ALL
SELECT 'lineitem', (SELECT COUNT(*) FROM lineitem), (SELECT COUNT(*) FROM lineitem), TRUE""")(reconcile_counts)


def orphan_fk(spark, sf_dir):
    l = C.table(spark, sf_dir, "lineitem").withColumn(
        "l_partkey_opt", F.when(F.col("l_returnflag") != "N", F.col("l_partkey")))
    o = C.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    p = C.table(spark, sf_dir, "part").where(F.col("p_size") <= 40)
    return Q.orphan_counts(l, [("l_orderkey", "orders", o, "o_orderkey", False),
                               ("l_partkey_opt", "part", p, "p_partkey", True)])


query("orphan_fk", """
WITH a AS (
  SELECT 'l_orderkey' AS fk_column, 'orders' AS dim_name,
         CAST(COUNT(*) AS BIGINT) AS orphan_rows
  FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus <> 'P' AND o.o_orderkey = l.l_orderkey)
  UNION ALL
  SELECT 'l_partkey_opt', 'part', CAST(COUNT(*) AS BIGINT)
  FROM lineitem l WHERE l.l_returnflag <> 'N'
    AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_size <= 40 AND p.p_partkey = l.l_partkey)
)
SELECT fk_column, dim_name, orphan_rows, orphan_rows = 0 AS passed FROM a""")(orphan_fk)


# V13, V14 -----------------------------------------------------------------------

def profile_columns(spark, sf_dir):
    return Q.profile(C.table(spark, sf_dir, "customer"))


def _profile_sql():
    cols = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
            ("c_acctbal", "double"), ("c_mktsegment", "string")]
    parts = []
    for c, t in cols:
        parts.append(f"""SELECT '{c}' AS column_name, '{t}' AS data_type,
       CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count,
       CAST(COUNT(DISTINCT {c}) AS BIGINT) AS distinct_count,
       CAST(MIN({c}) AS VARCHAR) AS example,
       COUNT(DISTINCT {c}) = COUNT(*) AS is_unique
FROM customer""")
    return "\nUNION ALL\n".join(parts)


query("profile_columns", _profile_sql())(profile_columns)


def _supplier_copy(spark, sf_dir):
    s = C.table(spark, sf_dir, "supplier")
    changed = s.withColumn("s_acctbal", F.when(F.col("s_suppkey") % 7 == 0, F.col("s_acctbal") + 1)
                           .otherwise(F.col("s_acctbal")))
    kept = changed.where(F.col("s_suppkey") % 10 != 3)
    extra = s.where(F.col("s_suppkey") % 25 == 0).withColumn(
        "s_suppkey", F.col("s_suppkey") + s.select(F.max("s_suppkey")).scalar())
    return kept.unionByName(extra)


def cross_source_agreement(spark, sf_dir):
    return Q.cross_check(C.table(spark, sf_dir, "supplier"), _supplier_copy(spark, sf_dir),
                         ["s_suppkey"], ["s_nationkey", "s_acctbal"])


query("cross_source_agreement", """
WITH b AS (
  SELECT s_suppkey, s_nationkey,
         CASE WHEN s_suppkey % 7 = 0 THEN s_acctbal + 1 ELSE s_acctbal END AS s_acctbal
  FROM supplier WHERE s_suppkey % 10 <> 3
  UNION ALL
  SELECT s_suppkey + (SELECT MAX(s_suppkey) FROM supplier), s_nationkey, s_acctbal FROM supplier WHERE s_suppkey % 25 = 0
)
SELECT COALESCE(a.s_suppkey, b.s_suppkey) AS s_suppkey,
       a.s_nationkey AS a_s_nationkey, a.s_acctbal AS a_s_acctbal,
       b.s_nationkey AS b_s_nationkey, b.s_acctbal AS b_s_acctbal,
       CASE WHEN b.s_suppkey IS NULL THEN 'ONLY_A' WHEN a.s_suppkey IS NULL THEN 'ONLY_B'
            WHEN a.s_nationkey IS NOT DISTINCT FROM b.s_nationkey
             AND a.s_acctbal IS NOT DISTINCT FROM b.s_acctbal THEN 'MATCH' ELSE 'DIFFER' END AS status
FROM supplier a FULL OUTER JOIN b ON a.s_suppkey = b.s_suppkey""")(cross_source_agreement)
