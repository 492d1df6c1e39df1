"""Data-quality operators on hand-made rows (FIXTURES section 4, cases 1-5)."""

import datetime as dt

from pyspark.sql import functions as F

from pitchline.operators import quality as Q
from pitchline.operators import transform as T

MATCH = "match_date date, home_team string, away_team string, home_score int, away_score int, group_letter string, is_knockout boolean"
D = dt.date(2026, 6, 11)


def _matches(spark, rows):
    return spark.createDataFrame(rows, MATCH)


def test_duplicates_report_every_copy(spark):
    rows = [(D, "A", "B", 1, 0, "A", False)] * 3 + [(D, "C", "D", 1, 0, "B", False), (D, "C", "D", 2, 2, "B", False),
                                                 (D, "E", "F", 0, 0, "C", False)]
    out = Q.find_duplicates(_matches(spark, rows), ["match_date", "home_team", "away_team"])
    assert out.count() == 5
    assert {r.home_team for r in out.collect()} == {"A", "C"}


def test_duplicates_bad_row_fixture_then_clean(spark):
    rows = [(D, "A", "B", 1, 0, "A", False), (D, "C", "D", 1, 0, "B", False), (D, "A", "B", 1, 0, "A", False)]
    df = _matches(spark, rows)
    assert Q.find_duplicates(df, ["match_date", "home_team", "away_team"]).count() == 2
    assert Q.find_duplicates(df.dropDuplicates(), ["match_date", "home_team", "away_team"]).count() == 0


def test_mismatch_three_valued_vs_null_safe(spark):
    roster = spark.createDataFrame([("A", "G1"), ("B", "G1")], "team string, group_letter string")
    m = _matches(spark, [(D, "A", "B", 1, 0, "G1", False),      # agrees
                         (D, "A", "Z", 1, 0, "G1", False),      # Z not in roster
                         (D, "A", "B", 1, 0, "G2", False),      # row disagrees
                         (D, "A", "Z", 1, 0, "G1", True)])      # knockout: not checked
    args = (roster, "home_team", "away_team", "team", "group_letter", "group_letter",
            ["match_date", "home_team", "away_team"])
    cond = ~F.col("is_knockout")
    sql_like = Q.find_mismatches(m, *args, cond=cond, null_safe=False).collect()
    py_like = Q.find_mismatches(m, *args, cond=cond, null_safe=True).collect()
    assert len(sql_like) == 1 and len(py_like) == 2
    assert any(r.detail.endswith("/ none") for r in py_like)


def test_missing_members_anti_vs_not_in(spark):
    m = _matches(spark, [(D, "A", "B", 1, 0, "G", False), (D, "A", "X", 1, 0, "G", False)])
    roster = spark.createDataFrame([("A",), ("B",), (None,)], "team string")
    keys = ["home_team", "away_team"]
    assert Q.find_missing(m, keys, roster, "team", keys).count() == 1
    assert Q.find_missing(m, keys, roster, "team", keys, null_aware=True).count() == 0


def test_out_of_range_detail_never_null(spark):
    m = _matches(spark, [(D, "A", "B", None, 25, "G", False), (D, "C", "D", 1, 1, "G", False)])
    out = Q.find_out_of_range(m, ["home_score", "away_score"], 0, 20, ["home_team"]).collect()
    assert len(out) == 1 and out[0].detail == "invalid value: home_score=NULL away_score=25"


def test_outside_window_inclusive(spark):
    m = _matches(spark, [(dt.date(2026, 6, 11), "A", "B", 1, 0, "G", False),
                         (dt.date(2026, 7, 19), "A", "B", 1, 0, "G", False),
                         (dt.date(2026, 7, 20), "A", "B", 1, 0, "G", False)])
    assert Q.find_outside_window(m, "match_date", "2026-06-11", "2026-07-19", ["match_date"]).count() == 1


def test_compare_counts_full_outer(spark):
    m = spark.createDataFrame([("Group",)] * 3 + [("Final",), ("Bonus",)], "stage string")
    exp = spark.createDataFrame([("Group", 3), ("Final", 1), ("Semifinal", 2)], "category string, expected_count long")
    out = {r.category: (r.expected_count, r.actual_count) for r in Q.compare_counts(m, "stage", exp).collect()}
    assert out == {"Semifinal": (2, 0), "Bonus": (0, 1)}


def test_assert_absent_case_insensitive(spark):
    df = spark.createDataFrame([(1, 2)], "a int, Host_Flag int")
    assert Q.assert_absent(spark, df, ["host_flag", "other"], "t").count() == 1


def test_orphans_nullable_and_loss(spark):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "k long, w long")
    dim = spark.createDataFrame([(1,), (2,), (10,)], "id long")
    out = {r.fk_column: r.orphan_rows for r in Q.orphan_counts(
        fact, [("k", "dim", dim, "id", False), ("w", "dim", dim, "id", True)]).collect()}
    assert out == {"k": 1, "w": 1}
    loss = Q.fact_loss(fact, fact.where("k < 3")).first()
    assert (loss.rows_in, loss.rows_out, loss.passed) == (3, 2, False)


def test_normalize_alias_defined_once(spark):
    v = spark.createDataFrame([("Dallas",), ("Houston",)], "city string")
    assert [r.city for r in T.normalize_values(v, "city", {"Dallas": "Arlington"}).collect()] == ["Arlington", "Houston"]


def test_interval_lookup_strict_raises(spark):
    import pytest
    from pyspark.errors import PySparkException
    wins = spark.createDataFrame([("w1", dt.date(2026, 1, 1), dt.date(2026, 1, 31))],
                                 "window_name string, window_start date, window_end date")
    ok = spark.createDataFrame([(dt.date(2026, 1, 31),)], "d date")
    assert T.interval_lookup(ok, "d", wins).first().window_name == "w1"
    bad = spark.createDataFrame([(dt.date(2026, 2, 1),)], "d date")
    with pytest.raises(PySparkException):
        T.interval_lookup(bad, "d", wins).collect()


def test_profile_and_cross_check(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "x")], "k int, v string")
    p = {r.column_name: r for r in Q.profile(df).collect()}
    assert p["k"].is_unique and p["v"].null_count == 1 and p["v"].distinct_count == 1
    b = spark.createDataFrame([(1, "x"), (2, "y"), (4, "z")], "k int, v string")
    st = {r.k: r.status for r in Q.cross_check(df, b, ["k"], ["v"]).collect()}
    assert st == {1: "MATCH", 2: "DIFFER", 3: "ONLY_A", 4: "ONLY_B"}


def test_many_checks_read_their_table_once(spark, monkeypatch):
    from pitchline.operators import quality
    from pitchline.session import scratch_path
    path = scratch_path(spark, "matches")
    rows = [(D, "A", "B", 1, 0, "G1", False)] * 3 + [(D, "A|B", "C", 1, 99, "G1", False), (D, "A", "B|C", 50, 99, None, False),
                                                  (dt.date(2020, 1, 1), None, "C", None, 1, "G1", True)]
    _matches(spark, rows).write.parquet(path)
    m = spark.read.parquet(path)
    roster = spark.createDataFrame([("A", "G1"), ("B", "G1"), ("C", "G2")], "team string, letter string")
    pair = ["home_team", "away_team"]
    checks = [Q.duplicate_check("twice", pair), Q.range_check("scores", ["home_score", "away_score"], 0, 20, pair),
              Q.window_check("dates", "match_date", "2026-01-01", "2026-12-31", pair),
              Q.missing_check("known", pair, roster, "team", pair),
              Q.missing_check("known_sql", pair, roster, "team", pair, null_aware=True),
              Q.mismatch_check("groups", roster, *pair, "team", "letter", "group_letter", pair, cond=~F.col("is_knockout"))]
    plans = []
    monkeypatch.setattr(quality, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df)
    quality.run_checks(m, "matches", checks)
    assert plans[0].count("parquet") == 1  # the other leaves are the rosters
    monkeypatch.undo()
    found = Q.run_checks(m, "matches", checks)
    got = sorted((r.check_name, r.record_key, r.detail) for r in Q.rejects_of([found], stamp=False).collect())
    alone = [(c.name, c.record_key(), Q.find_duplicates(m, pair) if c.repeated else c.rows(m)) for c in checks]
    want = sorted((name, r.record_key, r.detail) for name, key, rows in alone for r in rows.select(key.alias("record_key"), "detail").collect())
    assert got == want and len([g for g in got if g[0] == "twice"]) == 3  # keys that only print alike are no copies
    s = {r.check_name: (r.rows_checked, r.rows_failed, r.passed) for r in Q.summary_of([(found, checks)], stamp=False).collect()}
    assert s == {c.name: (6, sum(w[0] == c.name for w in want), not any(w[0] == c.name for w in want)) for c in checks}
    empty = Q.run_checks(m.limit(0), "matches", checks)
    assert Q.rejects_of([empty], stamp=False).collect() == []
    assert {(r.check_name, r.rows_failed, r.passed) for r in Q.summary_of([(empty, checks)], stamp=False).collect()} == {(c.name, 0, True) for c in checks}


def test_profile_is_one_scan(spark):
    from pitchline.session import scratch_path
    path = scratch_path(spark, "wide")
    spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("x.y"), F.when(F.col("id") % 2 == 0, "even").alias("t"),
                            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("d")).write.parquet(path)
    df = spark.read.parquet(path)
    for exact in (True, False):
        out = Q.profile(df, exact)
        assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
        p = {r.column_name: r for r in out.collect()}
        assert {n: (r.null_count, r.example) for n, r in p.items()} == {
            "id": (0, "0"), "x.y": (0, "0.0"), "t": (200, "even"), "d": (0, "2024-01-01")}
        if exact:
            assert {n: (r.distinct_count, r.is_unique) for n, r in p.items()} == {
                "id": (400, True), "x.y": (7, False), "t": (1, False), "d": (100, False)}
        else:
            assert p["x.y"].distinct_count == 7 and abs(p["id"].distinct_count - 400) < 40
            assert p["x.y"].quartiles == ["1.0", "3.0", "5.0"] and p["t"].quartiles is None and p["d"].quartiles[1] == "2024-02-19"


def test_windows_over_timestamps_and_numbers(spark):
    import random
    rng = random.Random(2)
    edges = sorted(rng.sample(range(10 ** 7), 20_000))
    wins = [(f"w{k}", a, b - 1) for k, (a, b) in enumerate(zip(edges[::2], edges[1::2])) if b > a]
    wins += [("huge", 2 * 10 ** 7, 10 ** 9), ("point", 1.5 * 10 ** 7, 1.5 * 10 ** 7), ("none", None, 5), ("backwards", 9 * 10 ** 9, 8 * 10 ** 9)]
    values = [rng.randrange(10 ** 7) for _ in range(3000)] + [2 * 10 ** 7, 10 ** 9, 10 ** 9 + 1, 15 * 10 ** 6, 5, None, 85 * 10 ** 8]
    import bisect
    low = sorted((a, b, n) for n, a, b in wins if a is not None and a <= b)
    firsts = [w[0] for w in low]

    def expect(v):
        k = bisect.bisect_right(firsts, v) - 1 if v is not None else -1
        return low[k][2] if k >= 0 and v <= low[k][1] else None

    want = {k: expect(v) for k, v in enumerate(values)}
    numbers = spark.createDataFrame([(k, None if v is None else float(v)) for k, v in enumerate(values)], "k int, v double")
    table = spark.createDataFrame([(n, None if a is None else float(a), float(b)) for n, a, b in wins], "window_name string, window_start double, window_end double")
    out = T.interval_lookup(numbers, "v", table, strict=False)
    assert {r.k: r.window_name for r in out.collect()} == want and out.columns == ["k", "v", "window_name"]
    for kind in ("timestamp_ntz", "timestamp"):
        moment = lambda c, kind=kind: F.timestamp_micros(F.col(c).cast("long")).cast(kind)
        times = T.interval_lookup(numbers.withColumn("v", moment("v")), "v", table.select(
            "window_name", moment("window_start").alias("window_start"), moment("window_end").alias("window_end")), strict=False)
        assert {r.k: r.window_name for r in times.select("k", "window_name").collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan


def test_profile_groups_narrow_rows_by_hash(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, "b", -0.0, None), (1, "a", 0.0, None), (2, None, nan, None), (None, "a", nan, None), (3, "", None, None)],
                               "k long, `s.t` string, x double, gone date")
    out = Q.profile(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "SortAggregate(key=[_" not in plan and "Expand" not in plan
    assert [tuple(r) for r in out.orderBy("column_name").collect()] == [
        ("gone", "date", 5, 0, None, False), ("k", "bigint", 1, 3, "1", False),
        ("s.t", "string", 1, 3, "", False), ("x", "double", 1, 2, out.where("column_name = 'x'").first().example, False)]
    assert out.where("column_name = 'x'").first().example in ("0.0", "-0.0")
    assert [r.example for r in Q.profile(df.where("x = 0 and `s.t` = 'b'")).collect()] == ["1", "b", "-0.0", None]
    assert [tuple(r)[2:] for r in Q.profile(df.limit(0)).collect()] == [(0, 0, None, True)] * 4
