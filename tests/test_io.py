"""Sources, sinks, load control and publishing."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pitchline.session import scratch_path
from pitchline.sources import files as S
from pitchline.sources import publish as P

SCHEMA = "tournament_year int, venue_city string, neutral_site boolean, group_letter string"


def _write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w", encoding="utf-8") as fh:
        fh.write(text)


def test_csv_typed_quotes_empty_and_booleans(spark):
    p = scratch_path(spark, "csv")
    _write(p, 'tournament_year,venue_city,neutral_site,group_letter\n1994,"Pasadena, CA",TRUE,\n2026,Toronto,False,A\n')
    rows = sorted(S.read_csv(spark, p, SCHEMA).collect())
    assert rows[0].venue_city == "Pasadena, CA" and rows[0].neutral_site is True and rows[0].group_letter is None
    assert rows[1].neutral_site is False


def test_csv_reordered_header_fails(spark):
    p = scratch_path(spark, "csv-bad")
    _write(p, "venue_city,tournament_year,neutral_site,group_letter\nToronto,2026,TRUE,A\n")
    with pytest.raises(Exception, match="(?s)header|tournament_year"):
        S.read_csv(spark, p, SCHEMA).collect()


def test_load_is_idempotent_and_logged(spark):
    df = spark.range(0, 42)
    target = scratch_path(spark, "t")
    log_path = scratch_path(spark, "log")
    S.load_with_log(df, target, "t", "src.csv", log_path)
    _, log = S.load_with_log(df, target, "t", "src.csv", log_path)
    assert spark.read.parquet(target).count() == 42 and log.first().rows_loaded == 42
    assert spark.read.parquet(log_path).count() == 2


def test_align_schema_and_contract(spark):
    full = spark.createDataFrame([(1, "a", 2.0)], "k int, name string, x double")
    old = spark.createDataFrame([(2, "b")], "k int, name string")
    aligned = S.align_schema(old, full.schema)
    assert aligned.columns == ["k", "name", "x"] and aligned.first().x is None
    assert S.align_schema(aligned, full.schema).columns == aligned.columns
    st = S.assert_source(full, "src", ["k", "name", "x"], 2).first()
    assert st.header_ok and not st.passed
    with pytest.raises(PySparkException):
        S.assert_source(full, "src", ["k", "name", "x"], 2, strict=True).collect()


def test_sorted_csv_export_is_globally_ordered(spark):
    df = spark.range(0, 500).select((F.col("id") * 37 % 500).alias("k"))
    p = scratch_path(spark, "sorted")
    S.write_sorted_csv(df, ["k"], p, num_partitions=5)
    files = sorted(f for f in os.listdir(p) if f.startswith("part-"))
    keys = []
    for f in files:
        with open(os.path.join(p, f), encoding="utf-8") as fh:
            keys += [int(x) for x in fh.read().split()[1:]]
    assert keys == list(range(500))


def test_rebuild_raises_after_writing(spark):
    root = scratch_path(spark, "rebuild")
    steps = [("a", lambda t: spark.range(3)), ("b", lambda t: t["a"].where("id > 0"))]
    tables = S.rebuild(spark, root, steps, lambda t: t["b"].agg((F.count("*") == 2).alias("passed")))
    assert tables["b"].count() == 2
    with pytest.raises(AssertionError):
        S.rebuild(spark, root, steps, lambda t: t["b"].agg((F.count("*") == 3).alias("passed")))


def test_publish_only_allowlisted(spark):
    root = scratch_path(spark, "pub")
    built = []

    def mart(n):
        def thunk():
            built.append(n)
            return spark.range(2)
        return thunk

    P.publish({"a": mart("a"), "b": mart("b"), "secret": mart("secret")}, ["a", "b"], root)
    assert built == ["a", "b"] and P.published_names(spark, root) == ["a", "b"]
    assert {r.view_name for r in P.publish_report(spark, root, ["a", "b"]).collect()} == {"a", "b"}
    with pytest.raises(KeyError):
        P.publish({"a": mart("a")}, ["zzz"], root)


def test_bucketed_partners_join_without_shuffle(spark):
    orders = spark.range(0, 2000).select(F.col("id").alias("ok"), (F.col("id") % 7).alias("cust"))
    lines = spark.range(0, 8000).select((F.col("id") % 2000).alias("ok"), F.col("id").alias("ln"))
    o = S.load_bucketed(orders, "bk_orders", ["ok"], 4, scratch_path(spark, "bk_orders"))
    li = S.load_bucketed(lines, "bk_lines", ["ok"], 4, scratch_path(spark, "bk_lines"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the plan shape at scale
    try:
        j = li.join(o, "ok")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert j.count() == 8000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_load_log_end_time_does_not_move(spark, tmp_path):
    import time
    _, log = S.load_with_log(spark.range(3), str(tmp_path / "t"), "t", "f")
    first = log.first()
    time.sleep(1.1)
    assert log.first() == first and first.load_started_at <= first.load_ended_at


def test_failed_integrity_checks_are_all_written(spark, tmp_path):
    root = str(tmp_path / "build")

    def checks(tables):
        return tables["t"].select(F.concat(F.lit("check "), F.col("id").cast("string")).alias("check"),
                                  (F.col("id") < 3).alias("passed"))

    with pytest.raises(AssertionError, match="_failed_checks"):
        S.rebuild(spark, root, [("t", lambda t: spark.range(50))], checks)
    assert spark.read.parquet(f"{root}/_failed_checks").count() == 47


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    from pitchline import session as PS

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        PS.shared_root(Session())


def test_rejects_and_summaries_are_appended_with_one_time_per_run(spark, tmp_path):
    from pitchline.operators import quality as Q
    src = spark.range(10).withColumn("detail", F.lit("bad"))
    for run in ("r1", "r2"):
        out = Q.collect_rejects([("c", "t", src.where("id > 6"), ["id"])], run_id=run, sink=str(tmp_path / "rejects"))
        assert out.count() == 3 and out.select("rejected_at").distinct().count() == 1
        s = Q.summarize_checks([("c", "t", src, src.where("id > 6")), ("d", "t", src, src.limit(0))], run_id=run,
                               sink=str(tmp_path / "summary"))
        assert sorted((r.check_name, r.rows_checked, r.rows_failed, r.passed) for r in s.collect()) == [
            ("c", 10, 3, False), ("d", 10, 0, True)]
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 6
    assert spark.read.parquet(str(tmp_path / "summary")).count() == 4


def test_contests_over_bucketed_tables_need_no_exchange_on_the_order_key(spark, sf_dir):
    from pitchline.plans import contests as C
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the plan shape at scale
    try:
        o, li = C.bucketed_partners(spark, sf_dir, 4)
        plan = li.join(o, li.l_orderkey == o.o_orderkey)._jdf.queryExecution().executedPlan().toString()
        whole = C.bucketed_contests(spark, sf_dir, 4)
        shuffled = [x for x in whole._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert not any("orderkey" in x for x in shuffled)
    assert whole.count() == C.table(spark, sf_dir, "lineitem").count()


def test_raw_tables_are_not_reachable_under_the_publish_root(spark):
    from pitchline.sources import publish as P
    root = scratch_path(spark, "published")
    P.publish({"mart": lambda: spark.range(3), "secret": lambda: spark.range(5)}, ["mart"], root)
    got = {r.name: r.reachable for r in P.access_report(spark, root, ["mart", "secret", "lineitem"]).collect()}
    assert got == {"mart": True, "secret": False, "lineitem": False}
