"""Change capture, apply, equivalence and stream replay (FIXTURES section 4, case 10)."""

import datetime as dt

from pyspark.sql import functions as F

from pitchline.operators import cdc as I
from pitchline.session import scratch_path
from pitchline.streaming import changes as ST

RAW = "match_id long, home string, away string, hs int, as_ int"


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_diff_all_change_kinds(spark):
    old = _raw(spark, [(1, "A", "B", 1, 0), (2, "C", "D", 0, 0), (3, "E", "F", 2, 2), (4, "G", "H", None, 1)])
    new = _raw(spark, [(1, "A", "B", 1, 0),          # no-op
                       (2, "C", "D", 3, 0),          # score update
                       (5, "E", "F", 2, 2),          # key update: delete 3 + insert 5
                       (4, "G", "H", None, 1),       # NULL compared null-safe: no-op
                       (6, "Q", "R", 1, 1)])         # insert (unknown team downstream)
    ch = {r.match_id: r.change_type for r in I.diff_snapshots(old, new, ["match_id"], ["home", "away", "hs", "as_"]).collect()}
    assert ch == {2: "UPDATE", 3: "DELETE", 5: "INSERT", 6: "INSERT"}


def test_apply_routes_unapplicable_changes_to_rejects(spark):
    teams = spark.createDataFrame([("A", 1), ("B", 2), ("E", 3), ("F", 4)], "name string, team_id long")
    fact = spark.createDataFrame([(10, 1, 1, 2, 1, 0), (11, 3, 3, 4, 2, 2)], "sk long, match_id long, h long, a long, hs int, as_ int")
    changes = spark.createDataFrame(
        [(1, "A", "B", 5, 0, "UPDATE"), (9, "A", "B", 1, 1, "UPDATE"), (3, "E", "F", 2, 2, "DELETE"),
         (7, "E", "A", 0, 1, "INSERT"), (8, "Q", "A", 0, 1, "INSERT")],
        "match_id long, home string, away string, hs int, as_ int, change_type string")
    upd = I.apply_updates(fact, changes, ["match_id"], ["hs", "as_"])
    assert {r.match_id: r.hs for r in upd.collect()} == {1: 5, 3: 2}
    resolved, unresolved = I.resolve_inserts(changes, [(teams.withColumnRenamed("team_id", "h"), "home", "name", "h"),
                                                      (teams.withColumnRenamed("team_id", "a"), "away", "name", "a")])
    out = I.apply_inserts(upd, resolved.select("match_id", "h", "a", "hs", "as_"), "sk", ["match_id"])
    assert sorted(r.sk for r in out.collect()) == [10, 11, 12]
    rej = {r.match_id: r.reason for r in I.reject_changes(fact, changes, ["match_id"], unresolved).collect()}
    assert rej == {9: "update key not found", 3: "delete not applied", 8: "unknown home"}


def test_content_hash_order_insensitive_duplicate_aware(spark):
    a = _raw(spark, [(1, "A", "B", 1, 0), (2, "C", "D", 0, 0)])
    b = _raw(spark, [(2, "C", "D", 0, 0), (1, "A", "B", 1, 0)])
    c = _raw(spark, [(1, "A", "B", 1, 0), (1, "A", "B", 1, 0)])
    cols = ["match_id", "home", "away", "hs", "as_"]
    assert I.content_hash(a, cols).first() == I.content_hash(b, cols).first()
    assert I.content_hash(a, cols).first() != I.content_hash(c, cols).first()
    same = I.assert_same(a, b, cols, "x").first()
    diff = I.assert_same(a, c, cols, "y").first()
    assert same.equal and not diff.equal and (diff.only_a, diff.only_b) == (1, 1)


def test_rows_that_print_alike_have_different_digests(spark):
    text = spark.createDataFrame([("a|=b", "c")], "x string, y string")
    moved = spark.createDataFrame([("a", "b|=c")], "x string, y string")
    pairs = [(text, moved, ["x", "y"])]
    for x, y, kind in ((1.0, 1.0000000000000002, "double"), ("", None, "string"), ("~", None, "string"), (bytearray(b"\x0a"), bytearray(b"\x0b"), "binary"),
                       (["a", "b"], ["a,b"], "array<string>"), ([None], ["~"], "array<string>"), ([], None, "array<string>"),
                       ((1, "2"), (12, ""), "struct<p:int,q:string>"), ({"a": "b"}, {"a": None}, "map<string,string>")):
        pairs.append((spark.createDataFrame([(x,)], f"v {kind}"), spark.createDataFrame([(y,)], f"v {kind}"), ["v"]))
    for a, b, cols in pairs:
        assert I.content_hash(a, cols).first() != I.content_hash(b, cols).first()
        r = I.assert_same(a, b, cols, "x").first()
        assert not r.equal and (r.only_a, r.only_b) == (1, 1)
    zero, minus = (spark.createDataFrame([(v,)], "v double") for v in (0.0, -0.0))
    assert I.assert_same(zero, minus, ["v"], "zeros").first().equal


def test_one_changed_row_reads_one_leaf(spark):
    cols = ["k", "v"]
    a = spark.range(500).select(F.col("id").alias("k"), (F.col("id") / 3).alias("v"))
    b = a.withColumn("v", F.when(F.col("k") == 77, F.col("v") + 1e-12).otherwise(F.col("v")))
    ta, tb = (I.digest_tree(t, ["k"], cols, fanout=4, depth=3) for t in (a, b))
    leaf = a.where("k = 77").select(I.leaf_of(a, ["k"], 64)).first()[0]
    assert I.differing_leaves(ta, tb, 4, 3) == [leaf] and I.differing_leaves(ta, ta, 4, 3) == []
    levels = {r.level: r for r in ta.groupBy("level").agg(F.sum("rows").alias("n"), F.sum("h2").alias("h")).collect()}
    assert {x.n for x in levels.values()} == {500} and len({x.h for x in levels.values()}) == 1 and set(levels) == {0, 1, 2, 3}
    pa, pb = (scratch_path(spark, "digested") for _ in "ab")
    I.write_digested(a, pa, ["k"], cols, 4, 3)
    I.write_digested(b, pb, ["k"], cols, 4, 3)
    diff = I.changed_rows(spark, pa, pb, cols, 4, 3)
    assert sorted((r.side, r.k) for r in diff.collect()) == [("a", 77), ("b", 77)]
    scans = diff._jdf.queryExecution().executedPlan().toString()
    assert "_leaf#" in scans and f"= {leaf})" in scans.split("PartitionFilters:", 1)[1].split("]", 1)[0]
    assert I.changed_rows(spark, pa, pa, cols, 4, 3).collect() == []
    empty = a.limit(0)
    assert I.assert_same(empty, empty, cols, "x").first().equal and not I.assert_same(a, empty, cols, "x").first().equal


def test_diff_takes_null_keys_and_repeated_keys(spark):
    schema = "k string, j int, v double"
    old = spark.createDataFrame([(None, 1, 1.0), ("a", None, 2.0), ("b", 1, None), ("r", 1, 1.0), ("r", 1, 2.0), ("s", 1, 1.0), ("s", 1, 1.0)], schema)
    new = spark.createDataFrame([(None, 1, 1.0), ("a", None, 3.0), ("b", 1, None), ("r", 1, 2.0), ("r", 1, 1.0), ("s", 1, 1.0), (None, None, 4.0)], schema)
    got = sorted((tuple(r) for r in I.diff_snapshots(old, new, ["k", "j"], ["v"]).collect()), key=repr)
    assert got == sorted([("a", None, 3.0, "UPDATE"), (None, None, 4.0, "INSERT"), ("s", 1, 1.0, "DELETE"), ("s", 1, 1.0, "DELETE"),
                          ("s", 1, 1.0, "INSERT")], key=repr)
    assert I.diff_snapshots(new, new, ["k", "j"], ["v"]).collect() == []


def test_net_changes_do_not_depend_on_the_order_of_equal_sequence_numbers(spark):
    rows = [(1, 1.0, "UPDATE", 5), (1, 2.0, "UPDATE", 5), (2, 1.0, "UPDATE", 1), (2, 1.0, "INSERT", 1), (3, 1.0, "DELETE", 1), (3, 1.0, "INSERT", 1)]
    for order in (rows, rows[::-1]):
        net = I.net_changes(spark.createDataFrame(order, STREAM).coalesce(1), ["k"], "seq")
        assert sorted(tuple(r) for r in net.collect()) == [(1, 2.0, "UPDATE"), (2, 1.0, "INSERT")]


def test_point_mutations_and_first_without_match(spark):
    o = spark.createDataFrame([(1, dt.date(2026, 1, 2)), (2, dt.date(2026, 1, 1)), (3, dt.date(2026, 1, 1))],
                              "k long, d date")
    other = spark.createDataFrame([(3,)], "k2 long")
    first = I.first_without_match(o, other, ["k"], ["k2"], ["d", "k"]).collect()
    assert [r.k for r in first] == [2]
    df = I.insert_rows(o, spark.createDataFrame([(4, dt.date(2026, 1, 3))], "k long, d date"))
    df = I.update_where(df, F.col("k") == 4, {"d": F.lit(dt.date(2026, 2, 1))})
    df = I.delete_where(df, F.col("k") == 1)
    assert sorted((r.k, r.d.month) for r in df.collect()) == [(2, 1), (3, 1), (4, 2)]


STREAM = "k long, v double, change_type string, seq long"


def _accept(state, net):
    known = state.select("k")
    good = net.where("change_type = 'UPDATE'").join(known, "k", "left_semi").unionByName(
        net.where("change_type = 'INSERT'").join(known, "k", "left_anti"))
    return good.select("k", "v", "change_type"), I.reject_changes(state, net, ["k"], net.limit(0).withColumn("reason", F.lit("")))


def _consume(spark, src, ckpt, root, accept=_accept, **kw):
    return ST.consume_changes(spark, src, STREAM, ckpt, root, accept, ["k"], ["v"], lambda b: I.net_changes(b, ["k"], "seq"), **kw)


def _state(spark, root):
    return sorted(tuple(r) for r in ST.state(spark, root, ["k"], ["v"]).collect())


def test_stream_replay_after_a_lost_stream_commit(spark):
    import os
    import shutil
    src, root, ckpt, again, anew = (scratch_path(spark, n) for n in ("src", "root", "ckpt", "ckpt", "ckpt"))
    ST.bootstrap(root, spark.createDataFrame([(k, 1.0) for k in range(40)], "k long, v double"), ["k"])
    for rows in ([(1, 5.0, "UPDATE", 1), (1, 6.0, "UPDATE", 2), (99, 0.0, "UPDATE", 1), (50, 2.0, "INSERT", 1)],
                 [(2, 7.0, "UPDATE", 1), (3, 0.0, "DELETE", 1), (50, 4.0, "UPDATE", 1), (50, 5.0, "UPDATE", 2), (1, 9.0, "INSERT", 1)]):
        spark.createDataFrame(rows, STREAM).coalesce(1).write.mode("append").parquet(src)
    _consume(spark, src, ckpt, root, max_files_per_trigger=1)
    expect = sorted([(k, {1: 6.0, 2: 7.0}.get(k, 1.0)) for k in range(40)] + [(50, 5.0)])
    numbers = [(0, 3, 1, 1, 1), (1, 4, 2, 0, 2)]

    def check():
        assert _state(spark, root) == expect
        assert sorted(tuple(r) for r in ST.counts(spark, root).collect()) == numbers
        assert sorted((r.k, r.reason) for r in ST.rejects(spark, root).collect()) == [
            (1, "insert key already there"), (3, "delete not applied"), (99, "update key not found")]

    check()
    # the state after a crash between the target's writes and the stream's own commits: offsets there, commits gone
    shutil.copytree(ckpt, again, ignore=shutil.ignore_patterns("commits"))
    os.makedirs(os.path.join(again, "commits"))
    _consume(spark, src, again, root, max_files_per_trigger=1)
    check()
    ST.fold(spark, root, ["k"], ["v"])
    ST.fold(spark, root, ["k"], ["v"])  # nothing left to fold
    check()
    _consume(spark, src, anew, root, max_files_per_trigger=1)  # all checkpoints lost, after the fold
    check()
    spark.createDataFrame([(4, 8.0, "UPDATE", 1)], STREAM).coalesce(1).write.mode("append").parquet(src)
    _consume(spark, src, anew, root, max_files_per_trigger=1)
    assert dict(_state(spark, root))[4] == 8.0 and len(_state(spark, root)) == 41


def test_stream_attempt_that_failed_leaves_nothing_visible(spark):
    src, root, ckpt = (scratch_path(spark, n) for n in ("src", "root", "ckpt"))
    ST.bootstrap(root, spark.createDataFrame([(1, 1.0)], "k long, v double"), ["k"])
    spark.createDataFrame([(1, 5.0, "UPDATE", 1)], STREAM).write.mode("append").parquet(src)

    def failing(state, net):
        accepted, rejects = _accept(state, net)
        return accepted.withColumn("v", F.raise_error(F.lit("late failure")).cast("double")), rejects

    try:
        failed = _consume(spark, src, ckpt, root, failing).exception() is not None
    except Exception:  # noqa: BLE001  awaitTermination raises what the batch raised
        failed = True
    assert failed and _state(spark, root) == [(1, 1.0)] and ST.rejects(spark, root).count() == 0
    _consume(spark, src, ckpt, root)
    assert _state(spark, root) == [(1, 5.0)]


def test_drained_backlog_is_not_applied_again(spark):
    src, root, ckpt = (scratch_path(spark, n) for n in ("src", "root", "ckpt"))
    ST.bootstrap(root, spark.createDataFrame([(1, 1.0)], "k long, v double"), ["k"])
    spark.createDataFrame([(1, 9.0, "UPDATE", 1)], STREAM).write.mode("append").parquet(src)
    ST.drain_changes(spark, src, STREAM, ckpt)
    _consume(spark, src, ckpt, root)
    assert _state(spark, root) == [(1, 1.0)]


def test_net_changes_and_key_guards(spark):
    log = [(1, 1.0, "UPDATE", 1), (1, 2.0, "UPDATE", 2), (2, 1.0, "INSERT", 1), (2, 3.0, "UPDATE", 2), (3, 1.0, "UPDATE", 1),
           (3, 1.0, "DELETE", 2), (4, 1.0, "INSERT", 1), (4, 1.0, "DELETE", 2), (5, 1.0, "DELETE", 1), (5, 8.0, "INSERT", 2)]
    changes = spark.createDataFrame(log, STREAM)
    net = sorted((r.k, r.v, r.change_type) for r in I.net_changes(changes, ["k"], "seq").collect())
    assert net == [(1, 2.0, "UPDATE"), (2, 3.0, "INSERT"), (3, 1.0, "DELETE"), (5, 8.0, "UPDATE")]
    fact = spark.createDataFrame([(10, 1, 0.0), (11, 3, 0.0), (12, 5, 0.0)], "sk long, k long, v double")
    upd = I.apply_updates(fact, changes, ["k"], ["v"], sequence="seq")
    assert sorted((r.k, r.v) for r in upd.collect()) == [(1, 2.0), (3, 0.0), (5, 8.0)]
    ins = I.net_changes(changes, ["k"], "seq").where("change_type = 'INSERT'")
    once = I.apply_inserts(upd, ins, "sk", ["k"], ["k"])
    twice = I.apply_inserts(once, ins, "sk", ["k"], ["k"])  # a replayed insert adds nothing
    assert sorted(r.sk for r in twice.collect()) == sorted(r.sk for r in once.collect()) == [10, 11, 12, 13]
    again = I.reject_changes(once, ins, ["k"], ins.limit(0).withColumn("reason", F.lit("")))
    assert [(r.k, r.reason) for r in again.collect()] == [(2, "insert key already there")]


def test_new_keys_collide_with_no_id_above_a_million(spark):
    from pitchline.plans import q_cdc
    raw = spark.createDataFrame([(i, dt.datetime(2024, 1, 1), 1, "a", 1.0) for i in (39, 1000039, 26, 999987)],
                                "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    new = q_cdc.new_snapshot(raw)
    assert new.count() == new.select("event_id").distinct().count()


def test_clean_start_guard(spark):
    raw = _raw(spark, [(1, "A", "B", 1, 0), (1000001, "A", "B", 1, 0)])
    st = I.assert_clean(raw.limit(0), raw, F.col("match_id") > 1000000).first()
    assert not st.clean and st.marker_rows == 1


def test_scheduled_trigger_runs_and_stops(spark):
    src, root, ckpt = (scratch_path(spark, n) for n in ("src", "root", "ckpt"))
    ST.bootstrap(root, spark.createDataFrame([(1, 1.0)], "k long, v double"), ["k"])
    spark.createDataFrame([(1, 3.0, "UPDATE", 1)], STREAM).write.mode("append").parquet(src)
    # a short interval: processAllAvailable returns after a trigger finds no new data
    q = _consume(spark, src, ckpt, root, every="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert _state(spark, root) == [(1, 3.0)]
