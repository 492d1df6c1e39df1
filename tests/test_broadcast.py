"""The size-checked broadcast really hints, and only below its bound."""

import pytest
from pyspark.sql import functions as F

from pitchline.functions import columns as C
from pitchline.operators import dimensions, transform
from pitchline.session import scratch_path


@pytest.fixture
def no_auto(spark):
    """Spark's own threshold off: a broadcast in a plan comes from a hint."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hinted(df):
    return "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()


def test_hint_for_rows_files_and_aggregates(spark):
    path = scratch_path(spark, "small")
    spark.range(100).write.parquet(path)
    small = [spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.read.parquet(path),
             spark.read.parquet(path).groupBy((F.col("id") % 3).alias("k")).count()]
    for df in small:
        assert C.estimated_bytes(df) <= 64 << 20 and hinted(C.broadcast_if_small(df))
        assert not hinted(C.broadcast_if_small(df, max_bytes=1))
    assert C.estimated_bytes(spark.createDataFrame([(1, 2)] * 5, "k int, v long")) == 5 * (8 + 4 + 8)


def test_no_hint_for_long_frames_of_unknown_size(spark, monkeypatch):
    monkeypatch.setattr(C, "COUNT_ROWS", 3)
    long = spark.createDataFrame([(k,) for k in range(10)], "k int")
    assert C.estimated_bytes(long) >= C.UNKNOWN_BYTES and not hinted(C.broadcast_if_small(long))


def test_operators_broadcast_their_small_sides(spark, no_auto):
    facts = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int") % 90).alias("d"),
                                     F.concat(F.lit("s"), F.col("id") % 3).alias("stage"))
    windows = spark.createDataFrame([("w", "2024-01-01", "2024-04-01")], "window_name string, lo string, hi string").select(
        "window_name", F.col("lo").cast("date").alias("window_start"), F.col("hi").cast("date").alias("window_end"))
    names = spark.createDataFrame([("s0", "zero"), ("s1", "one")], "a string, b string")
    order = spark.createDataFrame([("s0", 1), ("s1", 2)], "name string, place int")
    plans = [plan(transform.interval_lookup(facts, "d", windows)),
             plan(transform.lookup_when(facts, F.col("k") < 9, names, "stage", "a", "b", "v", strict=False)),
             plan(dimensions.ordered_dimension(facts, "stage", order, "name", "place", "d", "id"))]
    for p in plans:
        assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
