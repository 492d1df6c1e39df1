"""Property tests: the distributed K1 / R0 / LAG equal their single-partition definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from pitchline.operators import stats as R
from pitchline.operators.keys import assign_keys
from pitchline.operators.sequence import lag_within

ROWS = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30), st.integers(-5, 5)), min_size=1, max_size=60)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 5))
def test_keys_equal_row_number(spark, rows, parts):
    df = spark.createDataFrame([(g, t, v, i) for i, (g, t, v) in enumerate(rows)], "g int, t int, v int, i int")
    order = ["g", "t", "i"]  # total order
    got = {r.i: r.sk for r in assign_keys(df, order, "sk", num_partitions=parts).collect()}
    want = {r.i: r.rn for r in df.select("i", F.row_number().over(Window.orderBy(*order)).alias("rn")).collect()}
    assert got == want


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 5))
def test_lag_equals_window_lag(spark, rows, parts):
    df = spark.createDataFrame([(g, t, v, i) for i, (g, t, v) in enumerate(rows)], "g int, t int, v int, i int")
    got = {r.i: (r.previous_v, r.previous_i) for r in
           lag_within(df, ["g"], ["t", "i"], ["v", "i"]).collect()}
    w = Window.partitionBy("g").orderBy("t", "i")
    want = {r.i: (r.pv, r.pi) for r in df.select("i", F.lag("v").over(w).alias("pv"), F.lag("i").over(w).alias("pi")).collect()}
    assert got == want


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 5))
def test_mid_ranks_equal_average_ranks(spark, rows, parts):
    vals = [v for _, _, v in rows]
    df = spark.createDataFrame([(v,) for v in vals], "v int")
    got = {r.v: r.rank for r in R.rank_histogram(df, "v", num_partitions=parts).collect()}
    s = sorted(vals)
    want = {v: (s.index(v) + 1 + len(s) - s[::-1].index(v)) / 2 for v in set(vals)}
    assert got == want
