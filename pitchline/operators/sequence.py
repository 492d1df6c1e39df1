"""Previous-row lookup (LAG) that survives a hot partition key.

``lag(...) OVER (PARTITION BY team, cohort ORDER BY date, id)`` sends every
row of one team to one task. If one team holds a third of the data, that task
holds a third of the data. Here the order (key, then order columns) is cut
into buckets by fixed splitters (``operators.ordering``), so a hot key spans
as many buckets as its rows need, for order columns of any type and direction.
The rows are shuffled once, by bucket; only the last row of every bucket is
carried into the next one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchline.functions.columns import bounded_broadcast
from pitchline.operators.ordering import ranges, sort_columns


def lag_within(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
               value_cols: Sequence[str], prefix: str = "previous_", num_partitions: int | None = None) -> DataFrame:
    """Add ``prefix + v`` = value of ``v`` on the previous row of the same key.

    NULL keys are a key of their own. Order columns may descend (``-name``);
    NULL comes first in ascending columns and last in descending ones, NaN
    counts above all numbers, as in Spark's own sort.
    """
    part, order, values = list(partition_cols), list(order_cols), list(value_cols)
    whole = [*part, *order]
    cut = ranges(df, whole, num_partitions, keep=values)
    df = cut.rows_of(df)
    if not cut.splitters:
        w = Window.partitionBy(*part).orderBy(*sort_columns(order))
        return df.select("*", *[F.lag(v).over(w).alias(prefix + v) for v in values])
    rows = df.withColumn("_bucket", cut.bucket(df))
    carried = F.struct(F.struct(*part).alias("key"), F.struct(*values).alias("values"))
    # the last row per bucket, cut down to one a task before its small shuffle
    back = Window.partitionBy("_bucket").orderBy(*sort_columns(whole, reverse=True))
    last = (cut.narrow.withColumn("_bucket", cut.bucket(cut.narrow)).withColumn("_back", F.row_number().over(back))
            .where(F.col("_back") == 1).groupBy("_bucket").agg(F.first(carried).alias("_last")))  # one row each
    edges = last.select("_bucket", F.lag("_last").over(Window.partitionBy(F.lit(0)).orderBy("_bucket")).alias("_edge"))
    w = Window.partitionBy("_bucket").orderBy(*sort_columns(whole))
    out = (rows.withColumn("_before", F.lag(carried).over(w)).withColumn("_first", F.row_number().over(w) == 1)
           .join(bounded_broadcast(edges), "_bucket", "left")  # one row per bucket
           .withColumn("_before", F.when(F.col("_first"), F.col("_edge")).otherwise(F.col("_before"))))
    same = F.lit(True)
    for c in part:
        same = same & F.col(f"_before.key.{c}").eqNullSafe(F.col(c))
    return out.select(*df.columns, *[F.when(same, F.col(f"_before.values.{v}")).alias(prefix + v) for v in values])
