"""Ordered numbering without a single-partition window.

Global ``ROW_NUMBER() OVER (ORDER BY ...)`` makes Spark move every row into
one partition. Here the order is cut into buckets by fixed splitters
(``operators.ordering``): rows are numbered inside their bucket, and the
counts of the lower buckets (one row per bucket, a bounded broadcast) become
offsets. The rows are shuffled once, by bucket, and not checkpointed.

The same idea gives running sums over a value histogram (mid-ranks, R0).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchline.functions.columns import bounded_broadcast, broadcast_if_small
from pitchline.operators.ordering import before_bucket, ranges, sort_columns
from pitchline.session import cut_lineage


def assign_keys(df: DataFrame, order_cols: Sequence[str], key_col: str = "id",
                start: int | Column = 1, num_partitions: int | None = None, bounded: bool = False) -> DataFrame:
    """K1: dense 1-based row numbers in the given (total) order; ``-name`` descends.

    ``start`` may be a literal or a column (K2 passes max+1 as a column of a
    one-row frame already joined in). ``bounded=True`` is for inputs whose
    size cannot grow with the data (days of a calendar span, years): a plain
    ``row_number`` window and no sample.
    """
    start_c = start if isinstance(start, Column) else F.lit(start)
    order = list(order_cols)
    if bounded:
        w = Window.orderBy(*sort_columns(order))
        return df.withColumn(key_col, (F.row_number().over(w) - 1 + start_c).cast("long"))
    cut = ranges(df, order, num_partitions)
    df = cut.rows_of(df)
    within = Window.partitionBy("_bucket").orderBy(*sort_columns(order))
    rows = df.withColumn("_bucket", cut.bucket(df)).withColumn("_place", F.row_number().over(within))
    if not cut.splitters:
        return rows.withColumn(key_col, (F.col("_place") - 1 + start_c).cast("long")).drop("_bucket", "_place")
    offsets = before_bucket(cut.narrow.select(cut.bucket(cut.narrow).alias("_bucket")), F.count(F.lit(1)))
    return (rows.join(bounded_broadcast(offsets), "_bucket")
            .withColumn(key_col, (F.col("_before") + F.col("_place") - 1 + start_c).cast("long"))
            .drop("_bucket", "_place", "_before").select(*df.columns, key_col))


def append_keys(df: DataFrame, existing: DataFrame, order_cols: Sequence[str],
                key_col: str = "id", existing_key: str | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """K2: continue numbering after ``max(existing_key)`` (0 when empty)."""
    ek = existing_key or key_col
    top = existing.agg(F.coalesce(F.max(ek), F.lit(0)).cast("long").alias("_base"))
    numbered = assign_keys(df, order_cols, key_col, start=1, num_partitions=num_partitions)
    return (numbered.crossJoin(F.broadcast(top))  # one row
            .withColumn(key_col, F.col(key_col) + F.col("_base"))
            .drop("_base"))


def running_total(hist: DataFrame, value_col: str, weight_col: str, by: Sequence[str] = (),
                  out_col: str = "cum", num_partitions: int | None = None, written: bool = False) -> DataFrame:
    """Inclusive running sum of ``weight_col`` in ``value_col`` order, per ``by`` group.

    A histogram with many distinct values (or one huge group) is split across
    buckets, and the sums of the lower buckets are carried as offsets. The
    histogram is an aggregate of the rows, so it is written once for its steps,
    unless it comes ``written``.
    """
    by = list(by)
    hist = hist if written else cut_lineage(hist)
    cut = ranges(hist, [*by, value_col], num_partitions, written=True)
    bucketed = hist.withColumn("_bucket", cut.bucket(hist))
    within = (Window.partitionBy("_bucket", *by).orderBy(*sort_columns([value_col]))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = bucketed.withColumn("_local", F.sum(weight_col).over(within))
    if not cut.splitters:
        return local.withColumn(out_col, F.col("_local")).drop("_bucket", "_local")
    offsets = before_bucket(bucketed, F.sum(weight_col), by)
    # without groups: one row per bucket (bounded); with groups: size-checked
    offsets = bounded_broadcast(offsets) if not by else broadcast_if_small(offsets)
    same = local["_bucket"] == offsets["_bucket"]
    for c in by:  # NULL is a group like others
        same = same & local[c].eqNullSafe(offsets[c])
    return local.join(offsets, same).select(*[local[c] for c in hist.columns],
                                            (offsets["_before"] + local["_local"]).alias(out_col))
