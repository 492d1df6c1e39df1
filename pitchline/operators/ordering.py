"""Order-preserving buckets: a total order cut into ranges by fixed splitters.

Spark's own range partitioner samples its input whenever a plan runs, so two
evaluations can cut it differently, and numbering needs two: one that counts
the ranges and one that numbers the rows. Here the splitters are data. They
come from a uniform sample (samples merge, whatever the partitioning) of the
order columns alone, which are written once; every later step computes a
row's bucket from the same list. The rows themselves are then shuffled once,
by bucket, and never checkpointed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchline.session import default_partitions, written as write_narrow

#: Tables of so many rows at most are one bucket.
SMALL_ROWS = 50_000
#: Sampled rows per bucket; all of them reach the driver.
SAMPLE_PER_BUCKET = 50
#: Buckets per shuffle partition: their hash spreads more evenly than one apiece.
BUCKETS_PER_PARTITION = 4


def ascending(column: str) -> tuple[str, bool]:
    """(name, whether it ascends) of an order column; ``-name`` descends."""
    return (column[1:], False) if column.startswith("-") else (column, True)


def sort_columns(order: Sequence[str], reverse: bool = False) -> list[Column]:
    """Sort order of the columns: NULL first where ascending, last where descending; NaN above all numbers."""
    return [F.asc(c) if up != reverse else F.desc(c) for c, up in map(ascending, order)]


@dataclass(frozen=True)
class Ranges:
    """Splitters of a total order, and the written order columns they were drawn from."""

    order: tuple[str, ...]
    splitters: tuple[tuple, ...]
    narrow: DataFrame

    def bucket(self, df: DataFrame) -> Column:
        """Number of splitters that do not come after the row (binary search; equal rows share a bucket).

        The search runs in a lambda, which is interpreted: its state is one
        number, and plain columns meet plain arrays, a column at a time.
        """
        if not self.splitters:
            return F.lit(0)
        n = len(self.splitters)
        parts = []
        for i, (c, up) in enumerate(map(ascending, self.order)):
            values = [row[i] for row in self.splitters]
            parts.append((F.col(c), up, F.array(*[F.lit(v).cast(df.schema[c].dataType) for v in values]), None in values))

        def step(low: Column, size: Column) -> Column:
            at = low + size - 1
            before = None  # the row lies before this splitter
            for x, up, table, nulls in reversed(parts):
                y = F.get(table, at)
                if nulls:  # NULL is the smallest
                    below, above, same = F.coalesce(x < y, x.isNull() & y.isNotNull()), F.coalesce(x > y, x.isNotNull() & y.isNull()), x.eqNullSafe(y)
                else:
                    below, above, same = F.coalesce(x < y, F.lit(True)), F.coalesce(x > y, F.lit(False)), F.coalesce(x == y, F.lit(False))
                first = below if up else above
                before = first if before is None else first | (same & before)
            return low + F.when((at < n) & ~before, size).otherwise(0)

        sizes = [1 << k for k in reversed(range(n.bit_length()))]
        return F.aggregate(F.array(*[F.lit(k) for k in sizes]), F.lit(0), step)

    def rows_of(self, df: DataFrame) -> DataFrame:
        """``df``, read from the written frame where that has all its columns."""
        return self.narrow.select(*df.columns) if set(df.columns) <= set(self.narrow.columns) else df


def ranges(df: DataFrame, order: Sequence[str], num_partitions: int | None = None, keep: Sequence[str] = (),
           written: bool = False) -> Ranges:
    """Cut the order of ``df`` into some ``BUCKETS_PER_PARTITION`` buckets per partition.

    ``keep`` names further columns of the written narrow frame; ``written``
    says that ``df`` is a table already. The sample is ``SAMPLE_PER_BUCKET``
    rows a bucket, whatever the number of rows. Splitters hold the shortest
    run of leading order columns of which no value fills half a bucket.
    """
    names = [ascending(c)[0] for c in order]
    narrow = df.select(*dict.fromkeys([*names, *keep]))
    narrow = narrow if written else write_narrow(narrow, "order-columns")
    rows = narrow.count()
    buckets = BUCKETS_PER_PARTITION * (num_partitions or default_partitions(df.sparkSession))
    if rows <= SMALL_ROWS or buckets < 2:
        return Ranges(tuple(order), (), narrow)
    wanted = SAMPLE_PER_BUCKET * buckets
    sample = narrow.select(*names).sample(min(1.0, wanted / rows), seed=7)
    drawn = sample.coalesce(1).orderBy(*sort_columns(order)).collect()  # about ``wanted`` rows
    if not drawn:
        return Ranges(tuple(order), (), narrow)
    columns = 1
    while columns < len(names) and max(Counter(tuple(map(repr, r[:columns])) for r in drawn).values()) * buckets * 2 > len(drawn):
        columns += 1
    cuts = [tuple(drawn[len(drawn) * k // buckets][:columns]) for k in range(1, buckets)]
    return Ranges(tuple(order[:columns]), tuple(c for k, c in enumerate(cuts) if not k or repr(c) != repr(cuts[k - 1])), narrow)


def before_bucket(df: DataFrame, total: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by..., _bucket, _before): sum of ``total`` over the lower buckets, from one row per bucket (and group)."""
    parts = df.groupBy(*by, "_bucket").agg(total.alias("_total"))
    lower = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(*by, "_bucket", F.coalesce(F.sum("_total").over(lower), F.lit(0)).alias("_before"))
