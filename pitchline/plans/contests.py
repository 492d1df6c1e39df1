"""Adapter: the driver's TPC-H-style tables seen as a contest star schema.

One contest = one lineitem row with its order, customer, supplier and part.

* cohort (tournament)   = year(o_orderdate)
* match_date            = o_orderdate as a date
* home team / away team = customer nation / supplier nation (role-playing
  ``nation``; a nation may meet itself, so every lineitem is a contest)
* home / away score     = l_quantity / p_size
* stage                 = o_orderpriority (five ordered values)
* venue                 = supplier nation, with synthetic coordinates
* confederation         = region of the nation; group = nationkey % 6
* shootout flag         = l_returnflag = 'R'
* ranking               = rank of the nation by order spend within the year

Dimension frames derived from ``nation``/``region`` are broadcast after a
check of their size.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.functions.columns import broadcast_if_small
from pitchline.session import default_partitions, scratch_path, written
from pitchline.sources.files import load_bucketed

# Fixed values of the adapter.
GROUP_COUNT = 6
LAT_BASE, LAT_STEP = -60.0, 5.0
LON_BASE, LON_STEP = -170.0, 14.0
# Ordered stage list: (stage name, stage order).
STAGE_ORDER = [
    ("1-URGENT", 1),
    ("2-HIGH", 2),
    ("3-MEDIUM", 3),
    ("4-NOT SPECIFIED", 4),
    ("5-LOW", 5),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team dimension: one row per nation (bounded by the nation table)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    return broadcast_if_small(
        n.join(r, n.n_regionkey == r.r_regionkey).select(
            key.cast("long").alias("team_id"),
            F.col("n_name").alias("team_name"),
            (key % GROUP_COUNT + 1).cast("long").alias("group_id"),
            F.char(F.lit(65) + key % GROUP_COUNT).alias("group_letter"),
            F.col("n_regionkey").cast("long").alias("confederation_id"),
            F.col("r_name").alias("confederation_name"),
        )
    )


def venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venue dimension: one per nation, synthetic coordinates."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    return broadcast_if_small(
        n.join(r, n.n_regionkey == r.r_regionkey).select(
            key.cast("long").alias("venue_id"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            (F.lit(LAT_BASE) + F.lit(LAT_STEP) * key).alias("latitude"),
            (F.lit(LON_BASE) + F.lit(LON_STEP) * key).alias("longitude"),
        )
    )


def stages(spark: SparkSession) -> DataFrame:
    return broadcast_if_small(
        spark.createDataFrame(STAGE_ORDER, "stage_name string, stage_order int"))


def orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined to their customer's nation, projected once.

    Shared by the contest fact and the ranking bridge (same subtree, so the
    shuffles of orders and customer are reused), and joined to lineitem only
    after this smaller join: lineitem-sized data is shuffled once per key.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice", "c_nationkey")


_LANDED: dict[tuple[int, str], dict[str, DataFrame]] = {}


@contextmanager
def landed_contests(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """Within the block, ``contests`` reads one materialisation of the fact.

    For jobs with several consumers of the contest fact (a build, a set of
    marts, a battery of tests): the four-way join runs once and its result is
    written to the shared folder, as a landing table would be, instead of being recomputed per consumer.
    Small tables that several consumers read (``landed``) are written once too.
    """
    key = (id(spark), sf_dir)
    if key in _LANDED:
        yield _LANDED[key]["contests"]
        return
    _LANDED[key] = {"contests": written(_contests(spark, sf_dir), "contests")}
    try:
        yield _LANDED[key]["contests"]
    finally:
        del _LANDED[key]


def landed(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()``, inside ``landed_contests`` written by its first reader and read by the others."""
    tables = _LANDED.get((id(spark), sf_dir))
    if tables is None:
        return build()
    if name not in tables:
        tables[name] = written(build(), name)
    return tables[name]


def contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contest fact with natural keys (the landed copy inside ``landed_contests``)."""
    return landed(spark, sf_dir, "contests", lambda: _contests(spark, sf_dir))


def _contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contest fact with natural keys. Keeps repeated lineitem keys."""
    l = table(spark, sf_dir, "lineitem")
    oc = orders_customers(spark, sf_dir)
    return _with_suppliers_and_parts(spark, sf_dir, l.join(oc, l.l_orderkey == oc.o_orderkey))


def _with_suppliers_and_parts(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    p = table(spark, sf_dir, "part")
    m = (lines.join(broadcast_if_small(s), F.col("l_suppkey") == s.s_suppkey)
         .join(broadcast_if_small(p), F.col("l_partkey") == p.p_partkey))
    return m.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.year("o_orderdate").alias("cohort"),
        F.to_date("o_orderdate").alias("match_date"),
        F.col("c_nationkey").cast("long").alias("home_team_id"),
        F.col("s_nationkey").cast("long").alias("away_team_id"),
        F.col("l_quantity").cast("int").alias("home_score"),
        F.col("p_size").cast("int").alias("away_score"),
        F.col("o_orderpriority").alias("stage_name"),
        F.col("s_nationkey").cast("long").alias("venue_id"),
        (F.col("l_returnflag") == "R").alias("went_to_so"),
    )


def bucketed_partners(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(orders, lineitem), loaded bucketed and sorted by the order key: the layout for tables that are joined often."""
    n = buckets or default_partitions(spark)
    tag = uuid.uuid4().hex
    return tuple(load_bucketed(table(spark, sf_dir, name), f"{name}_{tag}", [key], n, scratch_path(spark, f"bucketed-{name}"))
                 for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")))


def bucketed_contests(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> DataFrame:
    """The contest fact over co-bucketed lineitem and orders: neither is shuffled for the order key."""
    o, l = bucketed_partners(spark, sf_dir, buckets)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    partners = (l.join(o, l.l_orderkey == o.o_orderkey)
                .join(broadcast_if_small(c), F.col("o_custkey") == c.c_custkey))
    return _with_suppliers_and_parts(spark, sf_dir, partners)


def contests_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contests with ``stage_order`` resolved through the stage dimension."""
    return contests(spark, sf_dir).join(stages(spark), "stage_name", "left")


def ranking_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(team, cohort) -> ranking; rank by exact decimal order spend, ties share a rank.

    Bounded by nations x years; the window is partitioned by cohort. The copy
    written inside ``landed_contests`` has a known size, so that joins with it
    are broadcast and leave the contests where they are.
    """
    return broadcast_if_small(landed(spark, sf_dir, "ranking", lambda: _ranking(spark, sf_dir)))


def _ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    spend = (orders_customers(spark, sf_dir)
             .groupBy(F.year("o_orderdate").alias("cohort"),
                      F.col("c_nationkey").cast("long").alias("team_id"))
             .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spend")))
    w = Window.partitionBy("cohort").orderBy(F.desc("spend"))
    return spend.select(
        "team_id", "cohort",
        F.rank().over(w).cast("int").alias("fifa_ranking"),
        F.make_date("cohort", F.lit(1), F.lit(1)).alias("ranking_as_of_date"),
    )


def order_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence input for travel/rest: one row per order of a customer.

    team = customer, match = order, venue = smallest supplier nation among the
    order's lines (NULL for an order without lines).
    """
    o = table(spark, sf_dir, "orders")
    l = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier")
    venue = (l.join(s, l.l_suppkey == s.s_suppkey)
             .groupBy("l_orderkey")
             .agg(F.min(F.col("s_nationkey").cast("long")).alias("venue_id")))
    return (o.join(venue, o.o_orderkey == venue.l_orderkey, "left")
            .select(F.col("o_custkey").alias("team_id"),
                    F.col("o_orderkey").alias("match_id"),
                    F.year("o_orderdate").alias("cohort"),
                    F.to_date("o_orderdate").alias("match_date"),
                    "venue_id"))
