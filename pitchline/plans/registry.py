"""Query registry: name -> DataFrame job, name -> SQL oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.operators.dimensions import cohort_dimension
from pitchline.plans import contests as C

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def current_cohort(spark: SparkSession, sf_dir: str):
    """The latest order year, as a scalar subquery column."""
    return C.landed(spark, sf_dir, "latest-year", lambda: C.table(spark, sf_dir, "orders").select(
        F.max(F.year("o_orderdate")).alias("latest"))).scalar()


def cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.landed(spark, sf_dir, "cohorts", lambda: cohort_dimension(C.contests(spark, sf_dir), key_col=None))
