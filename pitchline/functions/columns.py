"""Scalar Column helpers (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Mean Earth radius (IUGG), metres: fixed value matching the published
# great-circle distances.
EARTH_RADIUS_M = 6371008.8

# Rounding goes through DECIMAL(38, 9) so that Spark and SQL engines agree on
# half-way cases (binary doubles otherwise round differently per engine).
ROUND_DECIMAL = "decimal(38,9)"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, scale: int) -> Column:
    """ROUND half away from zero on the decimal value, returned as double."""
    return F.round(col_(c).cast(ROUND_DECIMAL), scale).cast("double")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double; NULL when den is 0 or NULL (NULLIF semantics)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def pct(num: str | Column, den: str | Column, scale: int | None = 1) -> Column:
    r = F.lit(100.0) * safe_ratio(num, den)
    return r if scale is None else round_half_up(r, scale)


def count_if(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as long."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def geo_distance_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle (haversine) distance in metres; NULL if any input is NULL."""
    p1, p2 = F.radians(col_(lat1)), F.radians(col_(lat2))
    dphi = p2 - p1
    dlmb = F.radians(col_(lon2)) - F.radians(col_(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    root = F.sqrt(a)
    # clamp rounding overshoot; NULL stays NULL (LEAST would skip it)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.when(root > 1.0, F.lit(1.0)).otherwise(root))


def geo_distance_km(lat1, lon1, lat2, lon2) -> Column:
    return geo_distance_m(lat1, lon1, lat2, lon2) / F.lit(1000.0)


def rest_days(prev_date, cur_date) -> Column:
    """Whole days between two dates (no time-zone step)."""
    return F.datediff(col_(cur_date), col_(prev_date))


def magnitude_label(effect: str | Column, thresholds: tuple[float, float, float]) -> Column:
    """|e| < small/medium/large -> negligible/small/medium/large (lower bounds inclusive)."""
    small, medium, large = thresholds
    m = F.abs(col_(effect))
    return (F.when(m.isNull(), F.lit(None).cast("string"))
            .when(m < small, "negligible")
            .when(m < medium, "small")
            .when(m < large, "medium")
            .otherwise("large"))


def significance_phrase(p: str | Column, alpha: float = 0.05) -> Column:
    """Strict p < alpha on the exact p; p printed with 4 decimals (rounded half up first,
    so every engine prints the same digits)."""
    pc = col_(p)
    shown = F.format_string("%.4f", round_half_up(pc, 4))
    return (F.when(pc.isNull(), F.lit("p undefined"))
            .when(pc < alpha, F.concat(F.lit(f"statistically significant at alpha={alpha} (p="), shown, F.lit(")")))
            .otherwise(F.concat(F.lit(f"not statistically significant at alpha={alpha} (p="), shown, F.lit(")"))))


#: An estimate from here on means that Spark knows nothing of the size (frames of Python rows or of an RDD).
UNKNOWN_BYTES = 1 << 62
#: Rows up to which a frame of unknown size is counted.
COUNT_ROWS = 10_000


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size of ``df``.

    Where it has none, the rows are counted up to ``COUNT_ROWS`` and sized by
    their types; a longer frame stays of unknown size.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size < UNKNOWN_BYTES:
        return size
    rows = df.limit(COUNT_ROWS + 1).count()
    return size if rows > COUNT_ROWS else rows * (8 + df._jdf.schema().defaultSize())


def broadcast_if_small(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast hint only when the size of ``df`` is known to be ``max_bytes`` at most.

    Beyond the bound the frame is returned unhinted, so the join stays a
    shuffle join (and AQE may still switch it at run time).
    """
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a frame whose row count is bounded by construction.

    Callers use this only for frames with a proven bound that does not grow
    with the data (fixed lists, one row per partition, per nation/region).
    """
    return F.broadcast(df)
