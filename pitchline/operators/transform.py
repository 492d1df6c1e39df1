"""Extract / enrichment transforms."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.functions.columns import broadcast_if_small
from pitchline.session import cut_lineage


def filter_years(df: DataFrame, pred: Column | None, date_col: str, years: Iterable[int]) -> DataFrame:
    """Keep rows matching ``pred`` whose year(date) is in ``years``."""
    cond = F.year(F.col(date_col)).isin(list(years))
    return df.where(cond if pred is None else (pred & cond))


def filter_from_date(df: DataFrame, pred: Column | None, date_col: str, lower: str) -> DataFrame:
    """Keep rows matching ``pred`` with date >= ``lower`` (pushed to the scan)."""
    cond = F.col(date_col) >= F.lit(lower).cast(df.schema[date_col].dataType)
    return df.where(cond if pred is None else (pred & cond))


def _number(c: Column, kind: T.DataType) -> Column:
    """A value of an ordered type as a number that keeps its order (days, microseconds, or the number itself)."""
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(c.cast("timestamp"), F.current_timezone())).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    raise TypeError(f"windows over {kind.simpleString()} have no width")


def interval_lookup(df: DataFrame, value_col: str, windows: DataFrame, out_col: str = "window_name",
                    lo: str = "window_start", hi: str = "window_end", name: str = "window_name",
                    strict: bool = True) -> DataFrame:
    """Attach the name of the inclusive [lo, hi] window holding ``value_col`` (a date, timestamp or number).

    Windows do not overlap, so one row out per row in; of overlapping ones the
    row gets the one with the smallest name. A window belongs to the power of
    two next above its length and so to two bins of that width at most; a row
    looks up one bin per width in use, by equality, with the exact test inside
    the join. The number of bins follows the number of windows, never their
    length, so the windows are broadcast where they are few and the rows stay
    where they are. With ``strict`` an unmatched value raises at run time
    instead of passing silently. Windows with a NULL bound hold nothing.
    """
    kind = windows.schema[lo].dataType
    # a timestamp is looked up among dates by its day
    value = F.col(value_col).cast("date") if isinstance(kind, T.DateType) else F.col(value_col)
    if isinstance(kind, T.TimestampNTZType | T.TimestampType):
        value = value.cast(kind)
    first, last = _number(F.col(lo), kind), _number(F.col(hi), kind)
    level = F.when(last > first, F.ceil(F.log2(last - first))).otherwise(F.lit(0)).cast("int")
    size = F.pow(F.lit(2.0), F.col("_level"))
    bins = (windows.where(F.col(lo) <= F.col(hi)).select(F.col(name).alias("_name"), F.col(lo).alias("_lo"), F.col(hi).alias("_hi"),
                                                         first.alias("_first"), last.alias("_last"), level.alias("_level"))
            .select("_name", "_lo", "_hi", "_level", F.explode(F.array_distinct(F.array(
                F.floor(F.col("_first") / size), F.floor(F.col("_last") / size)))).alias("_bin")))
    bins = cut_lineage(bins)
    levels = sorted(r[0] for r in bins.select("_level").distinct().collect())  # some 100 powers of two at most
    where = _number(value, kind if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType) else df.schema[value_col].dataType)
    out, found = df.withColumn("_value", value).withColumn("_at", where), []
    for k in levels:
        part = broadcast_if_small(bins.where(F.col("_level") == k).select(
            F.col("_bin").alias(f"_bin{k}"), F.col("_lo").alias(f"_lo{k}"), F.col("_hi").alias(f"_hi{k}"), F.col("_name").alias(f"_name{k}")))
        inside = (F.floor(F.col("_at") / 2.0 ** k) == F.col(f"_bin{k}")) & F.col("_value").between(F.col(f"_lo{k}"), F.col(f"_hi{k}"))
        out = out.join(part, inside, "left")
        found.append(F.col(f"_name{k}"))
    label = F.least(*found) if len(found) > 1 else (found[0] if found else F.lit(None).cast(windows.schema[name].dataType))
    if strict:
        missing = F.concat(F.lit("no window holds "), F.coalesce(F.col("_value").cast("string"), F.lit("NULL")))
        label = F.when(label.isNull(), F.raise_error(missing)).otherwise(label)
    return out.select(*df.columns, label.alias(out_col))


def lookup_when(df: DataFrame, cond: Column, map_df: DataFrame, key: str, map_key: str, map_val: str,
                out_col: str, strict: bool = True) -> DataFrame:
    """T4: ``out_col`` = map[key] where ``cond`` holds, else NULL; a missing key under ``cond`` raises."""
    m = broadcast_if_small(map_df.select(F.col(map_key).alias("_k"), F.col(map_val).alias("_v")))
    j = df.join(m, df[key] == F.col("_k"), "left")
    val = F.when(cond, F.col("_v"))
    if strict:
        val = F.when(cond & F.col("_k").isNull(),
                     F.raise_error(F.concat(F.lit("missing lookup key "), F.col(key).cast("string")))).otherwise(val)
    return j.withColumn(out_col, val).drop("_k", "_v")


def derive_flag(df: DataFrame, out_col: str, cond: Column) -> DataFrame:
    """T5: boolean flag column (e.g. knockout = stage <> group stage)."""
    return df.withColumn(out_col, cond)


def project(df: DataFrame, mapping: Sequence[tuple[str, Column | str]]) -> DataFrame:
    """Field-by-field mapping to a target row shape."""
    return df.select(*[(F.col(src) if isinstance(src, str) else src).alias(dst) for dst, src in mapping])


def normalize_values(df: DataFrame, col: str, mapping: dict[str, str]) -> DataFrame:
    """Fold alias values into canonical ones; defined once, used by every caller."""
    if not mapping:
        return df
    c = F.col(col)
    expr = None
    for alias, canon in mapping.items():
        expr = (F.when(c == alias, F.lit(canon)) if expr is None else expr.when(c == alias, F.lit(canon)))
    return df.withColumn(col, expr.otherwise(c))
